"""Integer vectors shared by the vector operators: which rows count, and arrays out of Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer components up to this size keep every squared distance of 64 of them inside a long.
WIDEST = 1 << 27


def finite(vector: str) -> Column:
    """Whether the vector is there and holds neither nulls nor NaN nor infinities."""
    there = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(there, F.lit(False))


def floored(vector: str, scale: int) -> Column:
    """Each component x as floor(scale * x); null components where the integer would not fit."""

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) <= WIDEST, y).cast("int")

    return F.transform(F.col(vector), whole)


def integer_rows(vectors: DataFrame, vec_id: str, vector: str, scale: int, dim: int, *others: Column) -> DataFrame:
    """(vec_id, v, others): finite vectors; v is null where the length or a component does not fit."""
    rows = vectors.where(finite(vector)).select(
        F.col(vec_id).alias("vec_id"), floored(vector, scale).alias("v"), *others
    )
    fits = (F.size("v") == dim) & F.forall("v", lambda x: x.isNotNull())
    return rows.withColumn("v", F.when(fits, F.col("v")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column without nulls, as a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def column_sums(parts: DataFrame, keys: list[str], dim: int) -> list:
    """One row for each key: (*keys, n, s0, s1, ...), the totals of partial ``n`` and ``sums``.

    What the tasks send has at most one row for each task and key, so hot keys stay small.
    """
    totals = [F.sum("n").alias("n")] + [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    return parts.groupBy(*keys).agg(*totals).collect()


def floored_sql(scale: int, dim: int, others: str = "") -> str:
    """DuckDB text of the kept vectors as integers: (vec_id, v, others)."""
    return f"""SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v{others}
FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}"""


def floor_division_sql(a: str, b: str) -> str:
    """DuckDB divides integers towards zero; this goes down."""
    return f"CAST(({a} - (({a} % {b}) + {b}) % {b}) // {b} AS BIGINT)"
