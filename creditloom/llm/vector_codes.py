"""Vector code compression: product codes whose entries are searched along tries of parts.

Vectors are cut into equal parts, each with a codebook of its own.  The distinct parts of a
position, in lexicographic order, are the leaves of a trie whose edges are components.  A walk
in depth-first order keeps, for every node on the path, the distances from the node's components
to those of all entries; parts with a common beginning share them, so a component that several
leaves have in common is subtracted and squared once.  A leaf takes the nearest entry and adds
its part, times the number of vectors that hold it, to the sums of that entry.

The distinct parts and their counts are made once, with map-side combination, and written in
ranges of neighbouring parts, so each task has whole subtrees; a round only reads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.vectors import column_sums, floor_division_sql, floored_sql, integer_rows, lists, matrix
from creditloom.session import cut_lineage

DIM, SCALE, PARTS, ENTRIES, ROUNDS = 64, 1024, 4, 256, 4
# Neighbouring leaves that are walked side by side, depth by depth.
LEAVES = 256
# A table of label totals with at most so many rows is broadcast.
BROADCAST_ROWS = 100_000


def trie_nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each part; ties go to the lower index.

    ``parts`` are sorted lexicographically.  Held are the accumulated distances of one path and
    of ``LEAVES`` leaves, whatever the number of parts.
    """
    n, width = parts.shape
    nearest, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    if not n:
        return nearest, distance
    widest = int(max(np.abs(parts).max(), np.abs(entries).max()))
    kind = np.int32 if width * (2 * widest) ** 2 < 1 << 31 else np.int64  # exact in either
    by_depth = np.ascontiguousarray(entries.T.astype(kind))
    parts = parts.astype(kind)
    differs = parts[1:] != parts[:-1]
    # Components that a part has in common with the one before it; equal parts have all.
    common = np.concatenate([[0], np.where(differs.any(axis=1), differs.argmax(axis=1), width)])
    path = [np.zeros((1, len(entries)), kind)] + [None] * width
    for low in range(0, n, LEAVES):
        block, shared = parts[low : low + LEAVES], common[low : low + LEAVES]
        sums = path[0]
        node = np.zeros(len(block), np.int64)
        for depth in range(width):
            new = shared <= depth
            made = np.flatnonzero(new)
            apart = block[made, depth][:, None] - by_depth[depth][None, :]
            apart *= apart
            apart += sums[node[made]]
            carried = not new[0]  # the first leaf goes on in a node of the last block
            sums = np.concatenate([path[depth + 1], apart]) if carried else apart
            node = np.cumsum(new) - (0 if carried else 1)
            path[depth + 1] = sums[-1:].copy()
        at = sums.argmin(axis=1)
        nearest[low : low + LEAVES] = at[node]
        distance[low : low + LEAVES] = sums[np.arange(len(sums)), at][node]
    return nearest, distance


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """(position, part, n): how many vectors hold each part, in ranges of neighbouring parts."""
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("v", p * width + 1, width))
    found = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("n"))
    return cut_lineage(found.repartitionByRange("position", "part").sortWithinPartitions("position", "part"))


def _sums(shared, width: int):
    """Per task: (position, entry, n, sums) over the parts that it has read, by their counts."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        n = np.zeros(books.shape[:2], np.int64)
        sums = np.zeros(books.shape, np.int64)
        for batch in batches:
            position, weight = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            part = matrix(batch.column(1), width)
            for p in np.unique(position):
                mine = np.flatnonzero(position == p)
                mine = mine[np.lexsort(part[mine].T[::-1])]
                at, _ = trie_nearest(part[mine], books[p])
                np.add.at(sums[p], at, part[mine] * weight[mine][:, None])
                np.add.at(n[p], at, weight[mine])
        position, entry = np.nonzero(n)
        columns = [pa.array(position), pa.array(entry), pa.array(n[position, entry]), lists(sums[position, entry])]
        yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "n", "sums"])

    return partial


def fit(rows: DataFrame, parts: int, width: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks as (position, entry, component) after ``rounds`` rounds over ``rows`` (vec_id, v).

    They start as the parts of the ``entries`` smallest ids (null ids last, ties by components).
    """
    spark = rows.sparkSession
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    if not first:
        return books
    counted = distinct_parts(rows, parts, width)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        found = counted.mapInArrow(_sums(shared, width), "position long, entry long, n long, sums array<long>")
        sums = column_sums(found, ["position", "entry"], width)
        books = books.copy()
        for r in sums:
            books[r["position"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
        shared.destroy()
    return books


def _coded(shared, width: int):
    """Batches of vectors to codes: a trie of each batch's distinct parts, leaf results by vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            v = matrix(batch.column(1), width * len(books))
            codes = np.empty((len(v), len(books)), np.uint8)
            error = np.zeros(len(v), np.int64)
            for p, book in enumerate(books):
                different, where = np.unique(v[:, p * width : (p + 1) * width], axis=0, return_inverse=True)
                at, away = trie_nearest(different, book)
                codes[:, p] = at[where]
                error += away[where]
            columns = [batch.column(0), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return code


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): one byte for each part; null where ``v`` is null."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long"
    known = rows.where(F.col("v").isNotNull()).select("vec_id", "v", "label")
    if books.size:
        shared = rows.sparkSession.sparkContext.broadcast(books)
        known = known.mapInArrow(_coded(shared, books.shape[2]), out)
    else:
        known = rows.sparkSession.createDataFrame([], out)
    nowhere = rows.where(F.col("v").isNull()).select("vec_id", "label")
    return cut_lineage(known.unionByName(nowhere, allowMissingColumns=True))


def decoded(code: bytes, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([book[at] for book, at in zip(books, code, strict=True)])


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    dim: int = DIM, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error, label_error), codebooks) of every finite vector.

    A component x counts as floor(scale * x).  Rows whose vector is null or holds a null, NaN or
    infinite component have no output row.  error is the squared distance from the vector to
    what its code stands for, label_error its sum over the rows of a label, nulls together.

    Repeated rows and ids keep one output row each and count as often.  Fewer than ``entries``
    vectors make smaller codebooks; equal distances go to the lower index.  A vector of another
    length than ``dim``, which cannot be cut, or with a component beyond ``WIDEST``, whose
    distances would not fit a long, has null code and error.  A sum beyond a long is null.  An
    empty table gives no rows; other columns are not looked at.
    """
    if dim % parts or not 0 < entries <= 256:
        raise ValueError("parts must divide dim, and a code byte numbers at most 256 entries")
    rows = cut_lineage(integer_rows(vectors, vec_id, vector, scale, dim, F.col(label).alias("label")))
    books = fit(rows.where(F.col("v").isNotNull()), parts, dim // parts, entries, rounds)
    coded = encode(rows, books)
    # A label may hold a third of all rows: totals are combined map-side and joined back.
    totals = cut_lineage(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")))
    if totals.count() <= BROADCAST_ROWS:
        totals = F.broadcast(totals)
    same = coded["label"].eqNullSafe(totals["label"])
    return coded.join(totals, same, "left").select(coded["vec_id"], coded["label"], "code", "error", "label_error"), books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def digest(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), the code as two hex digits a part."""
    found, books = compress(vectors)
    return found.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codebooks_sha256(books)).alias("codebooks_sha256"),
    )


def oracle(dim: int = DIM, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB text of the query: every part against every entry of its codebook, round by round."""
    width = dim // parts
    texts = [
        f"kept AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id, v) - 1 AS i FROM ({floored_sql(scale, dim, ', label')}))",
        f"part AS MATERIALIZED (SELECT i, p, list_slice(v, p * {width} + 1, (p + 1) * {width}) AS x FROM kept, range({parts}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, i AS e, x AS w FROM part WHERE i < {entries})",
    ]
    squared = "list_sum(list_transform(list_zip(x, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(rounds + 1):
        texts.append(f"""a{r} AS MATERIALIZED (SELECT i, p, min(d) AS d, arg_min(e, d * {entries} + e) AS e FROM (
  SELECT i, part.p, e, CAST({squared} AS BIGINT) AS d FROM part JOIN b{r} b ON part.p = b.p) m GROUP BY i, p)""")
        if r < rounds:
            texts.append(f"""b{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(n.w, o.w) AS w FROM b{r} o LEFT JOIN (
  SELECT p, e, list({floor_division_sql('s', 'n')} ORDER BY j) AS w FROM (
    SELECT a.p, e, j, sum(x[j]) AS s, count(*) AS n FROM a{r} a JOIN part ON a.i = part.i AND a.p = part.p,
           range(1, {width + 1}) t(j) GROUP BY a.p, e, j) s GROUP BY p, e) n ON n.p = o.p AND n.e = o.e)""")
    return "WITH " + ",\n".join(texts) + f""",
coded AS (SELECT i, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY i)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (i)"""
