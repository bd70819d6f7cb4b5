"""Feature store on partitioned tables: upsert, as-of lookup, JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.plans.asof import backward_asof
from creditloom.session import cut_lineage
from creditloom.sources.tables import SCHEMAS

STORE_KEYS = ["company_id", "feature_date"]


def clean_number(column: Column) -> Column:
    """Non-finite numbers become null: JSON has no NaN."""
    value = column.cast("double")
    infinite = value.isin(float("inf"), float("-inf"))
    return F.when(F.isnan(value) | infinite, None).otherwise(value)


def encode_json(df: DataFrame, features, name: str = "features_json") -> DataFrame:
    """Features as one JSON object; missing values stay in it as null."""
    pairs = F.map_from_arrays(
        F.array(*[F.lit(f) for f in features]), F.array(*[clean_number(F.col(f)) for f in features])
    )
    return df.select(*[c for c in df.columns if c not in features], F.to_json(pairs).alias(name))


def decode_json(df: DataFrame, features, name: str = "features_json") -> DataFrame:
    """JSON objects back to typed columns; keys the object lacks are null."""
    schema = ", ".join(f"{f} DOUBLE" for f in features)
    parsed = df.withColumn("_f", F.from_json(name, schema))
    return parsed.select(*[c for c in df.columns if c != name], *[F.col(f"_f.{f}").alias(f) for f in features])


def merge_versions(stored: DataFrame, incoming: DataFrame, order: str = "created_at") -> DataFrame:
    """Last write for each (company, date) wins.

    The winner is an aggregate, so versions of a hot key are reduced before the shuffle.
    """
    rest = [c for c in stored.columns if c not in STORE_KEYS]
    both = stored.unionByName(incoming.select(*stored.columns))
    newest = both.groupBy(*STORE_KEYS).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*STORE_KEYS, "_row.*")


def store_schema() -> str:
    return SCHEMAS["feature_vectors"]


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(store_schema()).parquet(path)


def upsert(spark: SparkSession, path: str, incoming: DataFrame) -> None:
    """Merge ``incoming`` into the store, rewriting only the dates it touches.

    The merged dates are written to a staging folder first: a table must not be overwritten
    while it is being read.
    """
    touched = incoming.select("feature_date").distinct()
    try:
        stored = read_store(spark, path).join(touched, "feature_date", "left_semi")
        stored = stored.select(*incoming.columns)
    except Exception as missing:  # the first write creates the table
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        stored = incoming.limit(0)
    merged = cut_lineage(merge_versions(stored, incoming))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("feature_date").parquet(path)


def lookup_as_of(requests: DataFrame, store: DataFrame, payload) -> DataFrame:
    """Latest stored vector on or before each (company_id, as_of_date); null if none."""
    return backward_asof(requests, store, "company_id", "as_of_date", "feature_date", payload)


def feature_vectors(transaction_vector: DataFrame, alternative: DataFrame) -> DataFrame:
    """Both feature families for every company of the spine."""
    joined = alternative.join(transaction_vector, ["company_id", "as_of_date"], "left")
    return joined.withColumnRenamed("as_of_date", "feature_date")


def attach_labels(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    return vectors.join(labels.select("company_id", "defaulted"), "company_id", "left")
