"""Backward as-of join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backward_asof(
    requests: DataFrame, versions: DataFrame, key: str, request_date: str, version_date: str, payload
) -> DataFrame:
    """For each request the payload of the latest version dated on or before it.

    Requests are reduced to distinct (key, date) and versions are unique by (key, date), so a
    key has at most two rows per calendar day, however many requests it has; one pass carries
    the last version forward instead of pairing requests with versions.
    """
    payload = list(payload)
    body = F.struct(F.col(version_date), *payload)
    latest = versions.groupBy(key, version_date).agg(F.max(F.struct(*payload)).alias("_p")).select(
        key, version_date, "_p.*"
    )
    marks = requests.select(key, F.col(request_date).alias("_at")).distinct()
    line = (
        latest.select(key, F.col(version_date).alias("_at"), F.lit(0).alias("_kind"), body.alias("_body"))
        .unionByName(marks.select(key, "_at", F.lit(1).alias("_kind")), allowMissingColumns=True)
    )
    upto = Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        line.withColumn("_body", F.last("_body", ignorenulls=True).over(upto))
        .where("_kind = 1")
        .select(key, F.col("_at").alias(request_date), "_body.*")
    )
    return requests.join(carried, [key, request_date], "left")
