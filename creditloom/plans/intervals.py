"""Join of points with ranges of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(
    points: DataFrame, ranges: DataFrame, key: str, at: str, first: str, last: str, bucket_days: int = 32
) -> DataFrame:
    """Every point with every range of its key that holds its day (both ends included).

    Time is cut into buckets of ``bucket_days``.  A range goes to each bucket that it touches, a
    point to its own, so the two meet once; whether the day lies in the range is then asked
    exactly.  A hot key is spread over as many join keys as its history has buckets.  Ranges that
    end before they begin, and null days, meet nothing.
    """
    bucket = lambda d: F.floor(F.unix_date(d) / bucket_days).cast("int")
    cut = ranges.where(F.col(first) <= F.col(last)).withColumn(
        "_bucket", F.explode(F.sequence(bucket(first), bucket(last)))
    )
    return (
        points.withColumn("_bucket", bucket(at))
        .join(cut, [key, "_bucket"])
        .where(F.col(at).between(F.col(first), F.col(last)))
        .drop("_bucket")
    )
