"""Point-in-time features from reviews, headcount, local vacancy and the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.txn_features import KEYS, as_of_rows, spine_of
from creditloom.session import cut_lineage

DECAY_DAYS = 30.0
REGISTRY = ["number_of_officers", "number_of_shareholders", "share_capital", "mortgages_count", "charges_count"]
REGISTRY_NAMES = ["num_officers", "num_shareholders", "share_capital", "mortgages_count", "charges_count"]


def _days_ago(date: str) -> Column:
    return F.datediff("as_of_date", date)


def day_sums(rows: DataFrame, keys, date: str, value: str) -> DataFrame:
    """Per (keys, date) what a trend in (date, value) order needs of the day's rows.

    m: rows; k: rows with a value; y: their sum; r, rr and ry: sums of the ranks 0.. inside the
    day, of their squares and of rank times value, over rows with a value; top: the largest
    value.  Equal rows are interchangeable, so they are counted first, and a day's distinct
    values are ordered by themselves: no company's history comes together in one task.
    """
    keys = list(keys)
    counts = rows.groupBy(*keys, date, value).agg(F.count("*").alias("_c"))
    lower = Window.partitionBy(*keys, date).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    s, c = F.col("_s"), F.col("_c").cast("double")
    counts = counts.withColumn("_s", F.coalesce(F.sum("_c").over(lower), F.lit(0)).cast("double"))
    y = F.col(value).cast("double")
    r = c * s + c * (c - 1) / 2
    rr = c * s * s + s * c * (c - 1) + (c - 1) * c * (2 * c - 1) / 6
    there = lambda e: F.sum(F.when(y.isNotNull(), e).otherwise(F.lit(0.0)))
    return counts.groupBy(*keys, date).agg(
        F.sum("_c").alias("m"), there(c).alias("k"), there(c * y).alias("y"), there(r).alias("r"),
        there(rr).alias("rr"), there(r * y).alias("ry"), F.max(value).alias("top"),
    )


def numbered_sums(days: DataFrame, earlier: Column) -> DataFrame:
    """``day_sums`` with x, xx and xy: the sums with numbers that go on from day to day.

    ``earlier`` is the number of rows before the day.
    """
    s = earlier.cast("double")
    return days.withColumns({
        "x": F.col("k") * s + F.col("r"),
        "xx": F.col("k") * s * s + F.lit(2.0) * s * F.col("r") + F.col("rr"),
        "xy": s * F.col("y") + F.col("ry"),
    })


def slope_of(k: Column, x: Column, xx: Column, y: Column, xy: Column) -> Column:
    """Least-squares slope from sums; null without two numbers."""
    return F.try_divide(k * xy - x * y, k * xx - x * x)


def _numbered(rows: DataFrame, date: str, value: str) -> DataFrame:
    """The days of each (company, as-of date), numbered through; a day is one row."""
    days = day_sums(rows, KEYS, date, value)
    upto = Window.partitionBy(*KEYS).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    return numbered_sums(days, F.coalesce(F.sum("m").over(upto), F.lit(0)))


def _slope() -> Column:
    return slope_of(*[F.sum(n) for n in ("k", "x", "xx", "y", "xy")])


def sentiment_features(reviews: DataFrame, as_of) -> DataFrame:
    """Decayed mean sentiment, its trend in (date, score) order, and reviews a month."""
    days = _numbered(as_of_rows(reviews, as_of, "review_date"), "review_date", "sentiment_score")
    weight = F.exp(-_days_ago("review_date") / F.lit(DECAY_DAYS))
    stats = days.groupBy(*KEYS).agg(
        F.sum("m").alias("n"),
        F.sum(F.when(F.col("k") > 0, F.col("y") * weight)).alias("weighted"),
        F.sum(F.col("m") * weight).alias("weights"),
        _slope().alias("slope"),
        F.sum(F.when(_days_ago("review_date") <= 90, F.col("m")).otherwise(0)).alias("recent"),
    )
    enough = F.col("n") >= 3
    return stats.select(
        *KEYS,
        F.when(enough, F.try_divide("weighted", "weights")).alias("google_sentiment_mean"),
        F.when(F.col("n") >= 6, F.col("slope")).when(enough, F.lit(0.0)).alias("google_sentiment_trend"),
        F.when(enough, F.col("recent") / F.lit(3.0)).alias("google_review_velocity"),
    )


def rating_features(reviews: DataFrame, as_of) -> DataFrame:
    """Recent review count and mean rating of companies that have reviews."""
    rows = as_of_rows(reviews, as_of, "review_date")
    return rows.groupBy(*KEYS).agg(
        F.count_if(_days_ago("review_date") <= 90).alias("trustpilot_90d_count"),
        F.avg(F.col("rating").cast("double")).alias("trustpilot_rating_mean"),
    )


def headcount_features(headcount: DataFrame, as_of) -> DataFrame:
    """Relative headcount growth (from 4 points) and latest headcount (from 2).

    Several headcounts of one day count from the lowest to the highest.
    """
    days = _numbered(as_of_rows(headcount, as_of, "scrape_date"), "scrape_date", "headcount_estimate")
    stats = days.groupBy(*KEYS).agg(
        F.sum("m").alias("n"),
        _slope().alias("slope"),
        F.try_divide(F.sum("y"), F.sum("k")).alias("mean"),
        F.max_by("top", "scrape_date").alias("latest"),
    )
    growth = F.when(F.col("mean") > 0, F.try_divide("slope", "mean")).otherwise(F.lit(0.0))
    return stats.select(
        *KEYS,
        F.when(F.col("n") >= 4, growth).alias("headcount_growth_rate"),
        F.when(F.col("n") >= 2, F.col("latest")).alias("headcount_latest"),
    )


def area_spine(companies: DataFrame, as_of) -> DataFrame:
    """(company, area, as-of date); the area is the first two characters, kept as text."""
    area = "postcode_area" if "postcode_area" in companies.columns else "postcode"
    located = companies.select("company_id", F.substring(area, 1, 2).alias("postcode_area"))
    return located.join(spine_of(companies, as_of), "company_id")


def vacancy_features(companies: DataFrame, vacancy: DataFrame, as_of) -> DataFrame:
    """Latest local vacancy rate and its trend.

    Areas and as-of dates are few, so their features are computed once for each
    (area, date) and then looked up by the companies.
    """
    wanted = area_spine(companies, as_of)
    spine = wanted.where(F.col("postcode_area").isNotNull()).select("postcode_area", "as_of_date").distinct()
    rows = vacancy.join(spine, "postcode_area").where(F.col("date") <= F.col("as_of_date"))
    by_date = Window.partitionBy("postcode_area", "as_of_date").orderBy("date")
    stats = (
        rows.withColumn("at", (F.row_number().over(by_date) - 1).cast("double"))
        .groupBy("postcode_area", "as_of_date")
        .agg(
            F.count("*").alias("n"),
            F.max_by("vacancy_rate", "date").alias("local_vacancy_rate"),
            F.regr_slope("vacancy_rate", "at").alias("slope"),
        )
    )
    trend = F.when(F.col("n") >= 6, F.col("slope")).otherwise(F.lit(0.0))
    features = stats.select("postcode_area", "as_of_date", "local_vacancy_rate", trend.alias("local_vacancy_trend"))
    return wanted.join(features, ["postcode_area", "as_of_date"], "left").select(
        *KEYS, "local_vacancy_rate", "local_vacancy_trend"
    )


def registry_features(registry: DataFrame) -> DataFrame:
    """Registry attributes, one row per company; attributes the registry lacks are null.

    Of several rows of a company the most complete counts, the highest in declared order
    among equals.
    """
    present = {c: F.col(c) if c in registry.columns else F.lit(None).cast("double") for c in REGISTRY}
    row = F.struct(*[present[c].alias(c) for c in REGISTRY])
    known = sum((present[c].isNotNull().cast("int") for c in REGISTRY), F.lit(0))
    one = registry.groupBy("company_id").agg(F.max_by(row, F.struct(known.alias("known"), row.alias("row"))).alias("r"))
    return one.select(
        "company_id", *[F.col(f"r.{c}").cast("double").alias(n) for c, n in zip(REGISTRY, REGISTRY_NAMES)]
    )


def alternative_vector(
    companies: DataFrame,
    as_of,
    reviews: DataFrame,
    trustpilot: DataFrame,
    headcount: DataFrame,
    vacancy: DataFrame,
    registry: DataFrame,
) -> DataFrame:
    """Every company of the spine with all alternative features; absent sources give nulls.

    What needs windows is written before the sources meet, so that no task holds all their sorts.
    """
    spine = spine_of(companies, as_of)
    return (
        spine.join(cut_lineage(sentiment_features(reviews, as_of)), KEYS, "left")
        .join(rating_features(trustpilot, as_of), KEYS, "left")
        .join(cut_lineage(headcount_features(headcount, as_of)), KEYS, "left")
        .join(vacancy_features(companies, vacancy, as_of), KEYS, "left")
        .join(registry_features(registry), "company_id", "left")
    )
