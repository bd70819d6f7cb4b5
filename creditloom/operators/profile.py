"""Whole-history company profiles, distribution checks and chart datasets.

Amounts keep their sign here: outflows are negative.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.binning import money_bucket
from creditloom.plans.ranks import exact_quantiles
from creditloom.session import cut_lineage

CORRELATED = [
    "cv_txn", "top_5_concentration", "active_days_ratio", "mean_txn", "std_txn",
    "days_since_last_txn", "mean_daily_inflow", "mean_daily_outflow", "cv_daily_net", "defaulted",
]


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def join_labels(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    return transactions.join(labels.select("company_id", "defaulted", "default_date"), "company_id", "left")


def _totals() -> dict:
    amount, zero = F.col("amount"), F.lit(0).cast("decimal(18,2)")
    return {
        "n_transactions": F.count("*"),
        "total_volume": F.sum(amount),
        "total_inflow": F.sum(F.when(amount > 0, amount).otherwise(zero)),
        "total_outflow": F.sum(F.when(amount < 0, amount).otherwise(zero)),
    }


def _moments() -> dict:
    amount = _double("amount")
    return {
        "mean_txn": F.avg(amount),
        "std_txn": F.stddev_samp(amount),
        "skewness": F.skewness(amount),
        "kurtosis": F.kurtosis(amount),
    }


def _by_company(transactions: DataFrame, measures: dict) -> DataFrame:
    return transactions.groupBy("company_id").agg(*[v.alias(k) for k, v in measures.items()])


def counts_and_totals(transactions: DataFrame) -> DataFrame:
    return _by_company(transactions, _totals())


def _with_cv(stats: DataFrame) -> DataFrame:
    return stats.withColumn("cv_txn", F.try_divide("std_txn", F.abs("mean_txn")))


def moments(transactions: DataFrame) -> DataFrame:
    """Mean, sample deviation, their ratio, population skewness and excess kurtosis."""
    return _with_cv(_by_company(transactions, _moments()))


def median_amount(transactions: DataFrame) -> DataFrame:
    found = exact_quantiles(
        transactions.select("company_id", "amount"), "amount", [0.5], ["company_id"],
        bucket=money_bucket(F.col("amount")), name="q",
    )
    return found.select("company_id", F.col("q")[0].alias("median_txn"))


def amount_stats(transactions: DataFrame) -> DataFrame:
    return (
        moments(transactions)
        .join(median_amount(transactions), "company_id")
        .select("company_id", "mean_txn", "median_txn", "std_txn", "cv_txn")
    )


def shape_stats(transactions: DataFrame) -> DataFrame:
    return moments(transactions).select("company_id", "skewness", "kurtosis")


def daily_net(transactions: DataFrame) -> DataFrame:
    """Company x day: net amount and both flows; null where a day lacks that flow."""
    amount = F.col("amount")
    return transactions.groupBy("company_id", "transaction_date").agg(
        F.sum(amount).alias("net"),
        F.sum(F.when(amount > 0, amount)).alias("inflow"),
        F.sum(F.when(amount < 0, -amount)).alias("outflow"),
    )


def day_stats(daily: DataFrame, last_day: Column) -> DataFrame:
    """Everything a profile takes from the daily rows, in one aggregate."""
    first, last = F.min("transaction_date"), F.max("transaction_date")
    days = F.count("*")
    stats = daily.groupBy("company_id").agg(
        F.max("net").alias("max_daily_volume"),
        F.min("net").alias("min_daily_volume"),
        days.alias("active_days"),
        F.try_divide(days.cast("double"), F.datediff(last, first).cast("double")).alias("active_days_ratio"),
        last.alias("_last"),
        F.coalesce(F.avg(_double("inflow")), F.lit(0.0)).alias("mean_daily_inflow"),
        F.coalesce(F.avg(_double("outflow")), F.lit(0.0)).alias("mean_daily_outflow"),
        F.try_divide(F.stddev_samp(_double("net")), F.abs(F.avg(_double("net")))).alias("cv_daily_net"),
    )
    return stats.withColumn("days_since_last_txn", F.datediff(last_day, F.col("_last"))).drop("_last")


def latest_day(transactions: DataFrame) -> Column:
    """The last transaction date of the whole table as a scalar."""
    return transactions.agg(F.max("transaction_date")).scalar()


def _largest(transactions: DataFrame, k: int) -> DataFrame:
    """(company_id, top): sum of the k largest absolute amounts."""
    sizes = transactions.select("company_id", F.abs("amount").alias("size"))
    largest = Window.partitionBy("company_id").orderBy(F.desc("size"))
    ranked = sizes.withColumn("at", F.row_number().over(largest)).where(F.col("at") <= k)
    return ranked.groupBy("company_id").agg(F.sum("size").alias("top"))


def _share_of_top(k: int) -> Column:
    return F.coalesce(F.try_divide(_double("top"), _double("total")), F.lit(0.0)).alias(f"top_{k}_concentration")


def top_concentration(transactions: DataFrame, k: int = 5) -> DataFrame:
    """Share of the k largest absolute amounts; 0 when there is no volume."""
    totals = _by_company(transactions, {"total": F.sum(F.abs("amount"))})
    return totals.join(_largest(transactions, k), "company_id").select("company_id", _share_of_top(k))


def entity_profiles(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole profile.  The transactions are read once; what follows comes from their three
    columns, from one aggregate of them and from the daily rows."""
    rows = cut_lineage(transactions.select("company_id", "transaction_date", "amount"))
    daily = cut_lineage(daily_net(rows))
    stats = _with_cv(_by_company(rows, {**_totals(), **_moments(), "total": F.sum(F.abs("amount"))}))
    stats = stats.join(_largest(rows, 5), "company_id").select("*", _share_of_top(5)).drop("top", "total")
    return (
        stats.join(median_amount(rows), "company_id")
        .join(day_stats(daily, latest_day(daily)), "company_id")
        .join(labels.select("company_id", "defaulted"), "company_id", "left")
    )


def class_medians(profiles: DataFrame, columns, by: str = "defaulted") -> DataFrame:
    """Exact medians of several columns for each class, as (class, feature, median) rows."""
    long = profiles.where(F.col(by).isNotNull()).select(by, *columns).unpivot(
        [by], list(columns), "feature", "value"
    )
    return exact_quantiles(long, "value", [0.5], [by, "feature"], name="q").select(
        by, "feature", F.col("q")[0].alias("median")
    )


def validation_checks(transactions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Six plausibility checks as (check_name, passed) rows.  The profiles are made once."""
    compared = ["cv_txn", "top_5_concentration", "active_days_ratio"]
    profiles = cut_lineage(profiles.select("defaulted", *compared))
    medians = class_medians(profiles, compared)
    overall = exact_quantiles(profiles.select("top_5_concentration"), "top_5_concentration", [0.5], name="q")
    pick = lambda label, feature: F.max(
        F.when((F.col("defaulted") == label) & (F.col("feature") == feature), F.col("median"))
    )
    row = medians.agg(
        *[pick(label, f).alias(f"{f}_{label}") for f in compared for label in (0, 1)]
    ).withColumns(
        {
            "skew": transactions.agg(F.skewness(_double("amount"))).scalar(),
            "top": overall.select(F.col("q")[0]).scalar(),
        }
    )
    checks = {
        "amounts right-skewed": F.col("skew") > 0,
        "cv separates classes": F.col("cv_txn_1") > F.col("cv_txn_0"),
        "defaulters have higher cv": F.col("cv_txn_1") > F.col("cv_txn_0"),
        "top-5 concentration above 0.3": F.col("top") > 0.3,
        "defaulters more concentrated": F.col("top_5_concentration_1") > F.col("top_5_concentration_0"),
        "defaulters less active": F.col("active_days_ratio_1") < F.col("active_days_ratio_0"),
    }
    rows = [F.struct(F.lit(k).alias("check_name"), F.coalesce(v, F.lit(False)).alias("passed")) for k, v in checks.items()]
    return row.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, value: str, n_bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over each class's own range; the last bin is closed.

    The range is one row per class.
    """
    keys = [by] if by else []
    data = df.where(F.col(value).isNotNull()).select(*keys, _double(value).alias("v"))
    ranges = data.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    if by:
        placed = data.join(ranges, keys)
    else:
        placed = data.withColumns({c: ranges.select(c).scalar() for c in ("lo", "hi", "n")})
    flat = F.col("hi") == F.col("lo")
    low = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    high = F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))
    placed = placed.withColumns({"lo": low, "hi": high})
    width = (F.col("hi") - F.col("lo")) / n_bins
    bin_of = F.least(F.floor((F.col("v") - F.col("lo")) / width).cast("int"), F.lit(n_bins - 1))
    counted = placed.groupBy(*keys, bin_of.alias("bin"), "lo", "hi", "n").agg(F.count("*").alias("n_in_bin"))
    return counted.select(
        *keys,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.col("n_in_bin"),
        (F.col("n_in_bin") / (F.col("n") * width)).alias("density"),
    )


def hash_order(*columns, seed: int = 42) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def sample_rows(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """n distinct-key rows without replacement, the first by a hash of their key.

    The leading digits of the hash cut the rows into 65,536 even buckets; whole buckets are
    taken as long as they fit and only the bucket that holds the n-th row is ranked.
    """
    key = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_h", hash_order(*key, seed=seed)).withColumn("_bucket", F.substring("_h", 1, 4))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(upto), F.lit(0))).where(F.col("_before") < n)
    kept = hashed.join(sizes, "_bucket")
    whole = kept.where(F.col("_before") + F.col("_size") <= n)
    last = kept.where(F.col("_before") + F.col("_size") > n)
    at = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", *key))
    last = last.withColumn("_at", at).where(F.col("_before") + F.col("_at") <= n).drop("_at")
    return whole.unionByName(last).select(*df.columns)


def sample_by_class(df: DataFrame, k: int, by: str, key: str, seed: int = 42) -> DataFrame:
    order = Window.partitionBy(by).orderBy(hash_order(key, seed=seed), key)
    return df.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k).drop("_at")


def industry_default_rate(companies: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    joined = companies.select("company_id", "industry").join(labels.select("company_id", "defaulted"), "company_id", how)
    return joined.groupBy("industry").agg(
        F.avg(_double("defaulted")).alias("default_rate"), F.count("*").alias("n_companies")
    ).orderBy(F.desc("default_rate"), "industry")


def default_rate_totals(companies: DataFrame, labels: DataFrame, by=("industry", "postcode_area")) -> DataFrame:
    """Default rate and company counts for every combination of ``by``, for each column alone and overall.

    One pass makes all grouping sets.  ``level`` has a bit for each column that a row totals over
    (the first column is the highest), so a total is told from a null in the data.  Companies
    without a label count as companies and not in the rate.
    """
    joined = companies.select("company_id", *by).join(labels.select("company_id", "defaulted"), "company_id", "left")
    return joined.cube(*by).agg(
        F.grouping_id().cast("int").alias("level"), F.avg(_double("defaulted")).alias("default_rate"), F.count("*").alias("n_companies")
    )


def rolling_mean_days(daily: DataFrame, days: int = 30) -> DataFrame:
    """Mean daily net of the last ``days`` calendar days, over the days with activity."""
    day = F.datediff("transaction_date", F.to_date(F.lit("1970-01-01")))
    frame = Window.partitionBy("company_id").orderBy("_day").rangeBetween(-(days - 1), 0)
    return daily.withColumn("_day", day).select(
        "company_id", "transaction_date", "net", F.avg(_double("net")).over(frame).alias("rolling_mean")
    )


def rolling_mean_rows(daily: DataFrame, rows: int = 30) -> DataFrame:
    """Mean daily net of the last ``rows`` rows; null until there are that many."""
    frame = Window.partitionBy("company_id").orderBy("transaction_date").rowsBetween(-(rows - 1), 0)
    full = F.count("*").over(frame) == rows
    return daily.select(
        "company_id", "transaction_date", "net", F.when(full, F.avg(_double("net")).over(frame)).alias("rolling_mean")
    )


def correlations(profiles: DataFrame, columns=CORRELATED) -> DataFrame:
    """Pearson correlation of every pair of columns (lower triangle), pairwise complete."""
    pairs = list(combinations(columns, 2))

    def both(a: str, b: str) -> Column:
        complete = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(complete, _double(a)), F.when(complete, _double(b)))

    row = profiles.agg(*[both(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def dataset_summary(transactions: DataFrame, companies: DataFrame, labels: DataFrame) -> DataFrame:
    return transactions.agg(F.count("*").alias("n_transactions")).withColumns(
        {
            "n_companies": companies.agg(F.count("*")).scalar(),
            "default_rate": labels.agg(F.avg(_double("defaulted"))).scalar(),
        }
    )
