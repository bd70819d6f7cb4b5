"""Training-set preparation with exact statistics.

Spark ML's own imputer and scalers use approximate quantiles, sample deviations or no
centring; the definitions needed here are exact, so they are built from aggregates.  Fitted
parameters are one row per feature, a number fixed by the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.plans.ranks import column_quantiles, row_positions

# --- fixed values: model inputs in declared order -----------------------------------------
NUMERIC_FEATURES = [
    "cv_monthly_net", "net_operating_ratio", "txn_frequency_trend", "max_zero_day_streak_90d",
    "recurring_revenue_ratio", "months_runway", "supplier_hhi", "velocity_90_180",
    "txn_count_90d", "txn_count_180d", "mean_txn_amount", "median_txn_amount", "std_txn_amount",
    "total_inflow", "total_outflow", "active_days_ratio",
    "google_sentiment_mean", "google_sentiment_trend", "google_review_velocity",
    "trustpilot_90d_count", "trustpilot_rating_mean", "headcount_growth_rate", "headcount_latest",
    "num_officers", "num_shareholders", "share_capital", "mortgages_count", "charges_count",
]
HEAVY_TAILED = [
    "cv_monthly_net", "months_runway", "supplier_hhi", "velocity_90_180",
    "max_zero_day_streak_90d", "std_txn_amount",
]
# -------------------------------------------------------------------------------------------


def feature_counts(df: DataFrame) -> DataFrame:
    """(feature, position, n_present) of the declared features the table has."""
    present = [f for f in NUMERIC_FEATURES if f in df.columns]
    row = df.agg(*[F.count(f).alias(f) for f in present])
    cells = [
        F.struct(F.lit(f).alias("feature"), F.lit(NUMERIC_FEATURES.index(f)).alias("position"), F.col(f).alias("n_present"))
        for f in present
    ]
    return row.select(F.inline(F.array(*cells)))


def available_features(df: DataFrame) -> list[str]:
    """Declared features with at least one value, in declared order."""
    rows = feature_counts(df).where("n_present > 0").orderBy("position").collect()
    return [r["feature"] for r in rows]


def feature_groups(available) -> tuple[list[str], list[str]]:
    """(robustly scaled, standard scaled) features; assembly follows this order."""
    robust = [f for f in HEAVY_TAILED if f in available]
    standard = [f for f in NUMERIC_FEATURES if f in available and f not in HEAVY_TAILED]
    return robust, standard


def long_features(df: DataFrame, features, keys=()) -> DataFrame:
    keys = list(keys)
    return df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        keys, list(features), "feature", "value"
    )


def _medians(df: DataFrame, features) -> dict[str, float]:
    return {f: q[0] for f, q in column_quantiles(df, features, [0.5]).items()}


def fit_medians(df: DataFrame, features) -> DataFrame:
    """(feature, median) over the present values, interpolated and exact.  ``df`` is read several times."""
    return df.sparkSession.createDataFrame(list(_medians(df, features).items()), "feature STRING, median DOUBLE")


def fit_scaling(df: DataFrame, features) -> DataFrame:
    """(feature, median, center, scale) for imputation followed by scaling.

    The scaling statistics are those of the imputed values.  A zero scale becomes 1.  ``df`` is
    read several times; only values near the wanted ranks are exchanged.
    """
    medians = _medians(df, features)
    robust, _ = feature_groups(list(medians))
    standard = [f for f in medians if f not in robust]
    filled = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(medians[f])).alias(f) for f in robust + standard])
    centers = {f: (q[1], q[2] - q[0]) for f, q in column_quantiles(filled, robust, [0.25, 0.5, 0.75]).items()}
    if standard:
        row = filled.agg(*[F.struct(F.avg(f).alias("mean"), F.stddev_pop(f).alias("sd")).alias(f) for f in standard]).first()
        centers |= {f: (row[f]["mean"], row[f]["sd"]) for f in standard}
    rows = [(f, medians[f], center, 1.0 if scale == 0 else scale) for f, (center, scale) in centers.items()]
    return df.sparkSession.createDataFrame(rows, "feature STRING, median DOUBLE, center DOUBLE, scale DOUBLE")


def fitted_rows(scaling: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Fitted parameters as numbers: one entry per feature."""
    return {r["feature"]: (r["median"], r["center"], r["scale"]) for r in scaling.collect()}


def impute(df: DataFrame, medians: DataFrame, features, keys) -> DataFrame:
    """Wide table with missing values replaced by the fitted medians.

    A feature that has no value in the fitted rows has no median; it stays as it is.
    """
    values = {r["feature"]: r["median"] for r in medians.collect()}
    filled = lambda f: F.coalesce(F.col(f).cast("double"), F.lit(values.get(f)).cast("double"))
    return df.select(*keys, *[filled(f).alias(f) for f in features])


def scaled(column: str, fitted) -> Column:
    median, center, scale = fitted
    return (F.coalesce(F.col(column).cast("double"), F.lit(median)) - F.lit(center)) / F.lit(scale)


def scale(df: DataFrame, scaling: DataFrame, features, keys) -> DataFrame:
    fitted = fitted_rows(scaling)
    return df.select(*keys, *[scaled(f, fitted[f]).alias(f) for f in features])


def anova_scores(df: DataFrame, features, label: str = "defaulted") -> DataFrame:
    """(feature, f_value) of a one-way analysis of variance against the class."""
    moments = lambda v: F.struct(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("var"))
    wide = df.groupBy(label).agg(*[moments(F.col(f).cast("double")).alias(f"_{i}") for i, f in enumerate(features)])
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"_{i}.*")) for i, f in enumerate(features)]
    by_class = wide.select(label, F.inline(F.array(*cells)))
    total = by_class.groupBy("feature").agg(
        F.sum("n").alias("n_all"), F.count("*").alias("k"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")
    )
    parts = by_class.join(total, "feature").groupBy("feature", "n_all", "k").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    f_value = F.try_divide(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("n_all") - F.col("k")))
    return parts.select("feature", f_value.alias("f_value"))


def select_k_best(df: DataFrame, features, k: int = 15, label: str = "defaulted") -> list[str]:
    """The k features with the highest F value, in declared order."""
    best = anova_scores(df, features, label).orderBy(F.desc_nulls_last("f_value"), "feature").limit(k).collect()
    chosen = {r["feature"] for r in best}
    return [f for f in features if f in chosen]


def class_weights(df: DataFrame, label: str = "defaulted") -> DataFrame:
    """(class, n, weight) with weight n / (2 n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("weight", total / (F.lit(2.0) * F.col("n")))


def with_class_weight(df: DataFrame, label: str = "defaulted") -> DataFrame:
    """Add the balanced weight column; there is one weight per class, so it is broadcast."""
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``role``: each class gives ``test_share`` of its rows to 'test' by hash order.

    The hash is uniform, so its leading digits cut a class into 65,536 even buckets.
    """
    hashed = df.withColumn("_h", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("_bucket", F.substring("_h", 1, 4))
    placed = row_positions(hashed, ["_h", key], ["_bucket"], [label], name="_at")
    is_test = F.col("_at") <= F.round(F.col("_at_total") * F.lit(test_share))
    return placed.withColumn("role", F.when(is_test, "test").otherwise("train")).select(*df.columns, "role")


def temporal_folds(
    df: DataFrame, date: str = "application_date", key: str = "company_id", n_splits: int = 5, test_size: float = 0.2
) -> DataFrame:
    """(fold, key, role): each fold tests the next slice in time and trains on all before it.

    Rows of one date are ordered by a hash of their key, which also cuts a date with very many
    rows into 256 even buckets.
    A fold that would start at the first row is skipped.
    """
    hashed = df.select(key, date, F.md5(F.col(key).cast("string")).alias("_h")).withColumn(
        "_bucket", F.substring("_h", 1, 2)
    )
    ranked = row_positions(hashed, [date, "_h", key], [date, "_bucket"], name="position")
    n, at = F.col("position_total"), F.col("position") - 1
    size = F.floor(n * F.lit(test_size))
    folds = []
    for i in range(n_splits):
        start = n - (n_splits - i) * size
        end = F.least(start + size, n)
        role = F.when((start <= 0) | (end <= start), None).when(at < start, "train").when(at < end, "test")
        folds.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    return ranked.select(key, F.inline(F.array(*folds))).where("role IS NOT NULL").select("fold", key, "role")
