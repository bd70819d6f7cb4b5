"""Credit decisions, drivers and report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.plans.ranks import exact_quantiles

APPROVE_BELOW = 0.08
REVIEW_BELOW = 0.15


def decision_of(p: Column) -> Column:
    return F.when(p < APPROVE_BELOW, "APPROVE").when(p < REVIEW_BELOW, "REVIEW").otherwise("DECLINE")


def confidence_of(p: Column) -> Column:
    return F.when((p >= APPROVE_BELOW) & (p < REVIEW_BELOW), "MEDIUM").otherwise("HIGH")


def decide(scores: DataFrame, p: str = "p") -> DataFrame:
    return scores.withColumns({"decision": decision_of(F.col(p)), "confidence": confidence_of(F.col(p))})


def grey_zone(scores: DataFrame, p: str = "p", low: float = 0.4, high: float = 0.6) -> DataFrame:
    """Scores between two percentiles go to review; below approve, above decline."""
    cuts = exact_quantiles(scores.select(p), p, [low, high]).scalar()
    placed = scores.withColumn("_cuts", cuts)
    lo, hi = F.get("_cuts", F.lit(0)), F.get("_cuts", F.lit(1))
    zone = F.when(F.col(p) < lo, "APPROVE").when(F.col(p) <= hi, "REVIEW").otherwise("DECLINE")
    return placed.withColumn("decision", zone).drop("_cuts")


def top_drivers(vectors: DataFrame, importances: DataFrame, features, k: int = 5, key: str = "company_id") -> DataFrame:
    """Top k features of each company by importance x |value|.

    ``importances`` is (feature, importance), one row per model feature, read as numbers.  The
    impact is High above the 75th percentile of the company's own contributions.  All of it
    happens inside the company's row, without a shuffle.
    """
    weights = {r["feature"]: r["importance"] for r in importances.collect()}
    features = [f for f in features if f in weights]
    entries = [
        F.struct(
            # Sorting by the negated contribution puts the largest first; nulls go last.
            (F.col(f).isNull() | F.isnan(F.col(f).cast("double"))).alias("absent"),
            (-F.lit(weights[f]) * F.abs(F.col(f).cast("double"))).alias("order"),
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
        )
        for f in features
    ]
    ranked = vectors.select(key, F.array_sort(F.array(*entries)).alias("all"))
    sizes = F.transform(F.filter("all", lambda e: ~e["absent"]), lambda e: -e["order"])  # falling
    n = F.size("sizes")
    place = F.lit(0.25) * (n - 1)
    at = F.floor(place).cast("int")
    upper, lower = F.get("sizes", at), F.get("sizes", F.least(at + 1, n - 1))
    cut = F.when(n > 0, upper + (place - at) * (lower - upper))
    ranked = ranked.withColumn("sizes", sizes).withColumn("cut", cut)
    best = ranked.select(key, "cut", F.posexplode(F.slice("all", 1, k)).alias("position", "e"))
    contribution = -F.col("e.order")
    return best.select(
        key,
        (F.col("position") + 1).alias("position"),
        "e.feature",
        "e.value",
        contribution.alias("contribution"),
        F.when(contribution > F.col("cut"), "High").otherwise("Medium").alias("impact"),
    )


def shadow_review(primary: DataFrame, shadow: DataFrame, key: str = "id", max_gap: float = 0.2) -> DataFrame:
    """Both scores side by side; a large gap goes to manual review."""
    both = primary.select(key, F.col("p").alias("p_primary")).join(shadow.select(key, F.col("p").alias("p_shadow")), key)
    gap = F.abs(F.col("p_primary") - F.col("p_shadow"))
    same = decision_of(F.col("p_primary")) == decision_of(F.col("p_shadow"))
    return both.select(
        key, "p_primary", "p_shadow", gap.alias("gap"), (gap > max_gap).alias("needs_review"), same.alias("same_decision")
    )


def agreement_rate(reviewed: DataFrame) -> DataFrame:
    return reviewed.agg(
        F.avg(F.col("same_decision").cast("double")).alias("agreement_rate"),
        F.avg(F.col("needs_review").cast("double")).alias("review_rate"),
        F.count("*").alias("n"),
    )


def entity_reports(vectors: DataFrame, primary: DataFrame, shadow: DataFrame, labels: DataFrame) -> DataFrame:
    """Vector, both scores, decision and outcome for every company (filter by key for one)."""
    scored = (
        vectors.join(primary.select("company_id", F.col("p").alias("pd_primary")), "company_id", "left")
        .join(shadow.select("company_id", F.col("p").alias("pd_shadow")), "company_id", "left")
        .join(labels.select("company_id", "defaulted"), "company_id", "left")
    )
    outcome = F.when(F.col("defaulted") == 1, "DEFAULT").when(F.col("defaulted") == 0, "SURVIVE")
    return decide(scored, "pd_primary").withColumn("outcome", outcome)


def overview(transactions: DataFrame, companies: DataFrame, labels: DataFrame, metrics: DataFrame) -> DataFrame:
    from creditloom.operators.profile import dataset_summary

    return dataset_summary(transactions, companies, labels).withColumn("auc_roc", metrics.select("auc_roc").scalar())


def model_comparison(suites: dict[str, DataFrame]) -> DataFrame:
    """(metric, one column for each model) from one-row metric suites."""
    metrics = ["auc_roc", "gini", "ks_statistic", "brier_score", "ece"]
    long = None
    for model, suite in suites.items():
        rows = suite.select(*metrics).unpivot([], metrics, "metric", "value").withColumn("model", F.lit(model))
        long = rows if long is None else long.unionByName(rows)
    return long.groupBy("metric").pivot("model", list(suites)).agg(F.first("value"))


def proxy_correlations(vectors: DataFrame, features, proxies) -> DataFrame:
    """Gate 1: correlation of each feature with each proxy column; null where one of them never changes."""
    pairs = [(f, q) for f in features for q in proxies]

    def correlation(f: str, q: str) -> Column:
        x, y = F.col(f).cast("double"), F.col(q).cast("double")
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    row = vectors.agg(*[correlation(f, q).alias(f"r{i}") for i, (f, q) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(f).alias("feature"), F.lit(q).alias("proxy"), F.col(f"r{i}").alias("r"))
        for i, (f, q) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def group_parity(decided: DataFrame, group: str) -> DataFrame:
    """Gate 2: approval rate for each group against the overall rate."""
    approved = (F.col("decision") == "APPROVE").cast("double")
    overall = decided.agg(F.avg(approved)).scalar()
    return decided.groupBy(group).agg(F.avg(approved).alias("approval_rate"), F.count("*").alias("n")).withColumn(
        "parity_gap", F.col("approval_rate") - overall
    )


def proxy_drivers(drivers: DataFrame, proxies, top: int = 3, key: str = "company_id") -> DataFrame:
    """Gate 3: companies with a known proxy among their first drivers."""
    hit = F.col("feature").isin(list(proxies)) & (F.col("position") <= top)
    return drivers.groupBy(key).agg(F.max(hit).alias("proxy_flag"))


def fairness_scan(
    decided: DataFrame, drivers: DataFrame, group: str, proxies, vectors: DataFrame, features, demographic, key: str = "company_id"
) -> DataFrame:
    """All three gates: approval parity and share of proxy-driven decisions for each group, and the
    correlation of each feature with each demographic proxy.

    A row is a group (gates 2 and 3) or a pair of feature and proxy (gate 1); what belongs to the
    other kind is null.  Companies without a group are a group of their own.
    """
    flagged = decided.select(key, group, "decision").join(proxy_drivers(drivers, proxies, key=key), key, "left")
    share = flagged.groupBy(F.col(group).alias("_group")).agg(
        F.avg(F.coalesce(F.col("proxy_flag"), F.lit(False)).cast("double")).alias("proxy_share")
    )
    of_group = group_parity(decided, group).join(share, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    return of_group.unionByName(proxy_correlations(vectors, features, demographic), allowMissingColumns=True)
