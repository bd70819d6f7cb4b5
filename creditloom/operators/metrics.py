"""Discrimination and calibration metrics of probability scores.

Rows are reduced to distinct scores with class counts first; cumulative counts come from
bucketed prefix sums, so no step sorts all scores in one task.  Tied scores stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.binning import edges_at_or_below, edges_below, unit_edges
from creditloom.operators.profile import histogram
from creditloom.plans.ranks import exact_quantiles, running_totals
from creditloom.session import cut_lineage


def tallies(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Distinct score with its number of positives and negatives."""
    return scores.groupBy(F.col(p).alias("p")).agg(
        F.sum(F.col(y).cast("bigint")).alias("n1"), F.sum(1 - F.col(y).cast("bigint")).alias("n0")
    )


def cumulative(scores: DataFrame, y: str = "y", p: str = "p", previous: bool = False) -> DataFrame:
    return running_totals(tallies(scores, y, p), "p", ["n1", "n0"], previous=previous)


def rank_metrics(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """AUC (ties count half), Gini and KS in one row."""
    return _rank_metrics(cumulative(scores, y, p))


def _rank_metrics(counted: DataFrame, groups=()) -> DataFrame:
    d = lambda c: F.col(c).cast("double")
    below = d("cum_n0") - d("n0")
    one = counted.groupBy(*groups).agg(
        F.sum(d("n1") * (below + d("n0") / 2)).alias("wins"),
        F.max(F.abs(F.try_divide(d("cum_n1"), d("all_n1")) - F.try_divide(d("cum_n0"), d("all_n0")))).alias("gap"),
        F.max(d("all_n1")).alias("n1"),
        F.max(d("all_n0")).alias("n0"),
    )
    auc = F.try_divide("wins", F.col("n1") * F.col("n0"))
    return one.select(
        *groups, auc.alias("auc_roc"), (2 * auc - 1).alias("gini"), F.coalesce("gap", F.lit(0.0)).alias("ks_statistic")
    )


def brier(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scores.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))


def calibration_error(scores: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Expected calibration error; bins are [lo, hi), the last one closed."""
    bins = scores.withColumn("bin", edges_at_or_below(F.col(p), unit_edges(n_bins))).groupBy("bin").agg(
        F.count("*").alias("n"), F.avg(F.col(y).cast("double")).alias("rate"), F.avg(p).alias("mean_p")
    )
    gap = F.sum(F.col("n") * F.abs(F.col("rate") - F.col("mean_p"))) / F.sum("n")
    return bins.agg(gap.alias("ece"))


def decile_table(scores: DataFrame, y: str = "y", p: str = "p", n: int = 10) -> DataFrame:
    """Quantile bins (lo, hi], first closed; repeated edges merge and labels run 1..k."""
    inner = exact_quantiles(scores.select(p), p, [i * (1.0 / n) for i in range(n + 1)])
    edges = inner.select(F.array_distinct(F.slice("quantiles", 2, n - 1)).alias("e"), F.get("quantiles", F.lit(0)).alias("lo"))
    bounds = edges.select(F.struct("e", "lo").alias("b")).scalar()
    placed = scores.withColumn("_b", bounds)
    number = F.size(F.filter("_b.e", lambda e: (e < F.col(p)) & (e > F.col("_b.lo")))) + 1
    return placed.groupBy(number.alias("decile")).agg(
        F.count(y).alias("count"),
        F.avg(F.col(y).cast("double")).alias("default_rate"),
        F.avg(p).alias("avg_pd"),
        F.min(p).alias("min_pd"),
        F.max(p).alias("max_pd"),
    )


def metric_suite(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: AUC, Gini, KS, Brier and calibration error.

    All five follow from the distinct scores with their class counts, which are made once.
    """
    t = cut_lineage(tallies(scores.where(F.col(p).isNotNull() & F.col(y).isNotNull()), y, p))
    n, score = F.col("n1") + F.col("n0"), F.col("p").cast("double")
    squares = F.sum(F.col("n1") * F.pow(score - 1, 2) + F.col("n0") * F.pow(score, 2))
    loss = t.agg(F.try_divide(squares, F.sum(n)).alias("brier_score"))
    bins = t.groupBy(edges_at_or_below(score, unit_edges(10)).alias("bin")).agg(
        F.sum(n).alias("n"), F.sum("n1").alias("hits"), F.sum(n * score).alias("total")
    )
    gap = bins.agg(F.try_divide(F.sum(F.abs(F.col("hits") - F.col("total"))), F.sum("n")).alias("ece"))
    return _rank_metrics(running_totals(t, "p", ["n1", "n0"])).withColumns({"brier_score": loss.scalar(), "ece": gap.scalar()})


def grouped_metrics(scores: DataFrame, groups, y: str = "y", p: str = "p", extra: dict[str, Column] | None = None) -> DataFrame:
    """The columns of :func:`metric_suite` with row counts, one row for each group.

    One table of scores of many models and folds is measured at once.  ``extra`` names further
    aggregates over ``y`` and ``p``.  Rank metrics are null in a group of one class.
    """
    groups = list(groups)
    known = scores.where(F.col(p).isNotNull() & F.col(y).isNotNull()).select(*groups, F.col(y).alias("y"), F.col(p).alias("p"))
    t = cut_lineage(known.groupBy(*groups, "p").agg(
        F.sum(F.col("y").cast("bigint")).alias("n1"), F.sum(1 - F.col("y").cast("bigint")).alias("n0")
    ))
    n, score = F.col("n1") + F.col("n0"), F.col("p").cast("double")
    squares = F.sum(F.col("n1") * F.pow(score - 1, 2) + F.col("n0") * F.pow(score, 2))
    bins = t.groupBy(*groups, edges_at_or_below(score, unit_edges(10)).alias("bin")).agg(
        F.sum(n).alias("n"), F.sum("n1").alias("hits"), F.sum(n * score).alias("total"), squares.alias("squares")
    )
    sums = bins.groupBy(*groups).agg(
        F.sum("n").alias("n_rows"),
        F.sum("hits").alias("n_defaulted"),
        F.try_divide(F.sum("squares"), F.sum("n")).alias("brier_score"),
        F.try_divide(F.sum(F.abs(F.col("hits") - F.col("total"))), F.sum("n")).alias("ece"),
    )
    found = sums.join(_rank_metrics(running_totals(t, "p", ["n1", "n0"], groups), groups), groups)
    if extra:
        found = found.join(known.groupBy(*groups).agg(*[v.alias(k) for k, v in extra.items()]), groups)
    return found


def roc_curve(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) without collinear inner points, from (0, 0) at a null threshold."""
    points = cumulative(scores, y, p, previous=True)
    lowest = F.col("prev_n1").isNull()
    highest = (F.col("cum_n1") == F.col("all_n1")) & (F.col("cum_n0") == F.col("all_n0"))
    bend = (F.col("n1") != F.col("prev_n1")) | (F.col("n0") != F.col("prev_n0"))
    rate = lambda m: F.try_divide(
        (F.col(f"all_{m}") - F.col(f"cum_{m}") + F.col(m)).cast("double"), F.col(f"all_{m}").cast("double")
    )
    curve = points.where(lowest | highest | bend).select(
        F.col("p").alias("threshold"), rate("n0").alias("fpr"), rate("n1").alias("tpr")
    )
    start = scores.limit(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def pr_curve(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, precision, recall, prevalence), closed by precision 1 at recall 0."""
    d = lambda c: F.col(c).cast("double")
    at1 = d("all_n1") - d("cum_n1") + d("n1")
    at0 = d("all_n0") - d("cum_n0") + d("n0")
    prevalence = d("all_n1") / (d("all_n1") + d("all_n0"))
    points = cumulative(scores, y, p).select(
        F.col("p").alias("threshold"),
        F.try_divide(at1, at1 + at0).alias("precision"),
        F.try_divide(at1, d("all_n1")).alias("recall"),
        prevalence.alias("prevalence"),
    )
    closing = scores.agg(F.avg(F.col(y).cast("double")).alias("prevalence")).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        "prevalence",
    )
    return points.unionByName(closing)


def calibration_curve(scores: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Reliability curve; bins are (lo, hi] and empty ones are dropped."""
    return scores.withColumn("bin", edges_below(F.col(p), unit_edges(n_bins))).groupBy("bin").agg(
        F.avg(p).alias("mean_predicted"), F.avg(F.col(y).cast("double")).alias("fraction_positive"), F.count("*").alias("n")
    )


def score_histogram(scores: DataFrame, y: str = "y", p: str = "p", n_bins: int = 30) -> DataFrame:
    return histogram(scores.select(F.col(y).alias("y"), F.col(p).alias("p")), "p", n_bins, by="y")
