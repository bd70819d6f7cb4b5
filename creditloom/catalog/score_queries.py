"""Queries over score metrics and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.feature_queries import training
from creditloom.catalog.fixtures import cte, view
from creditloom.catalog.profile_queries import histogram_sql
from creditloom.catalog.registry import oracle, query
from creditloom.operators import decisions, metrics, prep
from creditloom.session import cut_lineage

SCORES = ("p", "p_tied")


def scored(spark, sf):
    return view(spark, sf, "scored")


def both(run):
    """Run a metric on the tie-free and on the tied score."""

    def of(spark, sf):
        parts = [
            run(scored(spark, sf).select("id", "y", F.col(s).alias("p"))).withColumn("score", F.lit(s)) for s in SCORES
        ]
        return parts[0].unionByName(parts[1])

    return of


cte("two_scores", "scored", "SELECT 'p' AS score, id, y, p FROM scored UNION ALL SELECT 'p_tied', id, y, p_tied FROM scored")
cte(
    "tallied",
    "two_scores",
    "SELECT score, p, sum(y) AS n1, sum(1 - y) AS n0 FROM two_scores GROUP BY 1, 2",
)
cte(
    "cumulated",
    "tallied",
    "SELECT *, sum(n1) OVER w AS c1, sum(n0) OVER w AS c0, sum(n1) OVER (PARTITION BY score) AS t1, sum(n0) OVER (PARTITION BY score) AS t0, "
    "lead(n1) OVER w AS next1, lead(n0) OVER w AS next0, lag(n1) OVER w AS low1, lag(n0) OVER w AS low0 FROM tallied "
    "WINDOW w AS (PARTITION BY score ORDER BY p)",
)
cte(
    "m_rank",
    "cumulated two_scores",
    "SELECT a.score, a.auc_roc, 2 * a.auc_roc - 1 AS gini, k.ks_statistic FROM ("
    "SELECT score, (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / "
    "(CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)) AS auc_roc FROM ("
    "SELECT score, y, rank() OVER (PARTITION BY score ORDER BY p) + (count(*) OVER (PARTITION BY score, p) - 1) / 2.0 AS r FROM two_scores) x GROUP BY 1) a "
    "JOIN (SELECT score, max(abs(CAST(c1 AS DOUBLE) / t1 - CAST(c0 AS DOUBLE) / t0)) AS ks_statistic FROM cumulated GROUP BY 1) k ON k.score = a.score",
)
_LO_EDGES = " + ".join(f"CAST(p >= {i} * CAST(0.1 AS DOUBLE) AS INT)" for i in range(1, 10))
_HI_EDGES = " + ".join(f"CAST(p > {i} * CAST(0.1 AS DOUBLE) AS INT)" for i in range(1, 10))
cte(
    "m_calibration",
    "two_scores",
    "SELECT b.score, b.brier_score, e.ece FROM (SELECT score, avg((p - y) * (p - y)) AS brier_score FROM two_scores GROUP BY 1) b JOIN ("
    "SELECT score, sum(n * abs(rate - mean_p)) / sum(n) AS ece FROM ("
    f"SELECT score, {_LO_EDGES} AS bin, count(*) AS n, avg(y) AS rate, avg(p) AS mean_p FROM two_scores GROUP BY 1, 2) x GROUP BY 1) e ON e.score = b.score",
)
query("mx_auc", oracle("SELECT * FROM m_rank", "score", "auc_roc", uses="m_rank"))(
    both(lambda s: metrics.rank_metrics(s).select("auc_roc"))
)
query("mx_gini", oracle("SELECT * FROM m_rank", "score", "gini", uses="m_rank"))(
    both(lambda s: metrics.rank_metrics(s).select("gini"))
)
query("mx_ks", oracle("SELECT * FROM m_rank", "score", "ks_statistic", uses="m_rank"))(
    both(lambda s: metrics.rank_metrics(s).select("ks_statistic"))
)
query("mx_brier", oracle("SELECT * FROM m_calibration", "score", "brier_score", uses="m_calibration"))(both(metrics.brier))
query("mx_ece", oracle("SELECT * FROM m_calibration", "score", "ece", uses="m_calibration"))(both(metrics.calibration_error))
_SUITE = "auc_roc gini ks_statistic brier_score ece"
cte("suite", "m_rank m_calibration", "SELECT r.*, c.* EXCLUDE (score) FROM m_rank r JOIN m_calibration c ON c.score = r.score")
query("mx_metric_suite", oracle("SELECT * FROM suite", "score", _SUITE, uses="suite"))(both(metrics.metric_suite))
query(
    "mx_decile",
    oracle(
        "SELECT score, decile, count(*) AS \"count\", avg(y) AS default_rate, avg(p) AS avg_pd, min(p) AS min_pd, max(p) AS max_pd FROM ("
        "SELECT s.score, s.y, s.p, CAST(1 + len(list_filter(e.edges, lambda v: v < s.p AND v > e.lo)) AS INT) AS decile FROM two_scores s JOIN ("
        "SELECT score, list_distinct(quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges, min(p) AS lo FROM two_scores GROUP BY 1) e "
        "ON e.score = s.score) x GROUP BY 1, 2",
        'score decile "count"', "default_rate avg_pd min_pd max_pd", uses="two_scores",
    ),
)(both(metrics.decile_table))
query(
    "mx_roc_curve",
    oracle(
        "SELECT score, p AS threshold, CAST(t0 - c0 + n0 AS DOUBLE) / t0 AS fpr, CAST(t1 - c1 + n1 AS DOUBLE) / t1 AS tpr FROM cumulated "
        "WHERE next1 IS NULL OR low1 IS NULL OR n1 <> low1 OR n0 <> low0 UNION ALL SELECT DISTINCT score, NULL, 0.0, 0.0 FROM two_scores",
        "score", "threshold fpr tpr", uses="cumulated",
    ),
)(both(metrics.roc_curve))
query(
    "mx_pr_curve",
    oracle(
        "SELECT score, p AS threshold, CAST(t1 - c1 + n1 AS DOUBLE) / (t1 - c1 + n1 + t0 - c0 + n0) AS precision, CAST(t1 - c1 + n1 AS DOUBLE) / t1 AS recall, "
        "CAST(t1 AS DOUBLE) / (t1 + t0) AS prevalence FROM cumulated UNION ALL SELECT score, NULL, 1.0, 0.0, avg(y) FROM two_scores GROUP BY 1",
        "score", "threshold precision recall prevalence", uses="cumulated",
    ),
)(both(metrics.pr_curve))
query(
    "mx_calibration_curve",
    oracle(
        f"SELECT score, CAST({_HI_EDGES} AS INT) AS bin, avg(p) AS mean_predicted, avg(y) AS fraction_positive, count(*) AS n FROM two_scores GROUP BY 1, 2",
        "score bin n", "mean_predicted fraction_positive", uses="two_scores",
    ),
)(both(metrics.calibration_curve))
query(
    "mx_score_histogram",
    oracle(histogram_sql("scored", "p", 30, "y"), "y bin n_in_bin", "bin_lo bin_hi density", uses="scored"),
)(lambda spark, sf: metrics.score_histogram(scored(spark, sf)))

# --- decisions ----------------------------------------------------------------------------
_DECISION = "CASE WHEN {p} < 0.08 THEN 'APPROVE' WHEN {p} < 0.15 THEN 'REVIEW' ELSE 'DECLINE' END"
query(
    "dc_decision",
    oracle(
        f"SELECT id, p, {_DECISION.format(p='p')} AS decision, CASE WHEN p >= 0.08 AND p < 0.15 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence FROM scored",
        "id decision confidence", "p", uses="scored",
    ),
)(lambda spark, sf: decisions.decide(scored(spark, sf).select("id", "p")))
query(
    "dc_grey_zone",
    oracle(
        "SELECT id, p, CASE WHEN p < q[1] THEN 'APPROVE' WHEN p <= q[2] THEN 'REVIEW' ELSE 'DECLINE' END AS decision "
        "FROM scored CROSS JOIN (SELECT quantile_cont(p, [0.4, 0.6]) AS q FROM scored) c",
        "id decision", "p", uses="scored",
    ),
)(lambda spark, sf: decisions.grey_zone(scored(spark, sf).select("id", "p")))
cte(
    "reviewed",
    "scored",
    f"SELECT id, p AS p_primary, p_tied AS p_shadow, abs(p - p_tied) AS gap, abs(p - p_tied) > 0.2 AS needs_review, "
    f"{_DECISION.format(p='p')} = {_DECISION.format(p='p_tied')} AS same_decision FROM scored",
)


def _reviewed(spark, sf):
    rows = scored(spark, sf)
    return decisions.shadow_review(rows.select("id", "p"), rows.select("id", F.col("p_tied").alias("p")))


query(
    "dc_shadow_review",
    oracle("SELECT * FROM reviewed", "id needs_review same_decision", "p_primary p_shadow gap", uses="reviewed"),
)(_reviewed)
query(
    "dc_agreement",
    oracle(
        "SELECT avg(CAST(same_decision AS INT)) AS agreement_rate, avg(CAST(needs_review AS INT)) AS review_rate, count(*) AS n FROM reviewed",
        "n", "agreement_rate review_rate", uses="reviewed",
    ),
)(lambda spark, sf: decisions.agreement_rate(_reviewed(spark, sf)))

# Company scores by a fixed formula, so that reports can be checked by value.
_PRIMARY, _SHADOW = "CAST((company_id * 7919) % 10007 AS DOUBLE) / 10007", "CAST((company_id * 104729) % 10007 AS DOUBLE) / 10007"
cte("company_scores", "companies", f"SELECT company_id, industry, {_PRIMARY} AS p, {_SHADOW} AS p_shadow FROM companies")


def company_scores(spark, sf, expression=_PRIMARY):
    return view(spark, sf, "companies").select("company_id", "industry", F.expr(expression).alias("p"))


FEATURES = list(prep.NUMERIC_FEATURES)
cte(
    "importances",
    "",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{f}', {1.0 / (i + 1)!r})" for i, f in enumerate(FEATURES))
    + ") v(feature, importance)",
)
cte(
    "long_training",
    "training",
    " UNION ALL ".join(f"SELECT company_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM training" for f in FEATURES),
)
cte(
    "drivers",
    "long_training importances",
    "SELECT company_id, pos AS position, feature, value, contribution, CASE WHEN contribution > cut THEN 'High' ELSE 'Medium' END AS impact FROM ("
    "SELECT *, CAST(row_number() OVER (PARTITION BY company_id ORDER BY contribution DESC NULLS LAST, feature) AS INT) AS pos, "
    "quantile_cont(contribution, 0.75) OVER (PARTITION BY company_id) AS cut FROM ("
    "SELECT l.company_id, l.feature, l.value, i.importance * abs(l.value) AS contribution FROM long_training l JOIN importances i ON i.feature = l.feature) a) b WHERE pos <= 5",
)


def drivers(spark, sf, rows=None):
    importances = spark.createDataFrame(
        [(f, 1.0 / (i + 1)) for i, f in enumerate(FEATURES)], "feature STRING, importance DOUBLE"
    )
    return decisions.top_drivers(rows if rows is not None else training(spark, sf), importances, FEATURES)


query(
    "dc_top_drivers",
    oracle("SELECT * FROM drivers", "company_id position feature impact", "value contribution", uses="drivers"),
)(drivers)
query(
    "dc_entity_report",
    oracle(
        f"SELECT s.company_id, t.supplier_hhi, t.txn_count_90d, t.local_vacancy_rate, s.p AS pd_primary, s.p_shadow AS pd_shadow, {_DECISION.format(p='s.p')} AS decision, "
        "CASE WHEN s.p >= 0.08 AND s.p < 0.15 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence, CASE l.defaulted WHEN 1 THEN 'DEFAULT' ELSE 'SURVIVE' END AS outcome "
        "FROM company_scores s JOIN training t ON t.company_id = s.company_id JOIN default_labels l ON l.company_id = s.company_id",
        "company_id txn_count_90d decision confidence outcome", "supplier_hhi local_vacancy_rate pd_primary pd_shadow",
        uses="company_scores training default_labels",
    ),
)(
    lambda spark, sf: decisions.entity_reports(
        training(spark, sf).drop("defaulted"),
        company_scores(spark, sf),
        company_scores(spark, sf, _SHADOW),
        view(spark, sf, "default_labels"),
    ).select(
        "company_id", "supplier_hhi", "txn_count_90d", "local_vacancy_rate", "pd_primary", "pd_shadow", "decision", "confidence", "outcome"
    )
)
query(
    "dc_overview",
    oracle(
        "SELECT (SELECT count(*) FROM transactions) AS n_transactions, (SELECT count(*) FROM companies) AS n_companies, "
        "(SELECT avg(defaulted) FROM default_labels) AS default_rate, (SELECT auc_roc FROM m_rank WHERE score = 'p') AS auc_roc",
        "n_transactions n_companies", "default_rate auc_roc", uses="transactions companies default_labels m_rank",
    ),
)(
    lambda spark, sf: decisions.overview(
        view(spark, sf, "transactions"), view(spark, sf, "companies"), view(spark, sf, "default_labels"),
        metrics.rank_metrics(scored(spark, sf)),
    )
)
query(
    "dc_model_comparison",
    oracle(
        "SELECT a.metric, a.value AS primary_model, b.value AS shadow_model FROM (UNPIVOT (SELECT * FROM suite WHERE score = 'p') ON "
        + _SUITE.replace(" ", ", ")
        + " INTO NAME metric VALUE value) a JOIN (UNPIVOT (SELECT * FROM suite WHERE score = 'p_tied') ON "
        + _SUITE.replace(" ", ", ")
        + " INTO NAME metric VALUE value) b ON a.metric = b.metric",
        "metric", "primary_model shadow_model", uses="suite",
    ),
)(
    lambda spark, sf: decisions.model_comparison(
        {
            "primary_model": metrics.metric_suite(scored(spark, sf)),
            "shadow_model": metrics.metric_suite(scored(spark, sf), p="p_tied"),
        }
    )
)
_PROXIES = ["local_vacancy_rate", "num_officers"]
query(
    "dc_proxy_correlation",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, '{q}' AS proxy, corr(CAST({f} AS DOUBLE), CAST({q} AS DOUBLE)) AS r FROM training"
            for f in FEATURES for q in _PROXIES if f not in _PROXIES
        ),
        "feature proxy", "r", uses="training",
    ),
)(lambda spark, sf: decisions.proxy_correlations(training(spark, sf), [f for f in FEATURES if f not in _PROXIES], _PROXIES))
_KNOWN = ["num_officers", "txn_count_180d"]
_SCANNED = [f for f in FEATURES if f not in _PROXIES]


@query(
    "dc_fairness_scan",
    oracle(
        "SELECT *, NULL AS feature, NULL AS proxy, NULL AS r FROM ("
        f"SELECT s.industry, avg(CAST(s.p < 0.08 AS INT)) AS approval_rate, count(*) AS n, avg(CAST(s.p < 0.08 AS INT)) - (SELECT avg(CAST(p < 0.08 AS INT)) FROM company_scores) AS parity_gap, "
        f"avg(CAST(coalesce(d.hit, false) AS INT)) AS proxy_share FROM company_scores s LEFT JOIN (SELECT company_id, bool_or(feature IN ('{_KNOWN[0]}', '{_KNOWN[1]}') AND position <= 3) AS hit "
        "FROM drivers GROUP BY 1) d ON d.company_id = s.company_id GROUP BY 1) g "
        + "".join(
            f"UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '{f}', '{q}', corr(CAST({f} AS DOUBLE), CAST({q} AS DOUBLE)) FROM training "
            for f in _SCANNED for q in _PROXIES
        ),
        "industry n feature proxy", "approval_rate parity_gap proxy_share r", uses="company_scores drivers training",
    ),
)
def _(spark, sf):
    """The three gates: parity and proxy-driven decisions of each industry, and the correlation of
    each feature with each proxy column."""
    rows = cut_lineage(training(spark, sf))
    scores = decisions.decide(company_scores(spark, sf))
    return decisions.fairness_scan(scores, drivers(spark, sf, rows), "industry", _KNOWN, rows, _SCANNED, _PROXIES)
