"""Queries over ranges of days: transactions in several windows, and merged sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.fixtures import view
from creditloom.catalog.registry import oracle, query
from creditloom.operators import sketches
from creditloom.plans.intervals import interval_join
from creditloom.session import cut_lineage

# Days before the default: overlapping windows of one company.
WINDOWS = (30, 90, 180, 365)


@query(
    "rg_distress_windows",
    oracle(
        "SELECT w.company_id, w.days, count(*) AS n, sum(t.amount) AS net, min(t.transaction_date) AS first_day FROM "
        f"(SELECT company_id, d.days, default_date - CAST(d.days AS INT) AS first, default_date AS last FROM default_labels CROSS JOIN (VALUES {', '.join(f'({d})' for d in WINDOWS)}) d(days) "
        "WHERE default_date IS NOT NULL) w JOIN transactions t ON t.company_id = w.company_id AND t.transaction_date BETWEEN w.first AND w.last GROUP BY 1, 2",
        "company_id days n first_day", "net", uses="default_labels transactions",
    ),
)
def _(spark, sf):
    """What companies took and paid in four windows before their default."""
    days = F.explode(F.array(*[F.lit(d) for d in WINDOWS])).alias("days")
    windows = view(spark, sf, "default_labels").where("default_date IS NOT NULL").select(
        "company_id", days, F.col("default_date").alias("last")
    ).withColumn("first", F.date_sub("last", F.col("days")))
    found = interval_join(view(spark, sf, "transactions"), windows, "company_id", "transaction_date", "first", "last")
    return found.groupBy("company_id", "days").agg(
        F.count("*").alias("n"), F.sum("amount").alias("net"), F.min("transaction_date").alias("first_day")
    )


@query("tf_sketches")
def _(spark, sf):
    """Distinct payees and quantiles of 1998 for each industry from the sketches of company days,
    with their errors; an error beyond five standard errors, or beyond twice the rank error, fails."""
    companies = view(spark, sf, "companies").select("company_id", "industry")
    rows = cut_lineage(view(spark, sf, "transactions").join(companies, "company_id"))
    days = cut_lineage(sketches.sketch_days(rows)).join(companies, "company_id")
    estimates = cut_lineage(sketches.merged(days, ["industry"], "1998-01-01", "1998-12-31"))
    year = rows.where("transaction_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
    found = cut_lineage(sketches.with_errors(estimates, year, ["industry"]))
    worst = found.agg(F.max("n_payees_error"), F.max(F.greatest("q50_rank_error", "q90_rank_error"))).first()
    if worst[0] is not None and (worst[0] > 5 * sketches.DISTINCT_ERROR or worst[1] > 2 * sketches.RANK_ERROR):
        raise ValueError(f"sketches beyond their bounds: {worst}")
    return found
