"""Point-in-time stability features from transactions.

Three aggregates feed everything; alone each is combined map-side before its shuffle, in the whole
vector their rows are dealt in bounded parts first:

* company x day    - flows, counts and moments; its windows are bounded by the calendar
* company x payee  - flows, summed per raw name before the mapping is joined
* company x amount - counts of equal amounts, for the exact median

``as_of`` is a date (a filter that reaches the scan) or a spine of (company_id, as_of_date)
rows for many dates in one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.binning import money_bucket
from creditloom.plans.ranks import BUCKET, exact_quantiles
from creditloom.session import cut_lineage, dealt, dealt_if_counted

KEYS = ["company_id", "as_of_date"]
MIN_HISTORY = 10
FEATURES = [
    "cv_monthly_net", "net_operating_ratio", "txn_frequency_trend", "max_zero_day_streak_90d",
    "recurring_revenue_ratio", "months_runway", "supplier_hhi", "velocity_90_180",
    "txn_count_90d", "txn_count_180d", "mean_txn_amount", "median_txn_amount", "std_txn_amount",
    "total_inflow", "total_outflow", "active_days_ratio",
]


def as_of_rows(df: DataFrame, as_of, date_column: str, keys=("company_id",)) -> DataFrame:
    """Rows dated on or before the as-of date, with the date as a column."""
    if isinstance(as_of, DataFrame):
        return df.join(as_of.select(*keys, "as_of_date").distinct(), list(keys)).where(
            F.col(date_column) <= F.col("as_of_date")
        )
    cut = F.to_date(F.lit(str(as_of)))
    return df.where(F.col(date_column) <= cut).withColumn("as_of_date", cut)


def spine_of(companies: DataFrame, as_of) -> DataFrame:
    if isinstance(as_of, DataFrame):
        return as_of.select(*KEYS)
    return companies.select("company_id", F.to_date(F.lit(str(as_of))).alias("as_of_date"))


def spread_keys(as_of) -> list[str]:
    """What rows are dealt by; a single date is a constant, by which nothing can be dealt."""
    return KEYS if isinstance(as_of, DataFrame) else ["company_id"]


def _double(column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where the bottom is zero or missing."""
    return F.try_divide(_double(top), _double(bottom))


def guarded(value: Column, history: Column) -> Column:
    """A feature is defined from ``MIN_HISTORY`` transactions on."""
    return F.when(history >= MIN_HISTORY, value)


def history_counts(transactions: DataFrame, as_of) -> DataFrame:
    """Number of transactions up to the as-of date and whether it suffices."""
    rows = as_of_rows(transactions, as_of, "transaction_date")
    return rows.groupBy(*KEYS).agg(F.count("*").alias("n_transactions")).withColumn(
        "has_history", F.col("n_transactions") >= MIN_HISTORY
    )


def daily_flows(transactions: DataFrame, as_of, n_rows: int | None = None) -> DataFrame:
    """Company x day aggregate: at most one row per calendar day for each company.

    With the number of rows given, the three columns that are read are dealt in bounded parts
    before they are summed: few rows share a day, and the sums are far wider than the rows.
    """
    rows = as_of_rows(transactions, as_of, "transaction_date")
    rows = dealt_if_counted(rows, n_rows, [*KEYS, "transaction_date", "amount"], *spread_keys(as_of), "transaction_date")
    amount, size = F.col("amount"), F.abs("amount")
    zero = F.lit(0).cast("decimal(18,2)")
    return rows.groupBy(*KEYS, "transaction_date").agg(
        F.count("*").alias("n"),
        F.count_if(amount > 0).alias("n_in"),
        F.count_if(amount < 0).alias("n_out"),
        F.sum(F.when(amount > 0, amount).otherwise(zero)).alias("inflow"),
        F.sum(F.when(amount < 0, -amount).otherwise(zero)).alias("outflow"),
        F.avg(_double(size)).alias("mean_size"),
        F.var_pop(_double(size)).alias("var_size"),
    )


def monthly_flows(daily: DataFrame) -> DataFrame:
    """Calendar-month rollup of the daily flows; months without rows do not exist."""
    month = F.trunc("transaction_date", "month").alias("month")
    return daily.groupBy(*KEYS, month).agg(
        F.sum("n").alias("n"),
        F.sum("n_in").alias("n_in"),
        F.sum("n_out").alias("n_out"),
        F.sum("inflow").alias("inflow"),
        F.sum("outflow").alias("outflow"),
    )


def monthly_rollup(transactions: DataFrame, as_of) -> DataFrame:
    """Sum, mean and count of the amounts for each month beside both flow sums."""
    monthly = monthly_flows(daily_flows(transactions, as_of))
    net = F.col("inflow") - F.col("outflow")
    return monthly.select(
        "company_id", "month", net.alias("net"), _ratio(net, F.col("n")).alias("mean_amount"), "n", "inflow", "outflow"
    )


def calendar_features(daily: DataFrame) -> DataFrame:
    """Every feature that follows from the daily rows, and the parts of the runway.

    Day windows, the month rollup and the final aggregate all keep a company together, so
    one exchange on (company, as-of date) serves the three of them.
    """
    whole = Window.partitionBy(*KEYS)
    by_day = whole.orderBy("transaction_date")
    date, as_of = F.col("transaction_date"), F.col("as_of_date")
    net = F.col("inflow") - F.col("outflow")
    zero = F.lit(0).cast("decimal(18,2)")
    busy = (date >= F.date_sub(as_of, 89)) & (net != 0)
    last_busy = F.last(F.when(busy, date), ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    days = daily.select(
        *KEYS,
        "transaction_date",
        "n", "n_in", "n_out", "inflow", "outflow", "mean_size", "var_size",
        net.alias("net"),
        F.sum(net).over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("balance"),
        F.max(date).over(whole).alias("last_day"),
        (F.sum(F.col("mean_size") * F.col("n")).over(whole) / F.sum("n").over(whole)).alias("mean_all"),
        F.when(busy, date).alias("busy_day"),
        F.when(busy, F.datediff(date, F.coalesce(last_busy, F.date_sub(as_of, 90))) - 1).alias("gap"),
    )
    recent_90 = date >= F.date_sub(as_of, 90)
    recent_180 = date >= F.date_sub(as_of, 180)
    months = days.groupBy(*KEYS, F.trunc("transaction_date", "month").alias("month")).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_in", "n_out", "inflow", "outflow")],
        F.max("gap").alias("gap"),
        F.max("busy_day").alias("last_busy"),
        F.max(F.when(date > F.date_sub("last_day", 90), F.col("balance"))).alias("cash_buffer"),
        F.sum(F.when(recent_90, F.col("net")).otherwise(zero)).alias("net_90"),
        F.sum(F.when(recent_180, F.col("net")).otherwise(zero)).alias("net_180"),
        F.sum(F.when(recent_90, F.col("n")).otherwise(0)).alias("n_90"),
        F.sum(F.when(recent_180, F.col("n")).otherwise(0)).alias("n_180"),
        F.first("mean_all").alias("mean_all"),
        F.sum(F.col("n") * (F.col("var_size") + F.pow(F.col("mean_size") - F.col("mean_all"), 2))).alias("spread"),
        F.count("*").alias("active_days"),
        F.min(date).alias("first_day"),
        F.max(date).alias("last_day"),
    )
    months = months.withColumn("at", F.row_number().over(whole.orderBy("month")) - 1)
    flowing = (F.col("n_in") > 0) | (F.col("n_out") > 0)
    turnover = F.when(flowing, _double(F.col("inflow") + F.col("outflow")))
    stats = months.groupBy(*KEYS).agg(
        F.sum("n").alias("n_transactions"),
        F.count("*").alias("n_months"),
        F.stddev_samp(turnover).alias("turnover_sd"),
        F.avg(turnover).alias("turnover_mean"),
        F.regr_slope(_double("n"), _double("at")).alias("slope"),
        F.avg(_double("n")).alias("mean_n"),
        F.sum("inflow").alias("total_in"),
        F.sum("outflow").alias("total_out"),
        F.avg(F.when(F.col("n_out") > 0, _double("outflow"))).alias("burn"),
        *[F.sum(c).alias(c) for c in ("net_90", "net_180", "n_90", "n_180", "spread", "active_days")],
        *[F.max(c).alias(c) for c in ("gap", "last_busy", "cash_buffer")],
        F.first("mean_all").alias("mean_all"),
        F.datediff(F.max("last_day"), F.min("first_day")).alias("span"),
    )
    n = F.col("n_transactions")
    tail_gap = F.datediff(as_of, F.col("last_busy"))
    streak = F.when(F.col("last_busy").isNull(), 90).otherwise(F.greatest("gap", tail_gap))
    values = {
        "cv_monthly_net": F.when(F.col("n_months") > 1, _ratio(F.col("turnover_sd"), F.abs("turnover_mean"))),
        "net_operating_ratio": _ratio(F.col("total_in"), F.col("total_out")),
        "txn_frequency_trend": F.when(F.col("n_months") >= 3, _ratio(F.col("slope"), F.col("mean_n"))),
        "max_zero_day_streak_90d": streak,
        # peak balance of the last 90 days of activity over the mean monthly outflow
        "months_runway": F.when(F.col("burn") > 0, _ratio(F.col("cash_buffer"), F.col("burn"))),
        "velocity_90_180": _ratio(F.col("net_90"), F.col("net_180") - F.col("net_90")),
        "txn_count_90d": F.col("n_90"),
        "txn_count_180d": F.col("n_180"),
        "mean_txn_amount": F.col("mean_all"),
        "std_txn_amount": F.sqrt(F.col("spread") / (n - 1)),
        "total_inflow": _double("total_in"),
        "total_outflow": _double("total_out"),
        "active_days_ratio": F.when(F.col("span") > 0, _ratio(F.col("active_days"), F.col("span"))).otherwise(F.lit(1.0)),
    }
    return stats.select(*KEYS, n, *[guarded(v, n).alias(k) for k, v in values.items()])


def payee_flows(transactions: DataFrame, as_of, mapping: DataFrame | None = None, n_rows: int | None = None) -> DataFrame:
    """Company x canonical payee flows.

    Raw names are summed first, so the mapping joins the reduced rows.  With the number of rows
    given, both sums are made in bounded parts.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    amount = F.col("amount")
    rows = as_of_rows(transactions, as_of, "transaction_date")
    flows = [
        F.sum(F.when(amount > 0, amount).otherwise(zero)).alias("inflow"),
        F.sum(F.when(amount < 0, -amount).otherwise(zero)).alias("outflow"),
        F.count("*").alias("n"),
    ]
    rows = dealt_if_counted(rows, n_rows, [*KEYS, "merchant_name", "amount"], *spread_keys(as_of), "merchant_name")
    raw = rows.groupBy(*KEYS, "merchant_name").agg(*flows)
    if mapping is None:
        return raw.withColumnRenamed("merchant_name", "canonical")
    lookup = mapping.select(F.col("raw").alias("merchant_name"), F.col("canonical").alias("_mapped"))
    named = raw.join(lookup, "merchant_name", "left").withColumn("canonical", F.coalesce("_mapped", "merchant_name"))
    named = dealt_if_counted(named, n_rows, [*KEYS, "canonical", "inflow", "outflow", "n"], *spread_keys(as_of), "canonical")
    return named.groupBy(*KEYS, "canonical").agg(
        F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow"), F.sum("n").alias("n")
    )


def payee_features(flows: DataFrame) -> DataFrame:
    """Share of the top three payers and concentration of the payees.

    The ranking is cut to three rows per company before the shuffle; squares of amounts
    are added in doubles, so sum(x^2) / sum(x)^2 needs one pass.
    """
    by_inflow = Window.partitionBy(*KEYS).orderBy(F.desc("inflow"), "canonical")
    top = (
        flows.where(F.col("inflow") > 0)
        .withColumn("at", F.row_number().over(by_inflow))
        .where("at <= 3")
        .groupBy(*KEYS)
        .agg(F.sum("inflow").alias("top_inflow"))
    )
    totals = flows.groupBy(*KEYS).agg(
        F.sum("n").alias("n_transactions"),
        F.sum("inflow").alias("total_in"),
        F.sum(_double("outflow")).alias("total_out"),
        F.sum(_double("outflow") * _double("outflow")).alias("squares"),
    )
    n = F.col("n_transactions")
    return totals.join(top, KEYS, "left").select(
        *KEYS,
        guarded(_ratio(F.col("top_inflow"), F.col("total_in")), n).alias("recurring_revenue_ratio"),
        guarded(_ratio(F.col("squares"), F.col("total_out") * F.col("total_out")), n).alias("supplier_hhi"),
    )


def median_amount(transactions: DataFrame, as_of, n_rows: int | None = None) -> DataFrame:
    """Exact median of the absolute amounts, found inside one money bucket per company.

    With the number of rows given, they are dealt by company and bucket in bounded parts.
    """
    rows = as_of_rows(transactions, as_of, "transaction_date").select(*KEYS, F.abs("amount").alias("size"))
    # A bucket that cannot be null leaves both readers of the counts one plan, so they share an exchange.
    bucket = F.coalesce(money_bucket(F.col("size")), F.lit(0))
    rows = rows.where(F.col("size").isNotNull()).withColumn(BUCKET, bucket)
    rows = dealt_if_counted(rows, n_rows, rows.columns, *spread_keys(as_of), BUCKET)
    return exact_quantiles(rows, "size", [0.5], KEYS, bucket=F.col(BUCKET), name="q").select(
        *KEYS, F.col("q")[0].alias("median_all")
    )


def vector_rows(transactions: DataFrame) -> DataFrame:
    """The four columns that the vector reads, written: several passes read them."""
    return cut_lineage(transactions.select("company_id", "transaction_date", "amount", "merchant_name"))


def stability_vector(
    transactions: DataFrame, as_of, companies: DataFrame | None = None, mapping: DataFrame | None = None, written: bool = False
) -> DataFrame:
    """All features for every company of the spine; null where the history is too short.

    The transactions are read once: ``vector_rows`` writes them, unless they are ``written`` by it
    already, and the payee flows, which are ranked and summed, are written with their names already
    mapped.  The mapping is written too, so that its join is planned with its size.  Each family of
    features is written before they meet, so that no task holds the sorts of all of them, and
    every exchange of a family's rows has parts of a bounded number of rows.
    """
    n = F.col("n_transactions")
    transactions = transactions if written else vector_rows(transactions)
    n_rows = as_of_rows(transactions.select("company_id", "transaction_date"), as_of, "transaction_date").count()
    mapping = mapping if mapping is None else cut_lineage(mapping.select("raw", "canonical"))
    flows = cut_lineage(payee_flows(transactions, as_of, mapping, n_rows))
    daily = dealt(daily_flows(transactions, as_of, n_rows), n_rows, *spread_keys(as_of))
    features = (
        cut_lineage(calendar_features(daily))
        .join(cut_lineage(payee_features(flows)), KEYS)
        .join(cut_lineage(median_amount(transactions, as_of, n_rows)), KEYS)
        .withColumn("median_txn_amount", guarded(F.col("median_all"), n))
        .select(*KEYS, *FEATURES)
    )
    if companies is None and not isinstance(as_of, DataFrame):
        return features
    return spine_of(companies, as_of).join(features, KEYS, "left")
