"""Queries over company profiles, business rules and the table sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.feature_queries import ENRICHMENT, enrichment, scanned
from creditloom.catalog.fixtures import cte, view
from creditloom.catalog.name_queries import simple_mapping
from creditloom.catalog.registry import oracle, query
from creditloom.operators import models, profile, rules
from creditloom.sources import tables
from creditloom.streaming.feeds import work_folder

# --- profiles: DuckDB tables --------------------------------------------------------------
cte(
    "p_entity",
    "transactions",
    "SELECT company_id, count(*) AS n_transactions, CAST(sum(amount) AS DOUBLE) AS total_volume, "
    "CAST(coalesce(sum(amount) FILTER (amount > 0), 0) AS DOUBLE) AS total_inflow, "
    "CAST(coalesce(sum(amount) FILTER (amount < 0), 0) AS DOUBLE) AS total_outflow, "
    "avg(a) AS mean_txn, median(a) AS median_txn, stddev_samp(a) AS std_txn, stddev_samp(a) / nullif(abs(avg(a)), 0) AS cv_txn, "
    "kurtosis_pop(a) AS kurtosis, max(transaction_date) AS last_day "
    "FROM (SELECT *, CAST(amount AS DOUBLE) AS a FROM transactions) t GROUP BY 1",
)
cte(
    "p_skew",
    "transactions p_entity",
    "SELECT company_id, avg(power(a - mean_txn, 3)) / nullif(power(avg(power(a - mean_txn, 2)), 1.5), 0) AS skewness "
    "FROM (SELECT t.company_id, CAST(t.amount AS DOUBLE) AS a, e.mean_txn FROM transactions t JOIN p_entity e ON e.company_id = t.company_id) x GROUP BY 1",
)
cte(
    "p_daily",
    "transactions",
    "SELECT company_id, transaction_date, CAST(sum(amount) AS DOUBLE) AS net, CAST(sum(amount) FILTER (amount > 0) AS DOUBLE) AS inflow, "
    "CAST(-sum(amount) FILTER (amount < 0) AS DOUBLE) AS outflow FROM transactions GROUP BY 1, 2",
)
cte(
    "p_days",
    "p_daily",
    "SELECT company_id, max(net) AS max_daily_volume, min(net) AS min_daily_volume, count(*) AS active_days, "
    "CAST(count(*) AS DOUBLE) / nullif(max(transaction_date) - min(transaction_date), 0) AS active_days_ratio, "
    "CAST((SELECT max(transaction_date) FROM p_daily) - max(transaction_date) AS INT) AS days_since_last_txn, "
    "coalesce(avg(inflow), 0) AS mean_daily_inflow, coalesce(avg(outflow), 0) AS mean_daily_outflow, "
    "stddev_samp(net) / nullif(abs(avg(net)), 0) AS cv_daily_net FROM p_daily GROUP BY 1",
)
cte(
    "p_top",
    "transactions",
    "SELECT company_id, sum(a) FILTER (pos <= 5) / nullif(sum(a), 0) AS top_5_concentration FROM (SELECT company_id, abs(CAST(amount AS DOUBLE)) AS a, "
    "row_number() OVER (PARTITION BY company_id ORDER BY abs(amount) DESC) AS pos FROM transactions) t GROUP BY 1",
)
cte(
    "profiles",
    "p_entity p_skew p_days p_top default_labels",
    "SELECT e.* EXCLUDE (last_day), s.skewness, d.* EXCLUDE (company_id), t.top_5_concentration, l.defaulted FROM p_entity e "
    "JOIN p_skew s USING (company_id) JOIN p_days d USING (company_id) JOIN p_top t USING (company_id) LEFT JOIN default_labels l USING (company_id)",
)
_REAL = {
    "total_volume", "total_inflow", "total_outflow", "mean_txn", "median_txn", "std_txn", "cv_txn", "skewness", "kurtosis",
    "max_daily_volume", "min_daily_volume", "active_days_ratio", "top_5_concentration", "mean_daily_inflow",
    "mean_daily_outflow", "cv_daily_net",
}


def _transactions(spark, sf):
    return view(spark, sf, "transactions")


def _labels(spark, sf):
    return view(spark, sf, "default_labels")


def _day_stats(spark, sf):
    t = _transactions(spark, sf)
    return profile.day_stats(profile.daily_net(t), profile.latest_day(t))


def _profiles(spark, sf):
    return profile.entity_profiles(_transactions(spark, sf), _labels(spark, sf))


def _profile_query(key, columns, run):
    keys = " ".join(["company_id", *[c for c in columns if c not in _REAL]])
    text = oracle("SELECT * FROM profiles", keys, " ".join(c for c in columns if c in _REAL), uses="profiles")
    query(key, text)(lambda spark, sf: run(spark, sf).select("company_id", *columns))


query(
    "eda_join_labels",
    oracle(
        "SELECT t.company_id, t.transaction_date, t.amount, t.merchant_name, l.defaulted, l.default_date FROM transactions t "
        "LEFT JOIN default_labels l ON t.company_id = l.company_id",
        "company_id transaction_date merchant_name defaulted default_date", "amount", uses="transactions default_labels",
    ),
)(lambda spark, sf: profile.join_labels(_transactions(spark, sf), _labels(spark, sf)).drop("category"))
_profile_query(
    "eda_counts_totals", ["n_transactions", "total_volume", "total_inflow", "total_outflow"],
    lambda spark, sf: profile.counts_and_totals(_transactions(spark, sf)),
)
_profile_query(
    "eda_amount_stats", ["mean_txn", "median_txn", "std_txn", "cv_txn"],
    lambda spark, sf: profile.amount_stats(_transactions(spark, sf)),
)
_profile_query("eda_shape", ["skewness", "kurtosis"], lambda spark, sf: profile.shape_stats(_transactions(spark, sf)))
_profile_query("eda_daily_extremes", ["max_daily_volume", "min_daily_volume"], _day_stats)
_profile_query("eda_activity", ["active_days", "active_days_ratio"], _day_stats)
_profile_query(
    "eda_top5_concentration", ["top_5_concentration"], lambda spark, sf: profile.top_concentration(_transactions(spark, sf))
)
_profile_query("eda_recency", ["days_since_last_txn"], _day_stats)
_profile_query("eda_daily_flows", ["mean_daily_inflow", "mean_daily_outflow", "cv_daily_net"], _day_stats)
_WHOLE = ["n_transactions", "active_days", "days_since_last_txn", "defaulted"]
_profile_query("eda_entity_profile", [*_WHOLE, *sorted(_REAL)], _profiles)

query(
    "eda_validation_checks",
    oracle(
        "SELECT unnest(['amounts right-skewed', 'cv separates classes', 'defaulters have higher cv', 'top-5 concentration above 0.3', "
        "'defaulters more concentrated', 'defaulters less active']) AS check_name, "
        "unnest([(SELECT avg(power(a - m, 3)) > 0 FROM (SELECT CAST(amount AS DOUBLE) AS a, avg(CAST(amount AS DOUBLE)) OVER () AS m FROM transactions) x), "
        "median(cv_txn) FILTER (defaulted = 1) > median(cv_txn) FILTER (defaulted = 0), "
        "median(cv_txn) FILTER (defaulted = 1) > median(cv_txn) FILTER (defaulted = 0), median(top_5_concentration) > 0.3, "
        "median(top_5_concentration) FILTER (defaulted = 1) > median(top_5_concentration) FILTER (defaulted = 0), "
        "median(active_days_ratio) FILTER (defaulted = 1) < median(active_days_ratio) FILTER (defaulted = 0)]) AS passed FROM profiles",
        "check_name passed", uses="profiles transactions",
    ),
)(lambda spark, sf: profile.validation_checks(_transactions(spark, sf), _profiles(spark, sf)))


def histogram_sql(source: str, value: str, n: int, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    key = f"{by}, " if by else ""
    return (
        f"SELECT {key}bin, lo + bin * width AS bin_lo, lo + (bin + 1) * width AS bin_hi, count(*) AS n_in_bin, count(*) / (any_value(n) * any_value(width)) AS density FROM ("
        f"SELECT {key}CAST(least(floor((v - lo) / ((hi - lo) / {n})), {n} - 1) AS INT) AS bin, lo, (hi - lo) / {n} AS width, n FROM ("
        f"SELECT {key}CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) OVER ({part}) AS lo, max(CAST({value} AS DOUBLE)) OVER ({part}) AS hi, "
        f"count(*) OVER ({part}) AS n FROM {source} WHERE {value} IS NOT NULL) a) b GROUP BY {key}bin, lo, width"
    )


query(
    "eda_histogram",
    oracle(histogram_sql("profiles", "cv_daily_net", 30, "defaulted"), "defaulted bin n_in_bin", "bin_lo bin_hi density", uses="profiles"),
)(
    lambda spark, sf: profile.histogram(
        _day_stats(spark, sf).join(_labels(spark, sf), "company_id", "left"), "cv_daily_net", 30, "defaulted"
    )
)
_SAMPLE_KEY = ["company_id", "transaction_date", "amount", "merchant_name"]
query(
    "eda_sample",
    oracle(
        "SELECT company_id, transaction_date, amount, merchant_name FROM transactions "
        "ORDER BY md5(concat_ws('|', company_id, transaction_date, amount, merchant_name, '42')), company_id, transaction_date, amount, merchant_name LIMIT 50000",
        "company_id transaction_date merchant_name", "amount", uses="transactions",
    ),
)(lambda spark, sf: profile.sample_rows(_transactions(spark, sf).select(*_SAMPLE_KEY), 50000, _SAMPLE_KEY))
query(
    "eda_sample_by_class",
    oracle(
        "SELECT company_id, defaulted FROM (SELECT *, row_number() OVER (PARTITION BY defaulted ORDER BY md5(concat(company_id, '|42')), company_id) AS pos "
        "FROM default_labels) x WHERE pos <= 2",
        "company_id defaulted", uses="default_labels",
    ),
)(lambda spark, sf: profile.sample_by_class(_labels(spark, sf).select("company_id", "defaulted"), 2, "defaulted", "company_id"))
query(
    "eda_daily_net",
    oracle(
        "SELECT d.company_id, d.transaction_date, d.net, l.defaulted FROM p_daily d LEFT JOIN default_labels l ON d.company_id = l.company_id",
        "company_id transaction_date defaulted", "net", uses="p_daily default_labels",
    ),
)(
    lambda spark, sf: profile.daily_net(_transactions(spark, sf))
    .join(_labels(spark, sf), "company_id", "left")
    .select("company_id", "transaction_date", "net", "defaulted")
)
query(
    "eda_industry_default_rate",
    oracle(
        "SELECT c.industry, avg(l.defaulted) AS default_rate, count(*) AS n_companies FROM companies c LEFT JOIN default_labels l ON c.company_id = l.company_id GROUP BY 1",
        "industry n_companies", "default_rate", uses="companies default_labels",
    ),
)(lambda spark, sf: profile.industry_default_rate(view(spark, sf, "companies"), _labels(spark, sf)))
_UNKNOWN = "CASE WHEN company_id % 11 = 0 THEN NULL ELSE industry END"


@query(
    "eda_default_rate_totals",
    oracle(
        f"SELECT industry, postcode_area, CAST(grouping(industry, postcode_area) AS INT) AS level, avg(defaulted) AS default_rate, count(*) AS n_companies "
        f"FROM (SELECT company_id, {_UNKNOWN} AS industry, postcode_area FROM companies) c LEFT JOIN default_labels l USING (company_id) GROUP BY CUBE (industry, postcode_area)",
        "industry postcode_area level n_companies", "default_rate", uses="companies default_labels",
    ),
)
def _(spark, sf):
    """Rates by industry and area with all totals; some companies have no industry."""
    companies = view(spark, sf, "companies").withColumn("industry", F.expr(_UNKNOWN))
    return profile.default_rate_totals(companies, _labels(spark, sf))


query(
    "eda_rolling_30d",
    oracle(
        "SELECT company_id, transaction_date, net, avg(net) OVER (PARTITION BY company_id ORDER BY transaction_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS rolling_mean FROM p_daily",
        "company_id transaction_date", "net rolling_mean", uses="p_daily",
    ),
)(lambda spark, sf: profile.rolling_mean_days(profile.daily_net(_transactions(spark, sf))))
query(
    "eda_correlation",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM profiles"
            for i, a in enumerate(profile.CORRELATED)
            for b in profile.CORRELATED[i + 1 :]
        ),
        "column_a column_b", "r", uses="profiles",
    ),
)(lambda spark, sf: profile.correlations(_profiles(spark, sf)))
query(
    "eda_dataset_summary",
    oracle(
        "SELECT (SELECT count(*) FROM transactions) AS n_transactions, (SELECT count(*) FROM companies) AS n_companies, "
        "(SELECT avg(defaulted) FROM default_labels) AS default_rate",
        "n_transactions n_companies", "default_rate", uses="transactions companies default_labels",
    ),
)(lambda spark, sf: profile.dataset_summary(_transactions(spark, sf), view(spark, sf, "companies"), _labels(spark, sf)))
query(
    "dc_trajectory",
    oracle(
        "SELECT company_id, transaction_date, net, CASE WHEN count(*) OVER w = 30 THEN avg(net) OVER w END AS rolling_mean FROM p_daily "
        "WINDOW w AS (PARTITION BY company_id ORDER BY transaction_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)",
        "company_id transaction_date", "net rolling_mean", uses="p_daily",
    ),
)(lambda spark, sf: profile.rolling_mean_rows(profile.daily_net(_transactions(spark, sf))))

# --- rules --------------------------------------------------------------------------------
_INDUSTRY_SQL = (
    "SELECT DISTINCT c_mktsegment AS industry, CAST(20 + 10 * (length(c_mktsegment) % 5) AS INT) AS avg_monthly_txns, "
    "CAST(length(c_mktsegment) AS DOUBLE) / 100 AS base_rate, "
    "CASE WHEN length(c_mktsegment) % 2 = 0 THEN {a} ELSE {b} END AS peak_months, "
    "CAST(1 + length(c_mktsegment) % 3 AS DOUBLE) AS peak_multiplier FROM customer"
)
cte("industries", "", _INDUSTRY_SQL.format(a="[6, 7, 8, 12]", b="[11, 12]"))


def industries(spark, sf):
    text = _INDUSTRY_SQL.format(a="array(6, 7, 8, 12)", b="array(11, 12)").replace("customer", "{customer}")
    return spark.sql(text, customer=view(spark, sf, "customer"))


query(
    "rg_prior_pd",
    oracle(
        "SELECT c.company_id, c.industry, i.base_rate + CASE WHEN company_age_months < 12 THEN 0.08 WHEN company_age_months < 24 THEN 0.04 ELSE 0 END "
        "+ CASE WHEN loan_amount > 50000 THEN 0.02 ELSE 0 END AS prior_pd FROM companies c JOIN industries i ON i.industry = c.industry",
        "company_id industry", "prior_pd", uses="companies industries",
    ),
)(lambda spark, sf: rules.prior_default_rate(view(spark, sf, "companies"), industries(spark, sf)))

_GROUPS = ", ".join(f"('{group}', '{category}')" for group, category in rules.CATEGORIES)
_GROUP_OF = "CASE WHEN raw LIKE 'PAYER%' THEN 'Stripe' WHEN raw LIKE '%bolt%' THEN 'Shell' WHEN raw LIKE '%gear%' THEN 'Courier' ELSE raw END"
query(
    "rg_category_lookup",
    oracle(
        f"SELECT n.raw, coalesce(g.category, 'Other') AS category_found, x.null_rate, n.n FROM names n "
        f"LEFT JOIN (VALUES {_GROUPS}) g(grp, category) ON g.grp = {_GROUP_OF} "
        "JOIN (SELECT merchant_name, avg(CAST(category IS NULL AS INT)) AS null_rate FROM transactions GROUP BY 1) x ON x.merchant_name = n.raw",
        "raw category_found n", "null_rate", uses="names transactions",
    ),
)(
    lambda spark, sf: rules.lookup_category(
        rules.category_null_rate(_transactions(spark, sf))
        .withColumnRenamed("merchant_name", "raw")
        .withColumn("merchant_group", F.expr(_GROUP_OF)),
        rules.category_dimension(spark),
        "merchant_group",
    ).select("raw", "category_found", "null_rate", "n")
)
query(
    "rg_distress_window",
    oracle(
        "SELECT t.company_id, t.transaction_date, t.amount, CAST(l.default_date - t.transaction_date AS INT) AS days_to_default, "
        "0.5 + 0.5 * ((l.default_date - t.transaction_date) / 180.0) AS intensity FROM transactions t JOIN default_labels l ON t.company_id = l.company_id "
        "WHERE l.default_date - t.transaction_date BETWEEN 1 AND 180",
        "company_id transaction_date days_to_default", "amount intensity", uses="transactions default_labels",
    ),
)(
    lambda spark, sf: rules.distress_window(_transactions(spark, sf), _labels(spark, sf)).select(
        "company_id", "transaction_date", "amount", "days_to_default", "intensity"
    )
)
_PEAK = "CASE WHEN list_contains(i.peak_months, month(d.transaction_date)) THEN i.peak_multiplier ELSE 1.0 END"
query(
    "rg_seasonal_peak",
    oracle(
        f"SELECT d.company_id, d.transaction_date, {_PEAK} AS multiplier FROM p_daily d JOIN companies c ON c.company_id = d.company_id JOIN industries i ON i.industry = c.industry",
        "company_id transaction_date", "multiplier", uses="p_daily companies industries",
    ),
)(
    lambda spark, sf: profile.daily_net(_transactions(spark, sf))
    .join(view(spark, sf, "companies").select("company_id", "industry"), "company_id")
    .join(industries(spark, sf), "industry")
    .select("company_id", "transaction_date", rules.seasonal_multiplier("transaction_date").alias("multiplier"))
)
query(
    "rg_panel_spine",
    oracle(
        "SELECT c.company_id, CAST(m.month AS DATE) AS month FROM companies c CROSS JOIN (SELECT unnest(generate_series(DATE '1997-01-01', DATE '1998-06-30', INTERVAL 1 MONTH)) AS month) m",
        "company_id month", uses="companies",
    ),
)(lambda spark, sf: rules.month_panel(view(spark, sf, "companies").select("company_id"), "1997-01-01", "1998-06-30"))
query(
    "rg_postcode_area", oracle("SELECT DISTINCT substr(postcode_area, 1, 2) AS postcode_area FROM companies", "postcode_area", uses="companies")
)(lambda spark, sf: rules.postcode_areas(view(spark, sf, "companies")))
query(
    "rg_seasonal_counts",
    oracle(
        f"SELECT d.company_id, d.transaction_date, d.observed, i.avg_monthly_txns / 30.0 * {_PEAK} * "
        "CASE WHEN l.default_date - d.transaction_date BETWEEN 1 AND 180 THEN 0.5 + 0.5 * ((l.default_date - d.transaction_date) / 180.0) ELSE 1.0 END AS expected "
        "FROM (SELECT company_id, transaction_date, count(*) AS observed FROM transactions GROUP BY 1, 2) d JOIN companies c ON c.company_id = d.company_id "
        "JOIN industries i ON i.industry = c.industry LEFT JOIN default_labels l ON l.company_id = d.company_id",
        "company_id transaction_date observed", "expected", uses="transactions companies industries default_labels",
    ),
)(
    lambda spark, sf: rules.expected_daily_counts(
        _transactions(spark, sf), view(spark, sf, "companies"), _labels(spark, sf), industries(spark, sf)
    )
)

# --- sources and sinks --------------------------------------------------------------------


@query(
    "scan_transactions",
    oracle(
        "SELECT lpad(CAST(company_id AS STRING), 8, '0') AS company_id, transaction_date, amount, merchant_name, category FROM transactions",
        "company_id transaction_date merchant_name category", "amount", uses="transactions",
    ),
)
def _(spark, sf):
    """Through CSV and back: codes keep leading zeros, money stays exact, empty is null."""
    path = work_folder(spark, "transactions-csv")
    feed = _transactions(spark, sf).select(
        F.lpad(F.col("company_id").cast("string"), 8, "0").alias("company_id"),
        "transaction_date", "amount", "merchant_name", "category",
        F.lit("Card").alias("payment_method"), F.lit(None).cast("string").alias("reference"),
    )
    tables.write_table(feed, path, "csv")
    return tables.read_table(spark, path, "transactions").drop("payment_method", "reference")


# (feed, key, date, two values) of every declared enrichment table.
_CONTENT = {
    "google_reviews": ("company_id", "review_date", "rating", "sentiment_score"),
    "trustpilot": ("company_id", "review_date", "rating", "NULL"),
    "linkedin": ("company_id", "scrape_date", "headcount_estimate", "NULL"),
    "property_vacancy": ("postcode_area", "date", "vacancy_rate", "NULL"),
    "companies_house": ("company_id", "NULL", "share_capital", "mortgages_count"),
    "merchant_mapping": ("raw", "NULL", "NULL", "NULL"),
}
_FROM = {**ENRICHMENT, "merchant_mapping": "normed"}


def _content(feed, source):
    key, date, first, second = _CONTENT[feed]
    return (
        f"SELECT '{feed}' AS feed, CAST({key} AS {{text}}) AS key, CAST({date} AS DATE) AS date, "
        f"CAST({first} AS DOUBLE) AS first_value, CAST({second} AS DOUBLE) AS second_value FROM {source}"
    )


@query(
    "scan_enrichment",
    oracle(
        " UNION ALL ".join(_content(t, v) for t, v in _FROM.items()).replace("{text}", "VARCHAR"),
        "feed key date", "first_value second_value", uses=" ".join(_FROM.values()),
    ),
)
def _(spark, sf):
    """Content of all six declared tables, scanned from CSV files by the reader."""
    names = simple_mapping(spark, sf).select("raw")
    feeds = {**enrichment(spark, sf), "merchant_mapping": scanned(spark, names, "merchant_mapping")}
    parts = [spark.sql(_content(t, "{feed}").replace("{text}", "STRING"), feed=df) for t, df in feeds.items()]
    return tables.union_feeds(*parts)


query(
    "parse_dates",
    oracle("SELECT company_id, merchant_name, transaction_date FROM transactions", "company_id merchant_name transaction_date", uses="transactions"),
)(
    lambda spark, sf: tables.parse_dates(
        _transactions(spark, sf).select("company_id", "merchant_name", F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date")),
        "transaction_date",
    )
)


@query("write_table", oracle("SELECT company_id, transaction_date, net FROM p_daily", "company_id transaction_date", "net", uses="p_daily"))
def _(spark, sf):
    path = work_folder(spark, "daily")
    daily = profile.daily_net(_transactions(spark, sf)).select("company_id", "transaction_date", "net")
    tables.write_table(daily, path)
    return spark.read.schema(daily.schema).parquet(path)


@query(
    "write_metrics_json",
    oracle(
        "SELECT count(*) AS n_transactions, CAST(sum(amount) AS DOUBLE) AS total FROM transactions", "n_transactions", "total", uses="transactions"
    ),
)
def _(spark, sf):
    path = work_folder(spark, "metrics")
    metrics = _transactions(spark, sf).agg(
        F.struct(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total")).alias("volume")
    )
    tables.write_metrics_json(metrics, path)
    back = tables.read_metrics_json(spark, path, metrics.schema)
    return back.select(F.col("volume.n").alias("n_transactions"), F.col("volume.total").alias("total"))


query(
    "union_entities",
    oracle("SELECT * FROM transactions", "company_id transaction_date merchant_name category", "amount", uses="transactions"),
)(lambda spark, sf: tables.union_feeds(view(spark, sf, "inflows"), view(spark, sf, "outflows")))
