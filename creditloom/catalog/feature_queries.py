"""Queries over transaction features, alternative features and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.fixtures import AS_OF, EARLY_AS_OF, REVIEW_AS_OF, cte, view
from creditloom.catalog.name_queries import simple_mapping
from creditloom.catalog.registry import oracle, query
from creditloom.operators import alt_features as alt
from creditloom.operators import store
from creditloom.operators import txn_features as txn
from creditloom.sources import tables
from creditloom.streaming.feeds import work_folder

# --- transaction features: DuckDB tables --------------------------------------------------
_D = f"DATE '{AS_OF}'"
cte("txn_asof", "transactions", f"SELECT * FROM transactions WHERE transaction_date <= {_D}")
cte("hist", "txn_asof", "SELECT company_id, count(*) AS n FROM txn_asof GROUP BY 1")
cte(
    "by_month",
    "txn_asof",
    "SELECT company_id, CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS n, "
    "CAST(sum(amount) AS DOUBLE) AS net, CAST(coalesce(sum(amount) FILTER (amount > 0), 0) AS DOUBLE) AS inflow, "
    "CAST(-coalesce(sum(amount) FILTER (amount < 0), 0) AS DOUBLE) AS outflow, "
    "count(*) FILTER (amount > 0) AS n_in, count(*) FILTER (amount < 0) AS n_out FROM txn_asof GROUP BY 1, 2",
)
cte(
    "by_day",
    "txn_asof",
    "SELECT company_id, transaction_date, sum(amount) AS net FROM txn_asof GROUP BY 1, 2",
)
cte(
    "f_month",
    "by_month hist",
    "SELECT m.company_id, "
    "CASE WHEN count(*) FILTER (n_in + n_out > 0) > 1 THEN stddev_samp(inflow + outflow) FILTER (n_in + n_out > 0) "
    "/ nullif(abs(avg(inflow + outflow) FILTER (n_in + n_out > 0)), 0) END AS cv_monthly_net, "
    "sum(inflow) / nullif(sum(outflow), 0) AS net_operating_ratio, "
    "CASE WHEN count(*) >= 3 THEN regr_slope(CAST(n AS DOUBLE), CAST(pos AS DOUBLE)) / avg(n) END AS txn_frequency_trend, "
    "sum(inflow) AS total_inflow, sum(outflow) AS total_outflow, avg(outflow) FILTER (n_out > 0) AS burn "
    "FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY month) - 1 AS pos FROM by_month) m GROUP BY 1",
)
cte(
    "f_streak",
    "by_day hist",
    "SELECT company_id, coalesce(max(run), 0) AS max_zero_day_streak_90d FROM ("
    "SELECT company_id, grp, count(*) AS run FROM ("
    "SELECT c.company_id, c.d, CAST(c.d - DATE '1990-01-01' AS BIGINT) - row_number() OVER (PARTITION BY c.company_id ORDER BY c.d) AS grp "
    f"FROM (SELECT company_id, {_D} - CAST(g AS INT) AS d FROM hist CROSS JOIN range(0, 90) r(g)) c "
    "LEFT JOIN by_day b ON b.company_id = c.company_id AND b.transaction_date = c.d WHERE coalesce(b.net, 0) = 0) z GROUP BY 1, 2) r GROUP BY 1",
)
cte(
    "f_runway",
    "by_day f_month",
    "SELECT b.company_id, max(balance) FILTER (transaction_date > last_day - 90) / nullif(any_value(f.burn), 0) AS months_runway "
    "FROM (SELECT company_id, transaction_date, CAST(sum(net) OVER (PARTITION BY company_id ORDER BY transaction_date) AS DOUBLE) AS balance, "
    "max(transaction_date) OVER (PARTITION BY company_id) AS last_day FROM by_day) b JOIN f_month f ON f.company_id = b.company_id GROUP BY 1",
)
cte("mapped_asof", "mapped", f"SELECT * FROM mapped WHERE transaction_date <= {_D}")
cte(
    "f_payer",
    "mapped_asof",
    "SELECT company_id, sum(v) FILTER (pos <= 3) / nullif(sum(v), 0) AS recurring_revenue_ratio FROM ("
    "SELECT company_id, canonical, CAST(sum(amount) AS DOUBLE) AS v, row_number() OVER (PARTITION BY company_id ORDER BY sum(amount) DESC, canonical) AS pos "
    "FROM mapped_asof WHERE amount > 0 GROUP BY 1, 2) p GROUP BY 1",
)
cte(
    "f_hhi",
    "mapped_asof",
    "SELECT company_id, sum(v * v) / nullif(sum(v) * sum(v), 0) AS supplier_hhi FROM ("
    "SELECT company_id, canonical, CAST(-sum(amount) AS DOUBLE) AS v FROM mapped_asof WHERE amount < 0 GROUP BY 1, 2) p GROUP BY 1",
)
cte(
    "f_recent",
    "txn_asof",
    f"SELECT company_id, CAST(sum(amount) FILTER (transaction_date >= {_D} - 90) AS DOUBLE) / nullif(CAST(coalesce(sum(amount) FILTER (transaction_date >= {_D} - 180), 0) "
    f"- coalesce(sum(amount) FILTER (transaction_date >= {_D} - 90), 0) AS DOUBLE), 0) AS v_raw, "
    f"CAST(coalesce(sum(amount) FILTER (transaction_date >= {_D} - 90), 0) AS DOUBLE) / nullif(CAST(coalesce(sum(amount) FILTER (transaction_date >= {_D} - 180), 0) "
    f"- coalesce(sum(amount) FILTER (transaction_date >= {_D} - 90), 0) AS DOUBLE), 0) AS velocity_90_180, "
    f"count(*) FILTER (transaction_date >= {_D} - 90) AS txn_count_90d, count(*) FILTER (transaction_date >= {_D} - 180) AS txn_count_180d, "
    "avg(abs(CAST(amount AS DOUBLE))) AS mean_txn_amount, median(abs(CAST(amount AS DOUBLE))) AS median_txn_amount, "
    "stddev_samp(abs(CAST(amount AS DOUBLE))) AS std_txn_amount, "
    "CASE WHEN max(transaction_date) = min(transaction_date) THEN 1.0 ELSE CAST(count(DISTINCT transaction_date) AS DOUBLE) "
    "/ (max(transaction_date) - min(transaction_date)) END AS active_days_ratio FROM txn_asof GROUP BY 1",
)
_NAMES = {f: None for f in txn.FEATURES}
cte(
    "tvec",
    "hist f_month f_streak f_runway f_payer f_hhi f_recent",
    "SELECT h.company_id, h.n AS n_transactions, "
    + ", ".join(f"CASE WHEN h.n >= 10 THEN {f} END AS {f}" for f in txn.FEATURES)
    + " FROM hist h LEFT JOIN f_month USING (company_id) LEFT JOIN f_streak USING (company_id) LEFT JOIN f_runway USING (company_id) "
    "LEFT JOIN f_payer USING (company_id) LEFT JOIN f_hhi USING (company_id) LEFT JOIN f_recent USING (company_id)",
)
_COUNTS = ["max_zero_day_streak_90d", "txn_count_90d", "txn_count_180d"]


def _transactions(spark, sf):
    return view(spark, sf, "transactions")


def _daily(spark, sf):
    return txn.daily_flows(_transactions(spark, sf), AS_OF)


def _payees(spark, sf):
    return txn.payee_flows(_transactions(spark, sf), AS_OF, simple_mapping(spark, sf))


def _feature_query(key, columns, run):
    whole = [c for c in columns if c in _COUNTS]
    real = [c for c in columns if c not in _COUNTS]
    text = oracle("SELECT * FROM tvec", " ".join(["company_id", *whole]), " ".join(real), uses="tvec")
    query(key, text)(lambda spark, sf: run(spark, sf).select("company_id", *columns))


query(
    "tf_asof_filter",
    oracle("SELECT company_id, n AS n_transactions, n >= 10 AS has_history FROM hist", "company_id n_transactions has_history", uses="hist"),
)(lambda spark, sf: txn.history_counts(_transactions(spark, sf), AS_OF).drop("as_of_date"))
query(
    "tf_monthly",
    oracle(
        "SELECT company_id, month, net, net / n AS mean_amount, n, inflow, outflow FROM by_month",
        "company_id month n", "net mean_amount inflow outflow", uses="by_month",
    ),
)(lambda spark, sf: txn.monthly_rollup(_transactions(spark, sf), AS_OF))


def _calendar(spark, sf):
    return txn.calendar_features(_daily(spark, sf))


def _amounts(spark, sf):
    rows = _transactions(spark, sf)
    joined = _calendar(spark, sf).join(txn.median_amount(rows, AS_OF), txn.KEYS)
    return joined.withColumn("median_txn_amount", txn.guarded(F.col("median_all"), F.col("n_transactions")))


def _payee_features(spark, sf):
    return txn.payee_features(_payees(spark, sf))


_feature_query("tf_cv_monthly_net", ["cv_monthly_net"], _calendar)
_feature_query("tf_net_operating_ratio", ["net_operating_ratio"], _calendar)
_feature_query("tf_txn_frequency_trend", ["txn_frequency_trend"], _calendar)
_feature_query("tf_totals", ["total_inflow", "total_outflow"], _calendar)
_feature_query("tf_max_zero_day_streak_90d", ["max_zero_day_streak_90d"], _calendar)
_feature_query("tf_velocity_90_180", ["velocity_90_180"], _calendar)
_feature_query("tf_txn_counts", ["txn_count_90d", "txn_count_180d"], _calendar)
_feature_query("tf_active_days_ratio", ["active_days_ratio"], _calendar)
_feature_query("tf_amount_stats", ["mean_txn_amount", "median_txn_amount", "std_txn_amount"], _amounts)
_feature_query("tf_months_runway", ["months_runway"], _calendar)
_feature_query("tf_recurring_revenue_ratio", ["recurring_revenue_ratio"], _payee_features)
_feature_query("tf_supplier_hhi", ["supplier_hhi"], _payee_features)


def stability(spark, sf, mapping=None):
    rows = txn.vector_rows(_transactions(spark, sf))
    mapping = simple_mapping(spark, sf, rows) if mapping is None else mapping
    return txn.stability_vector(rows, AS_OF, view(spark, sf, "companies"), mapping, written=True)


_REAL = [f for f in txn.FEATURES if f not in _COUNTS]
query(
    "tf_stability_vector",
    oracle(
        f"SELECT c.company_id, {_D} AS as_of_date, t.* EXCLUDE (company_id, n_transactions) FROM companies c LEFT JOIN tvec t USING (company_id)",
        " ".join(["company_id", "as_of_date", *_COUNTS]), " ".join(_REAL), uses="companies tvec",
    ),
)(stability)

# --- alternative features -----------------------------------------------------------------
cte(
    "spine",
    "companies",
    f"SELECT company_id, postcode_area, as_of_date FROM companies CROSS JOIN "
    f"(VALUES (DATE '{REVIEW_AS_OF}'), (DATE '{EARLY_AS_OF}')) a(as_of_date)",
)
cte(
    "f_sentiment",
    "spine google_reviews",
    "SELECT company_id, as_of_date, CASE WHEN count(*) >= 3 THEN sum(sentiment_score * w) / sum(w) END AS google_sentiment_mean, "
    "CASE WHEN count(*) >= 6 THEN regr_slope(sentiment_score, pos) WHEN count(*) >= 3 THEN 0.0 END AS google_sentiment_trend, "
    "CASE WHEN count(*) >= 3 THEN count(*) FILTER (as_of_date - review_date <= 90) / 3.0 END AS google_review_velocity FROM ("
    "SELECT s.company_id, s.as_of_date, r.review_date, r.sentiment_score, exp(-(s.as_of_date - r.review_date) / 30.0) AS w, "
    "CAST(row_number() OVER (PARTITION BY s.company_id, s.as_of_date ORDER BY r.review_date, r.sentiment_score) - 1 AS DOUBLE) AS pos "
    "FROM spine s JOIN google_reviews r ON r.company_id = s.company_id AND r.review_date <= s.as_of_date) x GROUP BY 1, 2",
)
cte(
    "f_trust",
    "spine trustpilot",
    "SELECT s.company_id, s.as_of_date, count(*) FILTER (s.as_of_date - r.review_date <= 90) AS trustpilot_90d_count, "
    "avg(CAST(r.rating AS DOUBLE)) AS trustpilot_rating_mean FROM spine s JOIN trustpilot r "
    "ON r.company_id = s.company_id AND r.review_date <= s.as_of_date GROUP BY 1, 2",
)
cte(
    "f_headcount",
    "spine headcount",
    "SELECT company_id, as_of_date, CASE WHEN count(*) >= 4 THEN CASE WHEN avg(v) > 0 THEN regr_slope(v, pos) / avg(v) ELSE 0 END END AS headcount_growth_rate, "
    "CASE WHEN count(*) >= 2 THEN CAST(arg_max(v, pos) AS INT) END AS headcount_latest FROM ("
    "SELECT s.company_id, s.as_of_date, CAST(h.headcount_estimate AS DOUBLE) AS v, "
    "CAST(row_number() OVER (PARTITION BY s.company_id, s.as_of_date ORDER BY h.scrape_date, h.headcount_estimate) - 1 AS DOUBLE) AS pos "
    "FROM spine s JOIN headcount h ON h.company_id = s.company_id AND h.scrape_date <= s.as_of_date) x GROUP BY 1, 2",
)
cte(
    "f_vacancy",
    "spine property_vacancy",
    "SELECT s.company_id, s.as_of_date, v.local_vacancy_rate, v.local_vacancy_trend FROM spine s LEFT JOIN ("
    "SELECT postcode_area, as_of_date, arg_max(vacancy_rate, pos) AS local_vacancy_rate, "
    "CASE WHEN count(*) >= 6 THEN regr_slope(vacancy_rate, pos) ELSE 0 END AS local_vacancy_trend FROM ("
    "SELECT p.postcode_area, d.as_of_date, p.vacancy_rate, CAST(row_number() OVER (PARTITION BY p.postcode_area, d.as_of_date ORDER BY p.date) - 1 AS DOUBLE) AS pos "
    "FROM property_vacancy p JOIN (SELECT DISTINCT as_of_date FROM spine) d ON p.date <= d.as_of_date) x GROUP BY 1, 2) v "
    "ON v.postcode_area = s.postcode_area AND v.as_of_date = s.as_of_date",
)
cte(
    "f_registry",
    "companies",
    "SELECT company_id, CAST(number_of_officers AS DOUBLE) AS num_officers, CAST(number_of_shareholders AS DOUBLE) AS num_shareholders, "
    "CAST(share_capital AS DOUBLE) AS share_capital, CAST(mortgages_count AS DOUBLE) AS mortgages_count, CAST(charges_count AS DOUBLE) AS charges_count FROM companies",
)
cte(
    "avec",
    "spine f_sentiment f_trust f_headcount f_vacancy f_registry",
    "SELECT s.company_id, s.as_of_date, a.* EXCLUDE (company_id, as_of_date), b.* EXCLUDE (company_id, as_of_date), "
    "c.* EXCLUDE (company_id, as_of_date), d.* EXCLUDE (company_id, as_of_date), e.* EXCLUDE (company_id) FROM spine s "
    "LEFT JOIN f_sentiment a ON a.company_id = s.company_id AND a.as_of_date = s.as_of_date "
    "LEFT JOIN f_trust b ON b.company_id = s.company_id AND b.as_of_date = s.as_of_date "
    "LEFT JOIN f_headcount c ON c.company_id = s.company_id AND c.as_of_date = s.as_of_date "
    "LEFT JOIN f_vacancy d ON d.company_id = s.company_id AND d.as_of_date = s.as_of_date "
    "LEFT JOIN f_registry e ON e.company_id = s.company_id",
)


def spine(spark, sf):
    dates = F.explode(F.array(F.lit(REVIEW_AS_OF), F.lit(EARLY_AS_OF)))
    return view(spark, sf, "companies").select("company_id", dates.alias("d")).select(
        "company_id", F.to_date("d").alias("as_of_date")
    )


def _alt_query(key, columns, table, run, whole=()):
    text = oracle(
        f"SELECT * FROM {table}", " ".join(["company_id", "as_of_date", *whole]),
        " ".join(c for c in columns if c not in whole), uses=table,
    )
    query(key, text)(lambda spark, sf: run(spark, sf).select("company_id", "as_of_date", *columns))


def _sentiment(spark, sf):
    return alt.sentiment_features(view(spark, sf, "google_reviews"), spine(spark, sf))


def _trust(spark, sf):
    return alt.rating_features(view(spark, sf, "trustpilot"), spine(spark, sf))


def _headcount(spark, sf):
    return alt.headcount_features(view(spark, sf, "headcount"), spine(spark, sf))


def _vacancy(spark, sf):
    return alt.vacancy_features(view(spark, sf, "companies"), view(spark, sf, "property_vacancy"), spine(spark, sf))


_alt_query("af_sentiment_mean", ["google_sentiment_mean"], "f_sentiment", _sentiment)
_alt_query("af_sentiment_trend", ["google_sentiment_trend"], "f_sentiment", _sentiment)
_alt_query("af_review_velocity", ["google_review_velocity"], "f_sentiment", _sentiment)
_alt_query("af_trustpilot_count", ["trustpilot_90d_count"], "f_trust", _trust, ["trustpilot_90d_count"])
_alt_query("af_trustpilot_rating", ["trustpilot_rating_mean"], "f_trust", _trust)
_alt_query("af_headcount_growth", ["headcount_growth_rate"], "f_headcount", _headcount)
_alt_query("af_headcount_latest", ["headcount_latest"], "f_headcount", _headcount, ["headcount_latest"])
_alt_query("af_vacancy_latest", ["local_vacancy_rate"], "f_vacancy", _vacancy)
_alt_query("af_vacancy_trend", ["local_vacancy_trend"], "f_vacancy", _vacancy)

query(
    "af_registry",
    oracle("SELECT * FROM f_registry", "company_id", " ".join(alt.REGISTRY_NAMES), uses="f_registry"),
)(lambda spark, sf: alt.registry_features(view(spark, sf, "companies")))


# The declared enrichment tables and the views they are filled from.
ENRICHMENT = {
    "google_reviews": "google_reviews",
    "trustpilot": "trustpilot",
    "linkedin": "headcount",
    "property_vacancy": "property_vacancy",
    "companies_house": "companies",
}


def scanned(spark, rows, name):
    """``rows`` under the declared schema of a table, written as CSV and read back."""
    fields = spark.createDataFrame([], tables.SCHEMAS[name]).schema.fields
    columns = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]
    path = work_folder(spark, f"scan-{name}")
    tables.write_table(rows.select(*columns), path, "csv")
    return tables.read_table(spark, path, name)


def enrichment(spark, sf):
    """table -> DataFrame; company ids are text in files and numbers in the given tables."""
    feeds = {t: scanned(spark, view(spark, sf, v), t) for t, v in ENRICHMENT.items()}
    number = F.col("company_id").cast("bigint")
    return {t: df.withColumn("company_id", number) if "company_id" in df.columns else df for t, df in feeds.items()}


def alternative(spark, sf, as_of=None):
    """The vector from the declared tables, written as CSV and scanned by the reader."""
    feeds = enrichment(spark, sf)
    return alt.alternative_vector(
        view(spark, sf, "companies"),
        spine(spark, sf) if as_of is None else as_of,
        *[feeds[t] for t in ("google_reviews", "trustpilot", "linkedin", "property_vacancy", "companies_house")],
    )


_ALT_WHOLE = ["trustpilot_90d_count", "headcount_latest"]
_ALT_REAL = [
    "google_sentiment_mean", "google_sentiment_trend", "google_review_velocity", "trustpilot_rating_mean",
    "headcount_growth_rate", "local_vacancy_rate", "local_vacancy_trend", *alt.REGISTRY_NAMES,
]
query(
    "af_alt_vector",
    oracle("SELECT * FROM avec", " ".join(["company_id", "as_of_date", *_ALT_WHOLE]), " ".join(_ALT_REAL), uses="avec"),
)(alternative)

# --- feature store ------------------------------------------------------------------------
cte(
    "vectors",
    "avec tvec",
    f"SELECT a.* EXCLUDE (as_of_date), {_D} AS feature_date, t.* EXCLUDE (company_id, n_transactions) "
    f"FROM avec a LEFT JOIN tvec t ON t.company_id = a.company_id WHERE a.as_of_date = DATE '{REVIEW_AS_OF}'",
)
cte("training", "vectors default_labels", "SELECT v.*, l.defaulted, l.application_date FROM vectors v LEFT JOIN default_labels l USING (company_id)")


def vectors(spark, sf, mapping=None):
    """Both families under one feature date (the sources cover different years)."""
    other = alternative(spark, sf, REVIEW_AS_OF).withColumn("as_of_date", F.to_date(F.lit(AS_OF)))
    return store.feature_vectors(stability(spark, sf, mapping), other)


def training(spark, sf, mapping=None):
    labels = view(spark, sf, "default_labels")
    return store.attach_labels(vectors(spark, sf, mapping), labels).join(
        labels.select("company_id", "application_date"), "company_id", "left"
    )


_VEC_WHOLE = ["company_id", "feature_date", *_COUNTS, *_ALT_WHOLE]
_VEC_REAL = [*_REAL, *_ALT_REAL]
query(
    "fs_feature_vector", oracle("SELECT * FROM vectors", " ".join(_VEC_WHOLE), " ".join(_VEC_REAL), uses="vectors")
)(vectors)
query(
    "fs_attach_labels",
    oracle("SELECT * FROM training", " ".join([*_VEC_WHOLE, "defaulted"]), " ".join(_VEC_REAL), uses="training"),
)(lambda spark, sf: store.attach_labels(vectors(spark, sf), view(spark, sf, "default_labels")))

_ENCODED = ["charges_count", "company_age_months", "number_of_officers"]
_AGE = "CASE WHEN company_age_months % 7 = 0 THEN NULL ELSE company_age_months END"


def _encodable(spark, sf):
    return view(spark, sf, "companies").select(
        "company_id",
        F.to_date(F.lit(AS_OF)).alias("feature_date"),
        F.col("charges_count").cast("double").alias("charges_count"),
        F.expr(_AGE).cast("double").alias("company_age_months"),
        F.col("number_of_officers").cast("double").alias("number_of_officers"),
    )


query(
    "fs_encode_json",
    oracle(
        f"SELECT company_id, {_D} AS feature_date, CAST(json_object('charges_count', CAST(charges_count AS DOUBLE), "
        f"'company_age_months', CAST({_AGE} AS DOUBLE), 'number_of_officers', CAST(number_of_officers AS DOUBLE)) AS VARCHAR) AS features_json FROM companies",
        "company_id feature_date features_json", uses="companies",
    ),
)(lambda spark, sf: store.encode_json(_encodable(spark, sf), _ENCODED))

_DECODED = oracle(
    f"SELECT company_id, {_D} AS feature_date, charges_count, {_AGE} AS company_age_months, number_of_officers FROM companies",
    "company_id feature_date", " ".join(_ENCODED), uses="companies",
)
query("fs_get_all", _DECODED)(
    lambda spark, sf: store.decode_json(store.encode_json(_encodable(spark, sf), _ENCODED), _ENCODED)
)


@query("fs_schema", _DECODED)
def _(spark, sf):
    path = work_folder(spark, "store")
    rows = store.encode_json(_encodable(spark, sf), _ENCODED).select(
        F.col("company_id").cast("string"), "feature_date", "features_json", F.current_timestamp().alias("created_at")
    )
    store.upsert(spark, path, rows)
    stored = store.read_store(spark, path).withColumn("company_id", F.col("company_id").cast("bigint"))
    return store.decode_json(stored.drop("created_at"), _ENCODED)


def store_rows(spark, sf):
    return view(spark, sf, "events").select(
        F.col("user_id").alias("company_id"), F.col("ts").cast("date").alias("feature_date"), "value",
        F.col("ts").alias("created_at"), "event_id", "event_type",
    )


query(
    "fs_upsert",
    oracle(
        "SELECT user_id AS company_id, CAST(ts AS DATE) AS feature_date, arg_max(value, ts) AS value FROM events GROUP BY 1, 2",
        "company_id feature_date", "value",
    ),
)(
    lambda spark, sf: store.merge_versions(
        store_rows(spark, sf).where("event_id % 2 = 0").drop("event_id", "event_type"),
        store_rows(spark, sf).where("event_id % 2 = 1").drop("event_id", "event_type"),
    ).drop("created_at")
)

cte(
    "versions",
    "",
    "SELECT user_id AS company_id, CAST(ts AS DATE) AS feature_date, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2",
)


@query(
    "fs_asof_lookup",
    oracle(
        "SELECT r.company_id, r.as_of_date, r.request_id, max(v.feature_date) AS feature_date, arg_max(v.value, v.feature_date) AS value FROM "
        "(SELECT event_id AS request_id, user_id AS company_id, CAST(ts AS DATE) + 1 AS as_of_date FROM events WHERE event_type <> 'view') r "
        "LEFT JOIN versions v ON v.company_id = r.company_id AND v.feature_date <= r.as_of_date GROUP BY 1, 2, 3",
        "company_id as_of_date request_id feature_date", "value", uses="versions",
    ),
)
def _(spark, sf):
    rows = store_rows(spark, sf)
    requests = rows.where("event_type <> 'view'").select(
        F.col("event_id").alias("request_id"), "company_id", F.date_add("feature_date", 1).alias("as_of_date")
    )
    return store.lookup_as_of(requests, rows.where("event_type = 'view'"), ["value"])
