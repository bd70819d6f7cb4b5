"""Domain tables as views over the given base tables.

One SQL text for each view serves both engines: ``{table}`` marks a base table or an
earlier view.  Spark runs them through :func:`view`; the DuckDB texts inline them as common
tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from creditloom.functions import names as nm

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

AS_OF = "1999-06-30"
REVIEW_AS_OF = "2024-01-25"
EARLY_AS_OF = "2024-01-05"

VIEWS = {
    "companies": (
        """SELECT c_custkey AS company_id, c_name AS company_name, c_mktsegment AS industry,
       lpad(CAST(c_nationkey AS STRING), 2, '0') AS postcode_area,
       CAST(1 + c_custkey % 60 AS INT) AS company_age_months,
       CAST(c_acctbal * 10 AS DECIMAL(18,2)) AS loan_amount,
       CAST(1 + c_custkey % 5 AS INT) AS number_of_officers,
       CAST(1 + c_custkey % 4 AS INT) AS number_of_shareholders,
       CAST((c_custkey % 50) * 100 AS DECIMAL(18,2)) AS share_capital,
       CAST(c_custkey % 7 AS INT) AS mortgages_count,
       CAST(c_custkey % 3 AS INT) AS charges_count
FROM {customer}""",
        "customer",
    ),
    "default_labels": (
        """SELECT c_custkey AS company_id, CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS INT) AS defaulted,
       CASE WHEN c_acctbal < 0 THEN DATE '1999-01-01' + CAST(c_custkey % 900 AS INT) END AS default_date,
       DATE '1997-01-01' + CAST((c_custkey * 37) % 1400 AS INT) AS application_date
FROM {customer}""",
        "customer",
    ),
    "inflows": (
        """SELECT o_custkey AS company_id, CAST(o_orderdate AS DATE) AS transaction_date,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       concat('PAYER ', CAST(o_orderkey % 12 AS STRING), CASE WHEN o_orderkey % 2 = 0 THEN ' LTD' ELSE '' END) AS merchant_name,
       CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_orderpriority END AS category
FROM {orders}""",
        "orders",
    ),
    "outflows": (
        """SELECT o.o_custkey AS company_id, CAST(l.l_shipdate AS DATE) AS transaction_date,
       CAST(-l.l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE l.l_suppkey % 9
         WHEN 0 THEN p.p_name
         WHEN 1 THEN concat(upper(p.p_name), ' LTD')
         WHEN 2 THEN concat('SQ *', upper(p.p_name))
         WHEN 3 THEN concat(p.p_name, ' #', CAST(l.l_suppkey AS STRING))
         WHEN 4 THEN concat(p.p_name, ' Store ', CAST(l.l_suppkey AS STRING))
         WHEN 5 THEN concat(upper(p.p_name), ' RETAIL')
         WHEN 6 THEN concat(p.p_name, ' UK Ltd')
         WHEN 7 THEN substr(p.p_name, 1, length(p.p_name) - 1)
         ELSE reverse(p.p_name) END AS merchant_name,
       CASE WHEN l.l_partkey % 33 = 0 THEN NULL ELSE p.p_type END AS category
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey""",
        "lineitem orders part",
    ),
    "transactions": ("SELECT * FROM {inflows} UNION ALL SELECT * FROM {outflows}", "inflows outflows"),
    "google_reviews": (
        """SELECT user_id AS company_id, CAST(ts AS DATE) AS review_date,
       CAST(1 + event_id % 5 AS INT) AS rating, CAST(event_id % 201 AS DOUBLE) / 100 - 1 AS sentiment_score
FROM {events} WHERE event_type IN ('view', 'click')""",
        "events",
    ),
    "trustpilot": (
        """SELECT user_id AS company_id, CAST(ts AS DATE) AS review_date,
       CAST(1 + event_id % 5 AS INT) AS rating
FROM {events} WHERE event_type IN ('purchase', 'signup')""",
        "events",
    ),
    "headcount": (
        """SELECT user_id AS company_id, CAST(ts AS DATE) AS scrape_date,
       CAST(1 + event_id % 50 AS INT) AS headcount_estimate
FROM {events} WHERE event_type = 'error'""",
        "events",
    ),
    "property_vacancy": (
        """SELECT lpad(CAST(c.c_nationkey AS STRING), 2, '0') AS postcode_area,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
       CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS vacancy_rate
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""",
        "orders customer",
    ),
    "scored": (
        """SELECT o_orderkey AS id, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INT) AS y,
       CAST((o_orderkey * 7919) % 10007 AS DOUBLE) / 10007 AS p,
       CAST((o_orderkey * 7919) % 11 AS DOUBLE) / 10 AS p_tied
FROM {orders}""",
        "orders",
    ),
    "dictionary": (
        """SELECT DISTINCT upper(p_name) AS entry, upper(p_name) AS entry_rank FROM {part}""",
        "part",
    ),
    "overrides": (
        """SELECT DISTINCT upper(p_name) AS normalised, concat('HOUSE ', upper(substr(p_name, 1, 3))) AS canonical
FROM {part} WHERE length(p_name) % 4 = 1""",
        "part",
    ),
    "taxonomy": (
        """SELECT group_rank, variant, min(variant) OVER (PARTITION BY group_rank) AS first_variant FROM (
  SELECT DISTINCT CAST(p_size % 7 AS INT) AS group_rank, p_name AS variant FROM {part} WHERE p_partkey % 3 = 0
  UNION SELECT DISTINCT CAST(p_size % 7 AS INT), concat(upper(p_name), ' LTD') FROM {part} WHERE p_partkey % 5 = 0) v""",
        "part",
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a domain view as a DataFrame."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text, uses = VIEWS[name]
    return spark.sql(text, **{u: view(spark, sf_dir, u) for u in uses.split()})


# ---------------------------------------------------------------------------------------
# The same views, and further intermediate results, as DuckDB common tables.


def _plain(text: str, uses: str) -> str:
    for used in uses.split():
        text = text.replace("{" + used + "}", used)
    return text


def duck_rules(expression: str, rules, flags: str) -> str:
    def one(inner, rule):
        pattern, replacement = rule
        return f"regexp_replace({inner}, '{pattern}', '{replacement}', '{flags}')"

    return reduce(one, rules, expression)


def duck_normalise(raw: str, upto: str = "clean") -> str:
    text = duck_rules(f"upper(coalesce({raw}, ''))", nm.EDGE_SPACE_RULES, "g")
    stages = [
        ("processor", nm.PROCESSOR_RULES, "gi"),
        ("codes", nm.CODE_RULES, "gi"),
        ("urls", nm.URL_RULES, "gi"),
        ("descriptors", nm.DESCRIPTOR_RULES, "gi"),
        ("legal", nm.LEGAL_RULES, "gi"),
        ("clean", nm.PUNCTUATION_RULES, "g"),
    ]
    for stage, rules, flags in stages:
        if upto == "upper":
            break
        text = duck_rules(text, rules, flags)
        if stage == upto:
            break
    return text


CTES: dict[str, tuple[str, list[str]]] = {}
for _name, (_text, _uses) in VIEWS.items():
    CTES[_name] = (_plain(_text, _uses), [u for u in _uses.split() if u in VIEWS])


def cte(name: str, uses: str, sql: str) -> None:
    CTES[name] = (sql, uses.split())


cte(
    "names",
    "transactions",
    "SELECT merchant_name AS raw, count(*) AS n FROM transactions WHERE merchant_name IS NOT NULL GROUP BY 1",
)
cte("normed", "names", f"SELECT raw, n, {duck_normalise('raw')} AS normalised FROM names")
cte(
    "mapped",
    "transactions normed",
    "SELECT t.*, coalesce(m.normalised, t.merchant_name) AS canonical "
    "FROM transactions t LEFT JOIN normed m ON t.merchant_name = m.raw",
)
