"""Typed table scans and sinks.  Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "DECIMAL(18,2)"

SCHEMAS = {
    "sme_profiles": (
        "company_id STRING, company_name STRING, industry STRING, incorporation_date DATE, "
        f"company_age_months INT, postcode STRING, loan_amount {MONEY}, num_employees INT, default_base_rate DOUBLE"
    ),
    "transactions": (
        f"company_id STRING, transaction_date DATE, amount {MONEY}, merchant_name STRING, "
        "category STRING, payment_method STRING, reference STRING"
    ),
    "default_labels": "company_id STRING, defaulted INT, default_date DATE, application_date DATE",
    "companies_house": (
        "company_id STRING, company_name STRING, company_number STRING, incorporation_date DATE, "
        "company_status STRING, company_type STRING, registered_office_postcode STRING, sic_code STRING, "
        "accounts_next_due DATE, confirmation_statement_next_due DATE, filing_frequency STRING, "
        f"number_of_officers INT, number_of_shareholders INT, share_capital {MONEY}, "
        "mortgages_count INT, charges_count INT"
    ),
    "google_reviews": "company_id STRING, review_date DATE, rating INT, sentiment_score DOUBLE",
    "trustpilot": "company_id STRING, review_date DATE, rating INT",
    "linkedin": "company_id STRING, scrape_date DATE, headcount_estimate INT",
    "property_vacancy": "postcode_area STRING, date DATE, vacancy_rate DOUBLE",
    "merchant_mapping": "raw STRING, normalised STRING, canonical STRING, method STRING, score DOUBLE",
    "ground_truth": "raw_name STRING, true_canonical STRING",
    "feature_vectors": "company_id STRING, feature_date DATE, features_json STRING, created_at TIMESTAMP",
}


def read_table(spark: SparkSession, path: str, name: str, file_format: str = "csv") -> DataFrame:
    """Scan one registered table; code columns keep their leading zeros."""
    reader = spark.read.schema(SCHEMAS[name])
    if file_format == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.format(file_format).load(path)


def parse_dates(df: DataFrame, *columns: str, strict: bool = True) -> DataFrame:
    """ISO text to DATE.  Strict parsing fails on malformed text; the lenient one gives null."""
    parse = F.to_date if strict else (lambda c, f: F.expr(f"CAST(try_to_timestamp({c}, '{f}') AS DATE)"))
    parsed = {c: (parse(F.col(c), "yyyy-MM-dd") if strict else parse(c, "yyyy-MM-dd")) for c in columns}
    return df.withColumns(parsed)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Bag union of feeds by column name."""
    result = feeds[0]
    for feed in feeds[1:]:
        result = result.unionByName(feed)
    return result


def write_table(df: DataFrame, path: str, file_format: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table; tables with a feature date are partitioned by it."""
    writer = df.write.mode(mode).format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if "feature_date" in df.columns:
        writer = writer.partitionBy("feature_date")
    writer.save(path)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Write a small frame of (nested) metrics as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_metrics_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
