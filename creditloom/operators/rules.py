"""Deterministic business rules over companies and transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: industry rows ----------------------------------------------------------
# industry, transactions a month, base default rate, peak months, peak multiplier
INDUSTRIES = [
    ("Technology", 80, 0.12, [], 1.0),
    ("Retail", 150, 0.18, [11, 12], 2.5),
    ("Professional Services", 45, 0.10, [], 1.0),
    ("Hospitality", 200, 0.22, [6, 7, 8, 12], 2.0),
    ("Construction", 60, 0.16, [4, 5, 6, 7, 8, 9], 1.8),
    ("Healthcare", 70, 0.08, [], 1.0),
]

# --- fixed values: category of each merchant group ----------------------------------------
CATEGORIES = [
    ("Starbucks", "Food & Drink"),
    ("Amazon", "Supplies"),
    ("Tesco", "Food & Drink"),
    ("Sainsburys", "Food & Drink"),
    ("Uber", "Travel"),
    ("Shell", "Fuel"),
    ("BP", "Fuel"),
    ("QuickBooks", "Software"),
    ("Xero", "Software"),
    ("Slack", "Software"),
    ("Microsoft", "Software"),
    ("Google", "Software"),
    ("AWS", "Software"),
    ("DigitalOcean", "Software"),
    ("Stripe", "Payment Processing"),
    ("GoCardless", "Payment Processing"),
    ("Rent", "Rent"),
    ("Utilities", "Utilities"),
    ("Insurance", "Insurance"),
    ("Accountant", "Professional Services"),
    ("Legal", "Professional Services"),
    ("Courier", "Logistics"),
    ("Catering", "Food & Drink"),
    ("Stationery", "Supplies"),
    ("Travel", "Travel"),
]
# -------------------------------------------------------------------------------------------

YOUNG_MONTHS, SETTLING_MONTHS, LARGE_LOAN = 12, 24, 50000
DISTRESS_DAYS = 180
INDUSTRY_DDL = (
    "industry STRING, avg_monthly_txns INT, base_rate DOUBLE, peak_months ARRAY<INT>, peak_multiplier DOUBLE"
)


def industry_dimension(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or INDUSTRIES, INDUSTRY_DDL)


def category_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "merchant_group STRING, category STRING")


def prior_default_rate(companies: DataFrame, industries: DataFrame) -> DataFrame:
    """Industry base rate plus loadings for young companies and large loans."""
    age = F.col("company_age_months")
    loading = F.when(age < YOUNG_MONTHS, 0.08).when(age < SETTLING_MONTHS, 0.04).otherwise(0.0)
    loan = F.when(F.col("loan_amount") > LARGE_LOAN, 0.02).otherwise(0.0)
    return companies.join(industries.select("industry", "base_rate"), "industry", "left").select(
        "company_id", "industry", (F.col("base_rate") + loading + loan).alias("prior_pd")
    )


def lookup_category(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Category of a merchant group, 'Other' when unknown."""
    looked = dimension.select(F.col("merchant_group").alias(key), F.col("category").alias("_found"))
    return df.join(looked, key, "left").withColumn("category_found", F.coalesce("_found", F.lit("Other"))).drop("_found")


def category_null_rate(transactions: DataFrame) -> DataFrame:
    missing = F.col("category").isNull().cast("double")
    return transactions.groupBy("merchant_name").agg(F.avg(missing).alias("null_rate"), F.count("*").alias("n"))


def distress_multiplier(days_to_default: Column) -> Column:
    inside = (days_to_default > 0) & (days_to_default <= DISTRESS_DAYS)
    return F.when(inside, 0.5 + 0.5 * (days_to_default / float(DISTRESS_DAYS))).otherwise(1.0)


def distress_window(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions within 180 days before their company's default, with the intensity."""
    dated = labels.where(F.col("default_date").isNotNull()).select("company_id", "default_date")
    days = F.datediff("default_date", "transaction_date")
    return (
        transactions.join(dated, "company_id")
        .withColumn("days_to_default", days)
        .where((F.col("days_to_default") > 0) & (F.col("days_to_default") <= DISTRESS_DAYS))
        .withColumn("intensity", distress_multiplier(F.col("days_to_default")))
    )


def seasonal_multiplier(date: str) -> Column:
    """The industry's multiplier in its peak months, otherwise 1."""
    return F.when(F.array_contains("peak_months", F.month(date)), F.col("peak_multiplier")).otherwise(1.0)


def month_panel(entities: DataFrame, start: str, end: str) -> DataFrame:
    """One row per entity and month start from ``start`` to ``end``."""
    months = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 MONTH"))
    return entities.withColumn("month", F.explode(months))


def postcode_areas(companies: DataFrame, column: str = "postcode_area") -> DataFrame:
    return companies.select(F.substring(column, 1, 2).alias("postcode_area")).distinct()


def expected_daily_counts(
    transactions: DataFrame, companies: DataFrame, labels: DataFrame, industries: DataFrame
) -> DataFrame:
    """Observed transactions for each active day against the rate the rules expect."""
    observed = transactions.groupBy("company_id", "transaction_date").agg(F.count("*").alias("observed"))
    described = (
        companies.select("company_id", "industry")
        .join(industries, "industry")
        .join(labels.select("company_id", "default_date"), "company_id", "left")
    )
    days = F.datediff("default_date", "transaction_date")
    expected = (
        F.col("avg_monthly_txns") / 30.0 * seasonal_multiplier("transaction_date") * distress_multiplier(days)
    )
    return observed.join(described, "company_id").select(
        "company_id", "transaction_date", "observed", expected.alias("expected")
    )
