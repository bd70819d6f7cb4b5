"""Counterparty name resolution: counts, dictionaries, overrides and the full cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.names import normalise_name
from creditloom.operators.clustering import cluster_names
from creditloom.operators.fuzzy import match_names
from creditloom.session import cut_lineage

# A name with more rows than this is dealt to several tasks.
HOT_ROWS, PARTS = 1_000_000, 64

# --- fixed values: curated canonical names ------------------------------------------------
CURATED_NAMES = (
    "STARBUCKS", "AMAZON", "TESCO", "SAINSBURYS", "UBER", "SHELL", "BP", "QUICKBOOKS", "XERO",
    "SLACK", "MICROSOFT", "GOOGLE", "AWS", "DIGITALOCEAN", "STRIPE", "GOCARDLESS", "RENT",
    "UTILITIES", "INSURANCE", "ACCOUNTANT", "LEGAL", "COURIER", "CATERING", "STATIONERY", "TRAVEL",
)

# --- fixed values: manual overrides, normalised spelling and canonical name ---------------
CURATED_OVERRIDES = [
    ("DIGITAL OCEAN LLC", "DIGITALOCEAN"),
    ("DIGITALOCEANCOM", "DIGITALOCEAN"),
    ("DIGITAL OCEAN", "DIGITALOCEAN"),
    ("AWS", "AMAZON WEB SERVICES"),
    ("AWS EMEA", "AMAZON WEB SERVICES"),
    ("AMAZON WEB SERV", "AMAZON WEB SERVICES"),
    ("QB", "QUICKBOOKS"),
    ("QB ONLINE", "QUICKBOOKS"),
    ("INTUIT QUICKBOOKS", "QUICKBOOKS"),
    ("XERO SOFTWARE", "XERO"),
    ("STRIPE TECHNOLOGY EUROPE", "STRIPE"),
    ("SHELL PETROL", "SHELL"),
    ("BP CONNECT", "BP"),
    ("BP OIL UK", "BP"),
    ("BP STATION", "BP"),
    ("UBER TRIP", "UBER"),
    ("UBER EATS", "UBER"),
    ("UBER BV", "UBER"),
    ("UBER TRIP HELPUBERCOM", "UBER"),
    ("TESCO METRO", "TESCO"),
    ("TESCO EXPRESS", "TESCO"),
    ("TESCO PLC", "TESCO"),
    ("TESCO STORES", "TESCO"),
    ("TESCO RETAIL", "TESCO"),
    ("SAINSBURYS LTD", "SAINSBURYS"),
    ("SAINSBURYS LOCAL", "SAINSBURYS"),
    ("SAINSBURYS SUPERMARKET", "SAINSBURYS"),
    ("J SAINSBURY PLC", "SAINSBURYS"),
    ("STARBUCKS LTD", "STARBUCKS"),
    ("STARBUCKS LIMITED", "STARBUCKS"),
    ("STARBUCKS STORE", "STARBUCKS"),
    ("SBUK RETAIL", "STARBUCKS"),
    ("SQ STARBUCKS", "STARBUCKS"),
    ("AMAZON EU SARL", "AMAZON"),
    ("AMAZON MARKETPLACE", "AMAZON"),
    ("AMZN MKTP", "AMAZON"),
    ("SQ AMAZON", "AMAZON"),
    ("SLACK TECHNOLOGIES", "SLACK"),
    ("SLACK SUBSCRIPTION", "SLACK"),
    ("SLACK TECHNOLOGIES LTD", "SLACK"),
    ("GOCARDLESS LTD", "GOCARDLESS"),
    ("GOCARDLESS PAYMENT", "GOCARDLESS"),
    ("MICROSOFT STORE", "MICROSOFT"),
    ("MSFT", "MICROSOFT"),
    ("MICROSOFT 365", "MICROSOFT"),
    ("GOOGLE SERVICES", "GOOGLE"),
    ("GOOGLE IRELAND", "GOOGLE"),
    ("GOOGLE CLOUD", "GOOGLE"),
    ("GOOGLE ADS", "GOOGLE"),
    ("ADS", "GOOGLE"),
    ("BP OIL", "BP"),
    ("TRIP", "UBER"),
    ("WHSMITH", "STATIONERY"),
    ("RYMAN", "STATIONERY"),
    ("VIKING DIRECT", "STATIONERY"),
    ("OFFICE DEPOT", "STATIONERY"),
    ("DWF LAW", "LEGAL"),
    ("HILL DICKINSON", "LEGAL"),
    ("TROWERS HAMLINS", "LEGAL"),
    ("MILLS REEVE", "LEGAL"),
    ("SHOOSMITHS", "LEGAL"),
    ("SMITH CO ACCOUNTANTS", "ACCOUNTANT"),
    ("PKF LITTLEJOHN", "ACCOUNTANT"),
    ("MOORE KINGSTON SMITH", "ACCOUNTANT"),
    ("PARCELFORCE", "COURIER"),
    ("HERMES", "COURIER"),
    ("DPD", "COURIER"),
    ("BOOKINGCOM", "TRAVEL"),
    ("EXPEDIA", "TRAVEL"),
    ("TRAINLINE", "TRAVEL"),
    ("NATIONAL RAIL", "TRAVEL"),
    ("EASYJET", "TRAVEL"),
    ("BRITISH AIRWAYS", "TRAVEL"),
    ("RYANAIR", "TRAVEL"),
    ("JUST EAT TAKEAWAY", "CATERING"),
    ("JUST EAT", "CATERING"),
]
# -------------------------------------------------------------------------------------------


def curated_dictionary(spark: SparkSession) -> DataFrame:
    """Curated canonical names with their rank (25 fixed rows)."""
    rows = [(name, rank) for rank, name in enumerate(CURATED_NAMES, start=1)]
    return spark.createDataFrame(rows, "entry STRING, entry_rank INT")


def curated_overrides(spark: SparkSession) -> DataFrame:
    """Manual overrides as (normalised, canonical) rows (a fixed list)."""
    return spark.createDataFrame(CURATED_OVERRIDES, "normalised STRING, canonical STRING")


def name_counts(transactions: DataFrame, column: str = "merchant_name") -> DataFrame:
    """Distinct raw names with their frequency; nulls are dropped."""
    return (
        transactions.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("raw"))
        .agg(F.count("*").alias("n"))
    )


def normalise_names(names: DataFrame, column: str = "raw") -> DataFrame:
    return names.withColumn("normalised", normalise_name(F.col(column)))


def build_dictionary(counts: DataFrame, min_frequency: int = 3) -> DataFrame:
    """Normalised names seen at least ``min_frequency`` times, ranked by frequency.

    ``counts`` is the output of :func:`name_counts`, so the cascade runs once per distinct
    raw name and not once per occurrence.
    """
    return (
        normalise_names(counts)
        .groupBy(F.col("normalised").alias("entry"))
        .agg(F.sum("n").alias("frequency"))
        .where((F.col("frequency") >= min_frequency) & (F.col("entry") != ""))
    )


def ranked_dictionary(entries: DataFrame) -> DataFrame:
    """Give entries a dense order number: higher frequency first, then the name.

    The number only has to order entries, so it packs nothing and needs no global sort:
    ties between equal scores are broken on (frequency, name) directly.
    """
    return entries.withColumn("entry_rank", F.struct((-F.col("frequency")).alias("f"), F.col("entry").alias("e")))


def sanitise_dictionary(entries: DataFrame, column: str = "entry") -> DataFrame:
    """Drop null and blank entries."""
    return entries.where(F.col(column).isNotNull() & (F.regexp_replace(column, r"(?U)\s", "") != ""))


def apply_overrides(names: DataFrame, overrides: DataFrame) -> DataFrame:
    """Names whose normalised form is overridden: canonical, method 'manual', score 100."""
    return (
        names.join(overrides, "normalised")
        .withColumn("method", F.lit("manual"))
        .withColumn("score", F.lit(100.0))
    )


def resolve_names(
    names: DataFrame,
    dictionary: DataFrame,
    overrides: DataFrame,
    fuzzy_threshold: float = 70.0,
    cluster_eps: float = 0.3,
) -> DataFrame:
    """raw names -> (raw, normalised, canonical, method, score), one row for each input row.

    Work is done once per distinct normalised name; the verdicts are joined back at the end.
    Each stage is written out before the next: later stages read a stage several times.
    """
    cleaned = cut_lineage(normalise_names(names.select("raw")))
    forms = cleaned.groupBy("normalised").agg(F.count("*").alias("copies"))
    manual = overrides.select("normalised", F.col("canonical").alias("manual_name"))
    open_forms = forms.join(manual, "normalised", "left_anti")
    dictionary = cut_lineage(sanitise_dictionary(dictionary))
    matched = match_names(
        open_forms.select(F.col("normalised").alias("name")), dictionary, fuzzy_threshold
    ).select(F.col("name").alias("normalised"), F.col("match").alias("fuzzy_name"), F.col("score").alias("fuzzy_score"))
    matched = cut_lineage(matched)
    unknown = open_forms.join(matched.select("normalised"), "normalised", "left_anti")
    clustered = cluster_names(
        unknown.select(F.col("normalised").alias("name"), "copies"), cluster_eps
    ).select(F.col("name").alias("normalised"), F.col("exemplar").alias("cluster_name"))
    joined = (
        cleaned.join(manual, "normalised", "left")
        .join(matched, "normalised", "left")
        .join(clustered, "normalised", "left")
    )
    method = (
        F.when(F.col("manual_name").isNotNull(), "manual")
        .when(F.col("fuzzy_name").isNotNull(), "fuzzy")
        .when(F.col("cluster_name").isNotNull(), "clustered")
        .otherwise("unknown")
    )
    return joined.select(
        "raw",
        "normalised",
        F.coalesce("manual_name", "fuzzy_name", "cluster_name", "normalised").alias("canonical"),
        method.alias("method"),
        F.when(method == "manual", F.lit(100.0)).otherwise(F.col("fuzzy_score")).alias("score"),
    )


def apply_mapping(transactions: DataFrame, mapping: DataFrame, hot_rows: int = HOT_ROWS, parts: int = PARTS) -> DataFrame:
    """Attach the canonical name by exact raw name; unmapped rows keep their own name.

    Null names map to nothing and skip the join.  Names with over ``hot_rows`` rows are dealt
    to ``parts`` parts, and only their mapping rows are repeated for each part.
    """
    counts = transactions.where("merchant_name IS NOT NULL").groupBy("merchant_name").agg(F.count("*").alias("_rows"))
    hot = F.when(F.col("_rows") > hot_rows, parts).otherwise(1)
    wanted = mapping.select(F.col("raw").alias("merchant_name"), F.col("canonical").alias("_mapped"))
    lookup = counts.join(wanted, "merchant_name").select("merchant_name", "_mapped", hot.alias("_parts"))
    lookup = cut_lineage(lookup)
    often = lookup.where("_parts > 1")
    spread = lookup.select("merchant_name", "_mapped", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    # Hot names are few: each has more than hot_rows rows.  Joined with its own row count, a
    # transaction learns over how many parts its name is dealt.
    marked = transactions.join(often.select("merchant_name", "_parts"), "merchant_name", "left")
    over = F.when(F.col("merchant_name").isNull(), parts).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(F.xxhash64(*[c for c in transactions.columns if c != "merchant_name"]), over).cast("int")
    marked = marked.withColumn("_part", part).drop("_parts")
    return (
        marked.join(spread, ["merchant_name", "_part"], "left")
        .withColumn("canonical", F.coalesce("_mapped", "merchant_name"))
        .select(*transactions.columns, "canonical")
    )


def lookup_names(wanted: DataFrame, mapping: DataFrame) -> DataFrame:
    """Normal form of each wanted raw name with its mapping, or 'not in data'."""
    found = mapping.select("raw", F.col("canonical"), F.col("method"))
    return (
        normalise_names(wanted.select("raw"))
        .join(found, "raw", "left")
        .withColumn("status", F.when(F.col("method").isNull(), "not in data").otherwise("found"))
    )


def method_summary(mapping: DataFrame) -> DataFrame:
    """Rows for each method beside the number of distinct raw and canonical names."""
    distinct_raw = mapping.agg(F.countDistinct("raw")).scalar()
    distinct_canonical = mapping.agg(F.countDistinct("canonical")).scalar()
    return (
        mapping.groupBy("method")
        .agg(F.count("*").alias("n"))
        .withColumns({"distinct_raw": distinct_raw, "distinct_canonical": distinct_canonical})
    )
