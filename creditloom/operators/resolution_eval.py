"""Evaluation of a name mapping against known truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.names import normalise_name
from creditloom.operators.profile import sample_rows


def join_truth(mapping: DataFrame, truth: DataFrame) -> DataFrame:
    """Predictions that have a known truth."""
    return mapping.join(truth.withColumnRenamed("raw_name", "raw"), "raw")


def _correct():
    return F.coalesce(F.col("canonical") == F.col("true_canonical"), F.lit(False)).cast("double")


def accuracy(joined: DataFrame) -> DataFrame:
    return joined.agg(
        F.coalesce(F.avg(_correct()), F.lit(0.0)).alias("overall_accuracy"), F.count("*").alias("n_evaluated")
    )


def method_accuracy(joined: DataFrame) -> DataFrame:
    return joined.groupBy("method").agg(F.avg(_correct()).alias("accuracy"), F.count("*").alias("n"))


def coverage(joined: DataFrame) -> DataFrame:
    """Share of names resolved to something other than their normal form."""
    changed = (F.col("canonical") != F.col("normalised")).cast("double")
    return joined.agg(F.coalesce(F.avg(changed), F.lit(0.0)).alias("coverage"))


def volume_coverage(transactions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Share of the absolute amount whose canonical name differs from the raw name.

    ``volume_coverage`` counts unmatched names as covered; ``strict_coverage`` does not.
    Amounts are summed per raw name before the join.
    """
    volumes = transactions.groupBy(F.col("merchant_name").alias("raw")).agg(F.sum(F.abs("amount")).alias("volume"))
    joined = volumes.join(mapping.select("raw", "canonical"), "raw", "left")
    volume = F.col("volume").cast("double")
    differs = F.col("canonical") != F.col("raw")
    loose = F.sum(F.when(F.col("canonical").isNull() | differs, volume).otherwise(0.0))
    strict = F.sum(F.when(differs, volume).otherwise(0.0))
    total = F.sum(volume)
    return joined.agg(
        F.coalesce(F.try_divide(loose, total), F.lit(0.0)).alias("volume_coverage"),
        F.coalesce(F.try_divide(strict, total), F.lit(0.0)).alias("strict_coverage"),
    )


def confusion_sample(joined: DataFrame, n: int = 20) -> DataFrame:
    """The first n wrong names in name order."""
    return (
        joined.where(_correct() == 0.0)
        .select("raw", "normalised", "canonical", "true_canonical", "method")
        .orderBy("raw")
        .limit(n)
    )


def truth_sample(names: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """n distinct names with their normal form as truth."""
    distinct = names.select("raw").where(F.col("raw").isNotNull()).distinct()
    return sample_rows(distinct, n, "raw", seed).select(
        F.col("raw").alias("raw_name"), normalise_name(F.col("raw")).alias("true_canonical")
    )


def truth_from_taxonomy(names: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Truth = normal form of the first variant of the first group that lists the name.

    ``taxonomy`` is (group_rank, variant, first_variant).
    """
    groups = taxonomy.groupBy(F.col("variant").alias("raw")).agg(F.min_by("first_variant", "group_rank").alias("first_variant"))
    return names.select("raw").join(groups, "raw", "left").select(
        F.col("raw").alias("raw_name"), normalise_name(F.coalesce("first_variant", "raw")).alias("true_canonical")
    )


def evaluate(mapping: DataFrame, truth: DataFrame, transactions: DataFrame | None = None) -> DataFrame:
    """One row of all scalar metrics with the per-method ones as an array of structs."""
    joined = join_truth(mapping, truth)
    methods = method_accuracy(joined).agg(F.sort_array(F.collect_list(F.struct("method", "accuracy", "n"))))
    row = accuracy(joined).withColumns(
        {"coverage": coverage(joined).scalar(), "method_accuracy": methods.scalar()}
    )
    if transactions is None:
        return row
    return row.withColumn("volume_coverage", volume_coverage(transactions, mapping).select("volume_coverage").scalar())


def mapping_drift(old: DataFrame, new: DataFrame, columns=("normalised", "canonical")) -> DataFrame:
    """(columns, change, n): rows that two versions of a mapping share, and those of one alone.

    Versions are bags: a row that stands three times in the one and once in the other is 'kept'
    once and 'removed' (or 'added') twice.  Nulls are values like others.
    """
    old, new = old.select(*columns), new.select(*columns)
    parts = [(old.intersectAll(new), "kept"), (old.exceptAll(new), "removed"), (new.exceptAll(old), "added")]
    counted = [df.groupBy(*columns).agg(F.count("*").alias("n")).withColumn("change", F.lit(name)) for df, name in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])
