"""Partitions that follow the rows of a table, and statistics that do not exchange all of them."""

import datetime as dt

from pyspark.sql import functions as F

from creditloom import session
from creditloom.plans import timeline as tl


def test_marks_are_spread_by_their_number(spark):
    """Keys of a few bytes that become many marks do not meet in a few tasks."""
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(100)]
    keys = spark.range(10_000).withColumnRenamed("id", "k")
    events = keys.where("k < 10").select("k", F.lit(19_723).alias(tl.AT), F.lit(1).alias("v"))
    line = tl.timeline([events], tl.Dates(dates, "k"), keys, {"now": lambda d: d})
    sizes = [r["count"] for r in line.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 10 + 1_000_000
    assert max(sizes) < 2 * session.ROWS_PER_PART


def test_column_quantiles_exchange_few_values(spark):
    """Exact on long, short, tied, empty and constant columns; the old form exchanged every value."""
    import numpy as np

    from creditloom.plans.ranks import column_quantiles

    x = np.random.default_rng(1).lognormal(0, 3, 40_000)
    rows = [(float(v), float(round(v)), float(v) if i < 3 else None, None, 7.0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "a DOUBLE, tied DOUBLE, short DOUBLE, none DOUBLE, flat DOUBLE")
    got = column_quantiles(df, df.columns, [0.0, 0.25, 0.5, 0.75, 1.0])
    assert set(got) == {"a", "tied", "short", "flat"}
    for c, i in (("a", 0), ("tied", 1), ("short", 2), ("flat", 4)):
        want = np.quantile([r[i] for r in rows if r[i] is not None], [0.0, 0.25, 0.5, 0.75, 1.0])
        assert np.allclose(got[c], want, rtol=1e-12)


def test_validation_makes_the_profiles_once(spark):
    from creditloom.operators import profile

    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v

    rows = [(i % 2, float(i), float(i), 0.5) for i in range(40)]
    profiles = spark.createDataFrame(rows, "defaulted INT, cv_txn DOUBLE, top_5_concentration DOUBLE, active_days_ratio DOUBLE")
    profiles = profiles.withColumn("top_5_concentration", F.udf(seen, "double")("top_5_concentration"))
    amounts = spark.createDataFrame([(1.0,), (1.0,), (9.0,)], "amount DOUBLE")
    assert profile.validation_checks(amounts, profiles).count() == 6
    assert profile.validation_checks(amounts, profiles).where("passed").count() == 5
    assert made.value == 2 * len(rows)


def test_daily_rows_of_the_vector_are_dealt_in_bounded_parts(spark, monkeypatch):
    """The day windows of the training table get as many parts as its transactions need."""
    from creditloom.operators import txn_features as txn

    parts = []

    def dealt(df, n_rows, *keys):
        parts.append((n_rows, session.dealt(df, n_rows, *keys)))
        return parts[-1][1]

    monkeypatch.setattr(session, "ROWS_PER_PART", 50)
    monkeypatch.setattr(txn, "dealt", dealt)
    rows = [(i % 30, dt.date(2024, 1, 1 + i % 28), float(i - 150), "A") for i in range(300)]
    rows = spark.createDataFrame(rows, "company_id LONG, transaction_date DATE, amount DOUBLE, merchant_name STRING")
    rows = rows.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    assert txn.stability_vector(rows, "2024-06-30").count() == 30
    assert [n for n, _ in parts] == [300] and parts[0][1].rdd.getNumPartitions() == 6


def test_families_of_the_vector_are_dealt_before_they_are_summed(spark, monkeypatch):
    """Days, payees and the median are exchanged in parts of a bounded number of rows, with the same results."""
    from creditloom.operators import txn_features as txn

    monkeypatch.setattr(session, "ROWS_PER_PART", 50)
    written = []
    monkeypatch.setattr(txn, "cut_lineage", lambda df: written.append((df.columns, df.rdd.getNumPartitions())) or session.cut_lineage(df))
    day, names = dt.date(2024, 1, 1), ["A", "B", None]
    rows = [(i % 30 or None, day + dt.timedelta(days=i % 90), None if i % 17 == 0 else float(i - 150), names[i % 3]) for i in range(300)]
    rows = spark.createDataFrame([*rows, *rows[:60]], "company_id LONG, transaction_date DATE, amount DOUBLE, merchant_name STRING")
    rows = rows.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    mapping = spark.createDataFrame([("A", "X"), ("B", "X")], "raw STRING, canonical STRING")
    assert txn.stability_vector(rows, "2024-06-30", mapping=mapping).count() == 29
    assert [n for c, n in written if "canonical" in c and "inflow" in c] == [8]
    as_text = lambda df: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    for make in (txn.daily_flows, lambda *a, **k: txn.payee_flows(*a, mapping, **k), txn.median_amount):
        assert as_text(make(rows, "2024-06-30", n_rows=360)) == as_text(make(rows, "2024-06-30"))
    plan = txn.median_amount(rows, "2024-06-30", 360)
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()
    assert txn.daily_flows(rows, "2024-06-30", 360).rdd.getNumPartitions() == 8


def test_rows_of_a_fit_fill_every_slot_alike(spark, monkeypatch):
    """Nine parts on eight slots would make every job of a fit wait for one task; few rows stay in few parts."""
    from creditloom.operators import models

    cells = [(F.col("id") % n).cast("double").alias(f) for f, n in (("supplier_hhi", 7), ("total_inflow", 11))]
    train = spark.range(0, 900, 1, 9).select(*cells, (F.col("id") % 2).cast("int").alias("defaulted"))
    parts = lambda: [r["count"] for r in models.prepared(train, ["supplier_hhi", "total_inflow"])[1].groupBy(F.spark_partition_id()).count().collect()]
    assert parts() == [900]
    monkeypatch.setattr(models, "ROWS_PER_TASK", 50)
    slots = spark.sparkContext.defaultParallelism
    assert sum(parts()) == 900 and len(parts()) == slots * -(-18 // slots)
    assert max(parts()) - min(parts()) <= 9
