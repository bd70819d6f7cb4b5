"""Interval joins and sketches on literal rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from creditloom.operators import sketches
from creditloom.plans.intervals import interval_join

START = dt.date(2020, 2, 27)


def test_interval_join_against_all_pairs(spark):
    rng = random.Random(4)
    day = lambda: START + dt.timedelta(days=rng.randrange(-40, 200))
    points = [(rng.choice("aaab"), day(), i) for i in range(200)] + [("a", None, 900), (None, START, 901)]
    ranges = [(rng.choice("aab"), *sorted((day(), day())), i) for i in range(40)]
    ranges += [("a", START, START, 40), ("a", START, START - dt.timedelta(days=1), 41), ("a", None, START, 42), (None, START, START, 43)]
    p = spark.createDataFrame(points, "k string, at date, p int")
    r = spark.createDataFrame(ranges, "k string, first date, last date, r int")
    want = sorted((i, j) for k, at, i in points for m, a, b, j in ranges if k and k == m and at and a and a <= at <= b)
    for days in (1, 32, 1000):
        assert sorted((x["p"], x["r"]) for x in interval_join(p, r, "k", "at", "first", "last", days).collect()) == want


def test_sketches_merge_within_their_bounds(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["big", "big", "big", "small"]), START + dt.timedelta(days=rng.randrange(30)), round(rng.lognormvariate(4, 2), 2), f"P{rng.randrange(3000)}") for _ in range(20_000)]
    rows += [("one", START, 5.0, "A"), ("none", START, None, None), ("one", None, 7.0, "B"), (None, START, 1.0, "A")]
    frame = spark.createDataFrame(rows, "company_id string, transaction_date date, amount double, merchant_name string")
    days = sketches.sketch_days(frame)
    last = START + dt.timedelta(days=19)
    year = frame.where(F.col("transaction_date").between(F.lit(START), F.lit(last)))
    found = {r["company_id"]: r for r in sketches.with_errors(sketches.merged(days, ["company_id"], str(START), str(last)), year, ["company_id"]).collect()}
    assert set(found) == {"big", "small", "one", "none", None}
    for r in found.values():
        assert (r["n_payees_error"] or 0) <= 5 * sketches.DISTINCT_ERROR
        assert max(r["q50_rank_error"] or 0, r["q90_rank_error"] or 0) <= 2 * sketches.RANK_ERROR
    assert found["one"]["q50"] == 5.0 and found["one"]["n_payees"] == 1
    assert (found["none"]["n"], found["none"]["q50"], found["none"]["n_payees"]) == (0, None, 0)
    assert found["big"]["n_payees_exact"] > 2500
    assert sketches.merged(days.limit(0), ["company_id"]).collect() == []
