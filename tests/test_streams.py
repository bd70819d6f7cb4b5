"""Streams over several arrivals against plain Python."""

import datetime as dt
import random
from collections import Counter

from creditloom.operators import profile, resolution_eval
from creditloom.streaming import feeds

DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def rows_of(rng, n, low, high):
    return [(i, START + dt.timedelta(seconds=rng.randrange(low * 86400, high * 86400)), rng.choice([1, 2, 2, 2, 3]), "x", 1.0, None) for i in range(n)]


def plain_windows(arrivals, days):
    kept, newest = [], None
    for rows in arrivals:
        mark = newest - DAY if newest else None
        for _, ts, user, *_ in rows:
            if ts is not None and user is not None and (mark is None or ts.replace(hour=0, minute=0, second=0) + DAY > mark):
                kept.append((user, ts.date()))
        newest = max([r[1] for r in rows if r[1] and r[2] is not None] + ([newest] if newest else []))
    counts = Counter()
    for user, day in kept:
        for k in range(days):
            counts[user, day - k * DAY] += 1
    return counts


def test_sliding_windows_close_and_late_rows_go(spark, tmp_path):
    rng = random.Random(6)
    arrivals = [rows_of(rng, 60, 0, 12), rows_of(rng, 50, 11, 25), rows_of(rng, 10, 5, 26), rows_of(rng, 20, 60, 70), rows_of(rng, 5, 69, 75)]
    arrivals[1] += [(900, None, 1, "x", 1.0, None), (901, START + 20 * DAY, None, "x", 1.0, None)]
    for days in (5, 90):
        folder, work = f"{tmp_path}/in-{days}", f"{tmp_path}/work-{days}"
        for rows in arrivals:
            spark.createDataFrame(rows, DDL).repartition(3).write.mode("append").parquet(folder)
            found = feeds.sliding_activity(feeds.event_stream(spark, folder, pattern="*.parquet"), work, days)
        got = found.collect()
        assert {(r["user_id"], r["window_start"]): r["n"] for r in got} == plain_windows(arrivals, days)
        assert len({(r["user_id"], r["window_start"]) for r in got}) == len(got)


def test_state_holds_open_days_only():
    """Windows that are all closed leave the state."""

    class State:
        exists, get = False, None

        def __init__(self):
            self.mark = 0

        def getCurrentWatermarkMs(self):
            return self.mark

        def update(self, value):
            self.exists, self.get = True, value

    import pandas as pd

    state, run = State(), feeds._slide(5)
    for day in range(0, 400, 2):
        state.mark = max(0, day - 1) * feeds.DAY_MS
        list(run((1,), [pd.DataFrame({"day": [day], "n": [3]})], state))
        assert len(state.get[1]) <= 14


def test_totals_are_told_from_nulls(spark):
    companies = spark.createDataFrame([(1, "A", "x"), (2, "A", None), (3, None, "x"), (4, None, None)], "company_id int, industry string, postcode_area string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "company_id int, defaulted int")
    got = {(r["industry"], r["postcode_area"], r["level"]): (r["default_rate"], r["n_companies"]) for r in profile.default_rate_totals(companies, labels).collect()}
    assert got[None, None, 3] == (2 / 3, 4) and got[None, None, 0] == (None, 1)
    assert got["A", None, 1] == (0.5, 2) and got["A", None, 0] == (0.0, 1) and got[None, "x", 2] == (1.0, 2)
    assert len(got) == 9


def test_drift_counts_repeats(spark):
    old = spark.createDataFrame([("a", "A")] * 3 + [("b", None)] * 2, "normalised string, canonical string")
    new = spark.createDataFrame([("a", "A"), ("b", None), ("b", None), ("b", None), ("c", "C")], old.schema)
    got = {(r["normalised"], r["change"]): r["n"] for r in resolution_eval.mapping_drift(old, new).collect()}
    assert got == {("a", "kept"): 1, ("a", "removed"): 2, ("b", "kept"): 2, ("b", "added"): 1, ("c", "added"): 1}


def test_quiet_gaps_open_and_close(spark, tmp_path):
    """A gap is there while it is open, gets its end, and late rows fall into their place."""
    hour = 3600

    def at(hours, user=1):
        return (0, START + dt.timedelta(seconds=round(hours * hour)), user, "x", 1.0, None)

    def found(rows):
        spark.createDataFrame(rows, DDL).write.mode("append").parquet(f"{tmp_path}/in")
        stream = feeds.event_stream(spark, f"{tmp_path}/in", pattern="*.parquet")
        got = feeds.quiet_gaps(stream, f"{tmp_path}/work", 10 * hour * 1000, "5 hours").collect()
        zero = (START - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        hours = lambda us: None if us is None else (us - zero) / (hour * 1e6)
        return {(r["user_id"], hours(r["start_us"]), hours(r["end_us"])) for r in got}

    assert found([at(0), at(1), at(3), at(12.5), at(30, 2), at(1, 3)]) == {(1, 12.5, None), (3, 1, None)}
    # 40 of company 1 ends its gap; 27 of company 2 is late but in time, 2 of company 3 is too late.
    assert found([at(40), at(27, 2), at(2, 3), at(41, 2), (0, None, 1, "x", 1.0, None)]) == {(1, 12.5, None), (3, 1, None)}
    assert found([at(60, 2)]) == {(1, 12.5, 40), (1, 40, None), (2, 30, 41), (2, 41, None), (3, 1, None)}


def test_quiet_gaps_end_inside_a_span(spark, tmp_path):
    """A gap gets its end as soon as the watermark has passed it, also if later events of the span still wait."""
    half_day = 43_200_000

    def found(rows):
        rows = [(0, START + dt.timedelta(hours=h), user, "x", 1.0, None) for h, user in rows]
        spark.createDataFrame(rows, DDL).write.mode("append").parquet(f"{tmp_path}/in")
        stream = feeds.event_stream(spark, f"{tmp_path}/in", pattern="*.parquet")
        got = feeds.quiet_gaps(stream, f"{tmp_path}/work", half_day, "5 hours").collect()
        return {(r["user_id"], r["end_us"] and (r["end_us"] - r["start_us"]) / 3.6e9) for r in got}

    assert START.hour == 0
    assert found([(0, 1), (17.5, 2)]) == {(1, None)}
    assert found([(13, 1), (20, 1), (21, 2)]) == {(1, 13)}
