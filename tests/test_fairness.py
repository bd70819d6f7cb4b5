"""The three gates of the fairness scan on literal rows."""

import pytest

from creditloom.operators import decisions


def test_all_three_gates(spark):
    decided = spark.createDataFrame(
        [("a", "X", "APPROVE"), ("b", "X", "DECLINE"), ("c", "Y", "APPROVE"), ("d", None, "APPROVE")],
        "company_id string, industry string, decision string",
    )
    drivers = spark.createDataFrame(
        [("a", 1, "f"), ("a", 2, "known"), ("b", 4, "known"), ("c", 1, "f"), ("d", 3, "known")],
        "company_id string, position int, feature string",
    )
    vectors = spark.createDataFrame(
        [("a", 1.0, 2, 5.0), ("b", 2.0, 4, 5.0), ("c", 3.0, None, 5.0), ("d", 4.0, 1, 5.0)],
        "company_id string, f double, officers int, flat double",
    )
    found = decisions.fairness_scan(decided, drivers, "industry", ["known"], vectors, ["f", "flat"], ["officers"]).collect()
    groups = {r["industry"]: r for r in found if r["feature"] is None}
    assert {g: (r["n"], r["approval_rate"], r["parity_gap"], r["proxy_share"]) for g, r in groups.items()} == {
        "X": (2, 0.5, -0.25, 0.5), "Y": (1, 1.0, 0.25, 0.0), None: (1, 1.0, 0.25, 1.0),
    }
    pairs = {(r["feature"], r["proxy"]): r["r"] for r in found if r["feature"] is not None}
    assert pairs.keys() == {("f", "officers"), ("flat", "officers")}
    # Over the rows that have both values: f 1, 2, 4 and officers 2, 4, 1.
    assert pairs["f", "officers"] == pytest.approx(-0.5, abs=0.02)
    assert pairs["flat", "officers"] is None
    assert sum(r["n"] is None for r in found) == 2
