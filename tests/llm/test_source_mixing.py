import pytest
from pyspark.sql import functions as F

from creditloom.llm import source_mixing as m
from creditloom.llm.queries import ORACLES, QUERIES
from tests.check import compare, duck
from tests.llm.brute import ODD, odd_rows, plain_words

SF = "/root/testdata/sf0.001"


def test_query_against_sql(spark):
    verdict = compare(spark, duck(SF), "op6_source_mixing", SF, QUERIES, ORACLES)
    assert verdict.startswith("ok "), verdict


def test_only_functions(spark):
    plan = m.mix(spark.read.parquet(f"{SF}/documents.parquet"), cycles=1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_expected_shares_hit_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = m.mix(docs).toPandas()
    assert rows["probability"].max() == pytest.approx(1.0) and rows["probability"].between(0, 1).all()
    for axis in m.AXES:
        tokens = rows.groupby(axis)["n_tokens"].sum()
        target = tokens[tokens > 0] ** m.TEMPERING[axis]
        want = (rows["n_tokens"] * rows["probability"]).groupby(rows[axis]).sum()
        assert (want / want.sum() - target / target.sum()).abs().max() < (1e-12 if axis == "topic" else 1e-3)
    assert 0 < rows["sampled"].sum() < len(rows)


def test_zero_cells_and_contradictions(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 10), ("b", "x", 5), ("b", "y", 0)], "source string, lang string, tokens long")
    targets = {
        "source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, target double"),
        "lang": spark.createDataFrame([("x", 0.7), ("y", 0.3)], "lang string, target double"),
    }
    rows = m.rake(cells, targets, cycles=12).collect()
    weight = {(r["source"], r["lang"]): r["tokens"] * r["factor"] for r in rows}
    assert weight == {("a", "x"): pytest.approx(0.2, abs=1e-4), ("a", "y"): pytest.approx(0.3), ("b", "x"): pytest.approx(0.5, abs=1e-4)}


def test_odd_rows(spark):
    rows = m.mix(odd_rows(spark), cycles=3).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] is not None:
            assert r["n_tokens"] == len(plain_words(dict(ODD)[r["doc_id"]]))
        assert r["probability"] > 0 if r["n_tokens"] else r["probability"] == 0
        assert not (r["sampled"] and (r["doc_id"] is None or not r["n_tokens"]))
    assert m.mix(odd_rows(spark).limit(0), cycles=1).collect() == []
    assert m.mix(odd_rows(spark).where(F.col("text").isNull()), cycles=1).count() == 1


def test_a_rare_cell_does_not_set_the_rate(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang")
    tiny = spark.createDataFrame([(10**9, "one", "tiny source", "tiny language")], docs.schema)
    rows = m.mix(docs.union(tiny)).toPandas()
    share = (rows["n_tokens"] * rows["probability"]).sum() / rows["n_tokens"].sum()
    assert share == pytest.approx(m.KEEP, abs=1e-4)
    assert rows.set_index("doc_id")["probability"][10**9] == 1.0
    reached = m.marginals(m.mix(docs.union(tiny))).toPandas()
    large = reached[reached["tokens"] > 1]
    assert (large["target"] - large["reached"]).abs().max() < 0.02
    assert reached.groupby("axis")["reached"].sum().between(1 - 1e-9, 1 + 1e-9).all()
