import random

import numpy as np
import pandas as pd
import pytest

from creditloom.llm import ngram_join
from creditloom.llm.queries import QUERIES
from tests.llm.brute import ODD, components, odd_rows

SF = "/root/testdata/sf0.001"


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op5_ngram_jaccard"](spark, SF)) == components(docs)


def corpus(rng):
    """Copies, near copies of several degrees, and documents around one shared passage."""
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, base = prose(40), prose(120)
    texts = [passage + prose(rng.choice([5, 8, 12, 40])) for _ in range(50)]
    for k in range(60):
        t = list(base)
        for _ in range(k % 6):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        texts.append(t)
    texts += [prose(rng.randint(1, 60)) for _ in range(40)]
    texts += [texts[3], texts[60], texts[60], texts[61]]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("long_column, row_block, frequent, share", [(4, 7, 3, 0.25), (2, 3, 2, 0.9), (64, 1024, 24, 0.25), (10, 16, 10**6, 0.25)])
def test_long_columns_lose_no_link(spark, monkeypatch, long_column, row_block, frequent, share):
    monkeypatch.setattr(ngram_join, "LONG_COLUMN", long_column)
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", row_block)
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 13)
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", frequent)
    monkeypatch.setattr(ngram_join, "CUT", int(share * 2**64))
    docs = corpus(random.Random(long_column))
    assert found(ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id long, text string"))) == components(docs)


def test_few_frequent_columns_are_shipped(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", 2)
    monkeypatch.setattr(ngram_join, "MOST_FREQUENT", 5)
    docs = corpus(random.Random(1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(ngram_join._frequent(ngram_join._low_columns(frame, "text", 4))) <= 5
    assert found(ngram_join.ngram_components(frame)) == components(docs)


def test_odd_rows(spark):
    rows = ngram_join.ngram_components(odd_rows(spark)).collect()
    assert len(rows) == 12
    want = components(ODD)
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        else:
            assert (r["n_shingles"], r["component_id"]) == (1, 4)


def test_empty_table_and_null_ids_alone(spark):
    assert ngram_join.ngram_components(odd_rows(spark).limit(0)).collect() == []
    alone = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "d")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in ngram_join.ngram_components(alone).collect()) == [(0, 0), (0, 0), (1, 1)]


def test_one_of_each_group_stays(spark):
    kept = ngram_join.one_of_each_group(odd_rows(spark))
    assert kept.columns == odd_rows(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [1, 2, 3, 4, 7, 8, 9, 10]


def test_repeats_leave_one_row(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "c d e"), (None, "x y"), (None, "x y"), (None, "z"), (2, None), (2, None), (2, ""), (None, ""), (None, ""), (3, "Z")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, th long")
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.one_of_each_group(docs).collect()), key=str)
    assert kept == sorted([(1, "a b"), (1, "c d e"), (None, "x y"), (2, None), (2, ""), (None, ""), (3, "Z")], key=str)
    assert ngram_join.one_of_each_group(docs.limit(0)).collect() == []


def test_many_texts_without_an_id(spark):
    """Documents without an id are classes of their own and are linked like any other."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        t = [rng.choice(words) for _ in range(60)]
        texts += [" ".join(t), " ".join([*t[:-1], "other"]), " ".join(t)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert ngram_join.one_of_each_group(docs).count() == 40


def test_ties_of_long_rows_are_exact():
    shared = 85 * 1069  # times 185 is odd and over 2^24
    a = np.arange(98883)
    b = np.concatenate([a[:shared], np.arange(200000, 200000 + 98882 - shared)])
    assert 100 * shared == 85 * (len(a) + len(b) - shared)
    block = pd.DataFrame({"id": [1, 2], "own": [1, 2], "part": [0, 0], "grams": [a, b]})
    assert ngram_join._products(85)(("g", 0, 0), block).values.tolist() == [[1, 2]]


def test_few_marked_rows_do_not_move_the_texts(spark):
    """Rows to drop that are few go to the tasks of the texts, whatever the session's own limit."""
    rows = [(i, f"a b c d e f g h {i % 3}") for i in range(9)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = ngram_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
