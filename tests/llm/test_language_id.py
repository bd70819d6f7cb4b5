import itertools
import random
import zlib

import numpy as np

from creditloom.llm import language_id as li
from creditloom.llm.queries import QUERIES
from tests.llm.brute import odd_rows

SF = "/root/testdata/sf0.01"


def test_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    assert len(rows) == len(docs)
    known = {d["lang"] for d in docs.values()} | {li.UNKNOWN}
    right = held = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in known and 0 <= r["score"] <= 1
        if r["held_out"]:
            held += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert held > 100 and right / held > 0.97


def test_paths_are_the_best_ones():
    rng = np.random.default_rng(5)
    model = li.Model(["a", "b", "c"], rng.random((3, li.BUCKETS)), rng.random((3, len(li.SCRIPTS))))
    scores = [rng.normal(0, 8, (n, 3)).astype(np.float32) for n in (0, 1, 5, 6, 2, 6)]
    for score, path in zip(scores, model.paths(scores), strict=True):
        def value(p, score=score):
            return sum(float(score[i, x]) for i, x in enumerate(p)) - li.SWITCH_PENALTY * sum(a != b for a, b in zip(p, p[1:], strict=False))
        best = max(value(p) for p in itertools.product(range(3), repeat=len(score)))
        assert abs(value(list(path)) - best) < 1e-3


def test_spans_of_mixed_text_and_scripts(spark):
    rng = random.Random(6)
    words = {"en": "the and with that from house water".split(), "de": "und der nicht schöner wasser häuser straße".split(), "ru": "вода дом и не слово это".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, 30), lang) for i, lang in enumerate(list(words) * 30)]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    a, b, c = text("en", 12), text("de", 12), text("ru", 5)
    lang, score, spans = model.describe([f"{a}. {b}! {c} 123"])[0]
    assert [x[2] for x in spans] == ["en", "de", "ru"] and spans[0][:2] == (0, len(a)) and spans[1][0] == len(a) + 2
    assert spans[2][1] == len(a) + len(b) + len(c) + 4 and 0 < score < 1 and lang in ("en", "de")
    assert model.describe(["... 123 !?", None, ""]) == [(li.UNKNOWN, 0.0, [])] * 3


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = np.random.default_rng(7)
    model = li.Model(["a", "b"], rng.random((2, li.BUCKETS)), rng.random((2, len(li.SCRIPTS))))
    text = " ".join("abcdefg"[: 1 + i % 7] for i in range(500))
    whole = model.words(text)
    monkeypatch.setattr(li, "SLICE", 64)
    for x, y in zip(whole, model.words(text), strict=True):
        assert np.allclose(x, y, atol=1e-4)


def test_odd_rows(spark):
    rows = li.learn_and_identify(odd_rows(spark)).collect()
    assert len(rows) == 12
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[8]["lang_pred"] == "en"
    assert li.learn_and_identify(odd_rows(spark).limit(0)).collect() == []
    kept = li.in_known_language(odd_rows(spark))
    assert kept.columns == odd_rows(spark).columns and 1 not in {r["doc_id"] for r in kept.collect()}
    nothing = li.learn_and_identify(odd_rows(spark).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang"))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_texts_that_no_language_fits_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    by_language = {r["lang"]: r["text"] for r in docs.where("length(text) > 400").groupBy("lang").agg({"text": "min"}).withColumnRenamed("min(text)", "text").collect()}
    odd = [
        "Это простое русское предложение о погоде и природе",
        "这是一个中文句子",
        "xkcd bvnm qwrt zxcv plkj hgfd mnbv",
        " ".join(x[:300] for x in by_language.values()),
        "12 34",
        None,
    ]
    more = spark.createDataFrame([(10**9 + 4 * i, t, None) for i, t in enumerate(odd)], docs.schema)
    kept = {r["doc_id"] for r in li.in_known_language(docs.union(more)).collect()}
    assert [10**9 + 4 * i in kept for i in range(len(odd))] == [False, False, False, True, False, False]
    assert len(kept) >= 0.999 * docs.count()
