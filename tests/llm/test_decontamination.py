import random

import numpy as np

from creditloom.llm import decontamination as d
from creditloom.llm.queries import QUERIES
from tests.llm.brute import edit_distance, odd_rows

SF = "/root/testdata/sf0.001"


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(1500):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        window = "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))
        budget = rng.randint(0, min(4, len(item) - 1))
        want = edit_distance(item, window)
        assert d.best_end(item, window, budget) == (want if want[0] <= budget else None)


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        text[at : at + 1] = rng.choice([[], ["z"], [text[at], "y"]])
    return "".join(text)


def test_no_place_within_the_budget_is_missed():
    rng = random.Random(2)
    for _ in range(200):
        items = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(20, 60))).strip() or "x") for i in range(3)]
        noise = ["".join(rng.choice("abcd ") for _ in range(rng.randint(0, 80))) for _ in range(3)]
        text = noise[0] + edited(rng, items[0][1], rng.randint(0, 6)) + noise[1] + edited(rng, items[1][1], rng.randint(0, 6)) + noise[2]
        finder = d.Finder(items, 0.1)
        found = {k: (distance, end) for k, distance, end in finder.hits(text)}
        for k, (_, item) in enumerate(items):
            want = edit_distance(item, text)
            assert found.get(k) == (want if want[0] <= finder.budgets[k] else None)


def test_common_openings_lose_no_place():
    """Items that share an opening get pieces elsewhere; every place within the budget is found."""
    rng = random.Random(5)
    opening = "read the text and answer "

    def prose(n):
        return "".join(rng.choice("abcdefg ") for _ in range(n)).strip()

    for _ in range(60):
        items = [(i, opening + prose(rng.randint(5, 60)) + "x") for i in range(7)]
        finder = d.Finder(items, 0.06)
        text = prose(20) + edited(rng, items[0][1], rng.randint(0, 5)) + opening + prose(9) + edited(rng, items[1][1], rng.randint(0, 5)) + prose(9)
        found = {k: (distance, end) for k, distance, end in finder.hits(text)}
        for k, (_, item) in enumerate(items):
            want = edit_distance(item, text)
            assert found.get(k) == (want if want[0] <= finder.budgets[k] else None)


def test_common_openings_are_not_verified(monkeypatch):
    """Hits of a common opening do not send every item to the edit distance."""
    rng = random.Random(6)
    opening = "please read the following passage and answer the question below "

    def prose(n):
        return "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(n))

    items = [(i, d.normal(opening + prose(160))) for i in range(400)]
    finder, calls = d.Finder(items, 0.06), []
    monkeypatch.setattr(d, "best_end", lambda *a: calls.append(a))
    assert list(finder.hits(d.normal((opening + prose(200)) * 5))) == [] and len(calls) < 20


def test_rare_pieces_do_not_overlap():
    rng = random.Random(7)
    for _ in range(100):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(20, 200)))
        budget = int(len(item) * 0.06)
        found = d.rare_pieces(item, budget, np.array([rng.randint(0, 50) for _ in range(d.GRAM_BUCKETS // 64)] * 64))
        assert len(found) == budget + 1 and all(p and item[a : a + len(p)] == p for a, p in found)
        assert all(a + len(p) <= b for (a, p), (b, _) in zip(found, found[1:]))


def test_short_items_between_word_ends():
    finder = d.Finder([(0, "a cat"), (1, "7"), (2, "dog.")], 0.5, min_chars=20)
    assert sorted(finder.hits("a category, a cat. 77 hotdog. dog.")) == [(0, 0, 17), (2, 0, 34)]
    assert list(finder.hits("x7 7x")) == [] and list(finder.hits("(7)")) == [(1, 0, 2)]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(r["doc_id"], i["item_id"]) for r in docs for i in items if d.normal(i["text"]) in d.normal(r["text"])}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op3_decontamination"](spark, SF).collect()}
    assert want and want <= set(got)
    assert all(got[p] == 0 for p in want) and all(got[p] > 0 for p in set(got) - want)


def test_blocks_and_odd_rows(spark):
    items = [(1, "a sentence that leaks into documents"), (2, "another sentence to be looked for"), (3, None), (4, "short"), (None, "a sentence that leaks into documents"), (1, "a sentence that leaks into documents")]
    benchmark = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, doc_id long")
    docs = odd_rows(spark).select("doc_id", "text").union(
        spark.createDataFrame([(20, "x A sentence  that leaks\ninto documents y"), (21, "another sentance to be looked for"), (22, "another word to be looked at")], "doc_id long, text string")
    )
    for block in (10**6, 40):
        got = d.find_leaks(docs, benchmark, block_chars=block).collect()
        assert sorted((r["doc_id"], r["item_id"] or 0, r["distance"]) for r in got) == [(20, 0, 0), (20, 1, 0), (20, 1, 0), (21, 2, 1)]
    assert sorted(r["doc_id"] for r in d.without_leaks(docs, benchmark).where("doc_id >= 20").collect()) == [22]
    assert d.without_leaks(odd_rows(spark), benchmark).count() == 12
    assert d.find_leaks(docs.limit(0), benchmark).count() == 0 and d.find_leaks(docs, benchmark.limit(0)).count() == 0
