import random

from creditloom.llm import license_scan as ls
from creditloom.llm.queries import QUERIES
from tests.llm.brute import ODD, license_base, odd_rows

SF = "/root/testdata/sf0.001"


def check(row, text):
    got = tuple(row[n] for n in ("n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got == license_base(text)
    assert 0 <= row["score"] <= 1
    assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op10_license_scan"](spark, SF).collect()
    assert len(rows) == len(docs) and sum(r["n_base"] for r in rows) > 0
    for r in rows:
        check(r, docs[r["doc_id"]])


def test_matching_statistics_of_each_template(monkeypatch):
    monkeypatch.setattr(ls, "LEAST_MATCH", 2)
    rng = random.Random(10)
    for _ in range(300):
        templates = [(f"t{i}", [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 12))]) for i in range(3)]
        automaton = ls.Automaton(templates)
        sequence = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        want = set()
        for k, (_, w) in enumerate(templates):
            parts = {tuple(w[i:j]) for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
            longest = [max((n for n in range(1, e + 1) if tuple(sequence[e - n : e]) in parts), default=0) for e in range(1, 31)]
            want |= {(e, n, k) for e, n in enumerate(longest, 1) if n >= min(2, len(w)) and (e == 30 or longest[e] != n + 1)}
        got = list(automaton.matches(sequence))
        assert len(got) == len(want) and {(e, n, k) for e, n, k, _ in got} == want
        for end, length, k, state in got:
            piece, w = sequence[end - length : end], templates[k][1]
            assert automaton.ends[state][k] == {i + length for i in range(len(w)) if w[i : i + length] == piece}


def longest_chain(parts, i):
    """(words covered, -start) of the best chain that ends with part i, by trying all."""
    end, length, t = parts[i]
    best = (length, length - end)
    for j, (stop, _, above) in enumerate(parts):
        over = max(0, stop - (end - length), above - (t - length))
        near = max(end - length + over - stop, t - length + over - above) <= ls.MOST_GAP
        if stop < end and above < t and over < length and near:
            covered, start = longest_chain(parts, j)
            best = max(best, (covered + length - over, start))
    return best


def test_chains_against_all_chains(monkeypatch):
    monkeypatch.setattr(ls, "MOST_GAP", 3)
    rng = random.Random(11)
    for _ in range(200):
        parts = sorted({(rng.randint(3, 25), rng.randint(1, 3), rng.randint(3, 20)) for _ in range(9)})
        want = [longest_chain(parts, i) for i in range(len(parts))]
        assert [(covered, -start) for start, _, _, covered in ls.best_chains(parts)] == want


def test_shorter_ends_of_a_match_are_not_lost(spark):
    """The first template holds only an end of the longest match, and goes on after one word."""
    first, second = "b c d e f g h i", "x a b c d e"
    rows = spark.createDataFrame([(1, "x a b c d e zz f g h i"), (2, "x a b c d e f g h i")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in ls.scan(rows, templates=[("one", first), ("two", second)]).collect()}
    for r in found.values():
        assert r["labels"] == "one,two" and r["score"] == 1
        assert {s["label"]: s["share"] for s in r["spans"]} == {"one": 1.0, "two": 1.0}


def test_changed_licence_is_covered(spark):
    mit = ls.TEMPLATES[1][1].replace("free of charge", "gratis").replace("sublicense", "")
    rows = spark.createDataFrame([(1, f"intro text {mit} outro"), (2, "permission is granted to copy"), (3, "Licensed under CC BY-NC 4.0.")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in ls.scan(rows).collect()}
    assert found[1]["labels"] == "mit" and 0.75 < found[1]["score"] < 1 and found[1]["spans"][0]["start"] == 2
    assert found[2]["labels"] == "" and found[2]["score"] < 0.75
    assert found[3]["labels"] == "cc-by-nc" and found[3]["score"] == 1


def test_odd_rows(spark):
    rows = ls.scan(odd_rows(spark)).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] is not None:
            check(r, dict(ODD)[r["doc_id"]])
    assert ls.scan(odd_rows(spark).limit(0)).collect() == []
