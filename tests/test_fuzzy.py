"""The dictionary search against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators import fuzzy


def lcs(a, b):
    line = [0] * (len(b) + 1)
    for c in a:
        before = 0
        for j, d in enumerate(b, 1):
            before, line[j] = line[j], before + 1 if c == d else max(line[j], line[j - 1])
    return line[-1]


def form(text):
    return " ".join(sorted(text.split()))


def ratio(a, b):
    a, b = form(a), form(b)
    return 100.0 if not a + b else 200.0 * lcs(a, b) / (len(a) + len(b))


def grams(text, q):
    padded = "<" * (q - 1) + text + ">" * (q - 1)
    return [padded[i : i + q] for i in range(len(padded) - q + 1)]


@pytest.mark.parametrize("q", [1, 2, 3, 4])
def test_bounds_hold(spark, q):
    """Shared grams are never fewer than asked, and allow the common subsequence that there is."""
    rng = random.Random(q)
    pairs = [("".join(rng.choice("AB C") for _ in range(rng.randrange(0, 14))), "".join(rng.choice("AB C") for _ in range(rng.randrange(0, 14)))) for _ in range(150)]
    frame = spark.createDataFrame([(a, b, lcs(a, b)) for a, b in pairs], "a string, b string, lcs int")
    ga, gb = fuzzy.numbered_grams(F.col("a"), q), fuzzy.numbered_grams(F.col("b"), q)
    total = F.length("a") + F.length("b")
    shared = F.size(F.array_intersect(ga, gb))
    found = frame.select(
        "a", "b", "lcs", shared.alias("shared"), fuzzy.least_shared(q, F.col("lcs"), total).alias("least"), fuzzy.most_common(q, shared, total).alias("most")
    ).collect()
    for r in found:
        have, other = grams(r["a"], q), grams(r["b"], q)
        assert r["shared"] == sum(min(have.count(g), other.count(g)) for g in set(have))
        assert r["least"] <= r["shared"] and r["lcs"] <= r["most"]


def test_gram_length_of_a_cutoff():
    assert [fuzzy.gram_length(c) for c in (0, 50, 66.6, 70, 79.9, 80, 85, 86, 100)] == [1, 1, 1, 2, 2, 3, 3, 4, 4]


def merchants(rng, n):
    syllables = "AR BE CO DA EN FI GO HA IN JO KE LA MO NE OR PA QUI RO SA TE UN VI WA XE YO ZA STR CHE".split()
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 3))) for _ in range(60)] + ["CAFE", "STORES", "TAXI", "12"]
    entries = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(n)})
    names = []
    for _ in range(n):
        text = list(rng.choice(entries))
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = rng.choice(["", "E", "S", " ", "Q"])
        names.append("".join(text).strip() or "AA")
    names += ["".join(reversed(e)) for e in entries[: n // 4]] + ["  ", "A", "É É", "AB " * 40]
    return sorted(set(names)), [*entries, entries[3], "", "AB " * 41]


def check(spark, names, entries, threshold):
    dictionary = spark.createDataFrame([(e, i) for i, e in enumerate(entries)], "entry STRING, entry_rank INT")
    got = {r["name"]: r for r in fuzzy.fuzzy_match(spark.createDataFrame([(n,) for n in names], "name STRING"), dictionary, threshold).collect()}
    assert len(got) == len(names)
    for name, row in got.items():
        scores = [ratio(name, e) for e in entries] if len(name) >= 2 else [0.0]
        best = max(scores)
        assert row["accepted"] == (best >= threshold), (name, best, row)
        if best >= threshold:
            assert (row["score"], row["match"]) == (pytest.approx(best), entries[scores.index(best)]), name


@pytest.mark.parametrize("threshold, cell, bands", [(70.0, 3, (1, 4)), (85.0, 50, ()), (50.0, 4096, (1, 16))])
def test_best_entries(spark, monkeypatch, threshold, cell, bands):
    monkeypatch.setattr(fuzzy, "CELL", cell)
    monkeypatch.setattr(fuzzy, "BANDS", bands)
    check(spark, *merchants(random.Random(int(threshold) + cell), 90), threshold)


def test_few_pairs_are_scored(spark, monkeypatch):
    """Entries that differ in a few places, all of them near every name: nearly none is scored."""
    scored = []
    score = fuzzy._scored
    monkeypatch.setattr(fuzzy, "_scored", lambda pairs, *rest: (scored.append(pairs.count()), score(pairs, *rest))[1])
    rng = random.Random(8)
    entries = sorted({f"CITY GARAGE {rng.choice('ABCDEFGH')}{rng.choice('KLMNOP')} {rng.randrange(100, 1000)} NORTH" for _ in range(200)})
    names = sorted({e.replace("GARAGE", "GARAG") for e in entries[::2]} | {e.replace("NORTH", "NORHT") for e in entries[1::2]})
    check(spark, names, entries, 70.0)
    assert sum(scored) * 20 <= len(names) * len(entries)


def test_nothing_to_match(spark):
    names = spark.createDataFrame([("ABC",), ("X",)], "name STRING")
    nothing = spark.createDataFrame([], "entry STRING, entry_rank INT")
    assert [r["accepted"] for r in fuzzy.fuzzy_match(names, nothing).collect()] == [False, False]
    some = spark.createDataFrame([("ABC", 1)], "entry STRING, entry_rank INT")
    assert fuzzy.fuzzy_match(names.limit(0), some).collect() == []
