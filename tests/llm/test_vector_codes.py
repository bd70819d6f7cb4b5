import hashlib
import math

import numpy as np
import pytest

from creditloom.llm import vector_codes
from creditloom.llm.queries import ORACLES, QUERIES
from creditloom.llm.vector_codes import codebooks_sha256, compress, decoded, trie_nearest
from tests.check import compare, duck

SF = "/root/testdata/sf0.001"


def test_query(spark):
    assert compare(spark, duck(SF), "op11_vector_codes", SF, QUERIES, ORACLES) == "ok 500"


def plain_nearest(x, entries):
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(entries))


def by_prefix(parts):
    return parts[np.lexsort(parts.T[::-1])]


@pytest.mark.parametrize("leaves", [1, 2, 3, 7, 256])
@pytest.mark.parametrize("n, width, span, entries", [(1, 1, 3, 1), (60, 4, 1, 5), (200, 3, 2, 30), (150, 8, 900, 16), (50, 4, 1 << 27, 9)])
def test_walk_equals_all_distances(monkeypatch, leaves, n, width, span, entries):
    monkeypatch.setattr(vector_codes, "LEAVES", leaves)
    rng = np.random.default_rng(n + leaves)
    parts = by_prefix(rng.integers(-span, span + 1, (n, width)))  # with repeats where few are possible
    book = rng.integers(-span, span + 1, (entries, width))
    book[entries // 2] = book[0]
    at, away = trie_nearest(parts, book)
    assert list(zip(away.tolist(), at.tolist())) == [plain_nearest(p, book) for p in parts]


def test_walk_of_no_parts():
    assert [len(x) for x in trie_nearest(np.empty((0, 3), np.int64), np.ones((2, 3), np.int64))] == [0, 0]


def test_common_beginnings_are_subtracted_once(monkeypatch):
    """Parts that differ in their last component only share all the others."""
    made = []
    parts = np.zeros((1000, 16), np.int64)
    parts[:, -1] = np.arange(1000)
    flat = np.flatnonzero
    monkeypatch.setattr(vector_codes.np, "flatnonzero", lambda x: (made.append(int(np.sum(x))), flat(x))[1])
    trie_nearest(parts, np.ones((4, 16), np.int64))
    assert sum(made) == 1000 + 15  # nodes of the trie, not 16,000


def plain(rows, dim, scale, parts, entries, rounds):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, label, tuple(math.floor(scale * x) for x in v)) for i, label, v in rows if ok(v) and len(v) == dim]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    w = dim // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    for r in range(rounds + 1):
        at = [[plain_nearest(cut(v, p), books[p]) for p in range(parts)] for _, _, v in kept]
        if r < rounds:
            for p in range(parts):
                for e in range(len(first)):
                    mine = [cut(v, p) for (_, _, v), own in zip(kept, at) if own[p][1] == e]
                    if mine:
                        books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine))
    errors = [sum(d for d, _ in own) for own in at]
    sums = {}
    for (_, label, _), error in zip(kept, errors):
        sums[label] = sums.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = ["".join(f"{e:02x}" for _, e in own) for own in at]
    return sorted(((i, c, e, sums[label]) for (i, label, _), c, e in zip(kept, codes, errors)), key=str), sha


def some_rows(rng):
    rows = [(i, i % 3 if i % 5 else None, [float(x) for x in rng.integers(-5, 5, 8) / 4]) for i in range(300)]
    rows += [(i, 1, rows[7][2]) for i in range(300, 450)]  # one vector for a third of the rows
    rows += [rows[1], rows[1], (None, None, rows[2][2]), (None, 0, [0.1] * 8), (3, 2, [9.0] * 8)]
    return rows + [(700, 0, None), (701, 0, [1.0, None] * 4), (702, 0, [float("nan")] * 8), (703, None, [float("-inf")] * 8)]


@pytest.mark.parametrize("entries", [7, 256])
def test_against_plain_integers(spark, entries):
    rows = some_rows(np.random.default_rng(entries))
    if entries == 256:
        rows = rows[:100]  # fewer vectors than entries
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5)
    found, books = compress(frame, dim=8, scale=16, parts=2, entries=entries)
    got = sorted(((r["vec_id"], bytes(r["code"]).hex(), r["error"], r["label_error"]) for r in found.collect()), key=str)
    assert (got, codebooks_sha256(books)) == plain([(i, n, v and [x if x is None else float(np.float32(x)) for x in v]) for i, n, v in rows], 8, 16, 2, entries, 4)


def test_code_and_error_agree_with_what_is_decoded(spark):
    rows = some_rows(np.random.default_rng(5))[:300]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found, books = compress(frame, dim=8, scale=16, parts=4, entries=20)
    rows = {i: [math.floor(16 * x) for x in v] for i, _, v in rows}
    for r in found.collect():
        assert ((np.array(rows[r["vec_id"]]) - decoded(bytes(r["code"]), books)) ** 2).sum() == r["error"]


def test_other_lengths_wide_and_empty_and_clashing_names(spark):
    rows = [(1, 1, [1.0, 2.0], 5), (2, 1, [1.0], 6), (3, None, [], 7), (4, 1, [1e7, 0.0], 8)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, code int")
    found = {r["vec_id"]: (r["code"] and bytes(r["code"]).hex(), r["error"], r["label_error"]) for r in compress(frame, dim=2, parts=2)[0].collect()}
    assert found == {1: ("0000", 0, 0), 2: (None, None, 0), 3: (None, None, None), 4: (None, None, 0)}
    assert compress(frame.limit(0), dim=2, parts=2)[0].collect() == []
    with pytest.raises(ValueError):
        compress(frame, dim=3, parts=2)
