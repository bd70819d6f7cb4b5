import hashlib
import math

import numpy as np
import pytest

from creditloom.llm import centroid_clusters
from creditloom.llm.centroid_clusters import VantageTree, cluster
from creditloom.llm.queries import ORACLES, QUERIES
from tests.check import compare, duck

SF = "/root/testdata/sf0.001"


def test_query(spark):
    assert compare(spark, duck(SF), "op12_centroid_clusters", SF, QUERIES, ORACLES) == "ok 500"


def plain_nearest(x, centroids):
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))


@pytest.mark.parametrize("k, dim, span", [(1, 3, 5), (4, 2, 3), (5, 1, 2), (16, 4, 3), (40, 2, 4), (200, 6, 50), (64, 3, 1 << 27)])
def test_tree_finds_the_nearest_with_ties(k, dim, span):
    rng = np.random.default_rng(k)
    centroids = rng.integers(-span, span + 1, (k, dim))
    centroids[k // 2 :: 3] = centroids[0]  # equal centroids
    x = np.concatenate([rng.integers(-span, span + 1, (300, dim)), centroids, (centroids + np.roll(centroids, 1, axis=0)) // 2])
    number, distance = VantageTree(centroids).nearest(x)
    assert [(d, c) for d, c in zip(distance.tolist(), number.tolist())] == [plain_nearest(v, centroids) for v in x]


def test_walks_in_small_chunks_and_of_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    centroids, x = rng.integers(-9, 9, (30, 3)), rng.integers(-9, 9, (100, 3))
    whole = VantageTree(centroids).nearest(x)
    monkeypatch.setattr(centroid_clusters, "CHUNK_CELLS", 50)
    parts = VantageTree(centroids).nearest(x)
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert [len(a) for a in VantageTree(centroids).nearest(x[:0])] == [0, 0]


def test_most_subtrees_are_left_out():
    """With centroids in clumps a walk looks at a small part of them."""
    rng = np.random.default_rng(2)
    clumps = rng.integers(-100_000, 100_000, (40, 8))
    centroids = np.concatenate([c + rng.integers(-50, 50, (25, 8)) for c in clumps])
    tree, looked = VantageTree(centroids), []
    look = tree._look
    tree._look = lambda x, rows, candidates, *rest: (looked.append(candidates.size), look(x, rows, candidates, *rest))[1]
    x = centroids + rng.integers(-20, 20, centroids.shape)
    number, distance = tree.nearest(x)
    assert sum(looked) < 0.2 * len(x) * len(centroids)
    assert [(d, c) for d, c in zip(distance[:50].tolist(), number[:50].tolist())] == [plain_nearest(v, centroids) for v in x[:50]]


def plain(rows, dim, scale, k, rounds):
    """Rows as (id, vector); the contract with Python's own integers."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    for r in range(rounds + 1):
        at = [plain_nearest(v, centroids) for _, v in kept]
        if r < rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), (_, own) in zip(kept, at) if own == c]
                if mine:
                    centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine))
    sums = [sum(d for d, c in at if c == n) for n in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums), sha[c]) for (i, _), (d, c) in zip(kept, at)), key=str)


def test_against_plain_integers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-6, 6, 4) / 4]) for i in range(400)]
    rows += [(i, rows[7][1]) for i in range(400, 600)]  # one vector for a third of the rows
    rows += [rows[1], rows[1], (None, rows[2][1]), (None, [0.1] * 4), (3, [9.0] * 4)]
    rows += [(700, None), (701, []), (702, [1.0] * 3), (703, [1.0, None, 1.0, 1.0]), (704, [1.0, float("nan"), 0.0, 0.0]), (705, [float("inf")] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = cluster(frame, dim=4, scale=3, k=9, rounds=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, 4, 3, 9, 3)


def test_few_empty_and_wide_rows_and_clashing_names(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0], 5), (2, [1e9, 0.0], 6)], "vec_id long, embedding array<float>, cluster int")
    rows = {r["vec_id"]: r for r in cluster(frame, dim=2, scale=64).collect()}
    assert (rows[1]["cluster"], rows[1]["distance"], rows[1]["inertia"]) == (0, 0, 0)
    assert rows[2]["cluster"] is None and rows[2]["distance"] is None
    for nothing in (frame.limit(0), frame.where("vec_id = 2")):
        assert [r["cluster"] for r in cluster(nothing, dim=2).collect()] == [None] * nothing.count()
    text_ids = frame.selectExpr("concat('v', vec_id) AS vec_id", "embedding")
    assert dict(cluster(text_ids, dim=2).dtypes)["vec_id"] == "string"
