"""Centroid clustering; the nearest centroid is found in a vantage-point tree.

Each round builds a tree over the centroids and broadcasts it (its size is that of the
centroids, a parameter).  Every vector walks the tree on its own, nearest subtree first, and
leaves out subtrees that begin beyond its best distance so far.  The walks of a batch are taken
in step, one node of each vector at a time, so numpy does the arithmetic of all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.vectors import column_sums, floor_division_sql, floored_sql, integer_rows, lists, matrix
from creditloom.session import cut_lineage

DIM, SCALE, CLUSTERS, ROUNDS = 64, 64, 16, 3
LEAF = 4
# Numbers held for a chunk of vectors that walk in step.
CHUNK_CELLS = 1 << 20
# Square roots are rounded, so a subtree goes only if it begins beyond the best distance by more
# than that rounding can explain; equal distances always stay.
SLACK = 1e-9


class VantageTree:
    """A vantage-point tree over integer centroids.

    An inner node holds one centroid and two children, the nearer and the farther half of the
    others by distance from it, each with its least and greatest distance.  A leaf holds at most
    ``LEAF`` centroids.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.vantage: list[int] = []
        self.children: list[tuple[int, int]] = []
        self.ranges: list[tuple[float, float, float, float]] = []
        self.leaves: list[list[int]] = []
        todo = [(np.arange(len(centroids)), self._node())]
        while todo:
            ids, at = todo.pop()
            if len(ids) <= LEAF:
                self.leaves[at] = ids.tolist()
                continue
            from_first = self._squared(ids, ids[0])
            top = ids[int(np.argmax(from_first))]
            rest = ids[ids != top]
            away = self._squared(rest, top)
            order = np.argsort(away, kind="stable")
            rest, away = rest[order], np.sqrt(away[order].astype(float))
            half = len(rest) // 2
            near, far = self._node(), self._node()
            self.vantage[at], self.children[at] = int(top), (near, far)
            self.ranges[at] = (away[0], away[half - 1], away[half], away[-1])
            todo += [(np.sort(rest[:half]), near), (np.sort(rest[half:]), far)]
        self.width = max(map(len, self.leaves))
        padded = [x + x[-1:] * (self.width - len(x)) if x else [0] * self.width for x in self.leaves]
        self.members = np.array(padded, np.int64)
        self.top = np.array(self.vantage, np.int64)
        self.below = np.array(self.children, np.int64)
        self.bounds = np.array(self.ranges, float)

    def _node(self) -> int:
        self.vantage.append(-1)
        self.children.append((-1, -1))
        self.ranges.append((0.0, 0.0, 0.0, 0.0))
        self.leaves.append([])
        return len(self.vantage) - 1

    def _squared(self, ids: np.ndarray, one: int) -> np.ndarray:
        apart = self.centroids[ids] - self.centroids[one]
        return (apart * apart).sum(axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and squared distance to the nearest centroid; ties go to the smaller number."""
        step = max(1, CHUNK_CELLS // max(len(self.top), self.width * vectors.shape[1]))
        found = [self._walk(vectors[i : i + step]) for i in range(0, len(vectors), step)]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(x)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids), np.int64)
        open_at = np.full((n, len(self.top)), np.inf)  # least distance of each open subtree
        open_at[:, 0] = 0
        walking = np.arange(n)
        while len(walking):
            node = np.argmin(open_at[walking], axis=1)
            begins = open_at[walking, node]
            radius = np.sqrt(best[walking].astype(float))
            go = begins <= radius + SLACK * (1 + radius)
            go &= np.isfinite(begins)
            walking, node = walking[go], node[go]
            open_at[walking, node] = np.inf
            inner = self.top[node] >= 0
            self._look(x, walking[~inner], self.members[node[~inner]], best, number)
            rows, at = walking[inner], node[inner]
            if len(rows):
                apart = self._look(x, rows, self.top[at][:, None], best, number)[:, 0]
                self._open(rows, at, np.sqrt(apart.astype(float)), begins[go][inner], open_at)
        return number, best

    def _look(self, x, rows, candidates, best, number) -> np.ndarray:
        """Exact distances from the vectors ``rows`` to their candidates; the best are kept."""
        apart = x[rows][:, None, :] - self.centroids[candidates]
        squared = (apart * apart).sum(axis=2)
        for j in range(candidates.shape[1]):
            d, c = squared[:, j], candidates[:, j]
            better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
            best[rows[better]], number[rows[better]] = d[better], c[better]
        return squared

    def _open(self, rows, at, away, begins, open_at) -> None:
        """Open both children with the least distance that the triangle inequality leaves them."""
        for side in (0, 1):
            low, high = self.bounds[at, 2 * side], self.bounds[at, 2 * side + 1]
            open_at[rows, self.below[at, side]] = np.maximum(begins, np.maximum(low - away, away - high))


def _sums(shared, dim: int):
    """Per task: (cluster, n, sums) of the vectors that it has read."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        k = len(tree.centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            cluster, _ = tree.nearest(x)
            np.add.at(sums, cluster, x)
            n += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), lists(sums[used])], ["cluster", "n", "sums"])

    return partial


def _assigned(shared, dim: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = shared.value.nearest(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return assign


def starting_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``; null ids last, ties by components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("key")
    first = rows.select("v", key).orderBy(F.asc_nulls_last("key"), "v").limit(k)
    return np.array([r["v"] for r in first.collect()], np.int64)


def fit(rows: DataFrame, dim: int, k: int, rounds: int, seed: str) -> np.ndarray:
    """Integer centroids after ``rounds`` rounds over ``rows`` (vec_id, v); fewer with fewer rows."""
    spark = rows.sparkSession
    centroids = starting_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        shared = spark.sparkContext.broadcast(VantageTree(centroids))
        parts = rows.select("v").mapInArrow(_sums(shared, dim), "cluster long, n long, sums array<long>")
        for r in column_sums(parts, ["cluster"], dim):
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
        shared.destroy()
    return centroids


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
    dim: int = DIM, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = "1",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of exactly ``dim`` components, none null, NaN or infinite; a component x
    counts as floor(scale * x).  Rows with a null or another vector have no output row.

    Repeated rows and repeated ids keep one output row each and count as often.  Rows with a null
    id take part; as starting centroids they come last.  With fewer than ``k`` kept vectors there
    are as many centroids.  Equal centroids and equal distances: the smaller number.  A vector
    with a component beyond ``WIDEST``, whose distances would not fit a long, is assigned nowhere:
    its row has nulls.  An inertia beyond a long is null.  An empty table gives no rows; other
    columns are not looked at.
    """
    whole = vectors.where(F.size(vector) == dim)
    rows = cut_lineage(integer_rows(whole, vec_id, vector, scale, dim))
    spark, known = rows.sparkSession, rows.where(F.col("v").isNotNull())
    centroids = fit(known, dim, k, rounds, seed)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {id_type}, cluster int, distance long"
    if len(centroids):
        shared = spark.sparkContext.broadcast(VantageTree(centroids))
        assigned = cut_lineage(known.mapInArrow(_assigned(shared, dim), out))
    else:
        assigned = spark.createDataFrame([], out)
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(total.alias("s")).collect()}
    facts = [
        (c, _long(sums.get(c, 0)), _long(sum(sums.values())), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for c, v in enumerate(centroids.tolist())
    ]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    found = assigned.join(F.broadcast(facts), "cluster").select(*columns)  # one row for each of k centroids
    nowhere = rows.where(F.col("v").isNull()).select("vec_id")
    return found.unionByName(nowhere, allowMissingColumns=True)


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def oracle(dim: int = DIM, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """DuckDB text of the query: every vector against every centroid, round by round."""
    squared = "list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    parts = [
        f"kept AS MATERIALIZED ({floored_sql(scale, dim)})",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w FROM (
  SELECT v, sha256('1:' || vec_id) AS h FROM kept ORDER BY h, v LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, d * {k} + c) AS c FROM (
  SELECT i, vec_id, v, c, CAST({squared} AS BIGINT) AS d FROM (SELECT *, row_number() OVER () AS i FROM kept) x, c{r}) m GROUP BY i, vec_id)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c0.c, coalesce(n.w, c0.w) AS w FROM c{r} c0 LEFT JOIN (
  SELECT c, list({floor_division_sql('s', 'n')} ORDER BY j) AS w FROM (
    SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) t(j) GROUP BY c, j) s GROUP BY c) n ON n.c = c0.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c"""
