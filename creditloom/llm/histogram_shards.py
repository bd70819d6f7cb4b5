"""Sharding by histogram sort: boundaries from exact counts, then one exchange.

Rows are ordered by a key: a hash of the group, a hash of the id, a number that tells equal rows
apart.  A shard is a range of the order.  Its boundaries are found by rounds over the keys and
sizes alone: every task counts bytes and rows between candidate boundaries (probes), the sums
tell where each wanted boundary lies, and the next round's probes divide what is still open.
When all boundaries stand, each row is sent once to its range and numbered there.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.session import cut_lineage

SHARDS = 16
KEY_BYTES = 24
BEYOND = 1 << (8 * KEY_BYTES)  # above every key
# Probes of a round, shared by the boundaries that are still open (two each at least).
PROBES = 4096
# A range is what one task sorts and numbers: at least so many ranges, of about so many rows.
LEAST_RANGES, RANGE_ROWS = 128, 1 << 20


def order_key(group: Column, row_id: Column) -> Column:
    """24 bytes: md5 halves of the group and of the id, and a number that no other row has.

    Equal groups are neighbours, and inside them equal ids.  The number holds for the files that
    the key is written to.
    """
    half = lambda c: F.substring(F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), 1, 16)
    number = F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")
    return F.unhex(F.concat(half(group), half(row_id), number))


def _packed(keys) -> np.ndarray:
    return np.array([k.to_bytes(KEY_BYTES + 1, "big")[-KEY_BYTES:] for k in keys], f"S{KEY_BYTES}")


def _number(key) -> int:
    return int.from_bytes(bytes(key), "big")


def _keys(column: pa.Array) -> np.ndarray:
    """Keys as fixed-width strings; numpy compares them as if padded with zeros, which they are."""
    return np.array(column.to_pylist(), f"S{KEY_BYTES}")


@dataclass
class Bucket:
    """Counted rows between two probes: first and last key, and what lies below the first."""

    first: int
    last: int
    rows: int
    bytes: int
    rows_below: int = 0
    bytes_below: int = 0


def histogram(keyed: DataFrame, probes: list[int]) -> list[Bucket]:
    """The non-empty buckets that ``probes`` cut (key, size) into, in order; exact.

    A task sends one row for each bucket that it has seen, so the driver gets at most one row
    for each probe, whatever the table.
    """
    shared = keyed.sparkSession.sparkContext.broadcast(_packed(probes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        total = np.zeros((len(cuts) + 1, 2), np.int64)
        first: dict[int, bytes] = {}
        last: dict[int, bytes] = {}
        for batch in batches:
            key, size = _keys(batch.column(0)), batch.column(1).to_numpy()
            order = np.argsort(key, kind="stable")
            key, size = key[order], size[order]
            at = np.searchsorted(cuts, key, "right")
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            ends = np.append(starts[1:], len(at))
            total[at[starts], 0] += ends - starts
            total[at[starts], 1] += np.add.reduceat(size, starts) if len(starts) else 0
            for b, i, j in zip(at[starts].tolist(), key[starts], key[ends - 1], strict=True):
                first[b] = min(first.get(b, i), i)
                last[b] = max(last.get(b, j), j)
        used = np.flatnonzero(total[:, 0])
        pad = lambda d: pa.array([bytes(d[b]).ljust(KEY_BYTES, b"\0") for b in used.tolist()], pa.binary())
        columns = [pa.array(used), pa.array(total[used, 0]), pa.array(total[used, 1]), pad(first), pad(last)]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n", "bytes", "first", "last"])

    parts = keyed.select("key", "size").mapInArrow(count, "bucket long, n long, bytes long, first binary, last binary")
    sums = parts.groupBy("bucket").agg(F.sum("n"), F.sum("bytes"), F.min("first"), F.max("last")).collect()
    shared.destroy()
    out, rows, size = [], 0, 0
    for _, n, b, first, last in sorted(sums):
        out.append(Bucket(_number(first), _number(last), n, b, rows, size))
        rows, size = rows + n, size + b
    return out


@dataclass
class Boundary:
    """The first key at or above ``key`` begins a range; exact counts of what lies below."""

    key: int
    rows_below: int
    bytes_below: int


class Wanted:
    """One boundary to be found: the first row with at least ``target`` of ``measure`` below it."""

    def __init__(self, target: int, tolerance: int, measure):
        self.target, self.tolerance, self.measure = target, tolerance, measure
        self.found: Boundary | None = None
        self.inside: Bucket | None = None

    def look(self, buckets: list[Bucket], below: list[int], end: Boundary) -> None:
        """Settle on an edge between buckets, or note the bucket to be divided."""
        at = bisect_right(below, self.target - 1) - 1  # the last bucket that begins below the target
        if at < 0:
            b = buckets[0]
            self.found = Boundary(b.first, b.rows_below, b.bytes_below)
            return
        b = buckets[at]
        above = end
        if at + 1 < len(buckets):
            c = buckets[at + 1]
            above = Boundary(c.first, c.rows_below, c.bytes_below)
        under = self.target - self.measure(b.rows_below, b.bytes_below)
        over = self.measure(above.rows_below, above.bytes_below) - self.target
        if b.rows == 1 or over <= min(self.tolerance, under) or over == 0:
            self.found = above
        elif under <= self.tolerance:
            self.found = Boundary(b.first, b.rows_below, b.bytes_below)
        else:
            self.inside = b


def find_boundaries(keyed: DataFrame, wanted: list[Wanted], probes: int = PROBES) -> int:
    """Refine until every wanted boundary stands; the number of rounds.

    A bucket's first and last key bound the next probes, so a range of the key space without
    rows costs nothing, and the rows of one heavy group are divided by id at once.  Every round
    cuts an open bucket in as many parts as it gets probes.
    """
    cuts = [BEYOND * i // probes for i in range(1, probes)]
    rounds = 0
    while open_ones := [w for w in wanted if w.found is None]:
        buckets = histogram(keyed, cuts)
        rounds += 1
        end = Boundary(BEYOND, buckets[-1].rows_below + buckets[-1].rows, buckets[-1].bytes_below + buckets[-1].bytes)
        by_measure: dict = {}
        for w in open_ones:
            if w.measure not in by_measure:
                by_measure[w.measure] = [w.measure(b.rows_below, b.bytes_below) for b in buckets]
            w.look(buckets, by_measure[w.measure], end)
        inside = {w.inside.first: w.inside for w in open_ones if w.found is None}
        each = max(2, probes // max(1, len(inside)))
        cuts = sorted({
            b.first + (b.last + 1 - b.first) * i // each for b in inside.values() for i in range(each + 1)
        })
    return rounds


def place(keyed: DataFrame, shards: int = SHARDS, tolerance: float = 0.0) -> DataFrame:
    """``keyed`` (a written table with ``key`` and ``size``) with ``shard`` and ``slot``.

    Shard s begins at the first row, in key order, that has s/shards of all bytes below it; with
    a ``tolerance``, at any row within that share of a shard's bytes, which takes fewer rounds.
    slot numbers the rows of a shard in key order, from 0, without gaps.  A size is at least 1.
    """
    rows, size = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    by_bytes = lambda n, b: b
    by_both = lambda n, b: n * size + b * rows  # noqa: E731  ranges even in rows and bytes
    wanted = [Wanted(-(-size * s // shards), int(tolerance * size / shards), by_bytes) for s in range(1, shards)]
    ranges = max(LEAST_RANGES, rows // RANGE_ROWS)
    whole = 2 * rows * size
    inner = [Wanted(-(-whole * r // ranges), whole // (4 * ranges), by_both) for r in range(1, ranges)]
    if rows:
        find_boundaries(keyed, wanted + inner)
    starts = [w.found for w in wanted if w.found]
    cuts = sorted({b.key: b for b in [*starts, *[w.found for w in inner if w.found]]}.items())
    shard_keys = sorted(b.key for b in starts)
    # For each range its shard and the slot of its first row.
    shard = [0] + [bisect_right(shard_keys, key) for key, _ in cuts]
    shard_start = [0] + [b.rows_below for b in sorted(starts, key=lambda b: b.key)]
    first_slot = [0] + [b.rows_below - shard_start[s] for (_, b), s in zip(cuts, shard[1:], strict=True)]
    shared = keyed.sparkSession.sparkContext.broadcast(
        (_packed([k for k, _ in cuts if k < BEYOND]), np.array(shard), np.array(first_slot))
    )

    @F.pandas_udf("range int, shard int, first long")
    def ranged(keys: pd.Series) -> pd.DataFrame:
        packed, shard, first = shared.value
        at = np.searchsorted(packed, np.array(keys.tolist(), f"S{KEY_BYTES}"), "right")
        return pd.DataFrame({"range": at.astype(np.int32), "shard": shard[at].astype(np.int32), "first": first[at]})

    sent = keyed.withColumn("_r", ranged("key"))
    at = F.row_number().over(Window.partitionBy(F.col("_r.range")).orderBy("key"))
    return (
        sent.withColumn("slot", F.col("_r.first") + at - 1).withColumn("shard", F.col("_r.shard")).drop("_r")
    )


def with_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *payload: str) -> DataFrame:
    """(key, size, text_crc32, doc_id, payload) of every row, written once; texts stay behind unless named."""
    body = F.coalesce(F.col(text), F.lit(""))
    return cut_lineage(docs.select(
        order_key(body, F.col(doc_id)).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.col(doc_id).alias("doc_id"),
        *payload,
    ))


def shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row for each row of ``docs``.

    size is the UTF-8 bytes of the text plus 1.  The law is ``bytes``: shard s holds the rows
    that have at least s/shards and less than (s+1)/shards of all bytes before them, in the order
    of (hash of text, hash of id), so the bytes of two shards differ by two rows at most.  Equal
    texts stand together and only a group that lies across a boundary is cut.

    Null text: as the empty one, size 1 and crc 0.  Null ids are ordered like the empty id.
    Repeated rows are rows like others and may take any of their slots.  Fewer rows than shards
    leave shards empty; so does a row that alone is larger than a shard.  An empty table gives no
    rows.  Other columns are not looked at.  grown_shard is null under this law.
    """
    placed = place(with_keys(docs, doc_id, text), shards, tolerance)
    return placed.select(
        F.col("doc_id").alias(doc_id), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> None:
    """Whole documents as Parquet, a folder for each shard, rows in slot order within a file.

    Columns of ``docs`` that clash with those of the order are kept under their own names; shard
    and slot are added as ``_shard`` and ``_slot``.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    placed = place(with_keys(docs.withColumn("_whole", whole), doc_id, text, "_whole"), shards)
    out = placed.select("_whole.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    out.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)


def oracle(shards: int = SHARDS) -> str:
    """DuckDB text of the query: one running sum over the whole order; CRC-32 byte by byte."""
    return f"""WITH entries AS (
  SELECT list(c ORDER BY b) AS entry FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i:
      CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(b))),
coded AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         substr(md5(coalesce(text, '')), 1, 16) AS h, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS t,
         xor(CAST(4294967295 AS BIGINT), list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
           lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, entries),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY h, t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before,
         sum(size) OVER () AS total FROM coded),
placed AS (SELECT *, CAST(before * {shards} // total AS INT) AS shard FROM ordered)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h, t) - 1 AS slot, CAST(NULL AS INT) AS grown_shard FROM placed"""
