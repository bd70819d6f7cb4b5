import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from creditloom.llm import histogram_shards
from creditloom.llm.histogram_shards import find_boundaries, shard, with_keys, write_shards
from creditloom.llm.queries import ORACLES, QUERIES
from tests.check import compare, duck
from tests.llm.brute import ODD, odd_rows

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_query(spark):
    assert compare(spark, duck(SF), "op13_histogram_shards", SF, QUERIES, ORACLES) == "ok 200"


def half(x):
    return hashlib.md5(("" if x is None else str(x)).encode()).hexdigest()[:16]


def plain(docs, shards):
    size = lambda t: len((t or "").encode()) + 1
    total, before, out, slots = sum(size(t) for _, t in docs), 0, [], Counter()
    for d, t in sorted(docs, key=lambda r: (half(r[1]), half(r[0]))):
        s = before * shards // total
        out.append((d, size(t), zlib.crc32((t or "").encode()), "bytes", s, slots[s], None))
        slots[s] += 1
        before += size(t)
    return sorted(out, key=str)


def found(frame):
    rows = frame.collect()
    assert frame.columns == COLUMNS
    return sorted((tuple(r) for r in rows), key=str)


def corpus():
    """A group of copies with a third of the rows, repeated rows, empty texts, one huge text."""
    docs = [(i, f"text {i * i} é {'x' * (i % 50)}") for i in range(500)]
    docs += [(1000 + i, "one text that many share") for i in range(300)] + [(7, "the same row")] * 120
    docs += [(2000 + i, "") for i in range(100)] + [(None, "no id")] * 40 + [(3000, "y" * 20_000)]
    return docs


@pytest.mark.parametrize("probes, ranges, shards", [(4096, 128, 16), (2, 1, 3), (7, 40, 16), (64, 5, 1), (16, 1, 200)])
def test_against_plain_order(spark, monkeypatch, probes, ranges, shards):
    monkeypatch.setattr(histogram_shards.find_boundaries, "__defaults__", (probes,))
    monkeypatch.setattr(histogram_shards, "LEAST_RANGES", ranges)
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    # Repeated rows may change places, so they are compared as a bag.
    assert found(shard(frame, shards=shards)) == plain(docs, shards)


def test_shards_are_near_equal_and_keep_groups(spark):
    docs = corpus()
    rows = shard(spark.createDataFrame(docs, "doc_id long, text string"), shards=8).collect()
    size, texts = Counter(), defaultdict(set)
    by_id = {d: t for d, t in docs}
    for r in rows:
        size[r["shard"]] += r["size"]
        texts[by_id[r["doc_id"]]].add(r["shard"])
    assert max(size[s] for s in range(8) if size[s]) - sum(size.values()) / 8 <= 20_001
    assert sum(len(s) > 1 for s in texts.values()) <= 7  # one for each boundary


def test_tolerance_takes_fewer_rounds(spark):
    docs = [(i, f"{i} " + "z" * (i % 90)) for i in range(3000)]
    frame = with_keys(spark.createDataFrame(docs, "doc_id long, text string"))
    total = frame.agg({"size": "sum"}).first()[0]

    def rounds(share):
        wanted = [histogram_shards.Wanted(-(-total * s // 4), int(share * total / 4), by_bytes) for s in range(1, 4)]
        n = find_boundaries(frame, wanted, 32)
        assert all(abs(w.found.bytes_below - w.target) <= max(share * total / 4, 91) for w in wanted)
        return n

    by_bytes = lambda n, b: b
    assert rounds(0.1) < rounds(0.0)


def test_counts_are_exact(spark):
    docs = [(i, "a" * (i % 7)) for i in range(200)]
    frame = with_keys(spark.createDataFrame(docs, "doc_id long, text string"))
    keys = sorted((int.from_bytes(bytes(r["key"]), "big"), r["size"]) for r in frame.collect())
    cuts = [keys[10][0], keys[10][0] + 1, keys[150][0]]
    got = [(b.first, b.last, b.rows, b.bytes, b.rows_below, b.bytes_below) for b in histogram_shards.histogram(frame, cuts)]
    want = []
    for low, high in ((0, 10), (10, 11), (11, 150), (150, 200)):
        part = keys[low:high]
        want.append((part[0][0], part[-1][0], len(part), sum(s for _, s in part), low, sum(s for _, s in keys[:low])))
    assert got == want


def test_odd_rows(spark):
    assert found(shard(odd_rows(spark))) == plain([*ODD, (4, "one"), (None, "one")], 16)
    assert shard(odd_rows(spark).limit(0)).collect() == []
    clash = odd_rows(spark).selectExpr("*", "1 AS key", "2 AS size", "3 AS shard", "4 AS slot")
    assert found(shard(clash)) == found(shard(odd_rows(spark)))


def test_whole_documents_are_written(spark, tmp_path):
    docs = [r for r in corpus() if r[0] is not None]
    frame = spark.createDataFrame([(d, t, d % 3) for d, t in docs], "doc_id long, text string, key long")
    write_shards(frame, f"{tmp_path}/shards", shards=5)
    back = spark.read.parquet(f"{tmp_path}/shards")
    got = sorted(((r["doc_id"], r["text"], r["key"], r["_shard"], r["_slot"]) for r in back.collect()), key=str)
    slots = {(d, half(t)): [] for d, t in docs}
    for d, _, crc, _, s, slot, _ in plain(docs, 5):
        slots.setdefault((d, crc), []).append((s, slot))
    want = sorted(((d, t, d % 3, *slots[d, zlib.crc32(t.encode())].pop()) for d, t in docs), key=str)
    assert got == want
