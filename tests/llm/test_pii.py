import random

import numpy as np

from creditloom.llm import pii
from creditloom.llm.queries import QUERIES
from tests.llm.brute import ODD, digest, odd_rows, pii_base

SF = "/root/testdata/sf0.001"


def check(row, text):
    base = pii_base(text)
    assert row["base_sha256"] == digest(base)
    assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in base) for k in pii.BASE_KINDS]
    spans = [tuple(x.split(":")) for x in row["spans"].split(",") if x]
    assert [(k, int(a), int(b)) for k, a, b in spans if k in pii.BASE_KINDS] == base


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, SF).collect()
    assert len(rows) == len(docs) and sum(r["n_ip"] + r["n_card"] for r in rows) > 0
    for r in rows:
        check(r, docs[r["doc_id"]])


def test_base_patterns_leftmost():
    rng = random.Random(8)
    parts = ["a", "b.c", "@", ".", "1", "22", "255", "300", "+", "-", " ", "(", ")", "4539578763621486", "1.2.3.4", "x@y.z", "+49 30", "_", "%", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == pii_base(text), text


def test_reliabilities_find_the_useful_labelers():
    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.4
    signs = np.stack([np.where(rng.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1)) for right in (0.95, 0.9, 0.85, 0.5)], axis=1)
    rows, counts = np.unique(np.hstack([signs, truth[:, None]]), axis=0, return_counts=True)
    posterior = pii.reliabilities(np.full(len(rows), "k"), rows[:, :4], counts.astype(float))
    assert (counts * ((posterior > 0.5) == (rows[:, 4] == 1))).sum() / 4000 > 0.93


def test_weak_kinds_come_by_votes(spark):
    good = [f"call me, iban DE89370400440532013000 born {d:02d}.05.1980 mail a{d}@example.org" for d in range(1, 25)]
    poor = [f"order number 1234567890{d} invoice 99999999999" for d in range(10, 34)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + poor)], "doc_id long, text string")
    rows = {r["doc_id"]: r["spans"] for r in pii.digest(docs).collect()}
    assert all("iban:14:36" in rows[i] and "birth:" in rows[i] and "email:" in rows[i] for i in range(24))
    assert all("number" not in rows[i] for i in range(24, 48))


def test_odd_rows(spark):
    rows = pii.digest(odd_rows(spark)).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] not in (None, 10):
            check(r, dict(ODD)[r["doc_id"]])
    assert pii.digest(odd_rows(spark).limit(0)).collect() == []
