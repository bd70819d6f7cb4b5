import math

import pytest

from creditloom.llm import quality_rules
from creditloom.llm.queries import QUERIES
from tests.llm.brute import ODD, odd_rows, quality_base

SF = "/root/testdata/sf0.001"
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("n, p", [(1, 0.3), (7, 0.5), (60, 0.01), (300, 0.08), (1000, 0.005)])
def test_binomial_tail(n, p):
    for k in {0, 1, n // 9, n // 3, n - 1, n}:
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9, abs=1e-14)


def check_base(rows, texts):
    for r in rows:
        base = quality_base(texts[r["doc_id"]])
        assert tuple(r[n] for n in NAMES) == base
        assert r["base_failed"] == (base[0] < 50 or 100 * base[4] > 50 * base[0])
        assert not (r["kept"] and r["base_failed"])


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_quality_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    check_base(rows, docs)


def corpus(spark, good, bad, wrong):
    """Prose, ``bad`` of it labelled bad and full of symbols; ``wrong`` good ones are, too."""
    prose = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"word{i}***" for i in range(80))
    docs = [(i, noisy if i < wrong else prose, "en") for i in range(good)]
    docs += [(good + i, noisy, "en") for i in range(bad)] + [(10**6, noisy, "xx"), (10**6 + 1, noisy, None)]
    labels = [(i, 1) for i in range(good)] + [(good + i, 0) for i in range(bad)] + [(10**7, 0), (None, 0), (0, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def brute_cutoff(good, wrong):
    """Whether rejecting ``wrong`` of ``good`` can be certified for one of two strata's rules."""
    share, level = quality_rules.ALPHA / len(quality_rules.RULES), quality_rules.DELTA / len(quality_rules.RULES)
    return sum(math.comb(good, i) * share**i * (1 - share) ** (good - i) for i in range(wrong + 1)) <= level


@pytest.mark.parametrize("good, wrong", [(100, 0), (700, 0), (700, 3), (1500, 2)])
def test_cutoffs_need_proof(spark, good, wrong):
    docs, labels = corpus(spark, good, 20, wrong)
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs, labels).collect()}
    assert rows[good]["kept"] == (not brute_cutoff(good, wrong))
    assert rows[10**6]["kept"] and rows[10**6 + 1]["kept"]
    assert rows[good - 1]["kept"]


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (8, 0)], "doc_id long, quality int")
    rows = quality_rules.judge(odd_rows(spark), labels).collect()
    assert len(rows) == 12
    check_base([r for r in rows if r["doc_id"] is not None], dict(ODD))
    assert quality_rules.judge(odd_rows(spark).limit(0), labels.limit(0)).collect() == []
