"""Quality rules whose cutoffs are chosen under a limit on wrongly rejected good documents.

Each rule rejects documents whose feature is over a cutoff.  For each stratum, labelled good
documents tell how often a cutoff rejects wrongly; an exact binomial test has to show that this
happens to fewer than a given share before the cutoff may be used.  Cutoffs of a rule are
tested from lenient to strict and the first failure ends the sequence, so they need no
correction among themselves; the level is divided among rules and strata (Bonferroni), and so
is the allowed share among the rules.  With probability 1 - DELTA all limits hold at once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.text import small_batches
from creditloom.session import cut_lineage

# Good documents of a stratum that all rules together may reject, and the risk of an error.
ALPHA = 0.05
DELTA = 0.05
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MISSING = "(none)"

# Rules and their cutoffs from lenient to strict; fixed before any label is seen.
SHARES = [k / 40 for k in range(39, 0, -1)]
RULES = {
    "symbol_share": SHARES,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "upper_share": SHARES,
    "mark_share": SHARES,
    "digit_share": SHARES,
}

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "symbol_share double, dup_line_share double, repeat_share double, upper_share double, mark_share double, digit_share double"
)


def repeated_words(words: list, width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, last = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + width - max(at, last)
            last = at + width
    return covered


def features(text: str | None) -> tuple:
    """The columns of FEATURES for one text; zeros for null."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    n_space = sum(map(text.count, " \t\n\v\f\r"))
    chars = len(text) - n_space
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    repeats = repeated_words(words)
    letters = np.frombuffer(raw, np.uint8)
    upper = int(((letters >= 65) & (letters <= 90)).sum())
    lower = int(((letters >= 97) & (letters <= 122)).sum())
    digits = int(((letters >= 48) & (letters <= 57)).sum())
    marks = text.count("!!")
    return (
        n,
        chars,
        symbols,
        dup,
        repeats,
        symbols / max(chars, 1),
        dup / max(lines, 1),
        repeats / max(n, 1),
        upper / max(upper + lower, 1),
        min(1.0, marks / max(n, 1)),
        digits / max(chars, 1),
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), as the regularised incomplete beta I_{1-p}(n-k, k+1)."""
    if k >= n:
        return 1.0
    return incomplete_beta(n - k, k + 1, 1 - p)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b) by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(100_000):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + term * d or tiny)
        c = 1 + term / c or tiny
        f *= c * d
        if i and abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, features, base_failed), one row for each row of ``docs``."""

    @F.pandas_udf(FEATURES)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in FEATURES.split(", ")]
        for batch in batches:
            yield pd.DataFrame([features(t) for t in batch], columns=names)

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit(MISSING)).alias("stratum"), measure(F.col(text)).alias("f")
    )
    rows = rows.select("doc_id", "stratum", "f.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _strictness(rule: str) -> Column:
    """How many cutoffs of the rule the feature is over; 0 if the rule never rejects it."""
    # Cutoffs fall, so the number over the feature's reach is counted from the strict end.
    return F.size(F.filter(F.array(*[F.lit(c) for c in RULES[rule]]), lambda c: F.col(rule) > c))


def choose_cutoffs(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n_good, n_wrong, n_bad, n_caught): one cutoff where one is safe.

    ``rows`` comes from ``measured``; documents that fail the base are not asked.  Among the
    cutoffs that pass, the one whose share of caught bad documents exceeds its share of wrongly
    rejected good ones most is taken, the more lenient of equals; none if none gains.
    Labels other than 0 and 1, and labels of unknown or null ids, say nothing; a label counts
    once for each document row that carries its id.
    """
    known = labels.where(F.col(quality).isin(0, 1)).select(F.col(doc_id).alias("doc_id"), (F.col(quality) == 1).alias("good"))
    judged = rows.where(~F.col("base_failed")).join(known, "doc_id")
    levels = F.array(*[F.struct(F.lit(r).alias("rule"), _strictness(r).alias("over")) for r in RULES])
    long = judged.select("stratum", "good", F.explode(levels).alias("x")).select("stratum", "good", "x.*")
    counts = long.groupBy("stratum", "rule", "over").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    counts = cut_lineage(counts)
    strata = counts.select("stratum").distinct().count()
    level = delta / max(1, strata * len(RULES))
    share = alpha / len(RULES)

    @F.pandas_udf("double")
    def tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), share) if b else 1.0 for a, b in zip(k, n, strict=True)])

    # One row for each cutoff: a feature over the i-th cutoff from the strict end is over all
    # stricter ones, so wrong rejections are sums from ``over`` upwards.
    grid = []
    for rule, cutoffs in RULES.items():
        for i, cutoff in enumerate(cutoffs):
            grid.append(F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(cutoff).alias("cutoff")))
    totals = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    steps = totals.select("stratum").distinct().select("stratum", F.explode(F.array(*grid)).alias("g")).select("stratum", "g.*")
    size = F.lit(len(SHARES))
    per_step = counts.where("over > 0").select("stratum", "rule", (size - F.col("over")).cast("int").alias("step"), "good", "bad")
    upto = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tested = steps.join(per_step, ["stratum", "rule", "step"], "left").join(totals, ["stratum", "rule"])
    tested = tested.withColumn("n_wrong", F.sum(F.coalesce("good", F.lit(0))).over(upto)).withColumn("n_caught", F.sum(F.coalesce("bad", F.lit(0))).over(upto))
    tested = tested.withColumn("p", tail("n_wrong", "n_good")).withColumn("worst", F.max("p").over(upto))
    gain = F.col("n_caught") / F.greatest("n_bad", F.lit(1)) - F.col("n_wrong") / F.greatest("n_good", F.lit(1))
    safe = tested.where(F.col("worst") <= level).withColumn("gain", gain).where("gain > 0")
    best = safe.groupBy("stratum", "rule").agg(
        F.max_by(F.struct("cutoff", "n_good", "n_wrong", "n_bad", "n_caught"), F.struct("gain", -F.col("step"))).alias("b")
    )
    return best.select("stratum", "rule", "b.*")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", quality: str = "quality") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    failed_rules), one row for each row of ``docs``.

    kept is false if the base fails or a rule with a safe cutoff rejects; failed_rules names
    those rules.  Null and empty texts have no words and fail the base; a null stratum is a
    stratum of its own; a stratum with too few labels, or none, has no cutoffs and keeps what
    passes the base.  Null ids have no label; repeated rows are judged each; an empty table
    gives no rows; other columns are not looked at.
    """
    small_batches(docs)
    rows = cut_lineage(measured(docs, doc_id, text, stratum))
    cutoffs = choose_cutoffs(rows, labels, doc_id, quality)
    of_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    out = rows.join(cut_lineage(of_stratum), "stratum", "left")
    failed = F.array_compact(F.array(*[F.when(F.col(r) > F.col("cutoffs")[r], F.lit(r)) for r in RULES]))
    failed = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(failed)
    out = out.withColumn("failed", failed)
    return out.select(
        F.col("doc_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
        F.concat_ws(",", "failed").alias("failed_rules"),
    )
