"""Small helpers shared by the corpus operators: words, hashes, columns and table reads."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = 1000) -> None:
    """Let tasks hand Python no more than so many rows at a time, to bound the memory of both."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def folded_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8; none for null.

    ``bytes.lower`` folds ASCII letters only and ``bytes.split`` cuts at exactly the six ASCII
    white-space characters, so other letters and other kinds of space stay inside the words.
    """
    return text.encode().lower().split() if text else []


class Remembered(dict):
    """A bounded memo of a pure function; it starts anew when full."""

    def __init__(self, function, limit: int = 100_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.function(key)
        return value


# Odd multipliers, one for each place of a shingle; longer shingles use them in turn.
PLACES = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]


def sorted_distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    keep = np.empty(len(h), bool)
    keep[:1] = True
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]


def shingle_hashes(words: list[bytes], width: int, memo: Remembered, below: int | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles, all or those under ``below``.

    Fewer words than ``width`` make one shingle of the whole sequence; no words make none.  A
    shingle's hash is a sum of its words' hashes, each times the multiplier of its place.
    """
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    span = min(width, len(ids))
    n = len(ids) - span + 1
    h = ids[:n] * np.uint64(PLACES[0]) + np.uint64(span)
    for i in range(1, span):
        h += ids[i : n + i] * np.uint64(PLACES[i % len(PLACES)] + 2 * (i // len(PLACES)))
    if below is not None:
        h = h[h < np.uint64(below)]
    return sorted_distinct(h)


def word_memo() -> Remembered:
    return Remembered(xxhash.xxh3_64_intdigest)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of (start, rank, end, kind), in its order, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
