"""Benchmark items inside documents, up to a share of edits.

Pigeonhole: an item cut into one piece more than its error budget has an intact piece in every
text within the budget.  Pieces are found with one automaton pass over each document; only the
neighbourhood of a piece is verified, with Myers' bit-parallel edit distance.  Pieces need not
cover an item: one whose equal pieces are common in the benchmark gets shorter ones, where its
text is rarest.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import small_batches
from creditloom.session import cut_lineage

# Edits allowed for each character of an item.
ERROR_RATE = 0.06
# Items with fewer characters, after normalising, are looked for as they are, between word ends.
MIN_CHARS = 20
# An equal piece that more items of a block share is common; its items get pieces of two thirds
# of that length where their grams are rarest.
COMMON_FROM = 4
GRAM = 6
GRAM_BUCKETS = 1 << 22
# Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 8_000_000

SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    """Lower case, with every run of white space as one blank."""
    return SPACE.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> Iterator[tuple[int, str]]:
    """(offset, piece): ``budget`` + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, item[a:b]


def _buckets(item: str) -> np.ndarray:
    """Bucket of the gram that starts at each place of ``item``."""
    codes = np.frombuffer(item.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - GRAM + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(GRAM if n > 0 else 0):
        h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(GRAM_BUCKETS)).astype(np.int64)


def rare_pieces(item: str, budget: int, items_with: np.ndarray) -> list[tuple[int, str]]:
    """(offset, piece): ``budget`` + 1 pieces that do not overlap, the rarest together.

    ``items_with`` has the number of items for each gram bucket; a piece counts as rare as its
    rarest gram.  All pieces have two thirds of the length of equal ones.
    """
    length = len(item) // (budget + 1) * 2 // 3
    if length < GRAM:
        return list(pieces(item, budget))
    grams = items_with[_buckets(item)]
    cost = np.lib.stride_tricks.sliding_window_view(grams, length - GRAM + 1).min(axis=1).astype(float)
    least, chosen = np.zeros(len(item) + 1), []
    for _ in range(budget + 1):
        # total[e]: the cheapest choice whose last piece ends at e; least[e]: at e or before.
        total = np.full(len(item) + 1, np.inf)
        total[length:] = least[: len(cost)] + cost
        least = np.minimum.accumulate(total)
        chosen.append(np.maximum.accumulate(np.where(total == least, np.arange(len(item) + 1), 0)))
    out, end = [], len(item)
    for ends in reversed(chosen):
        start = int(ends[end]) - length
        out.append((start, item[start : start + length]))
        end = start
    return out[::-1]


def best_end(item: str, window: str, budget: int) -> tuple[int, int] | None:
    """(distance, end): the smallest edit distance of ``item`` to a part of ``window``.

    The part may start anywhere; the first end with the smallest distance counts.  None if
    the distance is over ``budget``.
    """
    m = len(item)
    last, full = 1 << (m - 1), (1 << m) - 1
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    plus, minus, score, best = full, 0, m, None
    for end, c in enumerate(window, 1):
        eq = masks.get(c, 0)
        across = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(across | up)), up & across
        if score <= budget and (best is None or score < best[0]):
            best = (score, end)
            if not score:
                break
    return best


def between_word_ends(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit stands next to the part on either side."""
    return not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())


class Finder:
    """One block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int = 0):
        self.items = items
        self.short = [len(text) < min_chars for _, text in items]
        self.budgets = [0 if short else int(len(text) * error_rate) for short, (_, text) in zip(self.short, items, strict=True)]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, chosen in enumerate(self._pieces()):
            for offset, piece in chosen:
                places.setdefault(piece, []).append((k, offset))
        self.places = list(places.values())
        self.automaton = ahocorasick.Automaton()
        for i, piece in enumerate(places):
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def _pieces(self) -> Iterator[list[tuple[int, str]]]:
        """The pieces of each item: equal ones, or rare ones where an equal one is common."""
        holders: dict[str, int] = {}
        for (_, text), budget in zip(self.items, self.budgets, strict=True):
            for piece in {p for _, p in pieces(text, budget)}:
                holders[piece] = holders.get(piece, 0) + 1
        items_with = None
        for (_, text), budget in zip(self.items, self.budgets, strict=True):
            equal = list(pieces(text, budget))
            if max(holders[p] for _, p in equal) <= COMMON_FROM:
                yield equal
                continue
            if items_with is None:
                items_with = np.zeros(GRAM_BUCKETS, np.int32)
                for _, other in self.items:
                    items_with[np.unique(_buckets(other))] += 1
            yield rare_pieces(text, budget, items_with)

    def hits(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item number, distance, end) of the best place of each item in normalised ``text``."""
        starts: dict[int, list[int]] = {}
        for end, (i, length) in self.automaton.iter(text):
            for k, offset in self.places[i]:
                starts.setdefault(k, []).append(end + 1 - length - offset)
        for k, found in starts.items():
            item, budget = self.items[k][1], self.budgets[k]
            found = sorted(set(found))
            # An exact place has all pieces intact, so it starts where one of them says.
            exact = (s for s in found if s >= 0 and text.startswith(item, s) and (not self.short[k] or between_word_ends(text, s, s + len(item))))
            at = next(exact, None)
            if at is not None:
                yield k, 0, at + len(item)
            if at is not None or not budget:
                continue
            windows: list[list[int]] = []
            for start in found:
                low, high = max(0, start - budget), start + len(item) + budget
                if windows and low <= windows[-1][1]:  # windows that overlap are verified as one
                    windows[-1][1] = max(high, windows[-1][1])
                else:
                    windows.append([low, high])
            best = None
            for low, high in windows:
                near = best_end(item, text[low:high], budget)
                if near and (best is None or near[0] < best[0]):
                    best = (near[0], low + near[1])
            if best:
                yield k, *best


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, distance, end): documents that hold an item within its error budget.

    Both sides are lower-cased and runs of white space count as one blank; an item of m
    characters may differ by int(m * error_rate) edits, one below ``min_chars`` by none and only
    where no letter or digit stands next to it.  Each pair of a document row and an
    item row comes once, with the smallest distance and the first end of a best place (in the
    normalised text).  Null texts and texts or items without a character other than white space
    match nothing; repeated rows on either side give repeated pairs; null ids stay null; empty
    tables give no rows; other columns are not looked at.

    The benchmark is a query set: it is split by hash into blocks of about ``block_chars``
    characters, one block at a time is held by the tasks, and each makes one pass over the
    documents.  Its whole size thus never matters to memory.
    """
    spark = docs.sparkSession
    small_batches(docs)
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    rows = docs.select(F.col(doc_id).alias(doc_id), F.col(text).alias("text")).where(F.col("text").isNotNull())
    id_type = benchmark.schema[item_id].dataType.simpleString()
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        own = [(r["item_id"], t) for r in own if (t := normal(r["text"]))]
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(own)], f"k int, item_id {id_type}")
        part = rows.select(doc_id, F.explode(_search(spark, own, error_rate, min_chars)("text")).alias("hit"))
        part = part.join(F.broadcast(ids), F.col("hit.k") == ids["k"])  # one row for each item of the block
        part = part.select(doc_id, F.col("item_id").alias(item_id), F.col("hit.distance").alias("distance"), F.col("hit.end").alias("end"))
        found = part if found is None else found.unionByName(part)
    return found


# The finder of the block that this worker process is looking for, by the name of the search.
_CURRENT: dict[str, Finder | None] = {}


def _search(spark, items: list[tuple[int, str]], error_rate: float, min_chars: int):
    shared, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf("array<struct<k:int,distance:int,end:long>>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _CURRENT:  # built once for all tasks of a worker
            _CURRENT.clear()
            _CURRENT[name] = Finder(shared.value, error_rate, min_chars) if shared.value else None
        finder = _CURRENT[name]
        for batch in batches:
            out = []
            for value in batch:
                hits = finder.hits(normal(value)) if finder else ()
                out.append([{"k": k, "distance": d, "end": e} for k, d, e in hits])
            yield pd.Series(out)

    return search


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null id stay."""
    leaks = find_leaks(docs, benchmark, doc_id, text, **options).select(F.col(doc_id).alias("_leak")).distinct()
    leaks = cut_lineage(leaks)  # its size decides how docs are joined
    return docs.join(leaks, docs[doc_id] == leaks["_leak"], "left_anti")
