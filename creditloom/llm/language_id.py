"""Language of texts and of their parts.

Scripts narrow the candidate languages of each word, hashed character trigrams score the word
for each candidate, and a Viterbi pass with a penalty for switching labels runs of words, so
that mixed-language text comes out as spans.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import small_batches

UNKNOWN = "und"
BUCKETS = 1 << 14
SMOOTHING = 0.5
# Log-odds that a change of language has to earn.
SWITCH_PENALTY = 8.0
# A language is a candidate for a script that holds at least this share of its letters.
LEAST_SCRIPT_SHARE = 0.005
# The score table takes 64 KB for each language and is shipped to the tasks.
MOST_LANGUAGES = 1024
SLICE = 1 << 20
# A text fits if its letters score at most so many standard deviations of a learned letter under
# their mean, and as many more over the root of the number of letters, for chance.
MOST_BELOW = 2.0
# Share of letters that must be in learned scripts.
LEAST_KNOWN = 0.5

# First code point of the blocks whose letters belong to a script.
SCRIPT_RANGES = [
    (0x0041, 0x024F, "Latin"),
    (0x0370, 0x03FF, "Greek"),
    (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"),
    (0x0590, 0x05FF, "Hebrew"),
    (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"),
    (0x0A00, 0x0A7F, "Gurmukhi"),
    (0x0A80, 0x0AFF, "Gujarati"),
    (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"),
    (0x0C80, 0x0CFF, "Kannada"),
    (0x0D00, 0x0D7F, "Malayalam"),
    (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"),
    (0x1100, 0x11FF, "Hangul"),
    (0x1200, 0x137F, "Ethiopic"),
    (0x1E00, 0x1EFF, "Latin"),
    (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x309F, "Kana"),
    (0x30A0, 0x30FF, "Kana"),
    (0x3400, 0x9FFF, "Han"),
    (0xAC00, 0xD7AF, "Hangul"),
    (0x20000, 0x3134F, "Han"),
]
SCRIPTS = ["Other"] + sorted({name for _, _, name in SCRIPT_RANGES})


@functools.cache
def _letters() -> np.ndarray:
    """1 + script number of every letter, 0 of every other code point."""
    kinds = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint8, 0x110000)
    script = np.zeros(0x110000, np.uint8)
    for low, high, name in SCRIPT_RANGES:
        script[low : high + 1] = SCRIPTS.index(name)
    return np.where(kinds, script + 1, 0).astype(np.uint8)


def _codes(text: str) -> np.ndarray:
    """Lower-cased code points, one for each code point of ``text``."""
    lower = text.lower()
    if len(lower) != len(text):  # some capitals become two code points
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)


def _trigrams(codes: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of letters and the bucket of the trigram around each, with word ends as 0."""
    padded = np.zeros(len(codes) + 2, np.uint32)
    padded[1:-1] = np.where(letter > 0, codes, 0)
    at = np.flatnonzero(letter)
    h = padded[at] * np.uint32(0x9E3779B1) ^ padded[at + 1] * np.uint32(0x85EBCA6B) ^ padded[at + 2] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return at, (h >> np.uint32(18)).astype(np.int64)


def _slices(codes: np.ndarray, letter: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut long texts between words, to bound the memory of one pass."""
    start, n = 0, len(codes)
    while n - start > SLICE:
        gaps = np.flatnonzero(letter[start + SLICE // 2 : start + SLICE] == 0)
        end = start + SLICE // 2 + int(gaps[-1]) + 1 if len(gaps) else start + SLICE
        yield start, end
        start = end
    yield start, n


class Model:
    """Learned languages, their trigram scores and the languages that each script allows."""

    def __init__(self, languages: list[str], grams: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        smooth = grams + SMOOTHING
        self.scores = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        allowed = (share >= LEAST_SCRIPT_SHARE).T
        self.unlearned = ~allowed.any(axis=1)
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0, -1e4).astype(np.float32)
        # Mean and deviation of the score of a learned letter, each scored without itself.
        letters = np.maximum(grams.sum(axis=1, keepdims=True), 1)
        alone = np.log(np.maximum(smooth - 1, SMOOTHING) / np.maximum(smooth.sum(axis=1, keepdims=True) - 1, 1))
        self.mean = (grams * alone).sum(axis=1) / letters[:, 0]
        self.deviation = np.sqrt((grams * (alone - self.mean[:, None]) ** 2).sum(axis=1) / letters[:, 0])

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words (runs of letters) and their score for each language."""
        codes = _codes(text)
        letter = _letters()[codes]
        parts = []
        for low, high in _slices(codes, letter):
            at, bucket = _trigrams(codes[low:high], letter[low:high])
            if len(at):
                first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
                score = np.add.reduceat(self.scores[bucket], first, axis=0)
                score += self.barred[letter[low:high][at[first]].astype(np.int64) - 1]
                last = np.append(first[1:], len(at)) - 1
                parts.append((at[first] + low, at[last] + low + 1, score))
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, len(self.languages)), np.float32)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def paths(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Best language of each word of each text, all texts in step."""
        counts = np.array([len(s) for s in scores])
        order = np.argsort(-counts, kind="stable")
        live = counts[order]
        total = np.concatenate([scores[i] for i in order]) if len(scores) else np.empty((0, len(self.languages)))
        offset = np.concatenate([[0], np.cumsum(live)[:-1]]).astype(np.int64)
        state = np.zeros((len(order), len(self.languages)), np.float64)
        came = np.zeros(total.shape, np.int16)
        own = np.arange(len(self.languages), dtype=np.int16)
        steps = int(live[0]) if len(live) else 0
        active = np.searchsorted(-live, -np.arange(1, steps + 1), side="right")
        for t in range(steps):
            n = active[t]
            here = state[:n]
            if t:
                best = here.argmax(axis=1)
                switched = here[np.arange(n), best] - SWITCH_PENALTY
                moved = switched[:, None] > here
                came[offset[:n] + t] = np.where(moved, best[:, None], own)
                here = np.where(moved, switched[:, None], here)
            state[:n] = here + total[offset[:n] + t]
        label = np.zeros(len(total), np.int16)
        at = state.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            n = active[t]
            label[offset[:n] + t] = at[:n]
            at[:n] = came[offset[:n] + t, at[:n]] if t else at[:n]
        out: list = [None] * len(scores)
        for k, i in enumerate(order):
            out[i] = label[offset[k] : offset[k] + live[k]]
        return out

    def describe(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans) of each text; see ``identify``."""
        if not self.languages:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        found = [self.words(t or "") for t in texts]
        out = []
        for (start, end, score), path in zip(found, self.paths([f[2] for f in found]), strict=True):
            if not len(path):
                out.append((UNKNOWN, 0.0, []))
                continue
            letters = np.bincount(path, weights=end - start, minlength=len(self.languages))
            best = int(letters.argmax())
            total = score[path == best].sum(axis=0, dtype=np.float64)
            likely = 1 / np.exp(np.minimum(total - total[best], 50)).sum()
            first = np.flatnonzero(np.diff(path, prepend=-1))
            last = np.append(first[1:], len(path)) - 1
            spans = [(int(start[a]), int(end[b]), self.languages[path[a]]) for a, b in zip(first, last, strict=True)]
            out.append((self.languages[best], float(letters[best] / letters.sum() * likely), spans))
        return out

    def fits(self, texts: list[str | None]) -> list[tuple[float, float]]:
        """(share of letters in learned scripts, fit) of each text.

        fit is the mean, over the letters in learned scripts, of the score of the best path
        under the mean of its language, in deviations of a learned letter, plus the part that
        chance allows a text of that length.  It is at least -MOST_BELOW for texts that fit.
        """
        if not self.languages:
            return [(0.0, -np.inf)] * len(texts)
        found = [self.words(t or "") for t in texts]
        out = []
        for value, (start, end, score), path in zip(texts, found, self.paths([f[2] for f in found]), strict=True):
            if not len(path):
                out.append((0.0, -np.inf))
                continue
            known = ~self.unlearned[_letters()[_codes(value)[start]].astype(np.int64) - 1]
            size = end - start
            n, own = size[known].sum(), path[known]
            if not n:
                out.append((0.0, -np.inf))
                continue
            under = (score[known, own] - size[known] * self.mean[own]) / np.maximum(self.deviation[own], 1e-6)
            out.append((float(n / size.sum()), float(under.sum() / n + MOST_BELOW / np.sqrt(n))))
        return out


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count trigrams and scripts of all rows with a text and a language.

    Tasks count into fixed arrays and send one row for each language, kind and bucket that
    occurs; the driver gets two packed arrays for each language, bounded by their number.
    """

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch["text"], batch["lang"], strict=True):
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS + len(SCRIPTS), np.int64)
                codes = _codes(value)
                letter = _letters()[codes]
                for low, high in _slices(codes, letter):
                    part = letter[low:high]
                    _, bucket = _trigrams(codes[low:high], part)
                    sums[name][:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                    sums[name][BUCKETS:] += np.bincount(part[part > 0].astype(np.int64) - 1, minlength=len(SCRIPTS))
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pd.DataFrame({"lang": name, "slot": at, "n": row[at]})

    small_batches(docs)
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = known.mapInPandas(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list(F.struct("slot", "n")).alias("c")).select("lang", F.col("c.slot").alias("slot"), F.col("c.n").alias("n"))
    rows = packed.limit(MOST_LANGUAGES + 1).toArrow()
    if rows.num_rows > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    names = rows["lang"].to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    table = np.zeros((len(names), BUCKETS + len(SCRIPTS)))
    for i, k in enumerate(order):
        table[i, rows["slot"][k].values.to_numpy()] = rows["n"][k].values.to_numpy()
    names.sort()
    return Model(names, table[:, :BUCKETS], table[:, BUCKETS:])


def identify(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Struct column (lang, score, spans) for the texts of ``docs``.

    lang is the language with most letters among the spans; score is its share of the letters
    times its posterior on the words given to it.  ``und`` with score 0 where the text is null
    or empty, has no letter, or nothing was learned.  spans lists (start, end, lang) in code
    points, end exclusive, from the first to the last letter of each run.  Ties go to the
    language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, spans array<struct<start:long,end:long,lang:string>>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            values = batch.tolist()
            for low in range(0, len(values), 512):
                parts += shared.value.describe(values[low : low + 512])
            spans = [[{"start": a, "end": b, "lang": name} for a, b, name in p[2]] for p in parts]
            yield pd.DataFrame({"lang": [p[0] for p in parts], "score": [p[1] for p in parts], "spans": spans})

    return describe(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_and_identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans), one row for each row of ``docs``.

    Rows with a null id are not learned from and not held out; rows with a null or empty text
    get ``und``; repeated rows count as often as they occur; an empty table gives no rows.
    """
    model = train(docs.where(~held_out(doc_id) & F.col(doc_id).isNotNull()), text, lang)
    rows = docs.select(F.col(doc_id).alias(doc_id), held_out(doc_id).alias("held_out"), identify(docs, model, text).alias("_found"))
    spans = F.concat_ws(
        ",", F.transform("_found.spans", lambda s: F.concat_ws(":", s["lang"], s["start"].cast("string"), s["end"].cast("string")))
    )
    return rows.select(doc_id, "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"), spans.alias("spans"))


def in_known_language(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least_known: float = LEAST_KNOWN, most_below: float = MOST_BELOW
) -> DataFrame:
    """Rows of ``docs`` whose text fits the learned languages.

    Texts without letters go, those with under ``least_known`` of their letters in scripts of
    learned languages, and those whose other letters score over ``most_below`` deviations under
    what the learned rows of their language score; see ``Model.fits``.  A text in several
    learned languages stays.  All columns are kept as they are.
    """
    model = train(docs.where(~held_out(doc_id) & F.col(doc_id).isNotNull()), text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def fitting(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values, parts = batch.tolist(), []
            for low in range(0, len(values), 512):
                parts += shared.value.fits(values[low : low + 512])
            yield pd.Series([known >= least_known and fit >= -most_below for known, fit in parts], dtype=bool)

    return docs.where(fitting(F.col(text)))
