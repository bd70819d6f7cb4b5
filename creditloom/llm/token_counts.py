"""Token counts that follow edits without encoding whole documents again.

A byte-level BPE tokenizer cuts a text into pre-tokens and encodes each on its own, so a count
is a sum over pre-tokens.  A document's state is a segment tree over them: leaves with the
length and the tokens of a pre-token, inner nodes with the sums.  An edit takes the leaves it
touches and a little context out, cuts and encodes only the text there until the cuts agree
with the old ones again, and sums up the path to the root.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import Remembered, small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A pre-token is decided by the characters up to this many after its end: the one that stops
# it and, for white space, the one after.
LOOKAHEAD = 2
# Pre-tokens in a leaf block of the tree.
FANOUT = 32
EDIT = "array<struct<start:long,end:long,text:string>>"


class Tokenizer:
    """Pre-tokens and their token counts for a byte-level BPE vocabulary."""

    def __init__(self, vocabulary: str = VOCABULARY):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile(PATTERN)
        self.tokens = Remembered(lambda piece: len(self.encoding.encode_ordinary(piece)))

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Lengths and token counts of the pre-tokens of ``text``."""
        found = self.cut.findall(text)
        return list(map(len, found)), list(map(self.tokens.__getitem__, found))


class Tree:
    """Segment tree over pre-tokens with sums of characters and of tokens.

    Leaves hold up to 2 * FANOUT pre-tokens in blocks; levels[0] has the sums of the blocks and
    every level above the sums of FANOUT nodes.  A change of leaves rewrites their blocks and
    adds up their ancestors; if the number of blocks changes, the nodes right of the change are
    summed anew.
    """

    def __init__(self, lengths: list[int], tokens: list[int]):
        self.blocks = [
            (lengths[i : i + FANOUT], tokens[i : i + FANOUT]) for i in range(0, len(lengths), FANOUT)
        ]
        self.levels: list[list[tuple[int, int]]] = []
        self.updated = 0
        self._sum(0)
        self.updated = 0

    def _sum(self, block: int, last: int | None = None) -> None:
        """Sum up from ``block`` to ``last`` (to the end if None) and all their ancestors."""
        if not self.levels:
            self.levels.append([])
        below = [(sum(a), sum(b)) for a, b in self.blocks[block : None if last is None else last + 1]]
        self.levels[0][block : len(self.levels[0]) if last is None else last + 1] = below
        self.updated += len(below)
        k, low, high = 0, block, last
        while len(self.levels[k]) > 1:
            low, high = low // FANOUT, None if high is None else high // FANOUT
            under = self.levels[k]
            stop = -(-len(under) // FANOUT) if high is None else high + 1
            rows = [under[i * FANOUT : (i + 1) * FANOUT] for i in range(low, stop)]
            sums = [(sum(a for a, _ in r), sum(b for _, b in r)) for r in rows]
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1][low : len(self.levels[k + 1]) if high is None else stop] = sums
            self.updated += len(sums)
            k += 1
        del self.levels[k + 1 :]

    @property
    def total(self) -> tuple[int, int]:
        """Characters and tokens of the document."""
        top = self.levels[-1]
        return top[0] if top else (0, 0)

    def find(self, place: int) -> tuple[int, int, int]:
        """(block, leaf in it, start of the leaf) of the last leaf that starts at or before ``place``."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= FANOUT
            while node + 1 < len(level) and node % FANOUT < FANOUT - 1 and start + level[node][0] <= place:
                start += level[node][0]
                node += 1
        lengths, leaf = self.blocks[node][0], 0
        while leaf + 1 < len(lengths) and start + lengths[leaf] <= place:
            start += lengths[leaf]
            leaf += 1
        return node, leaf, start

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], tokens: list[int]) -> None:
        """Put new leaves for those from ``first`` up to, without, ``last``; both (block, leaf)."""
        low, high = first[0], min(last[0], len(self.blocks) - 1)
        a = self.blocks[low][0][: first[1]] + lengths
        b = self.blocks[low][1][: first[1]] + tokens
        if last[0] < len(self.blocks):
            a += self.blocks[high][0][last[1] :]
            b += self.blocks[high][1][last[1] :]
        n = max(1, -(-len(a) // (2 * FANOUT))) if a else 0
        size = -(-len(a) // n) if n else 1
        fresh = [(a[i : i + size], b[i : i + size]) for i in range(0, len(a), size)]
        same = len(fresh) == high - low + 1
        self.blocks[low : high + 1] = fresh
        self._sum(low, high if same else None)

    def leaves(self, block: int, leaf: int) -> Iterator[tuple[int, int, int]]:
        """(block, leaf, length) from a leaf onwards."""
        while block < len(self.blocks):
            lengths = self.blocks[block][0]
            for i in range(leaf, len(lengths)):
                yield block, i, lengths[i]
            block, leaf = block + 1, 0


class Counted:
    """A text with its tree; edits keep both in step."""

    def __init__(self, tokenizer: Tokenizer, text: str):
        self.tokenizer, self.text = tokenizer, text
        self.tree = Tree(*tokenizer.leaves(text))
        self.encoded = 0

    def edit(self, start: int, end: int, new: str) -> None:
        """Put ``new`` for the characters from ``start`` up to, without, ``end``."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(text) - len(self.text)
        if not self.tree.blocks:
            self.text = text
            self.tree = Tree(*self.tokenizer.leaves(text))
            self.encoded += len(text)
            return
        # The first leaf that the old or new characters could decide otherwise: leaves that
        # end LOOKAHEAD or more before the edit stay.
        block, leaf, at = self.tree.find(max(0, start - LOOKAHEAD))
        if at > max(0, start - LOOKAHEAD):
            block, leaf, at = 0, 0, 0
        old = self.tree.leaves(block, leaf)
        old_at, last = at, (block, leaf)
        lengths, tokens, here = [], [], at
        for found in self.tokenizer.cut.finditer(text, at):
            # Behind the edit both cuts run over the same text: once they meet, they agree.
            while old_at < end or old_at + shift < here:
                step = next(old, None)
                if step is None:
                    last = (len(self.tree.blocks), 0)
                    break
                old_at += step[2]
                last = (step[0], step[1] + 1)
            if old_at >= end and old_at + shift == here and here >= start + len(new):
                break
            piece = found[0]
            lengths.append(len(piece))
            tokens.append(self.tokenizer.tokens[piece])
            here = found.end()
        else:
            last = (len(self.tree.blocks), 0)
        self.encoded += here - at
        self.text = text
        self.tree.replace((block, leaf), last, lengths, tokens)


# Edits of the registered query: what masking and tidying would change in a text.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LONG_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9]{9,}(?![0-9A-Za-z])")


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits in the order of the text: mail addresses and long numbers masked, lines that equal
    an earlier line of the text taken out."""
    out = [(*m.span(), "<email>") for m in EMAIL.finditer(text)] if "@" in text else []
    out += [(*m.span(), "<number>") for m in LONG_NUMBER.finditer(text)]
    seen, at = set(), 0
    repeated = []
    for line in text.split("\n"):
        if line.strip() and line in seen:
            repeated.append((max(0, at - 1), at + len(line), ""))
        seen.add(line)
        at += len(line) + 1
    kept: list[tuple[int, int, str]] = []
    for edit in sorted(out + repeated):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


def with_cleaning_edits(docs: DataFrame, text: str = "text", name: str = "edits") -> DataFrame:
    """``docs`` with the array of cleaning edits of each text, last place first."""

    @F.pandas_udf(EDIT)
    def edits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"start": a, "end": b, "text": t} for a, b, t in reversed(cleaning_edits(v or ""))] for v in batch])

    return docs.withColumn(name, edits(F.col(text)))


def gathered_edits(edits: DataFrame, doc_id: str = "doc_id", order: str = "seq", start: str = "start", end: str = "end", text: str = "text") -> DataFrame:
    """(doc_id, edits): a table of single edits as one ordered array for each document.

    Edits of a document apply one after another, so they have to meet; one document's edits
    are taken to fit in memory, as its text is.
    """
    one = F.struct(F.col(order).alias("seq"), F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"), F.coalesce(text, F.lit("")).alias("text"))
    rows = edits.groupBy(doc_id).agg(F.array_sort(F.collect_list(one)).alias("_all"))
    return rows.select(doc_id, F.transform("_all", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["text"].alias("text"))).alias("edits"))


def edited_counts(text: Column, edits: Column, vocabulary: str = VOCABULARY) -> Column:
    """Struct column (n_pretokens, n_tokens, n_edits, n_chars_after, n_pretokens_after,
    n_tokens_after, n_chars_encoded, n_nodes_updated, text_after).

    ``edits`` is an array of (start, end, text) that apply in order, each to the text that the
    ones before it leave; places beyond the text are moved to its end.  Null text counts as
    empty, null edits as none.  Counts equal those of encoding the edited text whole.
    """

    @F.pandas_udf(
        "n_pretokens long, n_tokens long, n_edits long, n_chars_after long, n_pretokens_after long, n_tokens_after long, "
        "n_chars_encoded long, n_nodes_updated long, text_after string"
    )
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tokenizer = Tokenizer(vocabulary)
        for texts, changes in batches:
            rows = []
            for value, own in zip(texts, changes, strict=True):
                doc = Counted(tokenizer, value or "")
                n, before = sum(len(b[0]) for b in doc.tree.blocks), doc.tree.total[1]
                own = own if own is not None else []
                for e in own:
                    start = min(max(0, e["start"]), len(doc.text))
                    doc.edit(start, min(max(start, e["end"]), len(doc.text)), e["text"] or "")
                chars, after = doc.tree.total
                m = sum(len(b[0]) for b in doc.tree.blocks)
                rows.append((n, before, len(own), chars, m, after, doc.encoded, doc.tree.updated, doc.text))
            names = "n_pretokens n_tokens n_edits n_chars_after n_pretokens_after n_tokens_after n_chars_encoded n_nodes_updated text_after"
            yield pd.DataFrame(rows, columns=names.split())

    return count(text, edits)


def count_cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of every document before and after cleaning, one row for each row of ``docs``.

    Columns: doc_id and those of ``edited_counts`` without the text.  Null and empty texts have
    zero counts; null ids stay null; repeated rows are counted each; an empty table gives no
    rows; other columns are not looked at.
    """
    small_batches(docs)
    rows = with_cleaning_edits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    out = rows.select(F.col("doc_id").alias(doc_id), edited_counts(F.col("text"), F.col("edits"), vocabulary).alias("c"))
    return out.select(doc_id, "c.*").drop("text_after")
