"""Secrets in texts, with DataFrame functions only.

Three fixed patterns give the base spans.  Strings that look random give more: over every
candidate string a window slides, the counts of its characters are updated by the one that
enters and the one that leaves, and with them the Shannon entropy of the window.  Each
character class has its own threshold.  Strings on the allow list are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.text import spans_text

# The base patterns, in the order of their kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ["assign", "access", "hex", "entropy"]

WINDOW = 20
# Candidate strings: whole runs of the class, at least as long as the window, with a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
CLASS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Bits for each character of a window from which it counts as random: for candidates of lower
# hex digits alone, and for all others.
HEX_BITS = 2.9
WIDE_BITS = 3.75

# Strings that look random and are not secret.
ALLOWED = [
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"(?i).*(example|sample|dummy|placeholder|changeme|redacted|xxxx).*",
    r"(?i).*(0123456789|1234567890|abcdefghij).*",
    r"(?i)(sha1|sha256|sha384|sha512|md5)[-_=].*",  # checksums
    r"[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?[0-9]{1,4}",  # numbered names
]

# Places of an array, and characters of a text, that are gone through one by one.
BLOCK = 64
CHUNK = 4096

SPAN = "struct<start:long,rank:int,end:long,kind:string>"


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, zero: Column, join) -> Column:
    """For each place of an array the ``join`` of all values before it, ``zero`` at the first.

    Blocks are joined first, then the blocks before each block, so that a place looks at no
    more than BLOCK values and long arrays cost little more than their length.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: join(a, x))

    def with_blocks(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / BLOCK).cast("int")), lambda k: total(F.slice(v, k * BLOCK + 1, F.lit(BLOCK))))
        return _let(blocks, lambda sums: _let(F.transform(sums, lambda _, k: total(F.slice(sums, F.lit(1), k))), lambda heads: each(v, heads)))

    def each(v: Column, heads: Column) -> Column:
        def at(i):
            k = F.floor(i / BLOCK).cast("int")
            return join(F.get(heads, k), total(F.slice(v, k * BLOCK + 1, i - k * BLOCK)))

        return F.transform(v, lambda _, i: at(i))

    return _let(values, with_blocks)


def _spans(text: Column, pattern: str, hits: Column, kind: str) -> Column:
    """Array of spans of the ``hits`` of ``pattern``, from the lengths of what stands between.

    The text between matches is cut out by the same pattern, so the lengths up to a match
    add up to its place.  Lengths are in code points.
    """
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).cast("long").alias("gap"), F.length(h).cast("long").alias("own")))

    def placed(pairs: Column) -> Column:
        ends = _before(F.transform(pairs, lambda x: x["gap"] + x["own"]), F.lit(0).cast("long"), lambda a, x: a + x)
        return F.zip_with(pairs, ends, span)

    def span(item: Column, at: Column) -> Column:
        start = at + item["gap"]
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + item["own"]).alias("end"), F.lit(kind).alias("kind"))

    return F.when(F.size(hits) > 0, _let(lengths, placed)).otherwise(_none())


def _bits(count: Column) -> Column:
    """count * log2(count), 0 for 0."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _random_windows(candidate: Column) -> Column:
    """(first, last) of the windows of ``candidate`` whose entropy reaches its class's bits.

    first counts from 0, last is exclusive; last is 0 if no window does, or if an allow rule
    names the string.  With S the sum of c * log2(c) over the counts c, the entropy of a full
    window is log2(w) - S / w; one step changes S by the terms of the entering and the leaving
    character alone.
    """
    places = F.transform(F.split(candidate, ""), lambda c: F.call_function("instr", F.lit(CLASS), c))
    leaving = F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), places), 1, F.size(places))
    moves = F.zip_with(places, leaving, lambda a, b: F.struct(a.alias("enters"), b.alias("leaves")))
    least = F.when(candidate.rlike("^[0-9a-f]+$"), F.lit(HEX_BITS)).otherwise(F.lit(WIDE_BITS))
    state = F.struct(
        F.array_repeat(F.lit(0), len(CLASS)).alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(0).alias("at"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )

    def step(state, move):
        enters, leaves, at = move["enters"], move["leaves"], state["at"] + 1
        counts = F.transform(
            state["counts"],
            lambda c, k: c + F.when(k + 1 == enters, 1).otherwise(0) - F.when(k + 1 == leaves, 1).otherwise(0),
        )
        more, less = F.get(state["counts"], enters - 1), F.get(state["counts"], leaves - 1)
        grown = _bits(more + 1) - _bits(more)
        shrunk = F.when(leaves > 0, _bits(less) - _bits(less - 1)).otherwise(F.lit(0.0))
        s = F.when(enters == leaves, state["s"]).otherwise(state["s"] + grown - shrunk)
        hit = (at >= WINDOW) & (F.lit(math.log2(WINDOW)) - s / WINDOW >= least)
        return F.struct(
            counts.alias("counts"),
            s.alias("s"),
            at.alias("at"),
            F.when(hit & (state["last"] == 0), at - WINDOW).otherwise(state["first"]).alias("first"),
            F.when(hit, at).otherwise(state["last"]).alias("last"),
        )

    usable = F.lit(True)
    for pattern in ALLOWED:
        usable = usable & ~candidate.rlike(f"^(?:{pattern})$")
    found = F.aggregate(moves, state, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    return F.when(usable, found).otherwise(F.struct(F.lit(0).alias("first"), F.lit(0).alias("last")))


def _untouched(base: Column, candidates: Column) -> Column:
    """Spans of the ``candidates`` (s, c), with c, that no span of ``base`` touches.

    In the order of starts a candidate is touched by a base span before it that ends behind
    its start, or by one that starts inside it; candidates do not overlap each other, so only
    the next span can.
    """
    entropy = F.lit(KINDS[3])
    own = F.transform(candidates, lambda x: F.struct(x["s"]["start"].alias("start"), x["s"]["rank"].alias("rank"), x["s"]["end"].alias("end"), x["s"]["kind"].alias("kind"), x["c"].alias("c")))
    others = F.transform(
        base, lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"), b["kind"].alias("kind"), F.lit(None).cast("string").alias("c"))
    )

    def apart(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: F.when(x["kind"] == entropy, F.lit(0).cast("long")).otherwise(x["end"]))
        return _let(_before(ends, F.lit(0).cast("long"), F.greatest), lambda reached: chosen(spans, reached))

    def chosen(spans: Column, reached: Column) -> Column:
        def free(x, i):
            following = F.get(spans, i + 1)
            inside = F.coalesce((following["kind"] != entropy) & (following["start"] < x["end"]), F.lit(False))
            return (x["kind"] == entropy) & (F.get(reached, i) <= x["start"]) & ~inside

        return F.filter(spans, free)

    none = F.filter(own, lambda _: F.lit(False))
    return F.when(F.size(candidates) > 0, _let(F.array_sort(F.concat(others, own)), apart)).otherwise(none)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, base, spans), one row for each row of ``docs``.

    base and spans are arrays of (start, rank, end, kind) by start, then kind; start and end in
    code points, end exclusive.  base holds, leftmost and not overlapping within a kind,

    * assign: a secret's name, a sign and a value of 6 characters or more,
    * access: AKIA and capitals or digits, 20 characters or more,
    * hex: 24 or more of 0-9a-f;

    spans has the entropy spans too: the hull of the random windows of a candidate string, if
    no base span touches it and no allow rule names the string.  Null text counts as empty,
    empty texts have no spans, repeated rows are scanned each, null ids stay null, an empty
    table gives no rows; other columns are not looked at.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("text"))
    rows = rows.select(
        "*",
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(0)).alias("_assign"),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)).alias("_access"),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)).alias("_hex"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("_candidate"),
    )
    assign = _spans(F.col("text"), ASSIGN, F.col("_assign"), "assign")
    values = F.transform("_assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)))
    assign = F.filter(F.zip_with(assign, values, lambda s, n: F.struct(s.alias("s"), n.alias("n"))), lambda x: x["n"] >= LEAST_VALUE)
    assign = F.transform(assign, lambda x: x["s"])
    base = F.concat(
        assign,
        _spans(F.col("text"), ACCESS, F.col("_access"), "access"),
        _spans(F.col("text"), HEX, F.col("_hex"), "hex"),
    )
    candidates = F.zip_with(
        _spans(F.col("text"), CANDIDATE, F.col("_candidate"), "entropy"), F.col("_candidate"), lambda s, c: F.struct(s.alias("s"), c.alias("c"))
    )
    rows = rows.select("doc_id", "text", F.array_sort(base).alias("base"), candidates.alias("_candidates"))
    likely = F.filter("_candidates", lambda x: x["c"].rlike("[A-Za-z]"))
    rows = rows.select("doc_id", "text", "base", _untouched(F.col("base"), likely).alias("_alone"))
    rows = rows.select("doc_id", "text", "base", F.transform("_alone", lambda x: F.struct(x.alias("s"), _random_windows(x["c"]).alias("part"))).alias("_judged"))
    more = F.transform(
        F.filter("_judged", lambda x: x["part"]["last"] > 0),
        lambda x: F.struct(
            (x["s"]["start"] + x["part"]["first"]).alias("start"),
            x["s"]["rank"].alias("rank"),
            (x["s"]["start"] + x["part"]["last"]).alias("end"),
            x["s"]["kind"].alias("kind"),
        ),
    )
    return rows.select("doc_id", "text", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy) of ``scan``."""
    found = scan(docs, doc_id, text)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("doc_id").alias(doc_id),
        *[count(k) for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        count(KINDS[3]),
    )


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` and the length in ``chars`` brought up to date.

    Spans that overlap become one mask.  Rows without spans, nulls and other columns stay as
    they are.
    """
    columns = docs.columns
    found = scan(docs.withColumn("_all", F.struct(*[F.col(f"`{c}`") for c in columns])), "_all", text)
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def part(own: Column, start: Column, end: Column) -> Column:
        """Characters from ``start`` up to, without, ``end``; looks at no other chunks of the text."""
        first = F.floor(start / CHUNK).cast("int")
        held = F.array_join(F.slice(own, first + 1, F.floor(end / CHUNK).cast("int") - first + 1), "")
        return F.substr(held, (start - first * CHUNK + 1).cast("int"), (end - start).cast("int"))

    def pieces(own: Column, spans: Column, reached: Column) -> Column:
        def piece(x, i):
            at = F.get(reached, i)
            return F.when(x["start"] >= at, F.concat(part(own, at, x["start"]), F.lit(mask))).otherwise(F.lit(""))

        end = F.greatest(F.element_at(reached, -1), F.element_at(spans, -1)["end"])
        return F.concat(F.array_join(F.transform(spans, piece), ""), part(own, end, F.length("text").cast("long")))

    ends = F.transform("spans", lambda x: x["end"])
    reached = _before(ends, F.lit(0).cast("long"), F.greatest)
    clean = _let(chunks, lambda own: _let(reached, lambda at: pieces(own, F.col("spans"), at)))
    found = found.withColumn("_clean", F.when(F.size("spans") > 0, clean))
    new = []
    for c in columns:
        old = F.col("doc_id")[c]
        if c == text:
            old = F.coalesce("_clean", old)
        elif c == chars:
            old = F.when(F.col("_clean").isNotNull(), F.length("_clean").cast(docs.schema[c].dataType)).otherwise(old)
        new.append(old.alias(c))
    return found.select(*new)
