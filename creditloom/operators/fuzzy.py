"""Best dictionary entry for each name by token-sort similarity.

A name only wants its best entry, so the search goes down in levels.  At a high level few entries
can reach the score: two texts that similar must share many q-grams, long ones at that.  A name
that finds an entry there is done, because every entry that could beat it belongs to the same
level.  Only names without one go on to the next level, with shorter grams, down to the threshold.

At a level, names and entries meet by the q-grams that one of them must share with any partner
of a possible length (the rarest ones of each).  Meetings carry numbers only, and frequent grams
are dealt to cells by the measured sizes of both sides.  A pair's grams and characters bound its
score from above.  Each name's entries are scored in the order of that bound, in bands, and a
band only as far as its bounds still reach the best score so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.similarity import (
    bound,
    character_bag,
    characters,
    lcs_length,
    position_masks,
    ratio_from_lcs,
    token_sorted,
)
from creditloom.session import cut_lineage

# Levels above the threshold; the gram length of a level follows from its score.  This is the
# lowest at which four characters are sure to be shared in a row.
LEVELS = (86.0,)
# Rows of one gram that meet in one cell, on either side.
CELL = 4096
# Positions in the order of bounds at which the best score so far is looked at again.
BANDS = (1,)
SLACK = 1e-9


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity 0..100 of two names after sorting their tokens."""

    def ratio(texts: Column) -> Column:
        left, right = texts["left"], texts["right"]
        lcs = lcs_length(characters(left), position_masks(right), F.length(right))
        return ratio_from_lcs(lcs, F.length(left), F.length(right))

    return bound(F.struct(token_sorted(a).alias("left"), token_sorted(b).alias("right")), ratio)


def gram_length(cutoff: float) -> int:
    """The longest grams of which texts at ``cutoff`` must share one, whatever their lengths; 1 is characters.

    See :func:`least_shared`: with a common subsequence of cutoff/200 of both lengths it is at
    least 1 where (2q - 1) cutoff >= 200 (q - 1).
    """
    return max(q for q in (1, 2, 3, 4) if (2 * q - 1) * cutoff >= 200.0 * (q - 1))


def least_shared(q: int, lcs: Column, total: Column) -> Column:
    """Grams that two texts with a common subsequence of ``lcs`` share at least.

    Texts are padded by q - 1 marks at both ends.  A character that only one text has touches at
    most q grams of that text, and parts at most q - 1 that the common characters would form in
    the other.  For q = 1 this is the subsequence itself.
    """
    return lcs * (2 * q - 1) - total * (q - 1) + (q - 1)


def most_common(q: int, shared: Column, total: Column) -> Column:
    """The longest common subsequence that so many shared grams allow."""
    return F.floor((shared + (total - 1) * (q - 1)) / (2 * q - 1))


def numbered_grams(form: Column, q: int) -> Column:
    """All q-grams of the padded text, equal ones told apart by number."""
    if q == 1:
        return character_bag(form)
    edge = (q - 1) * "\u0001"
    padded = F.concat(F.lit(edge), form, F.lit(edge.replace("\u0001", "\u0002")))
    grams = F.transform(F.sequence(F.lit(1), F.length(form) + q - 1), lambda i: F.substring(padded, i, F.lit(q)))
    return F.transform(
        grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string"))
    )


def _prepared(texts: DataFrame, lengths) -> DataFrame:
    """``texts`` (id, form) with length, character bag and the grams of the wanted lengths, written once."""
    grams = {f"grams_{q}": numbered_grams(F.col("form"), q) for q in lengths}
    return cut_lineage(texts.withColumns({"n": F.length("form"), "bag": character_bag(F.col("form")), **grams}))


def _at_level(rows: DataFrame, cutoff: float, q: int) -> DataFrame:
    """The prepared rows with ``grams`` and ``by``, by how many of them a text is to be met."""
    share, length = cutoff / 200.0, F.col("n")
    shortest = F.ceil(length * (share / (1.0 - share)) - SLACK).cast("int")
    longest = F.floor(length * ((1.0 - share) / share) + SLACK).cast("int")
    need = lambda n: least_shared(q, F.ceil((length + n) * share - SLACK), length + n)
    needed = F.array_min(F.transform(F.sequence(shortest, F.greatest(shortest, longest)), need))
    rows = rows.withColumn("grams", F.col(f"grams_{q}"))
    return rows.withColumn("by", F.size("grams") - F.greatest(needed, F.lit(1)) + 1)


def _frequencies(names: DataFrame, entries: DataFrame) -> DataFrame:
    """(gram, pa, pb, df): entries with a gram that both sides have, and in how many cells either side's rows go."""
    side = lambda df, mine: df.select(F.explode("grams").alias("gram"), F.lit(mine).alias("entry"))
    both = side(names, 0).union(side(entries, 1)).groupBy("gram").agg(
        F.sum("entry").alias("df"), F.sum(F.lit(1) - F.col("entry")).alias("nf")
    )
    cells = lambda n: F.ceil(F.col(n) / CELL).cast("int")
    return both.where("df > 0 AND nf > 0").select("gram", "df", cells("nf").alias("pa"), cells("df").alias("pb"))


def _met_by(rows: DataFrame, frequency: DataFrame, mine: str, other: str, i: str, j: str) -> DataFrame:
    """(gram, i, j, id, n): the rarest grams of each text, as many as it is to be met by, dealt to cells.

    A gram that only one side has comes first and meets nobody.
    """
    grams = rows.select("id", "n", "by", F.explode("grams").alias("gram")).join(frequency, "gram", "left")
    at = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("df", F.lit(0)), "gram"))
    met = grams.withColumn("at", at).where("at <= by AND df IS NOT NULL")
    own = F.pmod(F.xxhash64("id"), F.col(mine)).cast("int")
    return met.select("gram", "id", "n", own.alias(i), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(j))


def _bounded(names: DataFrame, entries: DataFrame, cutoff: float, q: int) -> DataFrame:
    """(a, b, entry_rank, bound, at): the pairs that may reach ``cutoff``, each name's in the order of their bounds."""
    frequency = _frequencies(names, entries)
    left, right = _met_by(names, frequency, "pa", "pb", "i", "j"), _met_by(entries, frequency, "pb", "pa", "j", "i")
    left = left.select("gram", "i", "j", F.col("id").alias("a"), F.col("n").alias("na"))
    right = right.select("gram", "i", "j", F.col("id").alias("b"), F.col("n").alias("nb"))
    possible = F.least("na", "nb") >= (F.col("na") + F.col("nb")) * (cutoff / 200.0) - SLACK
    met = left.join(right, ["gram", "i", "j"]).where(possible).select("a", "b").distinct()
    met = met.join(names.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"), F.col("bag").alias("ca")), "a")
    met = met.join(entries.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"), F.col("bag").alias("cb"), "entry_rank"), "b")
    total = F.col("na") + F.col("nb")
    lcs = F.least(most_common(q, F.size(F.array_intersect("ga", "gb")), total), F.size(F.array_intersect("ca", "cb")))
    bound = ratio_from_lcs(lcs, F.col("na"), F.col("nb"))
    found = met.select("a", "b", "entry_rank", bound.alias("bound")).where(F.col("bound") >= cutoff - SLACK)
    at = F.row_number().over(Window.partitionBy("a").orderBy(_order("bound")))
    return cut_lineage(found.withColumn("at", at))


def _scored(pairs: DataFrame, names: DataFrame, entries: DataFrame) -> DataFrame:
    """(a, b, entry_rank, score) by the exact common subsequence."""
    pairs = pairs.join(names.select(F.col("id").alias("a"), F.col("form").alias("fa")), "a")
    pairs = pairs.join(entries.select(F.col("id").alias("b"), F.col("form").alias("fb")), "b")
    length = F.length("fb")
    lcs = lcs_length(characters(F.col("fa")), position_masks(F.col("fb")), length)
    return pairs.select("a", "b", "entry_rank", ratio_from_lcs(lcs, F.length("fa"), length).alias("score"))


def _order(value: str) -> Column:
    """Highest value first; equal values go to the earlier entry."""
    return F.struct((-F.col(value)).alias("v"), F.col("entry_rank").alias("r"))


def _best(scored: DataFrame) -> DataFrame:
    return scored.groupBy("a").agg(F.min_by(F.struct("b", "entry_rank", "score"), _order("score")).alias("best")).select("a", "best.*")


def _best_of_level(names: DataFrame, entries: DataFrame, cutoff: float) -> DataFrame:
    """(a, b, entry_rank, score): the best entry of the names that have one at ``cutoff`` or above."""
    q = gram_length(cutoff)
    pairs = _bounded(_at_level(names, cutoff, q), _at_level(entries, cutoff, q), cutoff, q)
    best, low = None, 0
    for high in [*BANDS, None]:
        band = pairs.where(F.col("at") > low) if high is None else pairs.where((F.col("at") > low) & (F.col("at") <= high))
        if best is not None:
            known = best.select("a", F.col("score").alias("_s"), F.col("entry_rank").alias("_r"))
            reaches = (F.col("bound") > F.col("_s")) | ((F.col("bound") >= F.col("_s")) & (F.col("entry_rank") < F.col("_r")))
            band = band.join(known, "a", "left").where(F.col("_s").isNull() | reaches).drop("_s", "_r")
        found = _scored(band, names, entries).where(F.col("score") >= cutoff)
        best = cut_lineage(_best(found if best is None else found.unionByName(best)))
        low = high
    return best


def match_names(names: DataFrame, dictionary: DataFrame, threshold: float = 70.0) -> DataFrame:
    """(name, match, score) for names with an entry at or above ``threshold``.

    Names equal to an entry after token sorting score 100, the maximum, and skip the search.  Of
    equal scores the earlier entry counts.
    """
    names = names.select("name").where(F.length("name") >= 2)
    keyed = names.withColumn("form", token_sorted(F.col("name")))
    entries = dictionary.select("entry", "entry_rank").withColumn("form", token_sorted(F.col("entry")))
    first = entries.groupBy("form").agg(F.min_by("entry", "entry_rank").alias("match"))
    keyed = cut_lineage(keyed.join(first, "form", "left"))
    found = keyed.where(F.col("match").isNotNull()).select("name", "match", F.lit(100.0).alias("score"))
    rest = keyed.where(F.col("match").isNull()).drop("match")
    cutoffs = [level for level in LEVELS if level > threshold] + [threshold]
    lengths = sorted({gram_length(c) for c in cutoffs})
    rest = _prepared(rest.withColumn("id", F.monotonically_increasing_id()), lengths)
    searched = _prepared(entries.withColumn("id", F.monotonically_increasing_id()), lengths)
    open_names = rest
    for cutoff in cutoffs:
        best = _best_of_level(open_names, searched, cutoff)
        named = best.join(rest.select(F.col("id").alias("a"), "name"), "a")
        named = named.join(searched.select(F.col("id").alias("b"), F.col("entry").alias("match")), "b")
        found = found.unionByName(named.select("name", "match", "score"))
        open_names = open_names.join(best.select(F.col("a").alias("id")), "id", "left_anti")
    return found


def fuzzy_match(names: DataFrame, dictionary: DataFrame, threshold: float = 70.0) -> DataFrame:
    """(name, match, score, accepted) for every name.

    A name without an entry at or above the threshold is its own match; its score is null,
    since nothing uses how far below the threshold it stays.
    """
    found = match_names(names, dictionary, threshold)
    return names.select("name").join(found, "name", "left").select(
        "name",
        F.coalesce("match", "name").alias("match"),
        "score",
        F.col("score").isNotNull().alias("accepted"),
    )
