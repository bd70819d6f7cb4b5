"""Clusters of unknown names by character n-gram cosine similarity.

With two points enough for a cluster, density clusters are the connected components of the
graph of pairs within ``eps``; isolated names stay noise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.plans.components import connected_components
from creditloom.session import cut_lineage

SLACK = 1e-9
CELL = 4096
# Signatures of the approximate search: bands of so many signs each.  Two names at cosine 0.7 agree
# in a sign with probability 1 - acos(0.7)/pi = 0.75, so they share one of 40 bands of 9 signs with
# probability 0.95, at 0.8 with 0.99.
BANDS, SIGNS = 40, 9


def ngrams(text: Column, smallest: int = 2, largest: int = 4) -> Column:
    """All character n-grams of the lower-cased text, white space included."""
    lowered = F.lower(F.regexp_replace(text, r"(?U)\s\s+", " "))
    length = F.length(lowered)

    def of_size(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), length - n + 1), lambda i: F.substring(lowered, i, n))

    sizes = F.sequence(F.lit(smallest), F.least(F.lit(largest), length))
    return F.when(length >= smallest, F.flatten(F.transform(sizes, of_size))).otherwise(F.array().cast("array<string>"))


def tfidf(names: DataFrame) -> DataFrame:
    """(name, gram, df, weight): raw counts times smoothed idf, scaled to unit length.

    ``copies`` says how many documents share a name; they count in the document frequencies.
    """
    counts = (
        names.select("name", "copies", F.explode(ngrams(F.col("name"))).alias("gram"))
        .groupBy("name", "copies", "gram")
        .agg(F.count("*").alias("tf"))
    )
    n_docs = names.agg(F.sum("copies")).scalar()
    frequencies = counts.groupBy("gram").agg(F.sum("copies").alias("df"))
    raw = counts.join(frequencies, "gram").withColumn(
        "raw_weight", F.col("tf") * (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)
    )
    lengths = raw.groupBy("name").agg(F.sqrt(F.sum(F.col("raw_weight") * F.col("raw_weight"))).alias("_norm"))
    return raw.join(lengths, "name").select("name", "gram", "df", (F.col("raw_weight") / F.col("_norm")).alias("weight"))


def name_vectors(weights: DataFrame) -> DataFrame:
    """One row per name: its grams, rarest first, with weights and the norm from each gram on."""
    item = F.struct("df", "gram", "weight")
    vectors = weights.groupBy("name").agg(F.sort_array(F.collect_list(item)).alias("items"))
    size = F.size("items")
    tail = lambda i: F.sqrt(
        F.aggregate(F.slice("items", i, size), F.lit(0.0), lambda acc, x: acc + x["weight"] * x["weight"])
    )
    return vectors.withColumn("tails", F.transform(F.sequence(F.lit(1), size), tail))


def postings(vectors: DataFrame, threshold: float) -> DataFrame:
    """Grams by which a name can be found.

    If two unit vectors have a product of at least t, then from their first common gram on
    the norms multiply to at least t, so that gram lies where the norm is still t or more.
    """
    n_keep = F.size(F.filter("tails", lambda x: x >= threshold - SLACK))
    found = vectors.withColumn("grams", F.slice(F.transform("items", lambda x: x["gram"]), 1, n_keep))
    return found.select("name", "items", "grams", "tails", F.posexplode("grams").alias("at", "gram")).withColumn(
        "tail", F.get("tails", F.col("at"))
    ).drop("tails", "at")


def _weight_in(items: str):
    return lambda gram: F.aggregate(
        F.filter(items, lambda y: y["gram"] == gram), F.lit(0.0), lambda acc, y: acc + y["weight"]
    )


def _cosine(items_a: str, items_b: str) -> Column:
    weight_in_b = _weight_in(items_b)
    return F.aggregate(items_a, F.lit(0.0), lambda acc, x: acc + x["weight"] * weight_in_b(x["gram"]))


def _meetings(found: DataFrame, threshold: float, apart: str | None = None) -> DataFrame:
    """Pairs of postings within the threshold, each pair once.

    Frequent grams are split into cells of at most ``CELL`` x ``CELL`` names so that no task
    gets a whole posting list.  A pair is scored only at its first common gram, only if the
    norms from there on allow the threshold and, with ``apart``, only if it differs there.
    """
    parts = found.groupBy("gram").agg(F.ceil(F.count("*") / CELL).alias("parts"))
    found = found.join(parts.where("parts > 1"), "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("name"), F.col("parts"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    carried = ["name", "items", "grams", "tail", *([apart] if apart else [])]

    def side(suffix: str, mine: str, other: str) -> DataFrame:
        columns = [F.col(c).alias(f"{c}_{suffix}") for c in carried]
        return found.select("gram", *columns, own.alias(mine), every.alias(other))

    close = (
        (F.col("name_a") < F.col("name_b"))
        & (F.col("tail_a") * F.col("tail_b") >= threshold - SLACK)
        & (F.get(F.array_intersect("grams_a", "grams_b"), F.lit(0)) == F.col("gram"))
    )
    if apart:
        close = (F.col(f"{apart}_a") != F.col(f"{apart}_b")) & close
    left, right = side("a", "part_a", "part_b"), side("b", "part_b", "part_a")
    pairs = left.join(right, ["gram", "part_a", "part_b"]).where(close)
    return pairs.select("name_a", "name_b", _cosine("items_a", "items_b").alias("cosine")).where(
        F.col("cosine") >= threshold - SLACK
    )


def cosine_pairs(names: DataFrame, eps: float = 0.3) -> DataFrame:
    """(name_a, name_b, cosine) for every pair of names within cosine distance ``eps``."""
    threshold = 1.0 - eps
    return _meetings(cut_lineage(postings(name_vectors(tfidf(names)), threshold)), threshold)


def _hashed(items: str, n_signs: int) -> Column:
    words = F.sequence(F.lit(0), F.lit((n_signs - 1) // 64))
    return F.transform(
        items, lambda x: F.struct(x["weight"].alias("w"), F.transform(words, lambda k: F.xxhash64(k, x["gram"])).alias("h"))
    )


def _band_keys(hashed: str, bands: int, signs: int) -> Column:
    """One number for each band: on which sides of its random hyperplanes the vector lies.

    A hyperplane's coordinate for a gram is +1 or -1, one bit of a hash of the gram, so 64
    hyperplanes cost one hash and nothing is stored or sent.
    """

    def sign(n: Column) -> Column:
        bit = lambda x: F.call_function("shiftright", F.get(x["h"], F.floor(n / 64).cast("int")), n % 64).bitwiseAND(F.lit(1))
        total = F.aggregate(hashed, F.lit(0.0), lambda acc, x: acc + x["w"] * (F.lit(1) - bit(x) * 2))
        return (total > 0).cast("int")

    def key(band: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(signs - 1)), F.lit(0), lambda acc, i: acc * 2 + sign(band * signs + i))

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)


def approximate_pairs(names: DataFrame, eps: float = 0.3, bands: int = BANDS, signs: int = SIGNS) -> DataFrame:
    """(name_a, name_b, cosine): pairs within ``eps`` that share a band of random-hyperplane signs.

    Every cosine is exact and no pair is beyond ``eps``; a pair may be missed, more rarely the
    nearer it is (see ``BANDS``).  :func:`cosine_pairs` finds all.  Names meet by (band, key) with
    their numbers only; a key that many names share is dealt to cells of ``CELL`` x ``CELL``.
    """
    vectors = cut_lineage(name_vectors(tfidf(names)).withColumn("id", F.monotonically_increasing_id()))
    hashed = vectors.select("id", _hashed("items", bands * signs).alias("hashed"))
    found = cut_lineage(hashed.select("id", F.posexplode(_band_keys("hashed", bands, signs)).alias("band", "key")))
    parts = found.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    found = found.join(parts.select("band", "key", F.ceil(F.col("n") / CELL).alias("parts")), ["band", "key"])
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    left = found.select("band", "key", F.col("id").alias("a"), own.alias("i"), every.alias("j"))
    right = found.select("band", "key", F.col("id").alias("b"), own.alias("j"), every.alias("i"))
    met = left.join(right, ["band", "key", "i", "j"]).where("a < b").select("a", "b").distinct()
    side = lambda s: vectors.select(F.col("id").alias(s), F.col("name").alias(f"name_{s}"), F.col("items").alias(f"items_{s}"))
    pairs = met.join(side("a"), "a").join(side("b"), "b")
    first, second = F.least("name_a", "name_b"), F.greatest("name_a", "name_b")
    return pairs.select(first.alias("name_a"), second.alias("name_b"), _cosine("items_a", "items_b").alias("cosine")).where(
        F.col("cosine") >= 1.0 - eps - SLACK
    )


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: exact pairs, those of them that were found, and their share (null without pairs)."""
    both = exact.join(found.select("name_a", "name_b", F.lit(1).alias("_found")), ["name_a", "name_b"], "left")
    return both.agg(F.count("*").alias("n_exact"), F.count("_found").alias("n_found")).withColumn(
        "recall", F.try_divide("n_found", "n_exact")
    )


def _first_groups(found: DataFrame, threshold: float) -> DataFrame:
    """Components of the edges from each name to the first name of its posting lists.

    One score per posting instead of one per pair; names of a dense cluster mostly end up
    together, so the search for pairs need only look between these groups.
    """
    pivots = found.groupBy("gram").agg(F.min_by(F.struct("name", "items"), "name").alias("pivot"))
    stars = (
        found.select("gram", "name", "items")
        .join(pivots, "gram")
        .where(F.col("name") != F.col("pivot.name"))
        .select("name", "items", F.col("pivot.name").alias("pivot_name"), F.col("pivot.items").alias("pivot_items"))
        .where(_cosine("items", "pivot_items") >= threshold - SLACK)
    )
    return connected_components(stars.select(F.col("pivot_name").alias("u"), F.col("name").alias("v")))


def _linked_names(names: DataFrame, eps: float) -> DataFrame:
    """(node, component) of the graph of pairs within ``eps``.

    Groups found through single scores come first, and pairs inside a group, which cannot
    change the components, are neither scored nor emitted.
    """
    threshold = 1.0 - eps
    found = cut_lineage(postings(name_vectors(tfidf(names)), threshold))
    groups = cut_lineage(_first_groups(found, threshold))
    grouped = found.join(groups.withColumnRenamed("node", "name"), "name", "left").withColumn(
        "component", F.coalesce("component", "name")
    )
    between = _meetings(grouped, threshold, apart="component").select(
        F.col("name_a").alias("u"), F.col("name_b").alias("v")
    )
    inside = groups.where(F.col("node") != F.col("component")).select(
        F.col("component").alias("u"), F.col("node").alias("v")
    )
    return connected_components(between.union(inside))


def cluster_names(names: DataFrame, eps: float = 0.3) -> DataFrame:
    """(name, exemplar) for every clustered name of ``names`` (name, copies).

    Several documents with one name are neighbours of each other, so such a name is clustered
    even alone.  A single document in all is its own cluster.  The exemplar is the shortest
    member, the alphabetically first among equals.
    """
    names = names.where(F.length(F.regexp_replace("name", r"(?U)^\s+|\s+$", "")) > 1)
    names = cut_lineage(names)
    members = cut_lineage(_linked_names(names, eps))
    exemplars = members.groupBy("component").agg(
        F.min_by("node", F.struct(F.length("node").alias("n"), F.col("node").alias("t"))).alias("exemplar")
    )
    joint = members.join(exemplars, "component").select(F.col("node").alias("name"), "exemplar")
    n_docs = names.agg(F.sum("copies")).scalar()
    alone = (
        names.join(joint.select("name"), "name", "left_anti")
        .where((F.col("copies") > 1) | (n_docs == 1))
        .select("name", F.col("name").alias("exemplar"))
    )
    return joint.unionByName(alone)
