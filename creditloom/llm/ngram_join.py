"""Jaccard self-join on word n-grams as a blocked sparse product of documents and n-grams.

The incidence matrix has one row for each distinct n-gram set and one column for each n-gram.
Columns are put in one global order: rare ones by hash first, then those known to be frequent.
The product is taken in blocks of columns and rows:

* the *head* of every row is its first n - ceil(t n) + 1 columns.  Rows that qualify must meet
  there, so pairs that do not are never made.  Overlap counts are accumulated over the heads,
  and a pair goes as soon as count plus what the tails could still add is below the overlap
  that the two sizes ask for;
* the rest is read only for rows of surviving pairs, which gives the exact overlap.

A head column that very many rows share would make all pairs of them.  Such a long column is
first multiplied with one pivot row for each size band.  If that leaves its rows in different
components, it is multiplied in blocks of rows: a task gets the whole rows of two blocks, adds
up their overlaps column block by column block and returns links between components only, a
spanning forest of them.  The number of links is not needed for components, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditloom.llm.text import folded_words, shingle_hashes, small_batches, word_memo
from creditloom.plans.components import connected_components
from creditloom.session import cut_lineage

PERCENT = 85
WIDTH = 4
# Frequencies are counted over all rows for columns in this lowest part of the hash range.  It
# holds the heads of most rows; for the others the remaining columns are counted as well.
COUNTED_SHARE = 0.25
# At most so many frequent columns of either count are shipped to the tasks (8 bytes each).
MOST_FREQUENT = 1 << 20
FREQUENT_FROM = 24
# Columns with more rows than this go by pivots and row blocks, not by all their pairs.
LONG_COLUMN = 64
ROW_BLOCK = 512
COLUMN_BLOCK = 2048
BROADCAST_ROWS = 200_000

CUT = int(COUNTED_SHARE * 2**64)


def head_length(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def _frequent(grams: DataFrame) -> np.ndarray:
    """Sorted hashes of the frequent columns; few by construction, see ``MOST_FREQUENT``."""
    heavy = cut_lineage(grams.groupBy("gram").count().where(F.col("count") >= FREQUENT_FROM))
    least = FREQUENT_FROM
    while heavy.where(F.col("count") >= least).count() > MOST_FREQUENT:
        least *= 2
    rows = heavy.where(F.col("count") >= least).select("gram").toPandas()["gram"]
    return np.sort(rows.to_numpy(np.int64, copy=True).view(np.uint64))


def _is_in(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _low_columns(docs: DataFrame, text: str, width: int) -> DataFrame:
    """(gram): the columns below CUT of every row."""

    def low(batches):
        memo = word_memo()
        for batch in batches:
            found = [shingle_hashes(folded_words(t), width, memo, CUT) for t in batch["text"]]
            if found:
                yield pd.DataFrame({"gram": np.concatenate(found).view(np.int64)})

    return docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).mapInPandas(low, "gram long")


def _rows(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(doc_id, th, n, fp, head, whole): hash of the text, size, fingerprint and head columns of
    each document's set.

    The head is there if rare columns below CUT fill it; otherwise whole has the entire set.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    @F.pandas_udf("n long, fp binary, head array<long>, whole array<long>")
    def row(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo, common = word_memo(), shared.value
        for batch in batches:
            out = []
            for value in batch:
                h = shingle_hashes(folded_words(value), width, memo)
                n = len(h)
                if not n:
                    out.append((0, None, None, None))
                    continue
                low = h[: np.searchsorted(h, np.uint64(CUT))]
                rare, length = low[~_is_in(low, common)], head_length(n, percent)
                full = len(rare) >= length
                head, whole = (rare[:length].view(np.int64), None) if full else (None, h.view(np.int64))
                out.append((n, xxhash.xxh3_128_digest(h.tobytes()), head, whole))
            yield pd.DataFrame(out, columns=["n", "fp", "head", "whole"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("th"), row(F.col(text)).alias("r"))
    return rows.select("doc_id", "th", "r.*")


def _with_heads(classes: DataFrame, percent: int, frequent: np.ndarray) -> DataFrame:
    """``classes`` with a head for every row, from the frequencies of the remaining columns."""
    spark = classes.sparkSession
    high = classes.where(F.col("whole").isNotNull())

    def above(batches):
        for batch in batches:
            found = [w[np.searchsorted(w, np.uint64(CUT)) :] for w in (np.asarray(x, np.int64).view(np.uint64) for x in batch["whole"])]
            if found:
                yield pd.DataFrame({"gram": np.concatenate(found).view(np.int64)})

    more = _frequent(high.select("whole").mapInPandas(above, "gram long"))
    shared = spark.sparkContext.broadcast(np.sort(np.concatenate([frequent, more])))

    @F.pandas_udf("array<long>")
    def ordered(wholes: pd.Series) -> pd.Series:
        out = []
        for w in wholes:
            if w is None:
                out.append(None)
                continue
            h = np.asarray(w, np.int64).view(np.uint64)
            often = _is_in(h, shared.value)
            out.append(np.concatenate([h[~often], h[often]])[: head_length(len(h), percent)].view(np.int64))
        return pd.Series(out)

    return classes.select("id", "cid", "th", "fp", "n", F.coalesce("head", ordered("whole")).alias("head"))


def _fits(percent: int, a: str, b: str):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _reaches(percent: int, met):
    """Whether the overlap ``met`` plus the longer tail may reach what the sizes ask for."""
    tail = F.greatest(F.col("na") - head_length_column("na", percent), F.col("nb") - head_length_column("nb", percent))
    return (met + tail) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def head_length_column(n: str, percent: int):
    return F.col(n) - F.floor((F.col(n) * percent + 99) / 100) + 1


def _column_entries(classes: DataFrame, percent: int) -> DataFrame:
    """(gram, id, n, m, leads, long): head entries of columns with m > 1 rows.

    leads: the column is among the first n - ceil(2 t n / (1 + t)) + 1 of the row, where the
    row must meet every other of its own size or larger.  long: how many of the row's head
    columns have over LONG_COLUMN rows.
    """
    entries = classes.select("id", "n", F.posexplode("head").alias("at", "gram"))
    # Counted map-side and joined back, so that a column with very many rows is no task's own.
    often = entries.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1")
    met = entries.join(often, "gram")
    leads = F.col("at") < F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent)) + 1
    is_long = F.sum((F.col("m") > LONG_COLUMN).cast("int")).over(Window.partitionBy("id"))
    return cut_lineage(met.select("gram", "id", "n", "m", leads.alias("leads"), is_long.alias("long")))


def _sides(entries: DataFrame, side: str) -> DataFrame:
    names = {"id": side, "n": f"n{side}", "long": f"long{side}"}
    return entries.select("gram", *[F.col(k).alias(v) for k, v in names.items()])


def _short_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b) that may link, from the columns whose pairs are all made."""
    short = entries.where(F.col("m") <= LONG_COLUMN)
    met = _sides(short, "a").join(_sides(short, "b"), "gram").where("a < b").where(_fits(percent, "na", "nb"))
    counted = met.groupBy("a", "b").agg(
        F.count("*").alias("met"), *[F.first(c).alias(c) for c in ("na", "nb", "longa", "longb")]
    )
    return counted.where(_reaches(percent, F.col("met") + F.least("longa", "longb"))).select("a", "b")


def _pivot_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b) of each row of a long column and the pivot of its size band and of the band below."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))
    long = entries.where(F.col("m") > LONG_COLUMN).select("gram", "id", "n", band.alias("band"))
    pivots = long.groupBy("gram", "band").agg(F.min(F.struct("id", "n")).alias("p"))
    pivots = pivots.select("gram", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("p.id").alias("p"), F.col("p.n").alias("np"))
    met = long.join(pivots, ["gram", "band"]).where(F.col("id") != F.col("p")).where(_fits(percent, "n", "np"))
    return met.select(F.least("id", "p").alias("a"), F.greatest("id", "p").alias("b")).distinct()


def _split_columns(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(gram, id, own, m, leads) of long columns that the components ``found`` leave split.

    own is the component of the row.  A column in which no row leads can be left out: two
    rows that link also share a column that leads the smaller.
    """
    long = entries.where(F.col("m") > LONG_COLUMN)
    long = long.join(found, long["id"] == found["node"], "left").withColumn("own", F.coalesce("component", "id"))
    parts = long.groupBy("gram").agg((F.min("own") < F.max("own")).alias("split"), F.max("leads").alias("led"))
    return cut_lineage(long.join(parts.where("split AND led"), "gram").select("gram", "id", "own", "m", "leads"))


def _products(percent: int):
    """The links of one pair of row blocks of a column; see ``_block_links``."""

    def product(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        first = int(key[1])
        rows = [np.asarray(x, np.int64) for x in block["grams"]]
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate(rows)
        columns, where, times = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(rows)), sizes)
        shared = times > 1
        rank = np.cumsum(shared) - 1
        keep = shared[where]
        owner, at = owner[keep], rank[where[keep]]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        overlap = np.zeros((len(rows), len(rows)), np.int64)  # a block's float32 counts are exact
        for low in range(0, int(shared.sum()), COLUMN_BLOCK):
            a, b = np.searchsorted(at, [low, low + COLUMN_BLOCK])
            part = np.zeros((len(rows), COLUMN_BLOCK), np.float32)
            part[owner[a:b], at[a:b] - low] = 1
            overlap += (part @ part.T).astype(np.int64)
        enough = overlap * (100 + percent) >= (sizes[:, None] + sizes[None, :]) * percent
        mine = block["part"].to_numpy() == first
        if key[1] != key[2]:
            enough &= mine[:, None] != mine[None, :]
        ids, own = block["id"].to_numpy(), block["own"].to_numpy()
        enough &= own[:, None] != own[None, :]
        root = {int(c): int(c) for c in set(own)}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        for i, j in np.argwhere(np.triu(enough, 1)):
            x, y = find(int(own[i])), find(int(own[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(ids[i]), int(ids[j])))
        return pd.DataFrame(links, columns=["u", "v"]).astype("int64")

    return product


def _block_links(split: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between different components inside the columns of ``split``.

    The rows of a column are dealt to blocks of about ROW_BLOCK; each pair of blocks is one
    task's work, so a column of any length is spread, and memory is that of two blocks.
    """
    blocks = F.ceil(F.col("m") / ROW_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    rows = split.withColumn("blocks", blocks).withColumn("part", own)
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("gram", "id", "own", "part", others.alias("other"))
    rows = rows.select("gram", "id", "own", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    rows = rows.join(sets, "id")
    return cut_lineage(rows.groupBy("gram", "i", "j").applyInPandas(_products(percent), "u long, v long"))


def _sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(id, grams): the whole rows of the wanted ids, from one of their documents each."""
    needed = cut_lineage(classes.select("id", "cid", "th", "fp").join(ids, "id"))
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # Documents without an id meet their class by the hash of their text, as all others do.
    named = F.col("doc_id").eqNullSafe(F.col("cid")) & (F.xxhash64("text") == F.col("th"))
    texts = texts.join(needed, named).select("id", "fp", "text")

    def whole(batches):
        memo = word_memo()
        for batch in batches:
            out = []
            for i, fp, value in zip(batch["id"], batch["fp"], batch["text"], strict=True):
                h = shingle_hashes(folded_words(value), width, memo)
                if xxhash.xxh3_128_digest(h.tobytes()) == bytes(fp):  # another text may have the same id and hash
                    out.append((i, h.view(np.int64)))
            yield pd.DataFrame(out, columns=["id", "grams"])

    return cut_lineage(texts.mapInPandas(whole, "id long, grams array<long>").dropDuplicates(["id"]))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs whose whole rows overlap enough, by exact row products."""

    @F.pandas_udf("long")
    def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    both = both.withColumn("o", overlap("ga", "gb"))
    enough = F.col("o") * (100 + percent) >= (F.size("ga") + F.size("gb")) * percent
    return cut_lineage(both.where(enough).select(F.col("a").alias("u"), F.col("b").alias("v")))


def ngram_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row for each row of ``docs``.

    A document's set holds its distinct ``width``-word shingles, or the whole word sequence if
    that is shorter.  Two documents link when 100 * overlap >= percent * union.  class_id is
    the smallest id with the same set, component_id the smallest id reachable by links.

    Null or empty text, or text without words: n_shingles 0, linked with nothing, class_id and
    component_id are the own id.  Repeated rows and rows that share an id keep one output row
    each; rows with a null id take part but never name a class, so a component of such rows
    alone has a null component_id.  Other columns are not looked at.  An empty table gives no
    rows.  Sets are compared by 64-bit hashes of their shingles.
    """
    rows = _grouped(docs, doc_id, text, width, percent)
    alone = F.col("n") == 0
    return rows.select(
        F.col("doc_id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """(doc_id, th, n, class_id, component_id, root), one row for each row of ``docs``; root
    names the component and is null, as the ids are, for rows without words."""
    small_batches(docs)
    frequent = _frequent(_low_columns(docs, text, width))
    rows = cut_lineage(_rows(docs, doc_id, text, width, percent, frequent))
    classes = rows.where("n > 0").groupBy("fp").agg(
        F.min("doc_id").alias("cid"),
        F.coalesce(F.min_by("th", "doc_id"), F.min("th")).alias("th"),
        *[F.first(c).alias(c) for c in ("n", "head", "whole")],
    )
    classes = cut_lineage(classes.withColumn("id", F.monotonically_increasing_id()))
    classes = cut_lineage(_with_heads(classes, percent, frequent))

    entries = _column_entries(classes, percent)
    pairs = cut_lineage(_short_pairs(entries, percent).union(_pivot_pairs(entries, percent)).distinct())
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _sets(ids, classes, docs, doc_id, text, width)
    edges = _linked(pairs, sets, percent)
    found = connected_components(edges)
    split = _split_columns(entries, found)
    if not split.isEmpty():
        missing = split.select("id").distinct().join(sets.select("id"), "id", "left_anti")
        sets = sets.union(_sets(missing, classes, docs, doc_id, text, width))
        found = connected_components(edges.union(_block_links(split, sets, percent)))

    names = classes.select("id", "cid", "fp").join(found, F.col("id") == F.col("node"), "left")
    names = names.withColumn("root", F.coalesce("component", "id"))
    smallest = names.groupBy("root").agg(F.min("cid").alias("component_id"))
    names = names.join(smallest, "root").select("fp", F.col("cid").alias("class_id"), "component_id", "root")
    return rows.select("doc_id", "th", "n", "fp").join(names, "fp", "left").drop("fp")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, ids before none,
    then the smallest hash of the text.

    Rows keep all their columns.  Rows that repeat the id and the text of a row that stays go
    too, also where both ids are null or the texts are null or without words; which of them
    stays is not defined.  Texts without words are linked with nothing: each id keeps one.
    """
    groups = cut_lineage(_grouped(docs, doc_id, text, width, percent))
    keys = groups.groupBy("doc_id", "th").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.count("*").alias("times"))
    keys = cut_lineage(keys)
    linked = keys.where("n > 0")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").alias("th"))
    first = linked.groupBy("root").agg(F.min(order).alias("first"))
    own = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th"))
    judged = linked.join(first, "root").select("doc_id", "th", "times", own.alias("own"))
    judged = judged.union(keys.where("n = 0").select("doc_id", "th", "times", F.lit(True)))
    named = F.col("doc_id").alias("_id"), F.col("th").alias("_th")
    marked = cut_lineage(judged.where("NOT own OR times > 1").select(*named, "own"))
    # A few rows of numbers go to all tasks; otherwise the texts of docs are exchanged.
    if marked.count() <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_th"))
    single = docs.join(marked, same, "left_anti")
    repeated = docs.join(marked.where("own"), same, "left_semi").dropDuplicates([doc_id, text])
    return single.unionByName(repeated)
