"""Mix a corpus to target shares of sources, languages and topics, with DataFrame functions only.

Iterative proportional fitting rakes the token totals of the cells (source, language, topic)
to the three marginals.  A cell's weight is the product of one factor for each of its three
values, so only three small factor tables change from cycle to cycle; the cells are written
once.  Documents are then sampled by the weight of their cell, scaled to a declared size: cells
that would be wanted more than once are kept whole and the rest is raked to what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.session import cut_lineage

AXES = ("source", "lang", "topic")
# Share of an axis value in the target: its token share to this power, brought to a sum of 1.
TEMPERING = {"source": 0.7, "lang": 0.7, "topic": 0.8}
MISSING = "(none)"
CYCLES = 20
# Share of the tokens that a sample is meant to hold.
KEEP = 0.5
TOLERANCE = 1e-10


def n_tokens(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic by fixed rules on the text; the first that holds counts."""
    value = F.coalesce(text, F.lit(""))
    return (
        F.when(value.rlike(r"[Ll]icen[sc]e|[Rr]ights reserved"), "legal")
        .when(F.contains(value, F.lit("@")) | F.contains(value, F.lit("+1 (")), "contact")
        .when(value.rlike(r"[0-9]{6}"), "records")
        .when(value.rlike(r"[#*$%&|<>]{2}"), "markup")
        .when(F.contains(value, F.lit("!!")), "shouting")
        .otherwise("prose")
    )


def tempered_targets(cells: DataFrame, axis: str, power: float) -> DataFrame:
    """(axis, target): token shares of the values of an axis, flattened by ``power``."""
    totals = cells.groupBy(axis).agg(F.sum("tokens").alias("t")).where("t > 0")
    total = totals.agg(F.sum(F.pow("t", F.lit(power)))).first()[0]
    return totals.select(axis, (F.pow("t", F.lit(power)) / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], cycles: int = CYCLES, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (axes, tokens) with the column factor.

    After fitting, sum(tokens * factor) over the cells of an axis value is its target share,
    for every axis, as nearly as ``cycles`` cycles bring it; they end sooner once a cycle moves
    no factor of the last axis by over ``tolerance`` (relative).  A cycle sets the factors of
    each axis in turn to target over current sum, so the last axis always fits exactly.  Values
    without a target get factor 0.  Targets that exclude each other have no joint solution.
    """
    axes = list(targets)
    base = cut_lineage(cells.where("tokens > 0"))
    factors = {a: cut_lineage(targets[a].select(a, "target", F.lit(1.0).alias(f"f_{a}"))) for a in axes}
    for _ in range(cycles):
        for a in axes:
            weighted, weight = base, F.col("tokens").cast("double")
            for b in axes:
                if b != a:
                    weighted = weighted.join(factors[b].select(b, f"f_{b}"), b)
                    weight = weight * F.col(f"f_{b}")
            sums = weighted.groupBy(a).agg(F.sum(weight).alias("_sum"))
            moved = factors[a].withColumnRenamed(f"f_{a}", "_old").join(sums, a, "left")
            fresh = F.when(F.col("_sum") > 0, F.col("target") / F.col("_sum")).otherwise(F.lit(0.0))
            factors[a] = cut_lineage(moved.select(a, "target", "_old", fresh.alias(f"f_{a}")))
        last, old = F.col(f"f_{axes[-1]}"), F.col("_old")
        gap = factors[axes[-1]].where(last > 0).agg(F.max(F.abs(old / last - 1))).first()[0] or 0.0
        if gap < tolerance:
            break
        factors = {a: f.drop("_old") for a, f in factors.items()}
    out = base
    for a in axes:
        out = out.join(factors[a].select(a, f"f_{a}"), a, "left")
    product = F.lit(1.0)
    for a in axes:
        product = product * F.coalesce(F.col(f"f_{a}"), F.lit(0.0))
    return out.select(*cells.columns, product.alias("factor"))


def size_targets(cells: DataFrame, targets: dict[str, DataFrame], size: float) -> dict[str, DataFrame]:
    """(axis, target, whole) for each axis: tokens wanted of every value, ``size`` in all.

    A value with fewer tokens than its share of ``size`` is kept whole, and what it lacks is
    dealt to the others by their shares.
    """
    out = {}
    for a, shares in targets.items():
        totals = cells.groupBy(a).agg(F.sum("tokens").alias("_t"))
        rows = cut_lineage(shares.join(totals, a).select(a, F.col("target").alias("_share"), "_t"))
        least, scale = -1, size
        while True:
            whole = F.col("_share") * scale >= F.col("_t")
            n, taken, free = rows.agg(
                F.sum(whole.cast("long")), F.sum(F.when(whole, F.col("_t")).otherwise(F.lit(0))), F.sum(F.when(~whole, F.col("_share")))
            ).first()
            if n == least or not free:
                break
            least, scale = n, (size - taken) / free
        target = F.when(whole, F.col("_t").cast("double")).otherwise(F.col("_share") * scale)
        out[a] = cut_lineage(rows.select(a, target.alias("target"), whole.alias("whole")))
    return out


def rake_to_size(
    cells: DataFrame, targets: dict[str, DataFrame], size: float, cycles: int = CYCLES, tolerance: float = TOLERANCE
) -> DataFrame:
    """``cells`` (axes, tokens) with the column probability, in (0, 1].

    A cell's probability is the product of its three factors, at most 1, and 1 in the values
    that ``size_targets`` keeps whole.  After fitting, sum(tokens * probability) over the cells
    of an axis value is its target, as nearly as ``cycles`` cycles bring it.  A step takes the
    cells that are whole by now off the target and rakes the others to what is left; where they
    alone are over the target, or all are whole, the factor follows target over current sum.
    The weights of the cells are written anew in each step, which keeps its plan to two joins.
    """
    axes = list(targets)
    base = cells.where("tokens > 0")
    wanted = size_targets(base, targets, size)
    for a in axes:
        base = base.join(wanted[a].select(a, F.col("whole").alias(f"_{a}")), a)
    whole = F.lit(False)
    for a in axes:
        whole = whole | F.col(f"_{a}")
    now = cut_lineage(base.select(*cells.columns, whole.alias("_whole"), F.lit(1.0).alias("_weight")))
    p = F.when(F.col("_whole"), F.lit(1.0)).otherwise(F.least(F.col("_weight"), F.lit(1.0)))
    kept, part = F.when(p >= 1, F.col("tokens")).otherwise(F.lit(0)), F.when(p < 1, F.col("tokens") * p).otherwise(F.lit(0.0))
    for _ in range(cycles):
        for a in axes:
            sums = now.groupBy(a).agg(F.sum(kept).cast("double").alias("_kept"), F.sum(part).alias("_part"))
            left = F.col("target") - F.col("_kept")
            step = F.when((left > 0) & (F.col("_part") > 0), left / F.col("_part")).otherwise(F.col("target") / (F.col("_kept") + F.col("_part")))
            steps = sums.join(wanted[a], a).select(a, step.alias("_step"))
            now = cut_lineage(now.drop("_step").join(steps, a).select(*cells.columns, "_whole", (F.col("_weight") * F.col("_step")).alias("_weight"), "_step"))
        gap = now.agg(F.max(F.abs(1 / F.col("_step") - 1))).first()[0] or 0.0
        if gap < tolerance:
            break
    return now.select(*cells.columns, p.alias("probability"))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.conv(F.substr(F.md5(doc_id.cast("string").cast("binary")), F.lit(1), F.lit(12)), 16, 10).cast("double") / float(16**12)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    tempering: dict[str, float] | None = None,
    cycles: int = CYCLES,
    keep: float | None = KEEP,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, lang, topic, n_tokens, factor,
    probability, sampled.

    The tokens of the cells are raked to tempered marginals.  The sample is expected to hold the
    share ``keep`` of all tokens: probability is at most 1, cells that reach it are kept whole
    and the others are raked to the rest, so that rare cells get what they have and do not set
    the rate of the others.  A value with fewer tokens than its share is kept whole; see
    ``marginals`` for the shares that were reached.  factor is probability over the expected
    tokens.  With ``keep`` None, probability is the factor over the largest factor, so that the
    rarest cell sets the size.  sampled compares probability with a number made from the id.
    Null sources and languages form a value of their own, ``(none)``; null
    or empty texts have no tokens, factor and probability 0 and are not sampled; rows with a
    null id are not sampled; repeated rows count and are sampled alike; an empty table gives no
    rows; other columns are not looked at.
    """
    tempering = tempering or TEMPERING
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(source), F.lit(MISSING)).alias("source"),
        F.coalesce(F.col(lang), F.lit(MISSING)).alias("lang"),
        topic(F.col(text)).alias("topic"),
        n_tokens(F.col(text)).alias("n_tokens"),
    )
    rows = cut_lineage(rows)
    cells = cut_lineage(rows.groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens")))
    targets = {a: tempered_targets(cells, a, tempering[a]) for a in AXES}
    if keep is None:
        raked = cut_lineage(rake(cells, targets, cycles))
        most = raked.agg(F.max("factor")).first()[0]
        raked = raked.select(*AXES, "factor", (F.col("factor") / F.lit(most)).alias("probability"))
    else:
        size = keep * (cells.agg(F.sum("tokens")).first()[0] or 0)
        raked = cut_lineage(rake_to_size(cells, targets, size, cycles))
        wanted = raked.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0]
        raked = raked.select(*AXES, (F.col("probability") / F.lit(wanted)).alias("factor"), "probability")
    out = rows.join(raked, list(AXES), "left")
    p = F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(F.lit(0.0))
    f = F.when(F.col("n_tokens") > 0, F.coalesce("factor", F.lit(0.0))).otherwise(F.lit(0.0))
    out = out.select("doc_id", *AXES, "n_tokens", f.alias("factor"), p.alias("probability"))
    sampled = F.coalesce(uniform(F.col("doc_id")) < F.col("probability"), F.lit(False))
    return out.withColumn("sampled", sampled)


def marginals(mixed: DataFrame, tempering: dict[str, float] | None = None) -> DataFrame:
    """(axis, value, tokens, target, reached) of what ``mix`` returns: the tempered share of each
    value and its share of the expected sampled tokens."""
    tempering = tempering or TEMPERING
    out = None
    for a in AXES:
        sums = mixed.groupBy(a).agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("_p"))
        sums = sums.where("tokens > 0")
        flat = F.pow("tokens", F.lit(tempering[a]))
        total, wanted = sums.agg(F.sum(flat), F.sum("_p")).first()
        rows = sums.select(
            F.lit(a).alias("axis"), F.col(a).alias("value"), "tokens", (flat / F.lit(total)).alias("target"), (F.col("_p") / F.lit(wanted)).alias("reached")
        )
        out = rows if out is None else out.union(rows)
    return out


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability to five digits, sampled) of ``mix``, as in
    the SQL text: by the factor over the largest factor."""
    return mix(docs, keep=None).select("doc_id", *AXES, "n_tokens", F.round("probability", 5).alias("probability"), "sampled")


def oracle(cycles: int = CYCLES) -> str:
    """DuckDB text for ``digest``: the cycles of raking one after another."""
    parts = [
        f"""rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '{MISSING}') AS source, coalesce(lang, '{MISSING}') AS lang,
    CASE WHEN regexp_matches(t, '[Ll]icen[sc]e|[Rr]ights reserved') THEN 'legal'
      WHEN contains(t, '@') OR contains(t, '+1 (') THEN 'contact'
      WHEN regexp_matches(t, '[0-9]{{6}}') THEN 'records'
      WHEN regexp_matches(t, '[#*$%&|<>]{{2}}') THEN 'markup'
      WHEN contains(t, '!!') THEN 'shouting' ELSE 'prose' END AS topic,
    len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0)",
    ]
    for a in AXES:
        parts.append(
            f"{a}_0 AS MATERIALIZED (SELECT {a}, pow(t, {TEMPERING[a]}) / sum(pow(t, {TEMPERING[a]})) OVER () AS target, 1.0::DOUBLE AS f "
            f"FROM (SELECT {a}, sum(tokens) AS t FROM cells GROUP BY 1))"
        )
    now = dict.fromkeys(AXES, 0)
    for k in range(1, cycles + 1):
        for a in AXES:
            b, c = (x for x in AXES if x != a)
            parts.append(
                f"{a}_{k} AS MATERIALIZED (SELECT {a}, any_value(x.target) AS target, any_value(x.target) / sum(tokens * y.f * z.f) AS f FROM cells "
                f"JOIN {a}_{now[a]} x USING ({a}) JOIN {b}_{now[b]} y USING ({b}) JOIN {c}_{now[c]} z USING ({c}) GROUP BY {a})"
            )
            now[a] = k
    joins = " ".join(f"LEFT JOIN {a}_{cycles} {n} USING ({a})" for a, n in zip(AXES, "xyz", strict=True))
    parts.append(f"raked AS MATERIALIZED (SELECT cells.*, x.f * y.f * z.f AS factor FROM cells {joins})")
    parts.append(
        "found AS (SELECT doc_id, rows.source, rows.lang, rows.topic, n_tokens, CASE WHEN n_tokens > 0 THEN factor / (SELECT max(factor) FROM raked) ELSE 0 END AS p "
        "FROM rows LEFT JOIN raked ON rows.source = raked.source AND rows.lang = raked.lang AND rows.topic = raked.topic)"
    )
    return (
        "WITH " + ",\n".join(parts) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(p, 5) AS probability, "
        "coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT / 281474976710656.0 < p, false) AS sampled FROM found"
    )
