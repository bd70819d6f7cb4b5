"""Order statistics that never sort a whole table or a whole hot group in one task.

Rows are first reduced to distinct values with counts (map-side combined), then cut into
ordered buckets.  Only the bucket totals are accumulated across buckets; values are sorted
inside their bucket.  Every result is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.binning import searched_bucket

N_BUCKETS = 512
BUCKET = "_bucket"
# Relative rank error of the approximate quantiles that close in on a rank of a column.
NEAR = 1.0 / (10 * N_BUCKETS)


def add_bucket(df: DataFrame, value: str, groups=(), bucket: Column | None = None) -> DataFrame:
    """Add an ordered bucket number.

    With ``bucket`` given (a monotone expression of the value) nothing is read.  Otherwise
    the cut points are approximate quantiles of the values in ``df``; the approximation
    only affects how even the buckets are.  There is one array of ``N_BUCKETS`` cut points for
    each group; whether it is broadcast is left to its size.
    """
    if bucket is not None:
        return df.withColumn(BUCKET, bucket)
    probabilities = [i / N_BUCKETS for i in range(1, N_BUCKETS)]
    cuts = F.percentile_approx(F.col(value), probabilities, 10 * N_BUCKETS)
    if groups:
        bounds = df.groupBy(*groups).agg(cuts.alias("_bounds"))
        joined = df.join(bounds, list(groups))
    else:
        joined = df.withColumn("_bounds", df.agg(cuts.alias("_bounds")).scalar())
    return joined.withColumn(
        BUCKET, searched_bucket(F.col(value), F.col("_bounds"), N_BUCKETS - 1)
    ).drop("_bounds")


def _in_order(groups, columns) -> "Window":
    window = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    return window.orderBy(*columns)


def running_totals(
    df: DataFrame, value: str, measures, groups=(), bucket: Column | None = None, previous: bool = False
) -> DataFrame:
    """Prefix sums over distinct ordered values.

    ``df`` holds one row per (groups, value).  For each measure m the result has ``cum_m``
    (sum up to and including the value) and ``all_m`` (group total); with ``previous`` also
    ``prev_m``, the measure at the next lower value (null at the lowest).
    """
    groups, measures = list(groups), list(measures)
    keys = groups + [BUCKET]
    rows = add_bucket(df, value, groups, bucket)
    totals = [F.sum(m).alias(f"_sum_{m}") for m in measures]
    if previous:
        totals.append(F.max_by(F.struct(*measures), F.col(value)).alias("_last"))
    per_bucket = rows.groupBy(*keys).agg(*totals)
    order = _in_order(groups, [BUCKET])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = [F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures]
    offsets += [F.sum(f"_sum_{m}").over(whole).alias(f"all_{m}") for m in measures]
    if previous:
        offsets.append(F.lag("_last").over(order).alias("_carry"))
    per_bucket = per_bucket.select(*keys, *offsets)
    inside = Window.partitionBy(*keys).orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(per_bucket, keys)
    columns = [F.col(c) for c in df.columns]
    columns += [(F.col(f"_before_{m}") + F.sum(m).over(upto)).alias(f"cum_{m}") for m in measures]
    columns += [F.col(f"all_{m}") for m in measures]
    if previous:
        columns += [
            F.coalesce(F.lag(m).over(inside), F.col("_carry")[m]).alias(f"prev_{m}") for m in measures
        ]
    return joined.select(*columns)


def exact_quantiles(
    df: DataFrame, value: str, probabilities, groups=(), bucket: Column | None = None, name: str = "quantiles"
) -> DataFrame:
    """Exact, linearly interpolated quantiles for each group as one array column.

    Only the buckets that hold a wanted rank are looked at value by value.
    """
    groups, probabilities = list(groups), list(probabilities)
    keys = groups + [BUCKET]
    rows = df.where(F.col(value).isNotNull())
    if bucket is None:
        counts = add_bucket(rows.groupBy(*groups, value).agg(F.count("*").alias("_n")), value, groups)
    else:
        # Counted with the bucket as a key, so rows that stand by it are not exchanged again.
        counts = add_bucket(rows, value, groups, bucket).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    order = _in_order(groups, [BUCKET])
    per_bucket = counts.groupBy(*keys).agg(F.sum("_n").alias("_size")).select(
        *keys,
        "_size",
        F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_size").over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("_total"),
    )

    def rank(p: float, rounding) -> Column:
        return rounding(F.lit(p) * (F.col("_total") - 1))

    wanted = [rank(p, r) for p in probabilities for r in (F.floor, F.ceil)]
    holds = F.lit(False)
    for r in wanted:
        holds = holds | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")))
    picked = counts.join(per_bucket.where(holds), keys)
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    picked = picked.withColumn("_cum", F.col("_before") + F.sum("_n").over(upto))
    aggregates = [F.first("_total").alias("_total")]
    aggregates += [
        F.min(F.when(F.col("_cum") > r, F.col(value).cast("double"))).alias(f"_v{i}") for i, r in enumerate(wanted)
    ]
    found = picked.groupBy(*groups).agg(*aggregates) if groups else picked.agg(*aggregates)
    values = []
    for i, p in enumerate(probabilities):
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        values.append(low + (F.lit(p) * (F.col("_total") - 1) - rank(p, F.floor)) * (high - low))
    return found.select(*groups, F.array(*values).alias(name))


def column_quantiles(df: DataFrame, columns, probabilities) -> dict[str, list[float]]:
    """Exact, linearly interpolated quantiles of several columns of a table that is cheap to read again.

    Approximate quantiles close in on each wanted rank, counts below them give its place, and only
    the values in between are exchanged.  Where they do not hold the rank, as may be in short
    columns, the column is ranked as a whole.  Columns without a value are left out.
    """
    columns, probabilities = list(columns), list(probabilities)
    if not columns:
        return {}
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sides = [min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2 * NEAR, 2 * NEAR)]
    near = df.agg(*[F.percentile_approx(c, sides, round(1 / NEAR)).alias(c) for c in columns]).first()
    between = {
        (c, j): (near[c][2 * j], near[c][2 * j + 1]) for c in columns if near[c] for j in range(len(probabilities))
    }
    if not between:
        return {}
    slots = list(between)
    inside = lambda s: F.col(s[0]).between(*[F.lit(v) for v in between[s]])
    sizes = [F.count(c).alias(f"n_{c}") for c in columns]
    sizes += [F.count_if(F.col(s[0]) < F.lit(between[s][0])).alias(f"b{i}") for i, s in enumerate(slots)]
    sizes += [F.count_if(inside(s)).alias(f"i{i}") for i, s in enumerate(slots)]
    size = df.agg(*sizes).first()
    place = {s: probabilities[s[1]] * (size[f"n_{s[0]}"] - 1) for s in slots}
    held = {
        s: size[f"b{i}"] <= math.floor(place[s]) and math.ceil(place[s]) < size[f"b{i}"] + size[f"i{i}"] for i, s in enumerate(slots)
    }
    short = {s[0] for s in slots if not held[s]}
    taken = [(i, s) for i, s in enumerate(slots) if s[0] not in short]
    found: dict[str, list[float]] = {}
    if taken:
        cells = [F.when(inside(s), F.struct(F.lit(i).alias("slot"), F.col(s[0]).alias("value"))) for i, s in taken]
        kept = df.select(F.explode(F.array(*cells)).alias("_c")).where("_c IS NOT NULL")
        counts = kept.groupBy("_c.slot", "_c.value").agg(F.count("*").alias("_n"))
        upto = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        wanted = df.sparkSession.createDataFrame(
            [(i, *[r(place[s]) - size[f"b{i}"] for r in (math.floor, math.ceil)]) for i, s in taken], "slot INT, low BIGINT, high BIGINT"
        )
        ranked = counts.withColumn("_cum", F.sum("_n").over(upto)).join(F.broadcast(wanted), "slot")
        at = ranked.groupBy("slot").agg(*[F.min(F.when(F.col("_cum") > F.col(r), F.col("value"))).alias(r) for r in ("low", "high")])
        values = {r["slot"]: (r["low"], r["high"]) for r in at.collect()}
        for i, s in taken:
            low, high = values[i]
            found.setdefault(s[0], []).append(low + (place[s] - math.floor(place[s])) * (high - low))
    if short:
        long = df.select(*sorted(short)).unpivot([], sorted(short), "feature", "value")
        ranked = exact_quantiles(long, "value", probabilities, ["feature"], name="q")
        found |= {r["feature"]: list(r["q"]) for r in ranked.collect()}
    return found


def row_positions(df: DataFrame, order, bucket_columns, groups=(), name: str = "position") -> DataFrame:
    """1-based row number in ``order`` for each group, numbered bucket by bucket.

    ``bucket_columns`` must be a prefix-compatible coarsening of ``order`` (sorting by them
    never contradicts it) that keeps single buckets small.
    """
    groups, bucket_columns = list(groups), list(bucket_columns)
    keys = groups + bucket_columns
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    order_of_buckets = _in_order(groups, bucket_columns)
    sizes = sizes.select(
        *keys,
        F.coalesce(
            F.sum("_size").over(order_of_buckets.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum("_size")
        .over(order_of_buckets.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias(f"{name}_total"),
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("_local", local)
        .join(sizes, keys)
        .withColumn(name, F.col("_before") + F.col("_local"))
        .drop("_before", "_local")
    )
