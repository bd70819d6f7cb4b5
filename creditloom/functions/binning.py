"""Bucket expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges_at_or_below(value: Column, edges) -> Column:
    """Number of edges <= value: bins are [lo, hi)."""
    return sum((F.when(value >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))


def edges_below(value: Column, edges) -> Column:
    """Number of edges < value: bins are (lo, hi]."""
    return sum((F.when(value > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))


def unit_edges(n_bins: int) -> list[float]:
    """Inner edges of n equal bins over 0..1 as plain double multiples of the width."""
    return [i * (1.0 / n_bins) for i in range(1, n_bins)]


def searched_bucket(value: Column, bounds: Column, n_bounds: int) -> Column:
    """Number of entries of the sorted array ``bounds`` that are <= value (binary search)."""
    steps, step = [], 1
    while step <= n_bounds:
        steps.append(step)
        step *= 2
    hops = F.array(*[F.lit(s) for s in reversed(steps)])
    return F.aggregate(
        hops,
        F.lit(0),
        lambda at, hop: F.when(
            (at + hop <= F.size(bounds)) & (F.get(bounds, at + hop - 1) <= value), at + hop
        ).otherwise(at),
    )


def money_bucket(amount: Column) -> Column:
    """Monotone bucket of a money amount: one per cent wide steps below and above zero.

    The number of buckets is bounded by the range of DECIMAL(18,2), whatever the data.
    """
    size = F.floor(F.log1p(F.abs(amount).cast("double")) * 64)
    return F.when(amount < 0, -size - 1).otherwise(size)
