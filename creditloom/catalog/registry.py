"""Registry of runnable queries and the DuckDB texts that check them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.catalog.fixtures import CTES

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
# Means of cents are often exactly half-way at the last digit, where the two engines may
# round apart; this shift, far below the last digit, moves them off the tie on both sides.
OFF_TIE = "3e-8"


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: decimals become doubles, doubles are rounded, no negative zero."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = (F.round(column.cast("double") + F.lit(float(OFF_TIE)), DIGITS) + F.lit(0.0)).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(name: str, oracle: str | None = None):
    def register(function):
        assert name not in QUERIES, name

        def run(spark, sf_dir):
            # Day windows of the streams are cut in the session time zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(function(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _needed(names, seen):
    for name in names:
        if name not in seen:
            _needed(CTES[name][1], seen)
            seen.append(name)
    return seen


def _once(name: str, sql: str) -> str:
    """Common tables are evaluated once, except recursive ones."""
    return "" if re.search(rf"\b{name}\b", sql) else "MATERIALIZED "


def oracle(body: str, keys: str = "", doubles: str = "", uses: str = "", extra=()) -> str:
    """DuckDB text: the needed common tables, then ``body``, then rounded output columns."""
    tables = [(n, CTES[n][0]) for n in _needed(uses.split(), [])] + list(extra)
    parts = [f"{n} AS {_once(n, sql)}(\n{sql}\n)" for n, sql in tables]
    parts.append(f"result AS (\n{body}\n)")
    columns = [k for k in keys.split()]
    columns += [f"round(CAST({d} AS DOUBLE) + {OFF_TIE}, {DIGITS}) + 0.0 AS {d}" for d in doubles.split()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\nSELECT " + ", ".join(columns) + " FROM result"
