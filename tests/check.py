"""Run registered queries beside their DuckDB texts and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, key, sf_dir, queries, oracles):
    df = queries[key](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if key not in oracles:
        return f"rows only: {len(got)}" if got else "EMPTY"
    result = con.execute(oracles[key])
    columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} vs {sorted(columns)}"
    a, b = canonical_rows(df.columns, got), canonical_rows(columns, want)
    if a == b:
        return f"ok {len(a)}" if a else "EMPTY but equal"
    only_a = [x for x in a if x not in set(b)][:3]
    only_b = [x for x in b if x not in set(a)][:3]
    return f"DIFFER {len(a)} vs {len(b)}\n   spark {only_a}\n   duck  {only_b}"


def main():
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from creditloom.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for key in queries:
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, key, sf_dir, queries, oracles)
        except Exception as e:  # report and go on
            verdict = "ERROR " + str(e).split("JVM stacktrace")[0][:700]
        print(f"{key:32s} {time.time() - start:6.1f}s {verdict}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
