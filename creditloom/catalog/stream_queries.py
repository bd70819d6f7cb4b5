"""Streaming queries, each checked against its batch equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.fixtures import cte
from creditloom.catalog.name_queries import simple_mapping
from creditloom.catalog.registry import oracle, query
from creditloom.operators import store
from creditloom.plans.ranks import exact_quantiles
from creditloom.session import cut_lineage
from creditloom.streaming import feeds


@query("st_ingest", oracle("SELECT event_id, user_id, event_type, value FROM events", "event_id user_id event_type", "value"))
def _(spark, sf):
    stream = feeds.event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    return feeds.append_to_files(stream, feeds.work_folder(spark, "ingest"))


@query(
    "st_dedup",
    oracle("SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events", "user_id event_type day"),
)
def _(spark, sf):
    stream = feeds.event_stream(spark, sf).withColumn("day", F.col("ts").cast("date"))
    unique = feeds.deduplicated(stream, ["user_id", "event_type", "day"]).select("user_id", "event_type", "day")
    return feeds.append_to_files(unique, feeds.work_folder(spark, "dedup"))


# Arrivals: the events come in three parts of equal size by time; every 50th event of the first
# part is late and only comes with a fourth.
def _part(us: str, first, second) -> str:
    return f"CASE WHEN {us} <= {first} THEN 0 WHEN {us} <= {second} THEN 1 ELSE 2 END"


def _late(part: str) -> str:
    return f"CASE WHEN {part} = 0 AND event_id % 50 = 0 THEN 3 ELSE {part} END"


_CUT = "(SELECT CAST(round(quantile_cont(CAST(epoch_us(ts) AS DOUBLE), {0})) AS BIGINT) FROM events)"
_ARRIVAL = _late(_part("epoch_us(ts)", _CUT.format("0.3"), _CUT.format("0.65")))


def _each_arrival(spark, sf, late, name, run):
    """The result of ``run`` on a stream that gets four arrivals.

    An arrival has as many files as Spark writes.  The stream is started after each of them and
    takes all of it, from where it stopped before.
    """
    folder = feeds.work_folder(spark, f"{name}-arrivals")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("_us", us)
    cuts = exact_quantiles(events.select(F.col("_us").cast("double").alias("t")), "t", [0.3, 0.65]).first()["quantiles"]
    part = _part("_us", *[round(c) for c in cuts])
    placed = events.withColumn("_at", F.expr(_late(part) if late else part))
    for k in range(4):
        placed.where(F.col("_at") == k).drop("_at", "_us").write.mode("append").parquet(folder)
        result = run(feeds.event_stream(spark, folder, pattern="*.parquet"))
    return result


# A late row counts only if its day was still open: its end has to lie behind the watermark,
# a day before the newest event of the earlier arrivals.
cte("arrived", "", f"SELECT *, {_ARRIVAL} AS arrival FROM events")
cte(
    "in_time",
    "arrived",
    "SELECT a.* FROM arrived a JOIN (SELECT k, (SELECT max(ts) FROM arrived WHERE arrival < k) - INTERVAL 1 DAY AS mark FROM range(0, 4) r(k)) w "
    "ON w.k = a.arrival WHERE w.mark IS NULL OR date_trunc('day', a.ts) + INTERVAL 1 DAY > w.mark",
)


def _daily(spark, sf):
    folder = feeds.work_folder(spark, "daily")
    run = lambda stream: feeds.latest_results(feeds.daily_activity(stream), folder, ["user_id", "day"])
    return _each_arrival(spark, sf, True, "daily", run)


query(
    "st_tumbling",
    oracle(
        "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM in_time GROUP BY 1, 2",
        "user_id day n", "total", uses="in_time",
    ),
)(_daily)


def _sliding(spark, sf):
    folder = feeds.work_folder(spark, "sliding")
    return _each_arrival(spark, sf, True, "sliding", lambda stream: feeds.sliding_activity(stream, folder))


query(
    "st_sliding",
    oracle(
        "SELECT user_id, CAST(d - CAST(g AS INT) AS DATE) AS window_start, CAST(sum(n) AS BIGINT) AS n FROM ("
        "SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM in_time GROUP BY 1, 2) x CROSS JOIN range(0, 90) r(g) GROUP BY 1, 2",
        "user_id window_start n", uses="in_time",
    ),
)(_sliding)


@query(
    "st_session",
    oracle(
        "SELECT * FROM (SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS end_us, count(*) AS n FROM ("
        "SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM ("
        "SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh FROM events) a) b GROUP BY user_id, session) s "
        "WHERE end_us <= (SELECT epoch_us(max(ts)) - 86400000000 FROM events)",
        "user_id start_us end_us n",
    ),
)
def _(spark, sf):
    """Sessions that the watermark has closed; their state is gone and each is written once."""
    folder = feeds.work_folder(spark, "session")

    def run(stream):
        closed = feeds.sessions(stream).select(
            "user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"), "n"
        )
        return feeds.append_to_files(closed, folder)

    return _each_arrival(spark, sf, False, "session", run)


GAP_HOURS = 24


@query(
    "st_quiet_gaps",
    oracle(
        "SELECT user_id, start_us, CASE WHEN next_us <= mark THEN next_us END AS end_us FROM ("
        "SELECT user_id, epoch_us(ts) AS start_us, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS next_us, "
        "(SELECT max(epoch_us(ts)) // 1000 - 86400000 FROM events) * 1000 - 1 AS mark FROM events) g "
        f"WHERE start_us <= mark AND CASE WHEN next_us <= mark THEN next_us - start_us >= {GAP_HOURS} * 3600000000 "
        f"ELSE start_us // 1000 + {GAP_HOURS} * 3600000 < mark // 1000 + 1 END",
        "user_id start_us end_us",
    ),
)
def _(spark, sf):
    """Gaps of a day or more as far as the watermark, after four arrivals and three restarts."""
    folder = feeds.work_folder(spark, "gaps")
    return _each_arrival(spark, sf, False, "gaps", lambda stream: feeds.quiet_gaps(stream, folder, GAP_HOURS * 3_600_000))


@query(
    "st_enrich",
    oracle(
        "SELECT o.o_orderkey, i.merchant_name, m.normalised AS canonical FROM orders o "
        "JOIN (SELECT DISTINCT o_orderkey, concat('PAYER ', o_orderkey % 12, CASE WHEN o_orderkey % 2 = 0 THEN ' LTD' ELSE '' END) AS merchant_name FROM orders) i "
        "ON i.o_orderkey = o.o_orderkey JOIN normed m ON m.raw = i.merchant_name",
        "o_orderkey merchant_name canonical", uses="normed",
    ),
)
def _(spark, sf):
    number = (F.col("o_orderkey") % 12).cast("string")
    suffix = F.when(F.col("o_orderkey") % 2 == 0, " LTD").otherwise("")
    stream = feeds.event_stream(spark, sf, feeds.ORDER_DDL, "orders.parquet").select(
        "o_orderkey", F.concat(F.lit("PAYER "), number, suffix).alias("merchant_name")
    )
    mapping = cut_lineage(simple_mapping(spark, sf))
    return feeds.append_to_files(feeds.enriched(stream, mapping), feeds.work_folder(spark, "enrich"))


@query(
    "st_upsert_store",
    oracle(
        "SELECT user_id AS company_id, CAST(ts AS DATE) AS feature_date, arg_max(value, ts) AS value FROM events GROUP BY 1, 2",
        "company_id feature_date", "value",
    ),
)
def _(spark, sf):
    folder = feeds.work_folder(spark, "upsert")
    writes = feeds.event_stream(spark, sf).select(
        F.col("user_id").cast("string").alias("company_id"),
        F.col("ts").cast("date").alias("feature_date"),
        F.to_json(F.struct("value")).alias("features_json"),
        F.col("ts").alias("created_at"),
    )
    feeds.upsert_stream(writes, f"{folder}/store", folder)
    stored = store.read_store(spark, f"{folder}/store").drop("created_at")
    return store.decode_json(stored, ["value"]).withColumn("company_id", F.col("company_id").cast("bigint"))
