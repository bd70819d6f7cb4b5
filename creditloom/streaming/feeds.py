"""Structured Streaming forms of the feed operators.

Streams run with ``availableNow``: they take what has arrived, keep their progress and state
in the shared folder, and can be started again for the next arrivals.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from creditloom.operators.store import upsert
from creditloom.session import shared_folder

EVENT_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDER_DDL = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"


def event_stream(
    spark: SparkSession, folder: str, ddl: str = EVENT_DDL, pattern: str = "events.parquet", files_at_once: int | None = None
) -> DataFrame:
    """Typed stream scan; a watermark needs a zoned timestamp, so ``ts`` is cast.

    ``files_at_once`` bounds the files of a micro-batch, oldest first.
    """
    reader = spark.readStream.schema(ddl).option("pathGlobFilter", pattern)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    stream = reader.parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in stream.columns else stream


def append_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Run an append stream into parquet files and read them back."""
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", f"{folder}/data").option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


def latest_results(stream: DataFrame, folder: str, keys) -> DataFrame:
    """Run an aggregation and return the newest row for each key.

    Every micro-batch writes its changed rows under its own number, so replaying a batch
    overwrites the same files.  Open windows are included, which append mode would hold back.
    """
    spark = stream.sparkSession

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/data/batch={number}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.option("basePath", f"{folder}/data").parquet(f"{folder}/data")
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*")


def deduplicated(stream: DataFrame, keys, delay: str = "2 days") -> DataFrame:
    """Each key once; repeats within the watermark are dropped."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def daily_activity(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Tumbling day counts and sums for each company; later rows than the watermark are dropped."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy("user_id", F.window("ts", "1 day").alias("w"))
        .agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
        .select("user_id", F.col("w.start").cast("date").alias("day"), "n", "total")
    )


DAY_MS = 86_400_000
RUNS = "ARRAY<STRUCT<first: INT, last: INT, n: BIGINT>>"


def _partial_days(batches):
    """(user_id, ts, day, n) of the rows that a task has: one for each company and day of a batch."""
    for rows in batches:
        rows = rows[rows["user_id"].notna() & rows["ts"].notna()]
        days = rows.assign(day=rows["ts"].values.astype("datetime64[D]").astype("int32"))
        yield days.groupby(["user_id", "day"], as_index=False).agg(ts=("ts", "max"), n=("ts", "size"))[["user_id", "ts", "day", "n"]]


def _runs(base: int, changes: dict[int, int]) -> list[tuple[int, int, int]]:
    """(first, last, n) of the window starts between changes, with a count above zero."""
    out, n, at = [], base, None
    for day in sorted(changes):
        if n and at is not None:
            out.append((at, day - 1, n))
        n, at = n + changes[day], day
    return out


def _slide(days: int):
    """State of a company: how the count of a window changes from one start day to the next.

    A day with n events adds n at the first window that holds it and takes n away ``days``
    later, two entries instead of one for each window.  Windows whose days are all closed by the
    watermark go out for the last time and leave the state, so it holds ``days`` days and the delay.
    """

    def run(key, batches, state):
        mark = state.getCurrentWatermarkMs()
        base, starts, steps = state.get if state.exists else (0, [], [])
        changes = dict(zip(starts, steps, strict=True))
        for rows in batches:
            for day, n in rows.loc[(rows["day"].astype("int64") + 1) * DAY_MS > mark, ["day", "n"]].itertuples(index=False):
                changes[day - days + 1] = changes.get(day - days + 1, 0) + int(n)
                changes[day + 1] = changes.get(day + 1, 0) - int(n)
        runs = _runs(base, changes)
        if runs:
            yield pd.DataFrame({"user_id": [key[0]], "first": [runs[0][0]], "runs": [[dict(zip(("first", "last", "n"), r)) for r in runs]]})
        closed = mark // DAY_MS - days  # the last start whose days are all closed
        past = [d for d in changes if d <= closed]
        base += sum(changes.pop(d) for d in past)
        if base and past:  # the count goes on from the first start that is still open
            changes[closed + 1] = changes.get(closed + 1, 0) + base
            base = 0
        state.update((base, sorted(changes), [changes[d] for d in sorted(changes)]))

    return run


def sliding_activity(stream: DataFrame, folder: str, days: int = 90, delay: str = "1 day") -> DataFrame:
    """(user_id, window_start, n): events in every ``days``-long window with a one-day hop.

    The counts come out of the stream as runs of equal windows: each micro-batch writes, for the
    companies that it touches, the runs that are not closed yet, and what a company wrote earlier
    stands for the starts before its next first one.  Open windows are included.  Rows whose day
    the watermark has closed are dropped, as in :func:`daily_activity`.  Tasks count by company
    and day before anything is exchanged, so a hot company has a row for each task and day.
    """
    spark = stream.sparkSession
    partial = stream.select("user_id", "ts").mapInPandas(_partial_days, "user_id BIGINT, ts TIMESTAMP, day INT, n BIGINT")
    states = (
        partial.withWatermark("ts", delay).groupBy("user_id").applyInPandasWithState(
            _slide(days), f"user_id BIGINT, first INT, runs {RUNS}", "base BIGINT, starts ARRAY<INT>, steps ARRAY<BIGINT>",
            "update", GroupStateTimeout.NoTimeout,
        )
    )

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/data/batch={number}")

    query = (
        states.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.option("basePath", f"{folder}/data").schema(f"user_id BIGINT, first INT, runs {RUNS}, batch INT").parquet(f"{folder}/data")
    later = Window.partitionBy("user_id").orderBy("batch").rowsBetween(1, Window.unboundedFollowing)
    runs = rows.withColumn("until", F.min("first").over(later)).select("user_id", "until", F.inline("runs"))
    runs = runs.withColumn("last", F.least("last", F.col("until") - 1)).where("first <= last")
    return runs.select("user_id", F.explode(F.sequence("first", "last")).alias("day"), "n").select(
        "user_id", F.date_from_unix_date("day").alias("window_start"), "n"
    )


def sessions(stream: DataFrame, gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    return (
        stream.withWatermark("ts", delay)
        .groupBy("user_id", F.session_window("ts", gap).alias("w"))
        .agg(F.count("*").alias("n"))
        .select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
    )


def _partial_times(gap_ms: int):
    """(user_id, ts, first, last) of a task's rows: one for each company and span of ``gap_ms``.

    Events in one span are less than a gap apart, so only its first and last one matter.
    """

    def partial(batches):
        for rows in batches:
            rows = rows[rows["user_id"].notna() & rows["ts"].notna()]
            us = rows["ts"].values.astype("datetime64[us]").astype("int64")
            spans = rows.assign(us=us, span=us // (1000 * gap_ms)).groupby(["user_id", "span"], as_index=False)
            yield spans.agg(ts=("ts", "max"), first=("us", "min"), last=("us", "max"))[["user_id", "ts", "first", "last"]]

    return partial


# Companies share their state in so many groups: a call handles all companies of a group at once.
GAP_GROUPS = 512
GAP_STATE = "now BIGINT, company ARRAY<BIGINT>, before ARRAY<BIGINT>, waits ARRAY<BIGINT>, firsts ARRAY<BIGINT>, lasts ARRAY<BIGINT>"


def _gaps(gap_ms: int):
    """State of a group: the last passed event of each company, and two times for each span that waits.

    Gaps are reported once they are open and again when they end.  Events wait until the watermark
    has passed them, so late ones find their place; by then they are in order.  The timeout stands
    at the next event to pass or the next gap to open.
    """
    gap = 1000 * gap_ms

    def run(key, batches, state):
        now = state.getCurrentWatermarkMs()
        then, company, before, waits, firsts, lasts = state.get if state.exists else (None, [], [], [], [], [])
        parts = [pd.DataFrame({"user_id": waits, "first": firsts, "last": lasts}, dtype="int64")]
        # What the watermark has passed is closed.
        parts += [rows.loc[rows["last"] // 1000 > now, ["user_id", "first", "last"]] for rows in batches]
        spans = pd.concat(parts, ignore_index=True)
        spans = spans.assign(span=spans["first"] // gap).groupby(["user_id", "span"], as_index=False).agg({"first": "min", "last": "max"})
        due = spans[spans["first"] // 1000 < now]
        passed = due["last"] // 1000 < now
        old = pd.Series(before, index=pd.Index(company, dtype="int64"), dtype="Int64")

        # Spans of a company follow each other; of those that are due only the last may wait in part.
        reached = due["last"].where(passed, due["first"]).astype("Int64")
        earlier = reached.groupby(due["user_id"]).shift().fillna(due["user_id"].map(old))
        ended = (due["first"] - earlier >= gap).fillna(False).astype(bool)
        newest = pd.concat([old, reached.set_axis(due["user_id"])]).groupby(level=0).max()

        opens = newest // 1000 + gap_ms
        is_open = opens < now
        if then is not None:  # one that was open before the last call has been reported then
            is_open &= ~((newest == old.reindex(newest.index)).fillna(False) & (opens < then))
        in_part = due[~passed]
        left = pd.concat([spans[spans["first"] // 1000 >= now], in_part.assign(first=in_part["last"])])
        state.update((
            now, newest.index.tolist(), newest.tolist(), left["user_id"].tolist(), left["first"].tolist(), left["last"].tolist(),
        ))
        times = (left["first"] // 1000).tolist() + opens[opens >= now].tolist()
        if times:
            state.setTimeoutTimestamp(min(times))
        found = pd.DataFrame({
            "user_id": [*due.loc[ended, "user_id"], *newest.index[is_open]],
            "start_us": [*earlier[ended], *newest[is_open]],
            "end_us": pd.array([*due.loc[ended, "first"], *[None] * int(is_open.sum())], "Int64"),
        })
        if len(found):
            yield found

    return run


def quiet_gaps(stream: DataFrame, folder: str, gap_ms: int, delay: str = "1 day") -> DataFrame:
    """(user_id, start_us, end_us): times of at least ``gap_ms`` without an event, as far as the watermark.

    end_us is null for a gap that is still open; once an event ends it the row has its end.
    """
    partial = stream.select("user_id", "ts").mapInPandas(_partial_times(gap_ms), "user_id BIGINT, ts TIMESTAMP, first BIGINT, last BIGINT")
    partial = partial.withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(GAP_GROUPS)))
    gaps = partial.withWatermark("ts", delay).groupBy("part").applyInPandasWithState(
        _gaps(gap_ms), "user_id BIGINT, start_us BIGINT, end_us BIGINT", GAP_STATE, "append", GroupStateTimeout.EventTimeTimeout,
    )
    found = append_to_files(gaps, folder)
    return found.groupBy("user_id", "start_us").agg(F.max("end_us").alias("end_us"))


def enriched(stream: DataFrame, mapping: DataFrame) -> DataFrame:
    """Stream-static left join with the name mapping; the optimizer broadcasts it if small."""
    lookup = mapping.select(F.col("raw").alias("merchant_name"), F.col("canonical").alias("_mapped"))
    return (
        stream.join(lookup, "merchant_name", "left")
        .withColumn("canonical", F.coalesce("_mapped", "merchant_name"))
        .drop("_mapped")
    )


def upsert_stream(stream: DataFrame, store_path: str, folder: str) -> None:
    """Keep the feature store current; last write wins, so replayed batches change nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, store_path, batch)

    query = (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
