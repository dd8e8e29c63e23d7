"""Windows of a stream that are shown before the watermark closes them.

The stream runs in update mode: every micro-batch adds the windows it has changed to a store, and a reader takes the
newest row of each. A window is final once the watermark has passed its end; the store says so in the column ``final``.
Sessions are read from windows as long as the gap, at most one for each user and half hour, so open sessions need no
state of their own and a user with very many events costs little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlight.operators.sessions import sessions_of_chunks
from martlight.streaming import store as stores
from martlight.streaming.jobs import LATE

DAILY_KEYS = ("date", "channel_group")
DAILY = "date date, channel_group string, events long, pageviews long, users_sketch binary, last_event timestamp"
CHUNK_KEYS = ("date", "user_pseudo_id", "chunk")
CHUNKS = "date date, user_pseudo_id string, chunk long, first timestamp, last timestamp, events long"
GAP_SECONDS = 1800


def daily_windows(staged: DataFrame) -> DataFrame:
    """Events, page views and a mergeable sketch of the users per day and channel."""
    return (
        staged.groupBy(F.window("event_timestamp", "1 day"), "channel_group")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_name") == "page_view").alias("pageviews"),
            F.hll_sketch_agg("user_pseudo_id").alias("users_sketch"),
            F.max("event_timestamp").alias("last_event"),
        )
        .select(F.to_date("window.start").alias("date"), "channel_group", "events", "pageviews", "users_sketch", "last_event")
    )


def session_chunks(staged: DataFrame) -> DataFrame:
    """First and last event and number of events of each user and half hour."""
    return (
        staged.where(F.col("user_pseudo_id").isNotNull())
        .groupBy(F.window("event_timestamp", f"{GAP_SECONDS} seconds"), "user_pseudo_id")
        .agg(F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"), F.count(F.lit(1)).alias("events"))
        .select(
            F.to_date("window.start").alias("date"), "user_pseudo_id",
            F.expr(f"unix_seconds(window.start) div {GAP_SECONDS}").alias("chunk"), "first", "last", "events",
        )
    )


def write_open(frame: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Add the changed windows of every micro-batch to ``store``."""
    return (
        frame.writeStream.foreachBatch(lambda batch, batch_id: stores.add_batch(batch, batch_id, store, "date"))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _watermark(rows: DataFrame, last: str) -> DataFrame:
    return rows.agg((F.max(last) - F.expr(f"INTERVAL {LATE}")).alias("_watermark"))


def daily_counts(spark: SparkSession, store: str) -> DataFrame:
    """date, channel_group, events, pageviews, users_sketch, final of every window, open ones included."""
    rows = stores.read(spark, store, "date", DAILY, DAILY_KEYS)
    marked = rows.crossJoin(F.broadcast(_watermark(rows, "last_event")))  # one row
    final = F.date_add("date", 1).cast("timestamp") <= F.col("_watermark")
    return marked.select(*DAILY_KEYS, "events", "pageviews", "users_sketch", final.alias("final"))


def users_of(daily: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Approximate users over any span of the rows of ``daily``: the sketches of days and channels are merged."""
    merged = F.hll_union_agg("users_sketch", F.lit(True))
    return daily.groupBy(*keys).agg(F.hll_sketch_estimate(merged).alias("approx_users"))


def sessions(spark: SparkSession, store: str) -> DataFrame:
    """user_pseudo_id, session_start, session_end, events, final of every session, open ones included."""
    rows = stores.read(spark, store, "date", CHUNKS, CHUNK_KEYS)
    chunks = rows.select("user_pseudo_id", F.col("chunk").alias("_chunk"), F.col("first").alias("_first"), F.col("last").alias("_last"), F.col("events").alias("_events"))
    found = sessions_of_chunks(chunks, "user_pseudo_id", GAP_SECONDS)
    marked = found.crossJoin(F.broadcast(_watermark(rows, "last")))  # one row
    final = F.col("session_end") + F.expr(f"INTERVAL {GAP_SECONDS} SECONDS") <= F.col("_watermark")
    return marked.select("user_pseudo_id", "session_start", "session_end", "events", final.alias("final"))
