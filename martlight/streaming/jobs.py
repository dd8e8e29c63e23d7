"""Streaming counterparts of staging, daily counts, sessions and the fact refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martlight.functions.classify import Site
from martlight.operators.sinks import metrics, replace_days
from martlight.plans import facts
from martlight.plans.staging import stg_events
from martlight.sources import schemas
from martlight.streaming import store as stores

LATE = "7 days"
GAP = "30 minutes"


def event_stream(spark: SparkSession, path: str, schema: str | StructType = schemas.EVENTS, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def staged_stream(raw: DataFrame, site: Site = Site()) -> DataFrame:
    """The batch staging projection on a stream, with late events accepted for seven days."""
    return stg_events(raw, site).withWatermark("event_timestamp", LATE)


def daily_counts(staged: DataFrame) -> DataFrame:
    """Events, page views and approximate users per day and channel.

    Exact distinct counts cannot run on a stream; the exact figures come from the fact refresh below.
    """
    return (
        staged.groupBy(F.window("event_timestamp", "1 day"), "channel_group")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_name") == "page_view").alias("pageviews"),
            F.approx_count_distinct("user_pseudo_id").alias("approx_users"),
        )
        .select(F.to_date("window.start").alias("date"), "channel_group", "events", "pageviews", "approx_users")
    )


def sessions(staged: DataFrame) -> DataFrame:
    """Sessions ended by 30 minutes of inactivity; events without a user belong to none.

    Sessions are merged in each partition before the shuffle, so a user with very many events costs little.
    """
    staged.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    window = F.session_window("event_timestamp", GAP).alias("session")
    return (
        staged.where(F.col("user_pseudo_id").isNotNull())
        .groupBy("user_pseudo_id", window)
        .agg(F.count(F.lit(1)).alias("events"), F.max("event_timestamp").alias("session_end"))
        .select("user_pseudo_id", F.col("session.start").alias("session_start"), "session_end", "events")
    )


def write_final(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows the watermark has made final; state of older rows is dropped."""
    return (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_session_fact(raw: DataFrame, store: str, fact_path: str, checkpoint: str, site: Site = Site()) -> StreamingQuery:
    """Keep the session fact exact while events arrive.

    Each micro-batch is added to the stored raw events under its days and batch number, so a repeated batch
    replaces itself. Then exactly the days it touches are read back, recomputed and replaced. ``compact_events``
    keeps the number of stored files in proportion to the days.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation()
        stores.add_batch(batch.observe(seen, F.collect_set("event_date").alias("days")), batch_id, store, "event_date")
        # The calendar days of one micro-batch.
        days = sorted(metrics(seen).get("days", ()))
        if days:
            touched = stored_events(spark, store, days)
            replace_days(facts.fact_sessions(stg_events(touched, site)), fact_path, "date", facts.CLUSTER)

    return (
        raw.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_events(spark: SparkSession, store: str, days: list[str] | None = None) -> DataFrame:
    """The raw events that a stream has stored, of all days or of some."""
    return stores.read(spark, store, "event_date", schemas.EVENTS, days=days).drop("batch")


def compact_events(spark: SparkSession, store: str, before: str, running: bool = True) -> list[str]:
    """Rewrite the stored days before ``before`` (yyyyMMdd), one folder each, for good; late events go on beside them."""
    return stores.compact(spark, store, "event_date", schemas.EVENTS, before, running=running)
