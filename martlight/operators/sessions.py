"""Sessions that end after a period of inactivity, safe for users with very many events.

Time is cut into chunks as long as the gap. Two neighbouring events inside one chunk are closer than the
gap, so a chunk never contains a session boundary. Events are first aggregated per (user, chunk) with
map-side combine; only these summaries, at most one per gap length and user, go through the window that
finds the boundaries. A user with a third of all events therefore costs no more than a long-lived one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _chunk(ts: Column, gap_seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(gap_seconds * 1_000_000)).cast("long")


def _chunk_sessions(chunks: DataFrame, user: str, gap_seconds: int) -> DataFrame:
    order = Window.partitionBy(user).orderBy("_chunk")
    previous_end = F.lag("_last").over(order)
    silence = F.unix_micros("_first") - F.unix_micros(previous_end)
    starts = F.when(previous_end.isNull() | (silence >= gap_seconds * 1_000_000), 1).otherwise(0)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return chunks.withColumn("_starts", starts).withColumn("session_no", F.sum("_starts").over(running))


def inactivity_sessions(events: DataFrame, user: str, ts: str, gap_minutes: int = 30) -> DataFrame:
    """One row per session: user, number, first and last event, event count, duration in seconds.

    Events without a user belong to no session.
    """
    gap = gap_minutes * 60
    chunks = events.where(F.col(user).isNotNull()).groupBy(user, _chunk(F.col(ts), gap).alias("_chunk")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_events")
    )
    return sessions_of_chunks(chunks, user, gap).withColumn(
        "duration_sec", (F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000.0)
    )


def sessions_of_chunks(chunks: DataFrame, user: str, gap_seconds: int) -> DataFrame:
    """user, session_no, session_start, session_end, events from the summaries (_chunk, _first, _last, _events) of chunks."""
    sessions = _chunk_sessions(chunks, user, gap_seconds)
    return sessions.groupBy(user, "session_no").agg(
        F.min("_first").alias("session_start"), F.max("_last").alias("session_end"), F.sum("_events").alias("events")
    )


def assign_sessions(events: DataFrame, user: str, ts: str, gap_minutes: int = 30) -> DataFrame:
    """The events with their session number.

    The join back is on (user, chunk), unique on the summary side, so AQE may split a hot chunk. Events
    without a user keep a NULL number.
    """
    gap = gap_minutes * 60
    tagged = events.withColumn("_chunk", _chunk(F.col(ts), gap))
    chunks = (
        tagged.where(F.col(user).isNotNull())
        .groupBy(user, "_chunk")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    )
    numbers = _chunk_sessions(chunks, user, gap).select(user, "_chunk", "session_no")
    return tagged.join(numbers, [user, "_chunk"], "left").drop("_chunk")
