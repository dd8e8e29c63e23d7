"""Upsert of bank rows, as a plan and onto a date-partitioned table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlight.operators.sinks import path_exists
from martlight.session import materialize

KEYS = ("token_id", "client_code", "event_date")
UPDATED = ("loan_count", "loan_amount", "deposit_count", "deposit_amount", "card_count", "uploaded_at")


def _salted(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``_salt`` keeps rows with a NULL in the key, which match nothing, apart and spreads them in a shuffle."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return frame.withColumn("_salt", F.when(whole, F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id()))


def latest_per_key(source: DataFrame, keys: tuple[str, ...] = KEYS, newest: str = "uploaded_at") -> DataFrame:
    """One source row per key: the newest, ties broken by the row's own values.

    An aggregation instead of a ranking window: map-side combine keeps a key with very many copies cheap.
    Rows with a NULL key match nothing in a merge, so all of them are kept.
    """
    rest = [c for c in source.columns if c not in keys and c != newest]
    best = _salted(source, keys).groupBy(*keys, "_salt").agg(F.max(F.struct(newest, *rest)).alias("_row"))
    return best.select(*keys, "_row.*").select(*source.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, ...] = KEYS,
    updated: tuple[str, ...] = UPDATED,
    newest: str = "uploaded_at",
    unique: bool = False,
) -> DataFrame:
    """The merged table with ``_action`` = keep, update or insert.

    Matched target rows take the updated columns of the newest source row of their key, unmatched source rows
    are inserted whole. One full outer join reads and shuffles each side once; the key names one application, so
    it is nearly unique. Rows with a NULL key match nothing and are spread by a salt. ``unique`` says that the
    source has one row per key already.
    """
    if not unique:
        source = latest_per_key(source, keys, newest)
    others = [c for c in target.columns if c not in keys]
    new = _salted(source, keys).select(*keys, "_salt", *[F.col(c).alias(f"_new_{c}") for c in others], F.lit(True).alias("_new"))
    both = _salted(target, keys).withColumn("_old", F.lit(True)).join(new, [*keys, "_salt"], "full")

    def merged(c: str):
        taken = F.col("_new") if c in updated else F.col("_old").isNull()
        return F.when(taken, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    action = F.when(F.col("_old") & F.col("_new"), "update").when(F.col("_old"), "keep").otherwise("insert")
    return both.select(*[F.col(c) if c in keys else merged(c) for c in target.columns], action.alias("_action"))


def action_counts(merged: DataFrame) -> DataFrame:
    """Added, updated and total rows of a merge."""
    return merged.agg(
        F.count_if(F.col("_action") == "insert").alias("added"),
        F.count_if(F.col("_action") == "update").alias("updated"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def merge_into(spark: SparkSession, path: str, source: DataFrame, schema: str) -> dict[str, int]:
    """Merge ``source`` into the table at ``path``, partitioned by event date.

    The date is part of the key, so only the dates of the source can change: only their partitions are
    read and replaced, in one job whose output becomes visible at commit. Returns added and updated rows.
    """
    # Read several times below, so written once.
    source = materialize(latest_per_key(source), "merge-source")
    if path_exists(spark, path):
        first, last, keyless = source.agg(
            F.min("event_date"), F.max("event_date"), F.count_if(F.col("event_date").isNull())
        ).first()
        span = F.col("event_date").between(F.lit(first), F.lit(last))
        stored = spark.read.schema(schema).parquet(path).where(span | F.col("event_date").isNull() if keyless else span)
        # One row per calendar day of the source, so the size is bounded.
        dates = F.broadcast(source.select(F.col("event_date").alias("_date")).distinct())
        touched = stored.join(dates, F.col("event_date").eqNullSafe(F.col("_date")), "left_semi")
        merged = upsert(touched, source, unique=True)
    else:
        merged = source.withColumn("_action", F.lit("insert"))
    seen = Observation()
    tagged = merged.observe(
        seen,
        F.count_if(F.col("_action") == "insert").alias("added"),
        F.count_if(F.col("_action") == "update").alias("updated"),
    )
    (
        tagged.drop("_action")
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )
    return dict(seen.get)


def key_bucket(keys: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_into_buckets(
    spark: SparkSession, path: str, source: DataFrame, schema: str, buckets: int, keys: tuple[str, ...] = KEYS, day: str = "event_date"
) -> dict[str, int]:
    """Merge ``source`` into a table whose days are cut into ``buckets`` by a hash of the key.

    A source row can only match in its own day and bucket, so only these folders are read and replaced, not whole days:
    the number of buckets, fixed for a table, decides how little of a day a few late rows rewrite. Returns added and
    updated rows, the bytes read and replaced, and the bytes of the touched days, which a merge by days replaces.
    """
    source = materialize(latest_per_key(source, keys).withColumn("key_bucket", key_bucket(keys, buckets)), "merge-source")
    layout = f"{schema}, key_bucket int"
    figures = {"bytes": 0, "day_bytes": 0}
    if path_exists(spark, path):
        # At most the days of the source times the buckets.
        pairs = source.select(F.col(day).alias("_day"), F.col("key_bucket").alias("_bucket")).distinct()
        stored = spark.read.schema(layout).parquet(path)
        same_day = F.col(day).eqNullSafe(F.col("_day"))
        size = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col(day), F.col("key_bucket")]
        files = stored.select(*size).distinct()
        marked = files.join(F.broadcast(pairs.groupBy("_day").agg(F.collect_set("_bucket").alias("_hit"))), same_day)
        figures = marked.agg(
            F.coalesce(F.sum(F.when(F.array_contains("_hit", F.col("key_bucket")), F.col("size"))), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("day_bytes"),
        ).first().asDict()
        touched = stored.join(F.broadcast(pairs), same_day & (F.col("key_bucket") == F.col("_bucket")), "left_semi")
        merged = upsert(touched, source, (*keys, "key_bucket") if "key_bucket" not in keys else keys, unique=True)
    else:
        merged = source.withColumn("_action", F.lit("insert"))
    seen = Observation()
    tagged = merged.observe(
        seen, F.count_if(F.col("_action") == "insert").alias("added"), F.count_if(F.col("_action") == "update").alias("updated")
    )
    (
        tagged.drop("_action")
        .hint("rebalance", day, "key_bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day, "key_bucket")
        .parquet(path)
    )
    return {**dict(seen.get), **figures}


def insert_if_absent(target: DataFrame, source: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The source rows whose key the target does not have yet."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")

