"""A store that a stream adds to in micro-batches, read whole at any time, with compaction of its closed days.

``<store>/open`` has one folder for each day and micro-batch, so a repeated batch replaces itself. ``compact`` rewrites
the closed days as one version of the table ``<store>/closed``, whose list of days also says up to which batch each is
covered. A reader takes the days of that list and the later batches of every day, so it sees each row once, whether a
compaction runs or not. Folders go one compaction after they were covered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.operators import versions
from martlight.operators.sinks import path_exists
from martlight.operators.versions import NO_DAY


def add_batch(batch: DataFrame, batch_id: int, store: str, day: str) -> None:
    """The rows of a micro-batch, under their days; adding the batch again replaces it."""
    (
        batch.withColumn("batch", F.lit(batch_id).cast("long"))
        .hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day, "batch")
        .parquet(f"{store}/open")
    )


def _without_batch(schema: str) -> str:
    return f"{schema}, batch long"


def _open(spark: SparkSession, store: str, schema: str) -> DataFrame:
    if not path_exists(spark, f"{store}/open"):
        return spark.createDataFrame([], _without_batch(schema))
    return spark.read.schema(_without_batch(schema)).parquet(f"{store}/open")


def _covered(spark: SparkSession, version: versions.Version) -> DataFrame:
    """(_day, _upto) of the compacted days."""
    return spark.createDataFrame([(e.day or NO_DAY, e.upto) for e in version.entries], "_day string, _upto long")


def read(spark: SparkSession, store: str, day: str, schema: str, keys: tuple[str, ...] = (), days: list[str] | None = None) -> DataFrame:
    """All rows of the store, or of some days, each once; with ``keys`` the newest row of each key.

    ``schema`` is that of the rows, the day included. The batch is in the column ``batch``.
    """
    version = versions.published(spark, f"{store}/closed")
    later = _open(spark, store, schema)
    if days is not None:
        later = later.where(F.col(day).cast("string").isin(days))
    rows = later
    if version is not None:
        # One row for each compacted day.
        marks = F.broadcast(_covered(spark, version))
        later = later.join(marks, F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY)) == F.col("_day"), "left")
        rows = later.where(F.col("_upto").isNull() | (F.col("batch") > F.col("_upto"))).drop("_day", "_upto")
        closed = version.read(spark)
        if days is not None:
            closed = closed.where(F.col(day).cast("string").isin(days))
        rows = rows.unionByName(closed.select(*rows.columns))
    return newest(rows, keys) if keys else rows


def newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def compact(
    spark: SparkSession, store: str, day: str, schema: str, before: str, keys: tuple[str, ...] = (), cluster: tuple[str, ...] = (), running: bool = True
) -> list[str]:
    """Rewrite the days before ``before`` that have batches outside the compacted table; returns these days.

    ``running`` says that the stream goes on: then its last batch, which may still be written, is left out. The
    folders that the compaction before this one covered are removed; a reader must not be older than that.
    """
    closed = f"{store}/closed"
    version = versions.published(spark, closed)
    stored = _open(spark, store, schema)
    # Only folder names are read here: the days and batches since the compaction before.
    folders = stored.select(F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY)).alias("day"), "batch").distinct().collect()
    upto = max((f["batch"] for f in folders), default=-1) - (1 if running else 0)
    covered = {e.day or NO_DAY: e.upto for e in (version.entries if version else ())}
    wanted = sorted({f["day"] for f in folders if f["day"] < before and covered.get(f["day"], -1) < f["batch"] <= upto})
    if wanted:
        rows = read(spark, store, day, schema, days=wanted).where(F.col("batch") <= upto)
        rows = newest(rows, keys) if keys else rows
        versions.publish(spark, versions.write(rows, closed, day, cluster, upto=upto))
    for f in folders:
        if f["batch"] <= covered.get(f["day"], -1):
            versions.delete(spark, f"{store}/open/{day}={f['day']}/batch={f['batch']}")
    return wanted
