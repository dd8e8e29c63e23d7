"""Helpers shared by the operators: reading, hashed buckets, distributed ranks, connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.session import materialize

TOP = "_top"
#: Bytes of an Arrow batch, but for one longer row.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Workers also look for this package where the driver has it, whatever their working folder.

    Executors that have it elsewhere find it by their own path, or get it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of few rows and bytes, since one text may be very long. Called before Python runs in tasks."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame doesn't have, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_for(rows: int, per_bucket: int = 2048) -> int:
    return max(1, -(-rows // per_bucket))


def bucket_starts(keyed: DataFrame, group: list[str], bucket: str, buckets: int) -> DataFrame:
    """(group, bucket, _n, _start) of each bucket of rows: its rows, and those of the group's buckets before it.

    The counts are summed in two levels, so that no task holds all of them.
    """
    upper = max(1, int(buckets**0.5))
    counts = keyed.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n")).withColumn(TOP, F.col(bucket).cast("long") % upper)
    tops = counts.groupBy(*group, TOP).agg(F.sum("_n").alias("_m"))
    over = Window.partitionBy(*group).orderBy(TOP).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_before", F.coalesce(F.sum("_m").over(over), F.lit(0)))
    within = Window.partitionBy(*group, TOP).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    match = F.col(f"_t.{TOP}") == F.col(f"_c.{TOP}")
    for g in group:
        match = match & F.col(f"_t.{g}").eqNullSafe(F.col(f"_c.{g}"))
    return counts.alias("_c").join(tops.alias("_t"), match).select(
        *[F.col(f"_c.{g}").alias(g) for g in group], F.col(f"_c.{bucket}").alias(bucket), "_n",
        (F.col("_start") + F.col("_before")).alias("_start"),
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), where root is the smallest node reachable.

    Alternates large-star and small-star steps; each is one aggregation and one join, so no task sees more of a
    component than the neighbours of one node. Every round is written to the shared folder, which cuts lineage.
    """
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(current)
    for _ in range(rounds):
        if not before[0]:
            break
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.select(F.col("a").alias("u"), "m"), F.col("a") == F.col("u"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        current = materialize(small.distinct(), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


#: Words of a text: runs of digits, a-z and what is not ASCII, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(column: Column) -> Column:
    return F.filter(F.split(ascii_lower(column), SEPARATORS), lambda w: w != "")
