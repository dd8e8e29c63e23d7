"""Writing marts: whole tables, empty tables and idempotent replacement of recent days."""

from __future__ import annotations

from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlight.session import materialize


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system it is in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, system = file_system(spark, path)
    return system.exists(target)


def metrics(seen: Observation) -> dict:
    """What was observed; nothing where Spark found the input to be empty and left the observation out of the plan."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def laid_out(df: DataFrame, partition: str, cluster: tuple[str, ...]) -> DataFrame:
    """Rows of a day together, sorted by the cluster columns; a rebalance splits days that are too large."""
    spread = df.hint("rebalance", partition)
    return spread.sortWithinPartitions(partition, *cluster) if cluster else spread


def replace_table(df: DataFrame, path: str, partition: str | None = None, cluster: tuple[str, ...] = ()) -> None:
    """Create or replace a table, optionally partitioned by a date and sorted by cluster columns.

    An unpartitioned table, which a failing query would leave empty, is written aside first.
    """
    if partition is None:
        materialize(df, "replacement").write.mode("overwrite").parquet(path)
        return
    (
        laid_out(df, partition, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition)
        .parquet(path)
    )


def create_if_absent(spark: SparkSession, path: str, schema: str, partition: str | None = None) -> None:
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def with_upload_time(df: DataFrame, loaded_at, column: str = "uploaded_at") -> DataFrame:
    """Default of the upload time: the time of the load where the row has none."""
    given = F.col(column) if column in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn(column, F.coalesce(given, F.lit(loaded_at).cast("timestamp")))


def replace_recent(df: DataFrame, path: str, since: date, partition: str = "date", cluster: tuple[str, ...] = ()) -> None:
    """Replace every day from ``since`` on with the rows of ``df``; older days stay untouched.

    Days of the window that got rows are replaced by one dynamic partition overwrite. A day of the window
    that has no rows any more is emptied. Running it twice gives the same table.
    """
    spark = df.sparkSession
    window = df.where(F.col(partition) >= F.lit(since))
    stored = spark.read.parquet(path)
    schema = stored.schema
    # Only partition values are read here, no row data; the window bounds their number.
    had = {row[0] for row in stored.where(F.col(partition) >= F.lit(since)).select(partition).distinct().collect()}
    seen = Observation()
    (
        laid_out(window.select(*schema.names).observe(seen, F.collect_set(partition).alias("days")), partition, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    empty = spark.createDataFrame([], schema).drop(partition)
    for day in sorted(had - set(metrics(seen).get("days", ()))):
        empty.write.mode("overwrite").parquet(f"{path}/{partition}={day.isoformat()}")


def replace_days(df: DataFrame, path: str, partition: str = "date", cluster: tuple[str, ...] = ()) -> None:
    """Replace exactly the days that occur in ``df``; creates the table where it does not exist."""
    (
        laid_out(df, partition, cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def append_new(df: DataFrame, path: str, keys: tuple[str, ...]) -> None:
    """Append the rows whose key the table does not have yet."""
    spark = df.sparkSession
    if path_exists(spark, path):
        known = spark.read.schema(df.schema).parquet(path).select(*keys).distinct()
        df = df.join(known, list(keys), "left_anti")
    df.write.mode("append").parquet(path)
