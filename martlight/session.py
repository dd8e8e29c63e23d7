"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are per-session SQL settings, so they can be
# applied to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The classifiers are long CASE expressions. Generated methods above this size are never compiled by the
    # JVM and run several times slower; below the limit Spark splits them instead of fusing the whole stage.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Enough initial shuffle partitions for an input of the given size; AQE merges those that stay small."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def local_session(app: str = "martlight", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # Plans are built from many small column calls; recording the Python line of each costs more than the call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


FALLBACK = "spark.martlight.folder"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only where nothing is set, and only on a local master, a fresh temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FALLBACK, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="martlight-")
    spark.conf.set(FALLBACK, folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
