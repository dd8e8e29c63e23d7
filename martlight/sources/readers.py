"""Readers of the landed inputs."""

from __future__ import annotations

import json
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, StructType, TimestampType

from martlight.functions.columns import missing_to_null, try_date
from martlight.sources import schemas

USD_TO_AMD = 400.0


def day_key(day: date) -> str:
    return day.strftime("%Y%m%d")


def events(spark: SparkSession, path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """Raw web events; ``since``/``until`` prune the ``event_date`` partitions of the scan."""
    frame = spark.read.schema(schemas.EVENTS).parquet(path)
    return between_days(frame, since, until)


def between_days(raw: DataFrame, since: date | None, until: date | None = None) -> DataFrame:
    if since is not None:
        raw = raw.where(F.col("event_date") >= day_key(since))
    if until is not None:
        raw = raw.where(F.col("event_date") <= day_key(until))
    return raw


def google_ads_stats(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Campaign statistics, stored partitioned by ``data_date``; the types of the figures may differ from drop to drop."""
    frame = landed(spark, path, schemas.GOOGLE_ADS_STATS)
    return frame if since is None else frame.where(F.col("data_date") >= F.lit(since))


def meta_insights(spark: SparkSession, path: str) -> DataFrame:
    return landed(spark, path, schemas.META_INSIGHTS)


def ad_spend(spark: SparkSession, path: str) -> DataFrame:
    return landed(spark, path, schemas.AD_SPEND)


def _drops(spark: SparkSession, path: str) -> list[DataFrame]:
    """The files at ``path``, one frame for those of equal types. Files in one folder are taken to be alike, so the
    footer of one file a folder is read; the list of folders is on the driver."""
    folders: dict[str, list[str]] = {}
    for file in spark.read.schema("_probe int").parquet(path).inputFiles():
        folders.setdefault(unquote(file).rpartition("/")[0], []).append(unquote(file))
    alike: dict[str, list[str]] = {}
    for folder in sorted(folders):
        own = spark.read.parquet(min(folders[folder])).schema
        alike.setdefault(own.json(), []).extend(folders[folder])
    # Partition columns are in the folder names below the path.
    reader = spark.read if any(c in path for c in "*?[{") else spark.read.option("basePath", path)
    return [reader.schema(StructType.fromJson(json.loads(own))).parquet(*sorted(files)) for own, files in alike.items()]


def _as_type(column: Column, own: DataType, wanted: DataType) -> Column:
    """A stored value in the wanted type; NULL where it does not fit."""
    if own == wanted:
        return column
    value = missing_to_null(column) if isinstance(own, StringType) else column
    if isinstance(wanted, DateType):
        text = value.cast("string")
        compact = F.when(text.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))))
        return F.to_date(value) if isinstance(own, TimestampType) else F.coalesce(compact, try_date(text))
    if isinstance(wanted, IntegralType):
        exact = value.try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact.try_cast(wanted))
    return value.try_cast(wanted)


def landed(spark: SparkSession, path: str, schema: str, lost: bool = False) -> DataFrame:
    """Landed Parquet files in the types of ``schema``, whatever types each drop has stored.

    Every drop is read with its own types, so only the wanted columns are read, and each field is converted: figures
    and dates may be text, whole numbers may be fractions or the other way round, absent fields are NULL. A value that
    does not fit is NULL; with ``lost`` the column ``_lost`` names the fields of a row whose values did not fit.
    """
    wanted = StructType.fromDDL(schema)
    frames = []
    for drop in _drops(spark, path):
        own = {f.name: f.dataType for f in drop.schema}
        columns, marks = [], []
        for f in wanted:
            if f.name not in own:
                columns.append(F.lit(None).cast(f.dataType).alias(f.name))
                continue
            stored = F.col(f"`{f.name}`")
            value = _as_type(stored, own[f.name], f.dataType)
            columns.append(value.alias(f.name))
            given = missing_to_null(stored) if isinstance(own[f.name], StringType) else stored
            marks.append(F.when(given.isNotNull() & value.isNull(), f.name))
        if lost:
            columns.append(F.array_compact(F.array(*marks)).alias("_lost"))
        frames.append(drop.select(*columns))
    if not frames:
        return spark.createDataFrame([], f"{schema}, _lost array<string>" if lost else schema)
    return reduce(DataFrame.unionByName, frames)


def lost_values(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(field, lost, rows): the values of each field that do not fit its type, of all rows."""
    rows = landed(spark, path, schema, lost=True)
    fields = literal_table(spark, "field string", [(f.name,) for f in StructType.fromDDL(schema)])
    counts = rows.select(F.explode("_lost").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("lost"))
    total = rows.agg(F.count(F.lit(1)).alias("rows"))
    # The fields of the schema, and one row.
    return fields.join(F.broadcast(counts), "field", "left").crossJoin(F.broadcast(total)).select("field", F.coalesce("lost", F.lit(0)).alias("lost"), "rows")


def open_quotes(line: Column) -> Column:
    """Whether a quoted field goes on in the next line: the line has an odd number of quotes."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def typed_csv(spark: SparkSession, path: str, schema: str, separator: str = ",") -> DataFrame:
    """A CSV file with a header; columns are matched by name, absent optional ones are NULL.

    Records that do not fit the header are an error. Only files with a quoted line break are read unsplit.
    """
    wanted = StructType.fromDDL(schema)
    spans = spark.read.text(path).agg(F.coalesce(F.bool_or(open_quotes(F.col("value"))), F.lit(False))).first()[0]
    options = {"header": True, "sep": separator, "multiLine": spans, "escape": '"'}
    present = spark.read.options(**options).csv(path).columns
    text = spark.read.options(**options, enforceSchema=False, mode="FAILFAST").csv(
        path, schema=", ".join(f"`{name}` string" for name in present)
    )
    return text.select(
        *[
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ]
    )


def approvals(spark: SparkSession, path: str) -> DataFrame:
    return typed_csv(spark, path, schemas.APPROVALS_TEMPLATE)


def monthly_targets(spark: SparkSession, path: str) -> DataFrame:
    return typed_csv(spark, path, schemas.MONTHLY_TARGETS)


def monthly_budgets(spark: SparkSession, path: str) -> DataFrame:
    return fill_daily_budget(typed_csv(spark, path, schemas.MONTHLY_BUDGETS))


def fill_daily_budget(budgets: DataFrame) -> DataFrame:
    """An empty daily budget is the monthly one spread over the days of the month."""
    days = F.dayofmonth(F.last_day("period"))
    return budgets.withColumn("daily_budget_usd", F.coalesce("daily_budget_usd", F.col("monthly_budget_usd") / days))


def manual_ad_spend(spark: SparkSession, path: str, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    return fill_local_spend(typed_csv(spark, path, schemas.MANUAL_AD_SPEND), usd_to_amd)


def fill_local_spend(spend: DataFrame, usd_to_amd: float = USD_TO_AMD) -> DataFrame:
    return spend.withColumn("spend_amd", F.coalesce("spend_amd", F.col("spend_usd") * F.lit(usd_to_amd)))


def upload(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """A user upload: csv, tsv or parquet, whole."""
    if kind == "parquet":
        frame = spark.read.schema(schema).parquet(path)
    elif kind in ("csv", "tsv"):
        frame = typed_csv(spark, path, schema, "," if kind == "csv" else "\t")
    else:
        raise ValueError(f"upload kind must be csv, tsv or parquet, not {kind!r}")
    return frame


def date_spine(
    spark: SparkSession, start: Column | date, end: Column | date, source: DataFrame | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One row per day from ``start`` to ``end`` for each row of ``source`` (one by default); the bounds may refer to its columns."""
    first = start if isinstance(start, Column) else F.lit(start)
    last = end if isinstance(end, Column) else F.lit(end)
    base = spark.range(1) if source is None else source
    return base.select(*keys, F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small constant table as part of the plan, so it needs neither a file nor the driver's memory."""
    fields = StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
