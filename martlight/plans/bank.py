"""Bank outcomes: CSV export to raw table, staging and fact."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlight.functions.classify import bank_channel_group
from martlight.functions.columns import any_of, column_or, flexible_date, missing_to_null, number, try_date, whole_number
from martlight.operators.merge import merge_into
from martlight.operators.sinks import replace_days
from martlight.plans.staging import stg_bank_conversions
from martlight.session import materialize
from martlight.sources import schemas
from martlight.sources.readers import open_quotes

# Headers of the export, as they are spelled there.
REQUIRED = ("Event _date", "Client_code", "LOAN_COUNT", "CARD_COUNT")
TEXT_HEADERS = {
    "event_time_raw": "Event Time",
    "event_name": "Event Name",
    "token_id": "Event Param Value (String)",
    "acquired_source": "Acquired Source",
    "acquired_medium": "Acquired Medium",
    "acquired_campaign": "Acquired Campaign",
    "client_code": "Client_code",
    "soc_card": "Soc_card",
    "had_product": "HAD_PRODUCT",
}
WHOLE_HEADERS = {
    "count_soc_card": "count_soc_card",
    "is_first_interaction": "1-st/2-nd",
    "loan_count": "LOAN_COUNT",
    "deposit_count": "DEPOSIT_COUNT",
    "card_count": "CARD_COUNT",
}
AMOUNT_HEADERS = {"loan_amount": "LOAN_AMOUNT", "deposit_amount": "DEPOSIT_AMOUNT"}


def _windows_1251(column: Column) -> Column:
    """Text that was read byte by byte as Latin-1, re-read as Cyrillic."""
    upper = bytes(range(0x80, 0x100))
    return F.translate(column, upper.decode("latin1"), upper.decode("cp1251", errors="replace"))


#: Where a record of the export is from: its file, the split of the file, and a number that grows within the split.
PLACE = ("_file", "_block", "_order")


def _placed(frame: DataFrame) -> DataFrame:
    meta = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    return frame.select("*", *meta, F.monotonically_increasing_id().alias("_order"))


def read_export(spark: SparkSession, path: str, places: bool = False) -> DataFrame:
    """The export as text columns, whatever the encoding of each of its files; with ``places``, also the columns PLACE.

    One pass over the lines finds out for each file whether it is valid UTF-8, whether a byte occurs that the
    Cyrillic code page lacks, and whether a quoted field spans lines. Files alike in this are read together; only
    those with spanning fields are read unsplit. A column that some files lack is NULL there.
    """
    line = F.col("value")
    probes = (
        spark.read.text(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.bool_and(F.is_valid_utf8(line)).alias("utf8"),
            (~F.bool_or(F.contains(line.cast("binary"), F.lit(bytearray(b"\x98"))))).alias("cyrillic"),
            F.bool_or(open_quotes(line)).alias("spans"),
        )
        .collect()  # one row per file
    )
    alike: dict[tuple, list[str]] = {}
    for p in probes:
        alike.setdefault((p["utf8"], p["utf8"] or p["cyrillic"], p["spans"]), []).append(unquote(p["file"]))

    def read(paths: str | list[str], utf8: bool, cyrillic: bool, spans: bool) -> DataFrame:
        reader = spark.read.options(header=True, multiLine=spans, escape='"')
        stored = reader.csv(paths) if utf8 else reader.option("encoding", "ISO-8859-1").csv(paths)
        frame = _placed(stored) if places else stored
        if utf8 or not cyrillic:
            return frame
        return frame.select(
            *[_windows_1251(F.col(f"`{c}`")).alias(c.encode("latin1").decode("cp1251", errors="replace")) for c in stored.columns],
            *(PLACE if places else ()),
        )

    if len(alike) < 2:
        return read(path, *next(iter(alike), (True, True, False)))
    frames = [read(sorted(files), *kind) for kind, files in sorted(alike.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def check_headers(frame: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [name for name in required if name not in frame.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return frame


def clean_export(frame: DataFrame, loaded_at: datetime, strict: bool = True) -> DataFrame:
    """Typed rows of the raw bank table. Absent optional columns get the default, missing texts are NULL.

    An unreadable date is an error, or NULL if not ``strict``.
    """
    return frame.select(*_typed(frame, loaded_at, strict))


def _typed(frame: DataFrame, loaded_at: datetime, strict: bool) -> list[Column]:
    none = F.lit(None).cast("string")
    day = column_or(frame, "Event _date", none)
    columns = {"event_date": flexible_date(day) if strict else try_date(missing_to_null(day))}
    columns |= {name: missing_to_null(column_or(frame, header, none)) for name, header in TEXT_HEADERS.items()}
    columns |= {name: whole_number(column_or(frame, header, none)) for name, header in WHOLE_HEADERS.items()}
    columns |= {name: number(column_or(frame, header, none)) for name, header in AMOUNT_HEADERS.items()}
    columns["uploaded_at"] = F.lit(loaded_at).cast("timestamp")
    order = [part.split()[0] for part in schemas.BANK_CONVERSIONS.replace("\n", " ").split(",")]
    return [columns[name].alias(name) for name in order]


REJECTS = "file string, record long, position long, reason string, event_date_text string, token_id string, client_code string, loaded_at timestamp"


def judged_export(frame: DataFrame, loaded_at: datetime) -> DataFrame:
    """The typed rows with ``_reason``, why a row must not be loaded (NULL: it may), its date as text, and PLACE.

    Refused are unreadable dates, rows without any part of the key, and negative counts or amounts.
    """
    none = F.lit(None).cast("string")
    day = missing_to_null(column_or(frame, "Event _date", none))
    rows = frame.select(*_typed(frame, loaded_at, strict=False), day.alias("_day"), *PLACE)
    negative = any_of(*[F.col(c) < 0 for c in (*(set(WHOLE_HEADERS) & {"loan_count", "deposit_count", "card_count"}), *AMOUNT_HEADERS)])
    reason = (
        F.when(F.col("_day").isNotNull() & F.col("event_date").isNull(), "unreadable date")
        .when(F.coalesce("token_id", "client_code", "_day").isNull(), "no key")
        .when(negative, "negative figure")
    )
    return rows.withColumn("_reason", reason)


def rejects(judged: DataFrame) -> DataFrame:
    """The refused rows with file, number of the record in its file (from 1, the header not counted), and reason.

    ``position`` is its number in the whole export, the files in the order of their paths. ``judged`` must be stored, since
    the order within a file is that of its one reading.
    """
    blocks = judged.groupBy("_file", "_block").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # One row for each split of a file.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({n: F.coalesce(F.sum("_rows").over(w), F.lit(0)) for n, w in (("_before", before), ("_earlier", earlier))})
    within = F.col("_order") - F.col("_first") + 1
    return judged.where(F.col("_reason").isNotNull()).join(F.broadcast(blocks), ["_file", "_block"]).select(
        F.url_decode("_file").alias("file"), (within + F.col("_before")).alias("record"), (within + F.col("_earlier")).alias("position"),
        F.col("_reason").alias("reason"), F.col("_day").alias("event_date_text"), "token_id", "client_code", F.col("uploaded_at").alias("loaded_at"),
    )


class LoadRefused(ValueError):
    """More rows were refused than the load allows; nothing was loaded."""


def export_checks(frame: DataFrame) -> DataFrame:
    """Checks before a load, one pass: rows, missing headers, unreadable dates, empty clients, duplicate keys."""
    none = F.lit(None).cast("string")
    present = set(frame.columns)
    day = missing_to_null(column_or(frame, "Event _date", none))
    parsed = try_date(day)
    rows = frame.select(
        parsed.alias("event_date"),
        missing_to_null(column_or(frame, "Event Param Value (String)", none)).alias("token_id"),
        missing_to_null(column_or(frame, "Client_code", none)).alias("client_code"),
        (day.isNotNull() & parsed.isNull()).alias("_bad"),
    )
    per_key = rows.groupBy("token_id", "client_code", "event_date").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if("_bad").alias("_bad")
    )
    keyless = any_of(*[F.col(c).isNull() for c in ("token_id", "client_code", "event_date")])
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.lit(sum(name not in present for name in REQUIRED)).cast("bigint").alias("missing_columns"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad_dates"),
        F.coalesce(F.sum(F.when(F.col("event_date").isNull(), F.col("_rows"))) - F.sum("_bad"), F.lit(0)).alias("empty_dates"),
        F.coalesce(F.sum(F.when(F.col("client_code").isNull(), F.col("_rows"))), F.lit(0)).alias("empty_clients"),
        F.coalesce(F.sum(F.when(F.col("token_id").isNull(), F.col("_rows"))), F.lit(0)).alias("empty_tokens"),
        F.coalesce(F.sum(F.when(~keyless, F.col("_rows") - 1)), F.lit(0)).alias("duplicate_rows"),
    )


def fact_bank_conversions(staged: DataFrame) -> DataFrame:
    product = (
        F.when(F.col("loan_count") > 0, "Loans")
        .when(F.col("card_count") > 0, "Cards")
        .when(F.col("deposit_count") > 0, "Deposits")
        .otherwise("Other")
    )
    return staged.select(
        F.col("event_date").alias("date"),
        bank_channel_group().alias("channel_group"),
        product.alias("product_category"),
        "acquired_source",
        "acquired_medium",
        "acquired_campaign",
        F.col("had_product").alias("is_existing_customer"),
        "is_first_interaction",
        "loan_count",
        "loan_amount",
        "deposit_count",
        "deposit_amount",
        "card_count",
        (F.col("loan_amount") + F.col("deposit_amount")).alias("total_revenue_amd"),
    )


def load_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.sum("loan_count").alias("loans"),
        F.sum("card_count").alias("cards"),
        F.sum("deposit_count").alias("deposits"),
        F.round(F.sum(F.col("loan_amount") + F.col("deposit_amount"))).alias("total_revenue"),
    )


def load_bank(spark: SparkSession, csv_path: str, warehouse: str, loaded_at: datetime, max_rejected: float = 0.05) -> dict:
    """CSV export to raw table (merge), staging table and fact table. Returns the counts and totals.

    Rows that must not be loaded go to the table ``rejects`` of the warehouse, with their place and reason; if they are
    more than ``max_rejected`` of all rows, nothing is loaded. The three tables are partitioned by day, and only the
    days that occur in the accepted rows are built and replaced.
    """
    judged = materialize(judged_export(check_headers(read_export(spark, csv_path, places=True)), loaded_at), "bank-export")
    total, refused = judged.agg(F.count(F.lit(1)), F.count("_reason")).first()
    rejects(judged).write.mode("append").parquet(f"{warehouse}/rejects/bank_conversions")
    if refused > max_rejected * total:
        raise LoadRefused(f"{refused} of {total} rows are refused")
    cleaned = judged.where(F.col("_reason").isNull()).drop("_reason", "_day", *PLACE)
    raw_path = f"{warehouse}/raw/bank_conversions"
    counts = merge_into(spark, raw_path, cleaned, schemas.BANK_CONVERSIONS)
    # One row for each calendar day of the export, so the size is bounded.
    days = F.broadcast(cleaned.select(F.col("event_date").alias("_day")).distinct())

    def touched(schema: str, path: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path).join(days, F.col("event_date").eqNullSafe(F.col("_day")), "left_semi")

    staged = stg_bank_conversions(touched(schemas.BANK_CONVERSIONS, raw_path))
    staged_path = f"{warehouse}/staging/stg_bank_conversions"
    replace_days(staged, staged_path, "event_date")
    stored = touched(", ".join(f"`{name}` {kind}" for name, kind in staged.dtypes), staged_path)
    replace_days(fact_bank_conversions(stored), f"{warehouse}/marts/fact_bank_conversions")
    totals = load_totals(spark.read.parquet(f"{warehouse}/marts/fact_bank_conversions")).first()
    return {**counts, **totals.asDict(), "rejected": refused}
