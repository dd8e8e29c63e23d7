"""Daily refresh of all marts: full or incremental; written aside, checked, and published where the checks pass."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlight.functions.classify import Site
from martlight.operators.funnels import LOANS, REGISTRATION, funnel, funnel_summary
from martlight.operators import versions
from martlight.operators.quality import completeness, not_run, refresh_checks, related, run_checks, spend_checks, summary
from martlight.operators.sinks import metrics, path_exists, replace_recent, replace_table
from martlight.plans import dims, facts, spend
from martlight.plans.staging import stg_events, stg_events_clean
from martlight.session import materialize, size_shuffles
from martlight.sources.literals import dim_product
from martlight.sources.readers import between_days

LOOKBACK_DAYS = 7
SUMMARY_DAYS = 30
#: Marts written at a time: as many as there are, so that one fills the cores that another leaves idle.
WRITERS = 10

STAGED_COLUMNS = (
    "event_date", "event_name", "user_pseudo_id", "session_id", "session_number", "campaign", "engagement_time_msec",
    "session_engaged", "device_category", "country", "city", "source_clean", "channel_group", "product_category",
)

STATUS_SCHEMA = "table string, mode string, ok boolean, rows long, error string"
PUBLISHED_SCHEMA = "table string, published boolean, number long, reason string"
RUNS_SCHEMA = "as_of date, mode string, input string, files long, bytes long, rows long"


@dataclass
class Outcome:
    """Result of a refresh: a status row and a publication row per table, all check results, and the overall decision.

    ``relations`` has the checks that compare tables and days, ``scans`` the files, bytes and rows read per input.
    """

    status: DataFrame
    checks: DataFrame
    relations: DataFrame
    published: DataFrame
    scans: DataFrame
    summary: DataFrame
    ok: bool
    input_rows: int


def marts_path(warehouse: str, table: str) -> str:
    return f"{warehouse}/marts/{table}"


def reason(error: Exception) -> str:
    return f"{type(error).__name__}: {(str(error).splitlines() or [''])[0]}"


#: Tables that need the staged events.
EVENT_TABLES = ("dim_channel", "fact_sessions", "fact_conversions", "funnel_loans", "funnel_registration", "funnel_summary")

#: The marts of a refresh, in the order of its status.
ORDER = (
    "dim_channel", "dim_date", "dim_product", "fact_sessions", "fact_conversions", "fact_ad_spend_google", "fact_ad_spend",
    "funnel_loans", "funnel_registration", "funnel_summary",
)


def scan_figures(frame: DataFrame, name: str) -> DataFrame | None:
    """(input, files, bytes) of the files a scan reads after its pruning; None for frames that are no plain scan."""
    try:
        files = frame.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    except AnalysisException:
        return None
    # No column is read; the files are one row per task before the shuffle.
    files = files.groupBy("file").agg(F.max("size").alias("size"))
    return files.agg(F.lit(name).alias("input"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def read_mart(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The published version of a mart; marts that are replaced by days in place are read as they are."""
    path = marts_path(warehouse, table)
    version = versions.published(spark, path)
    return spark.read.parquet(path) if version is None else version.read(spark)


def refresh(
    spark: SparkSession,
    raw_events: DataFrame,
    warehouse: str,
    as_of: date,
    full: bool = False,
    google_stats: DataFrame | None = None,
    meta_insights: DataFrame | None = None,
    site: Site = Site(),
    test_users: tuple[str, ...] = (),
    lookback_days: int = LOOKBACK_DAYS,
    conversions: str = "clean",
    input_bytes: int | None = None,
    together: bool = False,
) -> Outcome:
    """Dimensions, facts, ad spend, funnels: written aside, checked, and published where no critical check fails.

    Every mart is written as a version that nobody reads. All checks run on these versions. A mart that was not
    written, or of which a critical check fails, keeps its published version; with ``together`` one such mart keeps
    all as they are. A failing table is recorded and the others go on. Marts that do not read each other are written
    at the same time, the ad spend while the events are staged.

    The columns the marts need are staged into one table of the warehouse, partitioned by day and kept across runs,
    so the nested raw events are parsed once. An incremental run stages and replaces the lookback days only, in that
    table as in the facts and funnels, reads the days of the funnel summary, and adds new pairs to the channel dimension.
    ``conversions`` chooses the conversion fact over clean or raw event names. ``input_bytes``, the size of the
    events, sets the number of shuffle partitions. The status has the rows of each table, taken from file footers; the
    files and bytes read of each input are kept in the table ``runs`` of the warehouse.
    """
    if input_bytes is not None:
        size_shuffles(spark, input_bytes)
    status: list[tuple] = []
    drafts: dict[str, versions.Version] = {}
    writers = ThreadPoolExecutor(WRITERS)
    # The write of each mart; its status and draft are taken over in the order of ``ORDER`` once all have ended.
    started: dict[str, Future] = {}

    def table(name: str) -> str:
        return marts_path(warehouse, name)

    def attempt(name: str, mode: str, write: Callable[[], versions.Version]) -> None:
        def run() -> tuple[tuple, versions.Version | None]:
            try:
                draft = write()
                return (name, mode, True, draft.read(spark).count(), None), draft
            except Exception as error:  # noqa: BLE001  failed reads and tasks come as errors of the JVM
                return (name, mode, False, None, reason(error)), None

        started[name] = writers.submit(inheritable_thread_target(spark)(run))

    dated = ("fact_sessions", "fact_conversions", "funnel_loans", "funnel_registration")
    stored = {name: versions.published(spark, table(name)) is not None for name in ("dim_channel", *dated)}
    incremental = not full and all(stored.values())
    run_mode = "incremental" if incremental else "full"
    since = as_of - timedelta(days=lookback_days)
    first_day = as_of - timedelta(days=max(lookback_days, SUMMARY_DAYS)) if incremental else None

    if google_stats is not None:
        attempt(
            "fact_ad_spend_google",
            "full",
            lambda: versions.write(spend.fact_ad_spend_google(google_stats), table("fact_ad_spend_google")),
        )
    if meta_insights is not None:

        def unified() -> versions.Version:
            part = started["fact_ad_spend_google"].result()[1] if google_stats is not None else None
            if google_stats is not None and part is None:
                raise ValueError("the Google part was not written")
            google = part.read(spark) if part is not None else None
            return versions.write(spend.fact_ad_spend(google, meta_insights), table("fact_ad_spend"), "date", ("channel_group",))

        attempt("fact_ad_spend", "full", unified)

    attempt("dim_date", "full", lambda: versions.write(dims.dim_date(spark), table("dim_date")))
    attempt("dim_product", "full", lambda: versions.write(dim_product(spark), table("dim_product")))

    seen = Observation()
    staging_path = f"{warehouse}/staging/stg_events"
    staged, staged_from = None, first_day
    try:
        kept = incremental and path_exists(spark, staging_path)
        staged_from = since if kept else first_day
        parsed = stg_events(raw_events, site, since=staged_from).select(*STAGED_COLUMNS)
        counted = parsed.observe(seen, F.count(F.lit(1)).alias("rows"))
        if kept:
            replace_recent(counted, staging_path, since, "event_date")
        else:
            replace_table(counted, staging_path, "event_date")
        staged = spark.read.schema(parsed.schema).parquet(staging_path)
        if first_day is not None:
            staged = staged.where(F.col("event_date") >= F.lit(first_day))
    except Exception as error:  # noqa: BLE001
        status += [(name, run_mode, False, None, reason(error)) for name in EVENT_TABLES]
    if staged is not None:
        clean = stg_events_clean(staged, test_users=test_users, site=site)

        pairs = staged.select("source_clean", "channel_group")
        if incremental:
            known = read_mart(spark, warehouse, "dim_channel").select("source_clean", "channel_group")
            pairs = pairs.unionByName(known).distinct()
        attempt("dim_channel", "full", lambda: versions.write(dims.dim_channel(pairs), table("dim_channel")))

        def write_dated(name: str, build: Callable[[DataFrame], DataFrame], frame: DataFrame, cluster: tuple[str, ...]):
            if full or not stored[name]:
                attempt(name, "full", lambda: versions.write(build(frame), table(name), "date", cluster))
            else:
                recent = frame.where(F.col("event_date") >= F.lit(since))
                attempt(name, "incremental", lambda: versions.write(build(recent), table(name), "date", cluster, since))

        write_dated("fact_sessions", facts.fact_sessions, staged, facts.CLUSTER)
        write_dated("fact_conversions", lambda frame: facts.fact_conversions(frame, conversions), clean, facts.CLUSTER)

        write_dated("funnel_loans", lambda frame: funnel(frame, LOANS), clean, ("channel_group",))
        write_dated("funnel_registration", lambda frame: funnel(frame, REGISTRATION), clean, facts.CLUSTER)
        attempt(
            "funnel_summary",
            "full",
            lambda: versions.write(funnel_summary(clean, as_of, SUMMARY_DAYS), table("funnel_summary")),
        )

    writers.shutdown()
    for name in (n for n in ORDER if n in started):
        row, draft = started[name].result()
        status.append(row)
        if draft is not None:
            drafts[name] = draft

    status_rows = spark.createDataFrame(status, STATUS_SCHEMA)
    expected = len(EVENT_TABLES) + len(("dim_date", "dim_product")) + (google_stats is not None) + (meta_insights is not None)

    def checked(found: list[tuple[DataFrame | None, list]]) -> DataFrame:
        """All checks in one job; where that fails, each frame by itself, and those that cannot run have failed."""
        try:
            return materialize(reduce(DataFrame.unionByName, [run_checks(frame, some) for frame, some in found]), "checks")
        except Exception:  # noqa: BLE001
            if len(found) == 1:
                return not_run(spark, found[0][1])
            return reduce(DataFrame.unionByName, [checked([one]) for one in found])

    # Tables that were not written fail their own checks and are compared in none; completeness reports them.
    frames = {name: draft.read(spark) for name, draft in drafts.items()}
    checks = checked([(frames.get(name), some) for name, some in refresh_checks(as_of).items()]).unionByName(completeness(status_rows, expected))
    bank = read_mart(spark, warehouse, "fact_bank_conversions") if path_exists(spark, table("fact_bank_conversions")) else None
    grain = (*facts.CONVERSION_KEYS, "user_type")
    compared = [(f, [c]) for f, c in related(frames.get("fact_sessions"), frames.get("fact_conversions"), bank, None, frames.get("dim_channel"), grain)]
    if "fact_ad_spend" in frames:
        compared.append((frames["fact_ad_spend"], spend_checks(as_of, "fact_ad_spend")))
    relations = checked(compared) if compared else not_run(spark, [])

    every = materialize(checks.unionByName(relations), "checks")
    # One row for each failed check of the fixed list.
    failed: dict[str, list[str]] = {}
    for row in every.where("NOT passed AND severity = 'critical'").orderBy("table", "check").collect():
        failed.setdefault(row["table"], []).append(row["check"])
    broken = [name for name, _, ok, _, _ in status if not ok] + [name for name in drafts if name in failed]
    outcomes = []
    for name, _, ok, _, error in status:
        why = error if not ok else "; ".join(failed[name]) if name in failed else f"held back with {broken[0]}" if together and broken else None
        number = None
        if why is None:
            try:
                number = versions.publish(spark, drafts[name]).number
            except Exception as failure:  # noqa: BLE001
                why = reason(failure)
        outcomes.append((name, why is None, number, why))

    input_rows = metrics(seen).get("rows", 0) if staged is not None else 0
    scans = _scans(spark, warehouse, as_of, run_mode, raw_events, staged_from, google_stats, meta_insights, input_rows)
    totals = summary(every)
    ok = all(row[1] for row in outcomes) and totals.first()["ok"]
    return Outcome(
        status_rows, checks, relations, spark.createDataFrame(outcomes, PUBLISHED_SCHEMA), scans, totals, ok, input_rows
    )


def _scans(
    spark: SparkSession, warehouse: str, as_of: date, mode: str, events: DataFrame, since: date | None,
    google: DataFrame | None, meta: DataFrame | None, event_rows: int | None,
) -> DataFrame:
    """What a refresh has read, added to the table of runs; inputs that are no plain scan have no files and bytes."""
    inputs = {"events": between_days(events, since), "google_ads_stats": google, "meta_insights": meta}
    rows = []
    for name, frame in inputs.items():
        if frame is None:
            continue
        try:
            figures = scan_figures(frame, name)
            files, size = figures.first()[1:] if figures is not None else (None, None)
        except Exception:  # noqa: BLE001  a damaged input has failed its table already
            files = size = None
        rows.append((as_of, mode, name, files, size, event_rows if name == "events" else None))
    run = spark.createDataFrame(rows, RUNS_SCHEMA)
    run.coalesce(1).write.mode("append").parquet(f"{warehouse}/runs")
    return run


MARTS = (
    "dim_channel", "dim_date", "dim_product", "fact_sessions", "fact_conversions", "fact_ad_spend_google", "fact_ad_spend",
    "fact_bank_conversions", "funnel_loans", "funnel_registration", "funnel_summary",
)


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Temporary views over the marts that exist, for SQL users; returns their names."""
    found = []
    for name in MARTS:
        path = marts_path(warehouse, name)
        if path_exists(spark, f"{path}/published") or path_exists(spark, path):
            read_mart(spark, warehouse, name).createOrReplaceTempView(name)
            found.append(name)
    return found
