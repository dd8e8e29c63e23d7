"""Headline queries over the tables in $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The raw events are landed first, one folder per day as a warehouse holds them; that step is reported, not
counted. Each query runs to the last row into a sink that keeps nothing. Yardsticks are plain forms of the
same results, reported beside the headline total.
"""

from __future__ import annotations

import json
import os
import time

from martlight.functions.metrics import contract_metrics
from martlight.operators import funnels, merge, sessions
from martlight.plans import analytics, charts, dims, facts, staging
from martlight.session import local_session, work_path
from workload import adapters as given
from workload.queries import Inputs

RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    inputs = Inputs(spark, folder)

    landed = work_path(spark, "bench-events")
    start = time.perf_counter()
    raw = given.raw_events(spark, folder)
    raw.repartition("event_date").write.partitionBy("event_date").parquet(landed)
    landing = time.perf_counter() - start

    def events():
        return spark.read.schema(raw.schema).parquet(landed)

    def staged():
        return staging.stg_events(events(), given.SITE)

    def clean():
        return staging.stg_events_clean(staged(), test_users=("u1",), site=given.SITE)

    def page_clicks():
        return inputs.table("events").selectExpr("event_id", "user_id", "CAST(ts AS TIMESTAMP) AS ts")

    def merged():
        rows = inputs.bank_rows()
        return merge.upsert(given.merge_target(rows), given.merge_source(rows))

    queries = {
        "stg_events": staged,
        "dim_channel": lambda: dims.dim_channel(dims.channel_pairs(events(), given.SITE)),
        "fact_sessions": lambda: facts.fact_sessions(staged()),
        "fact_conversions": lambda: facts.fact_conversions(staged()),
        "fact_conversions_clean": lambda: facts.fact_conversions(clean(), "clean"),
        "funnel_loans": lambda: funnels.funnel(clean(), funnels.LOANS),
        "funnel_registration": lambda: funnels.funnel(clean(), funnels.REGISTRATION),
        "funnel_summary": lambda: funnels.funnel_summary(clean(), given.AS_OF),
        "contract_totals": lambda: contract_metrics(staged()),
        "inactivity_sessions": lambda: sessions.inactivity_sessions(page_clicks(), "user_id", "ts"),
        "fact_ad_spend": inputs.spend,
        "fact_bank_conversions": inputs.bank,
        "bank_merge": merged,
        "channel_performance": lambda: charts.chart(
            "channel_performance", {charts.CONVERSIONS: facts.fact_conversions(staged())}, given.AS_OF
        ),
        "channel_scorecard": lambda: analytics.channel_scorecard(inputs.bank(), inputs.spend(), 400.0),
        "website_and_bank": lambda: analytics.website_and_bank(*facts.both_facts(staged()), inputs.bank()),
    }
    yardsticks = {
        "fact_conversions_plain": lambda: facts.fact_conversions_plain(staged()),
        "website_and_bank_apart": lambda: analytics.website_and_bank(facts.fact_sessions(staged()), facts.fact_conversions(staged()), inputs.bank()),
    }

    def measure(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def best(build) -> float:
        measure(build)
        return round(min(measure(build) for _ in range(RUNS)), 3)

    seconds = {name: best(build) for name, build in queries.items()}
    plain = {name: best(build) for name, build in yardsticks.items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "yardsticks": plain,
                "landing_sec": round(landing, 3),
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
