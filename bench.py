"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.adapters import (
    lineitem_as_maintenance,
    lineitem_as_production,
    suppliers_as_roster,
)
from checks.queries import PARAMS, QUERIES, scratch
from millwright.plans import pipeline

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "maintenance_summary",
    "fact_maintenance",
    "fact_lineitem",
    "summary_lineitem",
    "local_to_utc_seasons",
    "parts_usage",
    "enrich_operators",
    "enrich_operators_spread",
    "unmatched_technicians",
    "severity_mix",
    "kpi_cost",
    "kpi_downtime",
    "kpi_composition",
    "kpi_unplanned",
    "kpi_distribution",
    "kpi_report",
    "share_of_total",
    "quality_events",
    "quality_production",
    "duplicate_keys",
    "rule_violations",
    "event_alerts",
    "breakdown_alerts",
    "top_events_presented",
    "csv_safe",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def run_pipeline(spark: SparkSession) -> None:
    tables = {
        "events": lineitem_as_maintenance(spark, SF_DIR),
        "production": lineitem_as_production(spark, SF_DIR),
        "roster": suppliers_as_roster(spark, SF_DIR),
    }
    pipeline.run(spark, tables, scratch(spark, "bench"), PARAMS)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("millwright-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    jobs = {n: (lambda n=n: drain(QUERIES[n](spark, SF_DIR))) for n in HEADLINE}
    jobs["pipeline_end_to_end"] = lambda: run_pipeline(spark)
    seconds = {}
    for name, job in jobs.items():
        job()  # warm the JVM and the file cache
        seconds[name] = round(min(timed(job) for _ in range(REPEATS)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_time_of_headline_queries",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
