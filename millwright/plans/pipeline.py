"""The whole flow: check, clean, enrich, build the fact and the summary, export."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.operators import quality
from millwright.operators.clean import clean_events, trim_strings
from millwright.operators.enrich import enrich_events
from millwright.operators.fact import build_fact
from millwright.operators.joins import pick_strategy
from millwright.operators.summary import merged, metrics, partial_metrics, rollup_metrics
from millwright.params import Params
from millwright.schemas import EVENTS, FACT, PRODUCTION, ROSTER, SUMMARY, SUMMARY_KEYS
from millwright.sinks.export import write
from millwright.sinks.scratch import delete, exists, touch
from millwright.sinks.store import FactStore, Staged, drop_partitions, within
from millwright.sources.tables import read_csv_checked, read_table

log = logging.getLogger(__name__)

MAX_ROWS = 2**63 - 1
#: Compression of the CSV copies: as plain text the fact's is many times its Parquet files.
CSV_CODEC = "gzip"


@dataclass
class RunReport:
    status: str = "running"
    row_counts: dict[str, int] = field(default_factory=dict)
    validations: dict[str, dict] = field(default_factory=dict)
    outputs: dict[str, str] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


def read_inputs(spark: SparkSession, input_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The three input tables under ``input_dir``; CSV with the declared types."""
    names = {
        "events": ("maintenance_events", EVENTS),
        "production": ("manufacturing_factory_dataset", PRODUCTION),
        "roster": ("operators_roster", ROSTER),
    }
    tables = {}
    for key, (name, schema) in names.items():
        path = f"{input_dir}/{name}.{fmt}"
        if fmt == "csv":
            tables[key] = read_csv_checked(spark, path, schema)
        else:
            tables[key] = read_table(spark, path, fmt=fmt)
    return tables


def fact_of(
    events: DataFrame, roster: DataFrame, params: Params = Params(), strategy: str = "auto"
) -> DataFrame:
    """Raw events and roster to the fact, lazily."""
    cleaned = clean_events(events, params)
    enriched = enrich_events(cleaned, trim_strings(roster), params, strategy=strategy)
    return build_fact(enriched, params)


def check_inputs(tables: dict[str, DataFrame], params: Params) -> dict[str, dict]:
    """Evaluate the input rules of the tables given; reports keyed by table.

    Texts are trimmed first, as the flow does: ids that differ by blanks are one id.
    """
    rules = {
        "events": quality.event_rules,
        "production": quality.production_rules,
        "roster": quality.roster_rules,
    }
    reports = []
    for name, df in tables.items():
        df = trim_strings(df)
        checks = rules[name](params.expected_rows)
        if name == "events":
            checks += quality.time_text_rules(df)
        if "unreadable_columns" in df.columns:
            checks += quality.unreadable_rules()
        reports.append(quality.evaluate(df, name, checks))
    # One job for all tables, so that their stages run side by side.
    return quality.summaries(reduce(DataFrame.unionByName, reports))


#: Columns that hold one value for all events of a day, so that no summary row spans two of their partitions.
PERIODS = (*SUMMARY_KEYS, "event_year_month")


class _Periods:
    """The outputs of a table that is run again period by period.

    Beside the fact lie its partial aggregates, partitioned alike. A re-run computes those
    of the partitions it touched, and from them the summary's and the CSV copies' files of
    the same partitions. A marker says that all of them fit the fact: it goes before the
    fact is changed and returns at the end, and without it every partition is done.
    """

    def __init__(self, spark: SparkSession, output_dir: str, partition_by: tuple[str, ...]):
        self.spark, self.by = spark, partition_by
        self.fact = f"{output_dir}/fact_maintenance_events.parquet"
        self.summary = f"{output_dir}/summary_maintenance_metrics.parquet"
        self.partials = f"{output_dir}/partial_maintenance_metrics.parquet"
        self.marker = f"{self.partials}/_complete"
        self.store = FactStore(spark, self.fact, partition_by)
        self.keys = [*SUMMARY_KEYS, *[c for c in partition_by if c not in SUMMARY_KEYS]]
        self.touched: list | None = None
        self.emptied: list = []

    def start_over(self) -> None:
        """Before a run that replaces everything: what described the old table goes."""
        self.store.forget()
        delete(self.spark, self.partials)

    def merge(self, staged: Staged) -> None:
        if exists(self.spark, self.marker):
            self.touched = staged.touched
        delete(self.spark, self.marker)
        self.emptied = self.store.commit(staged)

    def _replace(self, df: DataFrame, path: str, fmt: str = "parquet") -> None:
        """The touched partitions of an output, or all of them."""
        some = self.touched is not None
        codec = CSV_CODEC if fmt == "csv" else None
        write(df, path, fmt, partition_by=self.by, replace_partitions_only=some, codec=codec)
        if some:
            drop_partitions(self.spark, path, self.by, self.emptied)

    def _partials(self, touched: list | None) -> DataFrame:
        stored = self.spark.read.parquet(self.partials)
        return stored if touched is None else stored.where(within(self.by, touched))

    def update(self, formats: tuple[str, ...]) -> dict[str, str]:
        """All other outputs, for what the fact's change concerns; their paths."""
        facts = self.store.rows(self.touched)
        self._replace(partial_metrics(facts, self.keys), self.partials)
        if set(self.by) <= set(PERIODS):
            self._replace(metrics(self._partials(self.touched), self.keys), self.summary)
        else:
            write(metrics(merged(self._partials(None))), self.summary)
        outputs = {"summary_parquet": self.summary}
        if "csv" in formats:
            outputs["fact_csv"] = self.fact.removesuffix(".parquet") + ".csv"
            outputs["summary_csv"] = self.summary.removesuffix(".parquet") + ".csv"
            self._replace(facts.select(*FACT.fieldNames()), outputs["fact_csv"], "csv")
            summary = self.spark.read.parquet(self.summary)
            if set(self.by) <= set(PERIODS):
                summary = summary if self.touched is None else summary.where(within(self.by, self.touched))
                self._replace(summary.select(*SUMMARY_KEYS, *[c for c in summary.columns if c not in SUMMARY_KEYS]), outputs["summary_csv"], "csv")
            else:
                write(summary, outputs["summary_csv"], "csv", codec=CSV_CODEC)
        touch(self.spark, self.marker)
        return outputs

    def row_count(self) -> int:
        return self._partials(None).agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0]


def run(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    output_dir: str,
    params: Params = Params(),
    formats: tuple[str, ...] = ("parquet", "csv"),
    partition_by: tuple[str, ...] = (),
    replace_partitions_only: bool = False,
    raise_errors: bool = True,
) -> RunReport:
    """Run the flow over ``events``, ``roster`` and optionally ``production``.

    The fact is computed once, as the Parquet write, which also counts its rows. The
    summary and the CSV copies read that table back, which also cuts the lineage: losing
    an executor later on costs a re-read, not the join.

    With ``replace_partitions_only`` the events given are merged into the stored fact: an
    event that is given anew replaces the stored one, in whatever partition that lies,
    and all others stay. The merged partitions are checked before they replace the stored
    ones, and all outputs, which are then partitioned alike, change in these partitions
    only. An event without an id is the same as one that says the same. The session
    stays the caller's.
    """
    unknown = set(formats) - {"parquet", "csv"}
    if unknown:
        raise ValueError(f"unknown formats: {sorted(unknown)}")
    if replace_partitions_only and not partition_by:
        raise ValueError("replace_partitions_only needs partition_by")
    report = RunReport()
    clock = time.perf_counter()

    def lap(phase: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        report.seconds[phase] = now - clock
        clock = now

    try:
        report.validations = check_inputs(tables, params)
        for name, checked in report.validations.items():
            report.row_counts[f"{name}_raw"] = checked["total_rows"]
        quality.gate(report.validations.values(), params.on_fail)
        lap("validate")

        events, roster = tables["events"], tables["roster"]
        lookup = roster.select("operator_id", "skill_level", "reliability_score")
        strategy = pick_strategy(lookup, params.joins.broadcast_bytes)
        log.info("roster join: %s", strategy)

        periods = _Periods(spark, output_dir, partition_by)
        fact_path = periods.fact
        fact = fact_of(events, roster, params, strategy)
        at_least = report.row_counts["events_raw"]
        rules = quality.fact_rules(params.expected_rows.fact or (at_least, MAX_ROWS), params.expected_total_cost)

        def check(rows: DataFrame) -> None:
            report.validations.update(quality.summaries(quality.evaluate(rows, "fact", rules)))
            quality.gate([report.validations["fact"]], params.on_fail)

        if replace_partitions_only and exists(spark, fact_path):
            staged = periods.store.stage(fact)
            lap("fact")
            try:
                check(staged.rows)
            except quality.QualityError:
                periods.store.discard(staged)
                raise
            lap("check")
            periods.merge(staged)
            lap("merge")
        else:
            periods.start_over()
            report.row_counts["fact"] = write(fact, fact_path, partition_by=partition_by)
            lap("fact")
            check(read_table(spark, fact_path, FACT))
            lap("check")
            if replace_partitions_only:
                periods.store.locate_all()
        report.outputs["fact_parquet"] = fact_path

        if replace_partitions_only:
            report.outputs.update(periods.update(formats))
            report.row_counts["fact"] = periods.row_count()
            lap("summary")
        else:
            stored = read_table(spark, fact_path, FACT)
            summary_path = periods.summary
            write(rollup_metrics(stored), summary_path)
            report.outputs["summary_parquet"] = summary_path
            lap("summary")
        if "csv" in formats and not replace_partitions_only:
            stored_summary = read_table(spark, summary_path, SUMMARY)
            for key, df, path in (
                ("fact_csv", stored.select(*FACT.fieldNames()), fact_path),
                ("summary_csv", stored_summary, summary_path),
            ):
                report.outputs[key] = path.removesuffix(".parquet") + ".csv"
                write(df, report.outputs[key], "csv", codec=CSV_CODEC)
            lap("csv")
        report.status = "success"
    except Exception as e:
        report.status = "failed"
        report.errors.append(str(e))
        if raise_errors:
            raise
        log.exception("pipeline failed")
    return report
