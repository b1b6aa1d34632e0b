"""Every operator of the library run over the test tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType, TimestampNTZType

from checks.adapters import (
    defective_events,
    events_as_maintenance,
    lineitem_as_maintenance,
    lineitem_as_production,
    suppliers_as_roster,
    table,
)
from millwright.functions.times import clock_text, day_text, local_to_utc, month_text
from millwright.operators import alerts, clean, enrich, fact, joins, kpis, quality, summary
from millwright.params import PLANT_ROWS, AlertLimits, ExpectedRows, JoinLimits, Params
from millwright.plans import pipeline
from millwright.schemas import EVENTS, FACT, SUMMARY, SUMMARY_KEYS
from millwright.sinks import export
from millwright.sinks.scratch import exists, scratch_dir
from millwright.sources.tables import read_csv_checked, read_table, rows_with
from millwright.streaming.ingest import ingest_new_files, read_repeats

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = Params(run_ts=datetime(2024, 2, 1))
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which every comparison reads alike."""
    shown = {
        f.name: F.col(f.name).cast("double" if isinstance(f.dataType, DecimalType) else "string")
        for f in df.schema.fields
        if isinstance(f.dataType, (DecimalType, DateType))
    }
    return df.withColumns(shown) if shown else df


def minutes(name: str = "downtime_min") -> Column:
    """A whole number with gaps as double, for the same reason."""
    return F.col(name).cast("double").alias(name)


def register(name: str, fn: Query) -> None:
    QUERIES[name] = lambda spark, sf: plain(fn(spark, sf))


def query(fn: Query) -> Query:
    register(fn.__name__, fn)
    return fn


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own for each call, in the shared folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def flat_fact(df: DataFrame) -> DataFrame:
    """The fact without its load time, the parts as joined text."""
    return df.drop("load_timestamp").withColumn("parts_list", F.array_join("parts_list", ","))


def _events_fact(spark: SparkSession, sf: str, strategy: str = "auto") -> DataFrame:
    return pipeline.fact_of(
        events_as_maintenance(spark, sf), suppliers_as_roster(spark, sf), PARAMS, strategy
    )


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_events(events_as_maintenance(spark, sf), PARAMS)


# --- whole chain -----------------------------------------------------------


@query
def maintenance_summary(spark, sf):
    return summary.rollup_metrics(_events_fact(spark, sf))


@query
def fact_maintenance(spark, sf):
    return flat_fact(_events_fact(spark, sf))


@query
def fact_lineitem(spark, sf):
    return flat_fact(
        pipeline.fact_of(lineitem_as_maintenance(spark, sf), suppliers_as_roster(spark, sf), PARAMS)
    )


@query
def summary_lineitem(spark, sf):
    return summary.rollup_metrics(
        pipeline.fact_of(lineitem_as_maintenance(spark, sf), suppliers_as_roster(spark, sf), PARAMS)
    )


@query
def summary_by_factory(spark, sf):
    return summary.rollup_metrics(_events_fact(spark, sf), ["factory_id", "event_year_month"])


# --- clean -----------------------------------------------------------------


@query
def local_to_utc_events(spark, sf):
    return _cleaned(spark, sf).select(
        "event_id",
        "start_time_utc",
        "end_time_utc",
        day_text(F.col("start_time_utc")).alias("event_date"),
        month_text(F.col("start_time_utc")).alias("event_year_month"),
    )


@query
def local_to_utc_seasons(spark, sf):
    utc = local_to_utc(F.col("l_shipdate"), TimestampNTZType(), PARAMS.source_zone)
    return table(spark, sf, "lineitem").groupBy(utc.alias("ship_utc")).count()


@query
def local_to_utc_defects(spark, sf):
    cleaned = clean.clean_events(defective_events(spark, sf), PARAMS)
    return cleaned.select("start_time", "start_time_utc", "end_time", "end_time_utc")


@query
def parts_lists(spark, sf):
    return _cleaned(spark, sf).select(
        "event_id", F.array_join("parts_list", ";").alias("parts"), "parts_count"
    )


@query
def parts_lists_filled(spark, sf):
    return clean.fill_parts(clean.add_parts(events_as_maintenance(spark, sf))).select(
        "event_id", F.array_join("parts_list", ";").alias("parts"), "parts_count"
    )


@query
def parts_usage(spark, sf):
    return (
        _cleaned(spark, sf).select(F.explode("parts_list").alias("part")).groupBy("part").count()
    )


@query
def classify_events(spark, sf):
    return clean.clean_events(defective_events(spark, sf), PARAMS).select(
        "event_id", "reason", "is_unplanned", minutes(), "downtime_category"
    )


@query
def quality_flags(spark, sf):
    return _cleaned(spark, sf).select("event_id", "cost_eur", "data_quality_flags")


@query
def cost_quality(spark, sf):
    e = events_as_maintenance(spark, sf)
    return e.groupBy(clean.cost_quality(F.col("cost_eur")).alias("cost_data_quality")).count()


@query
def trim_strings(spark, sf):
    return clean.trim_strings(defective_events(spark, sf)).withColumn("downtime_min", minutes())


@query
def clamp_downtime(spark, sf):
    d = F.col("downtime_min")
    both = defective_events(spark, sf).withColumn("clamped", clean.clamp_non_negative(d))
    return both.select("event_id", "start_time", minutes(), minutes("clamped"))


@query
def cost_quality_labels(spark, sf):
    """All three labels: some events were free, some are not billed yet."""
    n = F.substring("event_id", 4, 20).cast("bigint")
    cost = F.when(n % 7 == 3, 0.0).otherwise(F.col("cost_eur"))
    e = events_as_maintenance(spark, sf).withColumn("cost_eur", cost)
    return e.groupBy(clean.cost_quality(F.col("cost_eur")).alias("cost_data_quality")).count()


# --- enrich ----------------------------------------------------------------


def _enriched(spark: SparkSession, sf: str, strategy: str = "auto", params=PARAMS) -> DataFrame:
    return enrich.enrich_events(
        events_as_maintenance(spark, sf), suppliers_as_roster(spark, sf), params, strategy=strategy
    )


_ENRICHED = (
    "event_id",
    "technician_id",
    "technician_found",
    "operator_skill_level",
    "operator_reliability",
)


@query
def enrich_operators(spark, sf):
    return _enriched(spark, sf).select(*_ENRICHED)


SPREAD = Params(run_ts=PARAMS.run_ts, joins=JoinLimits(rows_per_task=100))


def hot_technicians(spark: SparkSession, sf: str) -> DataFrame:
    """Events of which a third have one technician, and a tenth none."""
    n = F.substring("event_id", 4, 20).cast("bigint")
    hot = F.when(n % 3 == 0, "1").when(n % 10 == 1, None).otherwise(F.col("technician_id"))
    return events_as_maintenance(spark, sf).withColumn("technician_id", hot)


@query
def enrich_operators_spread(spark, sf):
    """The hot technician's rows are split over many tasks, as a test asserts."""
    return enrich.enrich_events(
        hot_technicians(spark, sf), suppliers_as_roster(spark, sf), SPREAD, strategy="spread"
    ).select(*_ENRICHED)


@query
def enrich_operators_by_suffix(spark, sf):
    """Keys that agree only after normalising: 'TECH-007' against 's7'."""
    events = events_as_maintenance(spark, sf).withColumn(
        "technician_id", F.concat(F.lit("TECH-00"), "technician_id")
    )
    roster = suppliers_as_roster(spark, sf).withColumn(
        "operator_id", F.concat(F.lit("s"), "operator_id")
    )
    return enrich.enrich_events(
        events, roster, PARAMS, normalise=lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("int")
    ).select(*_ENRICHED)


@query
def roster_one_per_key(spark, sf):
    """A roster with many rows per operator reduced to one each."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("operator_id"),
        F.col("l_returnflag").alias("skill_level"),
        (F.col("l_quantity") + F.col("l_tax")).alias("reliability_score"),
    )
    return joins.one_per_key(rows, "operator_id", ["reliability_score"])


@query
def match_rate(spark, sf):
    return enrich.match_rate(_enriched(spark, sf))


@query
def unmatched_technicians(spark, sf):
    return enrich.unmatched_keys(
        events_as_maintenance(spark, sf),
        suppliers_as_roster(spark, sf),
        "technician_id",
        "operator_id",
    )


# --- fact measures ---------------------------------------------------------


@query
def cost_per_downtime(spark, sf):
    return lineitem_as_maintenance(spark, sf).select(
        "event_id",
        "cost_eur",
        "downtime_min",
        fact.unit_cost(F.col("cost_eur"), F.col("downtime_min")).alias("cost_per_downtime_min"),
    )


@query
def severity_mix(spark, sf):
    level = fact.severity(F.col("cost_eur"), F.col("downtime_min"), PARAMS.severity)
    return (
        lineitem_as_maintenance(spark, sf)
        .groupBy(level.alias("severity_level"), "maintenance_type")
        .count()
    )


@query
def days_to_due(spark, sf):
    days = fact.days_to_due(F.col("next_due_date"), F.col("start_time_utc"))
    return _cleaned(spark, sf).select("event_id", days.alias("days_to_next_due"))


# --- key figures -----------------------------------------------------------


@query
def kpi_cost(spark, sf):
    return kpis.cost(defective_events(spark, sf))


@query
def kpi_downtime(spark, sf):
    return kpis.downtime(defective_events(spark, sf))


@query
def kpi_composition(spark, sf):
    return kpis.composition(defective_events(spark, sf))


@query
def kpi_unplanned(spark, sf):
    return kpis.unplanned(defective_events(spark, sf))


@query
def kpi_distribution(spark, sf):
    return kpis.downtime_distribution(defective_events(spark, sf))


def _kpi_sql(name: str) -> Query:
    return lambda spark, sf: kpis.sql(spark, name, defective_events(spark, sf))


for _name in kpis.SQL:
    register(f"kpi_{_name}_sql", _kpi_sql(_name))


@query
def kpi_efficiency(spark, sf):
    return kpis.efficiency(lineitem_as_maintenance(spark, sf))


@query
def costs_unrounded(spark, sf):
    """Costs with fractions of a cent, summed as they are."""
    e = table(spark, sf, "events").select(
        (F.col("value") / 7).alias("cost_eur"),
        F.col("event_type").alias("maintenance_type"),
        F.lit(1).alias("downtime_min"),
        F.lit(False).alias("is_unplanned_breakdown"),
    )
    return summary.rollup_metrics(e, ["maintenance_type"]).select(
        "maintenance_type", "event_count", "total_cost_eur", "avg_cost_eur"
    )


@query
def kpi_report(spark, sf):
    return _flat_report(spark, sf, ["cost", "breakdown"])


@query
def kpi_report_others(spark, sf):
    return _flat_report(spark, sf, ["downtime", "efficiency", "distribution"])


def _flat_report(spark, sf, which):
    """Several figures from one pass, flattened as figure_metric."""
    row = kpis.report(lineitem_as_maintenance(spark, sf), which)
    return row.select(
        *[
            F.col(f"{f.name}.{m}").alias(f"{f.name}_{m}")
            for f in row.schema.fields
            for m in f.dataType.fieldNames()
        ]
    )


@query
def share_of_total(spark, sf):
    return kpis.share_of_total(lineitem_as_maintenance(spark, sf))


@query
def downtime_variation_merged(spark, sf):
    """From the moments of each line and month, added up without the events."""
    events = events_as_maintenance(spark, sf).withColumn("month", F.substring("start_time", 1, 7))
    return kpis.variation_of(kpis.downtime_moments(events, ["line_id", "month"]))


@query
def composition_merged(spark, sf):
    """Stored sketches of each month, merged: estimates within 2% of the exact counts."""
    path = scratch(spark, "sketches")
    events = defective_events(spark, sf).withColumn("month", F.substring("start_time", 1, 7))
    export.write(kpis.composition_sketches(events, ["month"]), path)
    got = kpis.composition_of(spark.read.parquet(path))
    exact = kpis.composition(events).toDF("all", *[f"exact_{c}" for c in got.columns[1:]])
    near = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.02 * F.col(f"exact_{c}")).alias(c) for c in got.columns[1:]]
    return got.join(exact, F.col("total_events") == F.col("all")).select("total_events", *near)


@query
def downtime_variation(spark, sf):
    return kpis.downtime_variation(events_as_maintenance(spark, sf))


# --- quality ---------------------------------------------------------------

# The plant's own ranges do not fit the test tables; these hold at every size.
_ROWS = ExpectedRows(events=(90, 100), production=(1000, 10**12), roster=(1, 10**9))


def _event_report(spark, sf):
    return quality.evaluate(defective_events(spark, sf), "events", quality.event_rules(_ROWS))


def _production_report(spark, sf):
    return quality.evaluate(
        lineitem_as_production(spark, sf), "production", quality.production_rules(_ROWS)
    )


def _roster_report(spark, sf):
    return quality.evaluate(
        suppliers_as_roster(spark, sf), "roster", quality.roster_rules(_ROWS)
    )


register("quality_events", _event_report)
register("quality_production", _production_report)
register("quality_roster", _roster_report)


@query
def quality_times(spark, sf):
    cleaned = clean.clean_events(defective_events(spark, sf), PARAMS)
    return quality.evaluate(cleaned, "events", quality.time_rules())


@query
def quality_time_texts(spark, sf):
    events = defective_events(spark, sf)
    return quality.evaluate(events, "events", quality.time_text_rules(events))


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def rule_violations(spark, sf):
    bad = quality.violations(defective_events(spark, sf), quality.event_rules())
    return bad.select(
        "event_id",
        "start_time",
        "technician_id",
        F.concat_ws("|", "failed_rules").alias("failed_rules"),
    )


@query
def rule_violations_spread(spark, sf):
    """Repeated and missing ids have more rows than a task takes here."""
    bad = quality.violations(
        defective_events(spark, sf), quality.event_rules(), "spread", rows_per_task=5
    )
    return bad.select(
        "event_id",
        "start_time",
        "technician_id",
        F.concat_ws("|", "failed_rules").alias("failed_rules"),
    )


@query
def quality_gate(spark, sf):
    reports = [f(spark, sf) for f in (_event_report, _production_report, _roster_report)]
    return quality.gate_status(reduce(DataFrame.unionByName, reports))


@query
def gate_verdict(spark, sf):
    """What the gate says of each table alone: it warns of errors and goes on."""
    found = []
    for report in (_event_report, _production_report, _roster_report):
        for name, checked in quality.summaries(report(spark, sf)).items():
            try:
                verdict = "passed" if quality.gate([checked]) else "failed"
            except quality.QualityError:
                verdict = "stopped"
            found.append((name, verdict, checked["total_rows"]))
    return spark.createDataFrame(found, "`table` string, verdict string, total_rows bigint")


@query
def required_columns(spark, sf):
    df = defective_events(spark, sf).drop("factory_id")
    columns = ["event_id", "factory_id", "maintenance_type"]
    return quality.evaluate(df, "events", quality.required_columns(df, columns))


@query
def output_checks(spark, sf):
    return quality.evaluate(
        _events_fact(spark, sf), "fact", quality.fact_rules(rows=(90, 100))
    )


@query
def metric_bands(spark, sf):
    rules = quality.fact_rules(rows=(1, 10**12), total_cost=(169_000, 170_000))
    return quality.evaluate(_events_fact(spark, sf), "fact", rules)


@query
def metric_inside_band(spark, sf):
    rules = quality.fact_rules(rows=(1, 10**12), total_cost=(0, 10**15))
    return quality.evaluate(_events_fact(spark, sf), "fact", rules)


def _fine_events(spark, sf, text: bool):
    """Every third event ends a quarter of a second early; as timestamps or as text."""
    early = F.substring("event_id", 4, 20).cast("bigint") % 3 == 0
    start = F.col("start_time").cast("timestamp_ntz") + F.expr("interval '0.5' second")
    end = start - F.expr("interval '0.25' second")
    events = events_as_maintenance(spark, sf)
    times = {"start_time": start, "end_time": F.when(early, end).otherwise(start)}
    return events.withColumns({c: t.cast("string") if text else t for c, t in times.items()})


@query
def quality_fractions(spark, sf):
    """Ends before starts by a fraction of a second are found in timestamps and in text."""
    rules = [r for r in quality.event_rules() if r.name == "end_before_start"]
    parts = [quality.evaluate(_fine_events(spark, sf, t), n, rules) for n, t in (("stamps", False), ("texts", True))]
    return reduce(DataFrame.unionByName, parts)


@query
def metric_exact_band(spark, sf):
    """Each event with two large costs that cancel: the total is the number of events, to the cent."""
    costs = F.explode(F.array(F.lit(1e16), F.lit(1.0), F.lit(-1e16))).alias("cost_eur")
    events = events_as_maintenance(spark, sf).select("event_id", costs)
    n = table(spark, sf, "events").count()
    rules = [quality.Metric("total_cost", quality.exact_total("cost_eur"), n, n)]
    return quality.evaluate(events, "fact", rules)


# --- alerts and presentation -------------------------------------------------


@query
def event_alerts(spark, sf):
    found = alerts.event_alerts(lineitem_as_maintenance(spark, sf), AlertLimits(5000, 40))
    return found.select(
        "event_id",
        "cost_eur",
        "downtime_min",
        F.concat_ws("|", "alert_reasons").alias("alert_reasons"),
    )


@query
def event_alerts_default(spark, sf):
    found = alerts.event_alerts(events_as_maintenance(spark, sf))
    return found.select(
        "event_id", "downtime_min", F.concat_ws("|", "alert_reasons").alias("alert_reasons")
    )


@query
def breakdown_alerts(spark, sf):
    return alerts.breakdown_rate(maintenance_summary(spark, sf)).select(
        "factory_id", "line_id", "maintenance_type", "event_date", "unplanned_count",
        "unplanned_pct",
    )


@query
def top_events_presented(spark, sf):
    df = lineitem_as_maintenance(spark, sf).select(
        "event_id", "start_time", "technician_id", "parts_used", "cost_eur", "downtime_min"
    )
    order = ["-cost_eur", *[c for c in df.columns if c != "cost_eur"]]
    return export.present(df, order, PARAMS.result_limit, PARAMS.precision)


@query
def top_events_narrowed(spark, sf):
    """The same report, with the rows that cannot be in it left out before the sort."""
    df = lineitem_as_maintenance(spark, sf).select("event_id", "cost_eur", "downtime_min")
    return export.present(df, ["-cost_eur", "event_id", "downtime_min"], PARAMS.result_limit, PARAMS.precision, narrow=True)


@query
def top_groups_presented(spark, sf):
    order = ["-total_cost_eur", *SUMMARY_KEYS]
    return export.present(summary_lineitem(spark, sf), order, 1000, PARAMS.precision, narrow=False)


# --- sources and sinks -------------------------------------------------------


@query
def csv_safe(spark, sf):
    return export.csv_safe(_events_fact(spark, sf).drop("load_timestamp"))


@query
def read_csv_table(spark, sf):
    path = scratch(spark, "events")
    export.write(events_as_maintenance(spark, sf), path, "csv")
    return read_table(spark, path, EVENTS, "csv")


@query
def read_csv_checked_values(spark, sf):
    """Downtimes of a third of the events arrive as text that is no number."""
    path = scratch(spark, "events")
    d = F.col("downtime_min")
    bad = F.when(d % 9 == 0, F.concat(d.cast("string"), F.lit(" min"))).otherwise(d.cast("string"))
    export.write(events_as_maintenance(spark, sf).withColumn("downtime_min", bad), path, "csv")
    read = read_csv_checked(spark, path, EVENTS)
    return read.groupBy("unreadable_columns").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(minutes()).alias("downtime_min"),
        F.count("next_due_date").alias("dated"),
    )


def _shuffled_csv(spark, sf, *more: Column) -> str:
    """The events as CSV, columns from last to first, and more of them in front."""
    path = scratch(spark, "events")
    events = events_as_maintenance(spark, sf)
    export.write(events.select(*more, *reversed(events.columns)), path, "csv")
    return path


@query
def read_csv_reordered(spark, sf):
    read = read_csv_checked(spark, _shuffled_csv(spark, sf), EVENTS)
    return read.drop("unreadable_columns")


@query
def read_csv_extra_columns(spark, sf):
    more = [F.lit("x").alias("plant code"), F.lit(1.5).alias("weight")]
    read = read_csv_checked(spark, _shuffled_csv(spark, sf, *more), EVENTS)
    return read.drop("unreadable_columns")


@query
def read_csv_malformed(spark, sf):
    """A fifth of the rows lack fields, another has too many."""
    path = scratch(spark, "events")
    names = ["event_id", "line_id", "downtime_min", "cost_eur"]
    events = events_as_maintenance(spark, sf).select(*names)
    n = F.substring("event_id", 4, 20).cast("bigint") % 5
    line = F.concat_ws(",", *names[:3])
    line = F.when(n == 0, F.concat_ws(",", *names[:2])).when(n == 1, F.concat(line, F.lit(",1.5,9"))).otherwise(
        F.concat(line, F.lit(",2.5"))
    )
    # The low 33 bits of the id that Spark gives a row are its place in its task, so each
    # file begins with the header.
    begins = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows = events.select(line.alias("value")).repartition("value")
    rows.select(F.when(begins, F.concat(F.lit(",".join(names) + "\n"), "value")).otherwise(F.col("value"))).write.text(path)
    schema = StructType([EVENTS[c] for c in names])
    read = read_csv_checked(spark, path, schema)
    return read.groupBy("unreadable_columns").agg(F.count(F.lit(1)).alias("rows"))


@query
def pipeline_rerun_month(spark, sf):
    """One month stored, then a later file with a late event of that month and one across its end."""
    out = scratch(spark, "run")
    events = events_as_maintenance(spark, sf)
    n = F.substring("event_id", 4, 20).cast("bigint")
    first = F.substring("start_time", 9, 2) <= "15"
    roster = suppliers_as_roster(spark, sf)
    for part in (events.where(first), events.where(~first | (n % 10 == 0))):
        tables = {"events": part, "roster": roster}
        pipeline.run(
            spark, tables, out, PARAMS, formats=("parquet",),
            partition_by=("event_year_month",), replace_partitions_only=True,
        )
    stored = read_table(spark, f"{out}/fact_maintenance_events.parquet", FACT)
    return flat_fact(stored.select(*FACT.fieldNames()))


def _runs(spark, sf, *parts, **options) -> str:
    """The fact after several loads into one table, period by period."""
    out = scratch(spark, "run")
    for part in parts:
        tables = {"events": part, "roster": suppliers_as_roster(spark, sf)}
        pipeline.run(
            spark, tables, out, PARAMS,
            **{"formats": ("parquet",), "partition_by": ("event_year_month",), "replace_partitions_only": True, **options},
        )
    return out


def _stored_fact(spark, out: str) -> DataFrame:
    return flat_fact(read_table(spark, f"{out}/fact_maintenance_events.parquet", FACT).select(*FACT.fieldNames()))


def _later_by_a_month(events: DataFrame, which: Column) -> DataFrame:
    """Events whose times are 31 days later where the condition holds."""
    late = lambda c: clock_text(F.col(c).cast("timestamp_ntz") + F.expr("interval 31 days"))
    return events.withColumns({c: F.when(which, late(c)).otherwise(F.col(c)) for c in ("start_time", "end_time")})


@query
def pipeline_rerun_moved(spark, sf):
    """All events stored, then a seventh of them sent again with a month's delay: each is there once."""
    events = events_as_maintenance(spark, sf)
    seventh = F.substring("event_id", 4, 20).cast("bigint") % 7 == 0
    moved = _later_by_a_month(events, F.lit(True)).where(seventh)
    return _stored_fact(spark, _runs(spark, sf, events, moved))


@query
def pipeline_rerun_gaps(spark, sf):
    """Events without id and with unreadable times, sent in two loads of which one comes twice."""
    n = F.substring("event_id", 4, 20).cast("bigint")
    events = events_as_maintenance(spark, sf)
    events = events.withColumns({
        "reason": F.concat("reason", F.lit(" "), "event_id"),
        "start_time": F.when(n % 5 == 0, "unknown").otherwise(F.col("start_time")),
        "event_id": F.when(n % 4 == 0, None).otherwise(F.col("event_id")),
    })
    second = events.where(F.substring_index("reason", "-", -1).cast("bigint") % 3 == 0)
    return _stored_fact(spark, _runs(spark, sf, events, second, second))


@query
def pipeline_rerun_summary(spark, sf):
    """The summary after two loads, kept up from stored partial aggregates."""
    events = events_as_maintenance(spark, sf)
    late = F.substring("event_id", 4, 20).cast("bigint") % 5 == 0
    out = _runs(spark, sf, events.where(~late), events.where(late))
    return spark.read.parquet(f"{out}/summary_maintenance_metrics.parquet").select(*SUMMARY.fieldNames())


@query
def ingest_repeats(spark, sf):
    """A file, then one that sends a third of its events again: what is stored, and what is reported."""
    folder, path = scratch(spark, "in"), scratch(spark, "fact")
    checkpoint = scratch(spark, "checkpoint")
    events = events_as_maintenance(spark, sf)
    n = F.substring("event_id", 4, 20).cast("bigint")
    for part in (events.where(n % 2 == 0), _later_by_a_month(events, n % 2 == 0).where((n % 2 == 1) | (n % 6 == 0))):
        export.write(part, folder, mode="append")
        ingest_new_files(spark, folder, suppliers_as_roster(spark, sf), path, checkpoint, PARAMS, "parquet").awaitTermination()
    stored = read_table(spark, path, FACT, "parquet").withColumn("outcome", F.lit("stored"))
    repeats = read_repeats(spark, path).withColumn("outcome", F.col("repeats"))
    rows = [df.select("outcome", "maint_event_id", "start_timestamp") for df in (stored, repeats)]
    return reduce(DataFrame.unionByName, rows)


@query
def parquet_lookup(spark, sf):
    """A few ids found in files that are clustered by id and have Bloom filters."""
    path = scratch(spark, "fact")
    export.write(_events_fact(spark, sf), path, partition_by=["event_year_month"], cluster_by=["maint_event_id"], bloom=["maint_event_id"])
    ids = [f"EV-{n}" for n in (0, 7, 77, 777, 10**9)]
    return flat_fact(rows_with(spark, path, "maint_event_id", ids, FACT).select(*FACT.fieldNames()))


@query
def csv_texts_roundtrip(spark, sf):
    """Texts with line breaks, quotes and backslashes, written as CSV and read again."""
    path = scratch(spark, "texts")
    text = F.concat(F.lit(' \\"'), "text", F.lit('\r\n,"\\'))
    export.write(table(spark, sf, "documents").select("doc_id", text.alias("text"), "n_chars"), path, "csv")
    schema = table(spark, sf, "documents").select("doc_id", "text", "n_chars").schema
    read = read_csv_checked(spark, path, schema)
    return read.select("doc_id", F.sha2("text", 256).alias("text"), "n_chars", "unreadable_columns")


@query
def write_formats(spark, sf):
    """What becomes of a write in each format: the rows stored, or the refusal, which stores none."""
    events = events_as_maintenance(spark, sf)
    out = []
    for fmt in ("parquet", "csv", "orc", "json", "PARQUET", ""):
        path = scratch(spark, "formats")
        try:
            out.append((fmt, export.write(events, path, fmt), False))
        except ValueError as e:
            out.append((fmt, 0, "unsupported format" in str(e) and not exists(spark, path)))
    return spark.createDataFrame(out, "format string, `rows` bigint, refused boolean")


@query
def parquet_roundtrip(spark, sf):
    path = scratch(spark, "fact")
    export.write(_events_fact(spark, sf), path, partition_by=["event_year_month"])
    return flat_fact(read_table(spark, path, FACT).select(*FACT.fieldNames()))


@query
def parquet_append(spark, sf):
    """Two writes to one table: counts per save must add up."""
    path = scratch(spark, "fact")
    rows = _events_fact(spark, sf).select("maint_event_id", "line_id", "event_date")
    export.write(rows, path, mode="overwrite")
    export.write(rows, path, mode="append")
    export.write(rows, path, mode="ignore")
    return read_table(spark, path, rows.schema).groupBy("line_id").count()


@query
def pipeline_summary(spark, sf):
    """The whole run with its writes; the stored summary read back."""
    out = scratch(spark, "run")
    tables = {
        "events": lineitem_as_maintenance(spark, sf),
        "production": lineitem_as_production(spark, sf),
        "roster": suppliers_as_roster(spark, sf),
    }
    report = pipeline.run(spark, tables, out, PARAMS)
    return read_table(spark, report.outputs["summary_parquet"], SUMMARY)


@query
def pipeline_fact_csv(spark, sf):
    """The whole run with its writes; the stored fact CSV read back as text."""
    out = scratch(spark, "run")
    tables = {"events": events_as_maintenance(spark, sf), "roster": suppliers_as_roster(spark, sf)}
    report = pipeline.run(spark, tables, out, PARAMS)
    text = ", ".join(f"{c} string" for c in FACT.fieldNames())
    return read_table(spark, report.outputs["fact_csv"], text, "csv").select(
        "maint_event_id", "start_timestamp", "cost_per_downtime_min", "parts_list",
        "data_quality_flags", "technician_in_roster", "load_timestamp",
    )


@query
def pipeline_summary_csv(spark, sf):
    """The whole run with its writes; the stored summary CSV read back."""
    out = scratch(spark, "run")
    tables = {"events": lineitem_as_maintenance(spark, sf), "roster": suppliers_as_roster(spark, sf)}
    report = pipeline.run(spark, tables, out, PARAMS)
    return read_csv_checked(spark, report.outputs["summary_csv"], SUMMARY).drop("unreadable_columns")


@query
def pipeline_row_counts(spark, sf):
    """How many rows the run read and stored."""
    tables = {
        "events": events_as_maintenance(spark, sf),
        "production": lineitem_as_production(spark, sf),
        "roster": suppliers_as_roster(spark, sf),
    }
    report = pipeline.run(spark, tables, scratch(spark, "run"), PARAMS, formats=("parquet",))
    return spark.createDataFrame(sorted(report.row_counts.items()), "name string, row_count bigint")


@query
def pipeline_plant_rows(spark, sf):
    """The plant's own row ranges stop a run over other tables, and name what is outside."""
    params = Params(run_ts=PARAMS.run_ts, expected_rows=PLANT_ROWS)
    tables = {
        "events": events_as_maintenance(spark, sf),
        "production": lineitem_as_production(spark, sf),
        "roster": suppliers_as_roster(spark, sf),
    }
    report = pipeline.run(spark, tables, scratch(spark, "run"), params, raise_errors=False)
    outside = [(report.status, n, "row_count" in v["issues"]) for n, v in report.validations.items()]
    return spark.createDataFrame(outside, "status string, `table` string, outside boolean")
