"""Declarative quality rules, evaluated together.

All predicate, row-count and metric rules of a table share one aggregate over
one scan. A uniqueness rule needs the rows regrouped by key, so each adds one
aggregate that shuffles the key column only. As in SQL, a comparison with NULL
is unknown and so never a violation.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millwright.functions.text import column, quoted
from millwright.functions.money import exact_sum, rest_sum, total
from millwright.functions.times import FINE_LAYOUT, TIME_LAYOUT
from millwright.operators.joins import left_lookup
from millwright.params import ExpectedRows
from millwright.sinks.scratch import checkpointed

log = logging.getLogger(__name__)

# A violated warn rule is only reported, an error rule fails its table, and a
# fatal rule stops the flow whatever the gate is told.
FATAL, ERROR, WARN = "fatal", "error", "warn"


@dataclass(frozen=True)
class Check:
    """Rows for which the SQL predicate ``violated`` is true."""

    name: str
    violated: str
    severity: str = ERROR


@dataclass(frozen=True)
class Unique:
    """Distinct keys that occur more than once; NULL counts as a key."""

    name: str
    key: tuple[str, ...]
    severity: str = ERROR


@dataclass(frozen=True)
class RowCount:
    """One violation if the number of rows is outside ``[low, high]``."""

    name: str
    low: int
    high: int
    severity: str = FATAL


@dataclass(frozen=True)
class Metric:
    """One violation if an aggregate, as SQL or made by a function, is NULL or outside ``[low, high]``."""

    name: str
    aggregate: str | Callable[[], Column]
    low: float
    high: float
    severity: str = ERROR


Rule = Check | Unique | RowCount | Metric


def not_null(*columns: str, severity: str = ERROR) -> list[Rule]:
    return [Check(f"null_{c}", f"{quoted(c)} IS NULL", severity) for c in columns]


def required_columns(df: DataFrame, columns: Sequence[str]) -> list[Rule]:
    """Presence and non-NULL rules; an absent column is one violation."""
    present = set(df.columns)
    absent = [Metric(f"absent_{c}", "0", 1, 1) for c in columns if c not in present]
    return [*absent, *not_null(*[c for c in columns if c in present])]


def row_count_rules(name: str, bounds: tuple[int, int] | None) -> list[Rule]:
    return [RowCount(name, *bounds)] if bounds else []


def _time(name: str) -> str:
    """A time column as a timestamp: text of the layout, with a fraction or without, or as it is."""
    text = f"trim(CAST({name} AS STRING))"
    read = f"CASE WHEN {text} RLIKE r'{FINE_LAYOUT}' THEN try_cast({text} AS timestamp_ntz) END"
    return f"CASE WHEN typeof({name}) = 'string' THEN {read} ELSE CAST({name} AS timestamp_ntz) END"


def event_rules(expected: ExpectedRows = ExpectedRows()) -> list[Rule]:
    return [
        *row_count_rules("row_count", expected.events),
        Unique("duplicate_event_id", ("event_id",)),
        Check("end_before_start", f"{_time('end_time')} < {_time('start_time')}"),
        Check("negative_cost", "cost_eur < 0", WARN),
        Check("cost_not_finite", "isnan(cost_eur) OR abs(cost_eur) = double('Infinity')"),
        Check("negative_downtime", "downtime_min < 0", WARN),
        *not_null("event_id", "start_time", "end_time", "downtime_min"),
    ]


def time_rules() -> list[Rule]:
    """Cleaned events: a time that was given but could not be read."""
    return [
        Check(f"unparseable_{c}", f"{c} IS NOT NULL AND {c}_utc IS NULL")
        for c in ("start_time", "end_time")
    ]


def time_text_rules(df: DataFrame, columns: Sequence[str] = ("start_time", "end_time")) -> list[Rule]:
    """Raw events: the same as ``time_rules``, for the columns that are still text."""
    return [
        Check(
            f"unparseable_{c}",
            f"{quoted(c)} IS NOT NULL AND NOT (trim({quoted(c)}) RLIKE r'{TIME_LAYOUT}'"
            f" AND try_cast(trim({quoted(c)}) AS timestamp_ntz) IS NOT NULL)",
        )
        for c in columns
        if isinstance(df.schema[c].dataType, StringType)
    ]


def unreadable_rules(column: str = "unreadable_columns") -> list[Rule]:
    """Rows of a checked CSV read in which some value did not convert."""
    return [Check("unreadable_values", f"{column} <> ''", WARN)]


def production_rules(expected: ExpectedRows = ExpectedRows()) -> list[Rule]:
    return [
        *row_count_rules("row_count", expected.production),
        *[
            Check(f"{c}_out_of_range", f"{c} < 0 OR {c} > 1")
            for c in ("availability", "performance", "quality")
        ],
        Check("produced_over_planned", "produced_qty > planned_qty", WARN),
    ]


def roster_rules(expected: ExpectedRows = ExpectedRows()) -> list[Rule]:
    return [
        *row_count_rules("row_count", expected.roster),
        Unique("duplicate_operator_id", ("operator_id",)),
        Check(
            "reliability_out_of_range",
            "reliability_score < 0 OR reliability_score > 100",
            WARN,
        ),
    ]


def fact_rules(
    rows: tuple[int, int] | None = None, total_cost: tuple[float, float] | None = None
) -> list[Rule]:
    """Output checks: no negative cost, no missing id, row count and total in band."""
    return [
        *row_count_rules("row_count", rows),
        Check("negative_cost", "cost_eur < 0"),
        *not_null("maint_event_id"),
        *([Metric("total_cost", exact_total("cost_eur"), *total_cost)] if total_cost else []),
    ]


def exact_total(name: str) -> Callable[[], Column]:
    """The total of an amount that no order of rows changes, for a ``Metric``."""
    return lambda: total(exact_sum(column(name)), rest_sum(column(name)))


def _report_row(table: str, rule: Rule, violations: Column, total: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.severity).alias("severity"),
        violations.cast("bigint").alias("violations"),
        total.alias("total_rows"),
        (violations == 0).alias("passed"),
    )


def _one_pass(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    rows = F.count(F.lit(1))

    def violations(rule: Rule) -> Column:
        if isinstance(rule, Check):
            return F.count_if(F.expr(rule.violated))
        if isinstance(rule, RowCount):
            value = rows
        else:
            value = rule.aggregate() if callable(rule.aggregate) else F.expr(rule.aggregate)
        return F.when(value.between(rule.low, rule.high), F.lit(0)).otherwise(F.lit(1))

    counted = df.agg(
        rows.alias("__total"), *[violations(r).alias(f"__v{i}") for i, r in enumerate(rules)]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    _report_row(table, r, F.col(f"__v{i}"), F.col("__total"))
                    for i, r in enumerate(rules)
                ]
            )
        )
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def _uniqueness(df: DataFrame, table: str, rule: Unique) -> DataFrame:
    per_key = df.groupBy(*rule.key).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.count_if(F.col("__n") > 1).alias("__v"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("__total"),
    ).select(F.inline(F.array(_report_row(table, rule, F.col("__v"), F.col("__total")))))


def evaluate(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """One report row per rule: table, rule, severity, violations, total_rows, passed."""
    plain = [r for r in rules if not isinstance(r, Unique)]
    parts = [_one_pass(df, table, plain)] if plain else []
    parts += [_uniqueness(df, table, r) for r in rules if isinstance(r, Unique)]
    if not parts:
        raise ValueError("no rules to evaluate")
    return reduce(DataFrame.unionByName, parts)


def gate_status(reports: DataFrame) -> DataFrame:
    """Per table: passed (no error rule violated) and the violated rules by severity."""
    broken = ~F.col("passed")
    return reports.groupBy("table").agg(
        (F.count_if(broken & (F.col("severity") != WARN)) == 0).alias("passed"),
        F.count_if(broken & (F.col("severity") != WARN)).alias("errors"),
        F.count_if(broken & (F.col("severity") == WARN)).alias("warnings"),
        F.max("total_rows").alias("total_rows"),
    )


def summaries(reports: DataFrame) -> dict[str, dict]:
    """Reports as ``{table: {table, total_rows, passed, issues}}``; collects one row per rule."""
    out: dict[str, dict] = {}
    for r in reports.collect():
        entry = out.setdefault(
            r["table"],
            {
                "table": r["table"],
                "total_rows": r["total_rows"],
                "passed": True,
                "fatal": False,
                "issues": {},
            },
        )
        if not r["passed"]:
            entry["issues"][r["rule"]] = r["violations"]
            entry["passed"] &= r["severity"] == WARN
            entry["fatal"] |= r["severity"] == FATAL
    return out


class QualityError(ValueError):
    """A fatal rule was violated, or an error rule under ``on_fail='raise'``."""


def gate(checked: Iterable[dict], on_fail: str = "warn") -> bool:
    """Whether all tables passed; otherwise warn and go on, or raise."""
    if on_fail not in ("warn", "raise"):
        raise ValueError(f"unknown on_fail: {on_fail}")
    checked = list(checked)
    failed = {c["table"]: c["issues"] for c in checked if not c["passed"]}
    if any(c["fatal"] for c in checked) or (failed and on_fail == "raise"):
        raise QualityError(f"quality rules violated: {failed}")
    if failed:
        log.warning("quality rules violated: %s", failed)
    return not failed


def violations(
    df: DataFrame,
    rules: Sequence[Rule],
    strategy: str = "auto",
    rows_per_task: int = 5_000_000,
) -> DataFrame:
    """Rows that break a row-level rule, with the names in ``failed_rules``.

    Uniqueness rules mark every row of a repeated key, by a left join to the
    repeated keys only; ``strategy`` is that of ``joins.left_lookup``. ``spread``
    finds the repeated keys at once, stores them, and splits the large ones.
    """
    flags = [F.when(F.expr(r.violated), F.lit(r.name)) for r in rules if isinstance(r, Check)]
    columns = df.columns
    for i, rule in enumerate(r for r in rules if isinstance(r, Unique)):
        names = [f"__k{i}_{k}" for k in rule.key]
        repeated = duplicate_keys(df, rule.key).withColumnsRenamed(dict(zip(rule.key, names)))
        if strategy == "spread":
            repeated = checkpointed(repeated)
        df = left_lookup(
            df,
            repeated.select(*names, F.lit(rule.name).alias(f"__dup{i}")),
            [F.col(k) for k in rule.key],
            names,
            strategy,
            rows_per_task,
            null_safe=True,
            key_counts=repeated,
        )
        flags.append(F.col(f"__dup{i}"))
    # Row-count and metric rules speak of no row in particular.
    broken = reduce(lambda a, b: a | b, [f.isNotNull() for f in flags], F.lit(False))
    return df.where(broken).select(
        *columns, F.array_compact(F.array(*flags).cast("array<string>")).alias("failed_rules")
    )
