"""Technician enrichment: a left join that keeps every event."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.money import half_up
from millwright.operators.joins import left_lookup
from millwright.params import Labels, Params

_KEY = "__dim_key"


def left_enrich(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    take: dict[str, tuple[str, object]],
    found: str,
    normalise: Callable[[Column], Column] | None = None,
    strategy: str = "auto",
    rows_per_task: int = 5_000_000,
) -> DataFrame:
    """Add lookup attributes and a match flag to every row of ``facts``.

    ``take`` maps a lookup column to its output name and default; the default
    also replaces a NULL attribute of a matched row. NULL keys match nothing.
    A repeated lookup key repeats its events: check uniqueness first, or reduce
    with ``joins.one_per_key``. ``normalise`` is applied to both keys.
    """
    norm = normalise or (lambda c: c)
    narrow = dim.select(
        norm(F.col(dim_key)).alias(_KEY),
        *[F.col(src).alias(f"__take_{out}") for src, (out, _) in take.items()],
    )
    joined = left_lookup(
        facts, narrow, [norm(F.col(fact_key))], [_KEY], strategy, rows_per_task
    )
    attributes = {
        out: F.coalesce(F.col(f"__take_{out}"), F.lit(default)) for out, default in take.values()
    }
    return joined.withColumns({found: F.col(_KEY).isNotNull(), **attributes}).drop(
        _KEY, *[f"__take_{out}" for out in attributes]
    )


def enrich_events(
    events: DataFrame,
    roster: DataFrame,
    params: Params = Params(),
    normalise: Callable[[Column], Column] | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Skill and reliability of the technician, with defaults for the unmatched."""
    labels: Labels = params.labels
    return left_enrich(
        events,
        roster,
        "technician_id",
        "operator_id",
        {
            "skill_level": ("operator_skill_level", labels.unknown_skill),
            "reliability_score": ("operator_reliability", labels.default_reliability),
        },
        "technician_found",
        normalise,
        strategy,
        params.joins.rows_per_task,
    )


def match_rate(enriched: DataFrame, found: str = "technician_found") -> DataFrame:
    """One row: total, matched and unmatched rows, and the matched percentage."""
    matched, total = F.count_if(found), F.count(F.lit(1))
    return enriched.agg(
        total.alias("total_events"),
        matched.alias("matched"),
        (total - matched).alias("unmatched"),
        half_up(matched * 100, total, 2).cast("double").alias("match_pct"),
    )


def unmatched_keys(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys missing from the lookup with their event counts.

    Facts shrink to one row per key before the join, so a hot key costs nothing
    there. The NULL key is listed too.
    """
    counts = facts.groupBy(fact_key).agg(F.count(F.lit(1)).alias("event_count"))
    keys = dim.select(F.col(dim_key).alias(_KEY)).where(F.col(_KEY).isNotNull())
    return counts.join(keys, F.col(fact_key) == F.col(_KEY), "left_anti")
