"""Daily metrics per line and maintenance type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.money import exact_sum, half_up, mean, rest_sum, total
from millwright.schemas import SUMMARY_KEYS


def partial_metrics(fact: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """Counts and sums per group, which ``merged`` adds up and ``metrics`` turns into figures.

    One hash aggregate: every partial is a count or a sum, so a group holding a
    large share of the rows is combined before the shuffle.
    """
    cost = F.col("cost_eur")
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("downtime_min").alias("downtime"),
        F.count("downtime_min").alias("timed"),
        exact_sum(cost).alias("exact"),
        rest_sum(cost).alias("rest"),
        F.count(cost).alias("costed"),
        F.count_if("is_unplanned_breakdown").alias("unplanned"),
    )


PARTIALS = ("events", "downtime", "timed", "exact", "rest", "costed", "unplanned")


def merged(partials: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """Partials of several tables, or at finer keys, added up."""
    sums = {c: F.sum(c) for c in PARTIALS}
    sums["exact"] = sums["exact"].cast(partials.schema["exact"].dataType)
    return partials.groupBy(*keys).agg(*[s.alias(c) for c, s in sums.items()])


def metrics(partials: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """The summary's figures from one row of partials per group."""
    parts, events = (F.col("exact"), F.col("rest")), F.col("events")
    timed = F.nullif(F.col("timed"), F.lit(0)).cast("double")
    return partials.select(
        *keys,
        events.alias("event_count"),
        F.col("downtime").alias("total_downtime_min"),
        (F.col("downtime").cast("double") / timed).alias("avg_downtime_min"),
        total(*parts).alias("total_cost_eur"),
        mean(*parts, F.col("costed")).alias("avg_cost_eur"),
        F.col("unplanned").alias("unplanned_count"),
        half_up(F.col("unplanned") * 100, events, 2).cast("decimal(5,2)").alias("unplanned_pct"),
    )


def rollup_metrics(fact: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """Event, downtime, cost and breakdown metrics per group."""
    return metrics(partial_metrics(fact, keys), keys)
