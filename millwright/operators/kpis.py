"""Key figures over raw-shaped events, each one row.

Every figure is a set of conditional aggregates over one scan. The single
figures also filter first, so the condition reaches the scan; ``report`` fuses
several figures into one pass instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.moments import deviation, mean, squares_of, sum_of
from millwright.functions.money import (
    LARGEST,
    exact_sum,
    half_up,
    rest_sum,
    rounded_mean,
    total,
    unit_cost,
)
from millwright.params import Labels


def _mean(total: Column, n: Column, scale: int = 2) -> Column:
    return half_up(total, n, scale).cast("double")


@dataclass(frozen=True)
class _Figure:
    """Aggregates over the rows where ``rows`` holds (all rows if None)."""

    rows: Column | None
    metrics: dict[str, Column]

    def alone(self, events: DataFrame) -> DataFrame:
        kept = events if self.rows is None else events.where(self.rows)
        return kept.agg(*[m.alias(name) for name, m in self.metrics.items()])


def _cost() -> _Figure:
    rows = F.col("cost_eur").isNotNull() & (F.col("cost_eur") >= 0)
    cost = F.when(rows, F.col("cost_eur"))
    parts, n = (exact_sum(cost), rest_sum(cost)), F.count(cost)
    return _Figure(
        rows,
        {
            "total_maintenance_cost": total(*parts),
            "event_count": n,
            "avg_cost_per_event": rounded_mean(*parts, n),
            "min_cost": F.min(cost),
            "max_cost": F.max(cost),
        },
    )


def _downtime() -> _Figure:
    d = F.col("downtime_min")
    return _Figure(
        d.isNotNull(),
        {
            "total_downtime_minutes": F.sum(d),
            "total_productive_downtime_min": F.sum(
                F.when(d > 0, d).when(d.isNotNull(), F.lit(0))
            ),
            "total_events": F.count(d),
            "events_with_downtime": F.count_if(d > 0),
            "monitoring_only_events": F.count_if(d == 0),
            "total_hours": half_up(F.sum(d), F.lit(60), 2).cast("double"),
        },
    )


def _unplanned(labels: Labels) -> _Figure:
    hit = F.col("reason") == labels.unplanned_reason
    d = F.when(hit, F.col("downtime_min"))
    c = F.when(hit, F.col("cost_eur"))
    parts = (exact_sum(c), rest_sum(c))
    return _Figure(
        None,  # the percentage needs every row, so there is no second scan for it
        {
            "unplanned_breakdowns": F.count_if(hit),
            "pct_of_total_events": half_up(
                F.count_if(hit) * 100, F.count(F.lit(1)), 2
            ).cast("double"),
            "total_unplanned_downtime_min": F.sum(d),
            "avg_unplanned_downtime_min": _mean(F.sum(d), F.count(d)),
            "total_unplanned_cost_eur": total(*parts),
            "avg_unplanned_cost_eur": rounded_mean(*parts, F.count(c)),
        },
    )


def _distribution() -> _Figure:
    d = F.col("downtime_min")
    positive = F.when(d > 0, d)
    return _Figure(
        d.isNotNull(),
        {
            "total_events": F.count(d),
            "events_with_downtime": F.count(positive),
            "mean_downtime_min": _mean(F.sum(d), F.count(d)),
            "mean_downtime_excluding_zeros": _mean(F.sum(positive), F.count(positive)),
            "min_downtime_min": F.min(d),
            "max_downtime_min": F.max(d),
            "stddev_downtime_min": F.round(deviation(F.count(d), sum_of(d), squares_of(d)), 2),
        },
    )


def _efficiency() -> _Figure:
    d = F.col("downtime_min")
    rows = (d > 0) & F.col("cost_eur").isNotNull()
    kept = F.when(rows, F.col("cost_eur"))
    per_min = F.when(rows, unit_cost(F.col("cost_eur"), d))
    return _Figure(
        rows,
        {
            "costed_events": F.count(kept),
            "cost_per_downtime_min": rounded_mean(exact_sum(kept), rest_sum(kept), F.sum(F.when(rows, d))),
            "min_cost_per_downtime_min": F.min(per_min),
            "max_cost_per_downtime_min": F.max(per_min),
        },
    )


def cost(events: DataFrame) -> DataFrame:
    """Total, mean and range of the known, non-negative costs."""
    return _cost().alone(events)


def downtime(events: DataFrame) -> DataFrame:
    """Downtime total, its positive part, event counts, and hours."""
    return _downtime().alone(events)


def unplanned(events: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """Breakdown count, share of all events, downtime and cost."""
    return _unplanned(labels).alone(events)


def downtime_distribution(events: DataFrame) -> DataFrame:
    """Mean, mean of the positive values, range and population deviation."""
    return _distribution().alone(events)


def efficiency(events: DataFrame) -> DataFrame:
    """Cost per minute of downtime over events with both."""
    return _efficiency().alone(events)


def downtime_moments(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, sum and sum of squares of downtime per group: what ``variation_of`` adds up."""
    d = F.col("downtime_min")
    return events.groupBy(*by).agg(F.count(d).alias("n"), sum_of(d).alias("s1"), squares_of(d).alias("s2"))


def variation_of(moments: DataFrame) -> DataFrame:
    """Mean, population deviation and coefficient of variation, from the moments of any parts."""
    whole = moments.agg(*[F.sum(c).cast(moments.schema[c].dataType).alias(c) for c in ("n", "s1", "s2")])
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    spread, middle = deviation(n, s1, s2), mean(n, s1)
    return whole.select(
        F.round(middle, 4).alias("mean_downtime_min"),
        F.round(spread, 4).alias("stddev_downtime_min"),
        F.round(spread / F.nullif(middle, F.lit(0.0)) * 100, 2).alias("variation_pct"),
    )


def downtime_variation(events: DataFrame) -> DataFrame:
    """Coefficient of variation of downtime, in percent."""
    return variation_of(downtime_moments(events))


def composition(
    events: DataFrame,
    key: str = "event_id",
    parts: Sequence[str] = ("factory_id", "line_id", "maintenance_type"),
    approx: bool = False,
) -> DataFrame:
    """Events, distinct events, and distinct factories, lines and types.

    Several exact distinct counts in one aggregate copy every row once per
    column. The label columns are instead grouped together first, which combines
    to few rows before the shuffle, and the key is counted by itself.
    ``approx`` answers all of it in one scan without a shuffle of the keys.
    """
    names = [c.removesuffix("_id") + "_count" for c in parts]
    if approx:
        return events.agg(
            F.count(F.lit(1)).alias("total_events"),
            F.approx_count_distinct(key).alias("unique_events"),
            *[F.approx_count_distinct(c).alias(n) for c, n in zip(parts, names)],
        )
    no_count = F.lit(None).cast("bigint")
    labels = (
        events.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("total_events"),
            no_count.alias("unique_events"),
            *[F.count_distinct(c).alias(n) for c, n in zip(parts, names)],
        )
    )
    keys = events.agg(
        no_count.alias("total_events"),
        F.count_distinct(key).alias("unique_events"),
        *[no_count.alias(n) for n in names],
    )
    columns = ["total_events", "unique_events", *names]
    return labels.unionByName(keys).agg(*[F.max(c).alias(c) for c in columns])


#: Of a sketch's buckets, the binary logarithm: 2**14 of them err by 0.8% in the mean.
SKETCH_BITS = 14
_COMPOSED = ("factory_id", "line_id", "maintenance_type")


def composition_sketches(
    events: DataFrame, by: Sequence[str] = (), key: str = "event_id", parts: Sequence[str] = _COMPOSED
) -> DataFrame:
    """Events and one mergeable sketch per counted column and group.

    A sketch has at most 2**SKETCH_BITS bytes however many rows it saw, so a period's can
    be stored and added to others' later without its rows.
    """
    columns = [c for c in (key, *parts) if c not in by]
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{c}_sketch") for c in columns],
    )


def composition_of(sketches: DataFrame, key: str = "event_id", parts: Sequence[str] = _COMPOSED) -> DataFrame:
    """``composition`` from the sketches of any parts: counts of distinct values are estimates."""
    names = {key: "unique_events", **{c: c.removesuffix("_id") + "_count" for c in parts}}
    return sketches.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        *[
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(n)
            for c, n in names.items()
        ],
    )


def share_of_total(events: DataFrame, by: str = "reason") -> DataFrame:
    """Each group's share of all events, downtime and cost, in percent.

    Totals come from the grouped rows as one scalar subquery, whose shuffle is the
    groups' own: no window over the whole result, and no second pass over the events.
    """
    cost = F.col("cost_eur")
    sums = {
        "events": F.count(F.lit(1)),
        "downtime": F.coalesce(F.sum("downtime_min"), F.lit(0)),
        "exact": F.coalesce(exact_sum(cost), F.lit(0).cast("decimal(38,10)")),
        "rest": rest_sum(cost),
    }
    grouped = events.groupBy(by).agg(*[s.alias(f"__{n}") for n, s in sums.items()])
    # One struct, so that the subquery needs all the columns that the groups need: the
    # same aggregate below it, which Spark then runs once.
    whole = grouped.agg(F.struct(*[F.sum(f"__{n}").alias(n) for n in sums]).alias("all")).scalar()
    all_of = {n: whole[n] for n in sums}

    def share(n: str) -> Column:
        return half_up(F.col(f"__{n}") * 100, all_of[n], 2).cast("double").alias(f"{n}_pct")

    # Costs are shares of decimals, or of doubles if some cost has no decimal.
    cost_of_all = F.nullif(all_of["exact"].cast("decimal(38,6)"), F.lit(0))
    decimal_pct = F.round(F.col("__exact").cast("decimal(38,6)") * 100 / cost_of_all, 2).cast("double")
    double_pct = F.round(
        total(F.col("__exact"), F.col("__rest")) * 100 / total(all_of["exact"], all_of["rest"]), 2
    )
    return grouped.select(
        by,
        F.col("__events").alias("event_count"),
        share("events"),
        share("downtime"),
        F.when(all_of["rest"].isNull(), decimal_pct).otherwise(double_pct).alias("cost_pct"),
    )


FIGURES = ("cost", "downtime", "breakdown", "efficiency", "distribution")


def report(
    events: DataFrame, which: Sequence[str] = FIGURES, labels: Labels = Labels()
) -> DataFrame:
    """The chosen figures in one pass: one row, one struct column per figure."""
    figures = {
        "cost": _cost,
        "downtime": _downtime,
        "breakdown": lambda: _unplanned(labels),
        "efficiency": _efficiency,
        "distribution": _distribution,
    }
    unknown = set(which) - set(figures)
    if unknown:
        raise ValueError(f"unknown figures: {sorted(unknown)}")
    return events.agg(
        *[
            F.struct(*[m.alias(n) for n, m in figures[name]().metrics.items()]).alias(name)
            for name in which
        ]
    )


# The same figures as SQL over any events DataFrame.
SQL = {
    "cost": """
        SELECT coalesce(CAST(x AS DOUBLE) + r, CAST(x AS DOUBLE), r) AS total_maintenance_cost,
               n AS event_count,
               CASE WHEN r IS NULL
                    THEN CAST(round(x / CAST(nullif(n, 0) AS DECIMAL(18,0)), 2) AS DOUBLE)
                    ELSE round((coalesce(CAST(x AS DOUBLE), 0) + r) / n, 2) END
                 AS avg_cost_per_event,
               min_cost, max_cost
        FROM (SELECT sum(CASE WHEN abs(cost_eur) < :largest
                              THEN CAST(cost_eur AS DECIMAL(30,10)) END) AS x,
                     sum(CASE WHEN NOT abs(cost_eur) < :largest THEN cost_eur END) AS r,
                     count(cost_eur) AS n, min(cost_eur) AS min_cost, max(cost_eur) AS max_cost
              FROM {events} WHERE cost_eur >= 0)
    """,
    "downtime": """
        SELECT sum(downtime_min) AS total_downtime_minutes,
               sum(greatest(downtime_min, 0)) AS total_productive_downtime_min,
               count(*) AS total_events,
               count_if(downtime_min > 0) AS events_with_downtime,
               count_if(downtime_min = 0) AS monitoring_only_events,
               CAST(round(CAST(sum(downtime_min) AS DECIMAL(20,0)) / 60, 2) AS DOUBLE)
                 AS total_hours
        FROM {events} WHERE downtime_min IS NOT NULL
    """,
    "composition": """
        WITH labels AS (
          SELECT factory_id, line_id, maintenance_type, count(*) AS n
          FROM {events} GROUP BY ALL),
        keys AS (SELECT count(DISTINCT event_id) AS unique_events FROM {events})
        SELECT coalesce(sum(n), 0) AS total_events,
               max(unique_events) AS unique_events,
               count(DISTINCT factory_id) AS factory_count,
               count(DISTINCT line_id) AS line_count,
               count(DISTINCT maintenance_type) AS maintenance_type_count
        FROM keys LEFT JOIN labels ON true
    """,
    "unplanned": """
        SELECT count_if(hit) AS unplanned_breakdowns,
               CAST(round(CAST(count_if(hit) * 100 AS DECIMAL(20,0))
                    / CAST(nullif(count(*), 0) AS DECIMAL(18,0)), 2) AS DOUBLE)
                 AS pct_of_total_events,
               sum(downtime_min) FILTER (WHERE hit) AS total_unplanned_downtime_min,
               CAST(round(CAST(sum(downtime_min) FILTER (WHERE hit) AS DECIMAL(20,0))
                    / CAST(nullif(count(downtime_min) FILTER (WHERE hit), 0)
                           AS DECIMAL(18,0)), 2) AS DOUBLE) AS avg_unplanned_downtime_min,
               coalesce(CAST(sum(x) AS DOUBLE) + sum(r), CAST(sum(x) AS DOUBLE), sum(r))
                 AS total_unplanned_cost_eur,
               CASE WHEN sum(r) IS NULL
                    THEN CAST(round(sum(x) / CAST(nullif(count(x), 0) AS DECIMAL(18,0)), 2)
                              AS DOUBLE)
                    ELSE round((coalesce(CAST(sum(x) AS DOUBLE), 0) + sum(r))
                               / (count(x) + count(r)), 2) END AS avg_unplanned_cost_eur
        FROM (SELECT reason = :unplanned_reason AS hit, downtime_min,
                     CASE WHEN reason = :unplanned_reason AND abs(cost_eur) < :largest
                          THEN CAST(cost_eur AS DECIMAL(30,10)) END AS x,
                     CASE WHEN reason = :unplanned_reason AND NOT abs(cost_eur) < :largest
                          THEN cost_eur END AS r FROM {events})
    """,
    "distribution": """
        SELECT count(*) AS total_events,
               count(pos) AS events_with_downtime,
               CAST(round(CAST(sum(downtime_min) AS DECIMAL(20,0))
                    / CAST(nullif(count(*), 0) AS DECIMAL(18,0)), 2) AS DOUBLE)
                 AS mean_downtime_min,
               CAST(round(CAST(sum(pos) AS DECIMAL(20,0))
                    / CAST(nullif(count(pos), 0) AS DECIMAL(18,0)), 2) AS DOUBLE)
                 AS mean_downtime_excluding_zeros,
               min(downtime_min) AS min_downtime_min,
               max(downtime_min) AS max_downtime_min,
               round(stddev_pop(downtime_min), 2) AS stddev_downtime_min
        FROM (SELECT downtime_min, if(downtime_min > 0, downtime_min, NULL) AS pos
              FROM {events} WHERE downtime_min IS NOT NULL)
    """,
}


def sql(
    spark: SparkSession, name: str, events: DataFrame, labels: Labels = Labels()
) -> DataFrame:
    """A figure of ``SQL`` run over ``events``."""
    return spark.sql(
        SQL[name], args={"unplanned_reason": labels.unplanned_reason, "largest": LARGEST}, events=events
    )
