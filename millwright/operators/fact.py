"""The event-grain fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.money import unit_cost
from millwright.functions.times import day_text, month_text, utc_now
from millwright.params import Params, SeverityLimits
from millwright.schemas import FACT


def severity(cost: Column, downtime: Column, limits: SeverityLimits = SeverityLimits()) -> Column:
    """High, Medium or Low; an unknown cost or downtime never raises the level."""
    return (
        F.when((cost > limits.high_cost) | (downtime > limits.high_downtime), "High")
        .when((cost > limits.medium_cost) | (downtime > limits.medium_downtime), "Medium")
        .otherwise("Low")
    )


def days_to_due(next_due: Column, start_utc: Column) -> Column:
    """Days from the UTC day of the event to the due date."""
    return F.date_diff(next_due.try_cast("date"), start_utc.cast("date"))


def _load_time(params: Params) -> Column:
    if params.run_ts is None:
        return utc_now()
    return F.lit(params.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def build_fact(enriched: DataFrame, params: Params = Params()) -> DataFrame:
    """Project cleaned and enriched events to the fact contract (``schemas.FACT``)."""
    start = F.col("start_time_utc")
    cost, downtime = F.col("cost_eur"), F.col("downtime_min")
    derived = {
        "maint_event_id": F.col("event_id"),
        "start_timestamp": start,
        "end_timestamp": F.col("end_time_utc"),
        "event_date": day_text(start),
        "event_year_month": month_text(start),
        "is_unplanned_breakdown": F.col("is_unplanned"),
        "cost_per_downtime_min": unit_cost(cost, downtime),
        "severity_level": severity(cost, downtime, params.severity),
        "days_to_next_due": days_to_due(F.col("next_due_date"), start),
        "technician_in_roster": F.col("technician_found"),
        "load_timestamp": _load_time(params),
    }
    return enriched.select(
        *[
            derived[name].alias(name) if name in derived else F.col(name)
            for name in FACT.fieldNames()
        ]
    )
