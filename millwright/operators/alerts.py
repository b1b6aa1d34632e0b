"""Threshold alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.functions.text import flag_array
from millwright.params import AlertLimits


def event_alerts(events: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Events strictly above the cost or downtime limit, with the reasons."""
    costly = F.col("cost_eur") > limits.cost
    long = F.col("downtime_min") > limits.downtime
    return events.where(costly | long).withColumn(
        "alert_reasons", flag_array((costly, "high_cost"), (long, "high_downtime"))
    )


def breakdown_rate(metrics: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """Metric groups whose breakdown share is strictly above the limit.

    Compared before rounding where the metrics have the counts, else as rounded.
    """
    if not {"unplanned_count", "event_count"} <= set(metrics.columns):
        return metrics.where(F.col("unplanned_pct") > limits.breakdown_pct)
    share = F.col("unplanned_count") * F.lit(100).cast("decimal(3,0)")
    limit = F.lit(limits.breakdown_pct).cast("decimal(9,4)")
    return metrics.where(share > limit * F.col("event_count"))
