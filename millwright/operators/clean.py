"""Cleaning: trimming, UTC times, parts lists, classes and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from millwright.functions.text import column, flag_text, split_list
from millwright.functions.times import local_to_utc
from millwright.params import Labels, Params


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column, in one projection."""

    def trimmed(f: StructField) -> Column:
        is_text = isinstance(f.dataType, StringType)
        return F.trim(column(f.name)).alias(f.name) if is_text else column(f.name)

    return df.select(*[trimmed(f) for f in df.schema.fields])


def add_utc(df: DataFrame, columns: dict[str, str], zone: str) -> DataFrame:
    """Add UTC twins of local time columns: ``{source: target}``."""
    return df.withColumns(
        {
            target: local_to_utc(F.col(source), df.schema[source].dataType, zone)
            for source, target in columns.items()
        }
    )


def add_parts(df: DataFrame, column: str = "parts_used") -> DataFrame:
    """Add ``parts_list`` (NULL when there is none) and ``parts_count``.

    Two steps, so that the count reads the list instead of splitting again.
    """
    return df.withColumn("parts_list", split_list(F.col(column))).withColumn(
        "parts_count", F.coalesce(F.size("parts_list"), F.lit(0))
    )


def fill_parts(df: DataFrame) -> DataFrame:
    """A missing ``parts_list`` as an empty one."""
    return df.withColumn(
        "parts_list", F.coalesce("parts_list", F.array().cast("array<string>"))
    )


def class_columns(
    reason: Column, downtime: Column, labels: Labels = Labels()
) -> dict[str, Column]:
    """Breakdown flag (NULL for an unknown reason) and downtime category."""
    return {
        "is_unplanned": reason == labels.unplanned_reason,
        "downtime_category": F.when(downtime == 0, labels.monitoring).otherwise(labels.downtime),
    }


def quality_flags(cost: Column, parts_list: Column, labels: Labels = Labels()) -> Column:
    return flag_text(
        (cost.isNull(), labels.missing_cost),
        (parts_list.isNull(), labels.missing_parts),
    )


def cost_quality(cost: Column) -> Column:
    """Where a cost stands: not billed yet, free, or confirmed."""
    return (
        F.when(cost.isNull(), "pending_cost")
        .when(cost == 0, "free_or_in_house")
        .otherwise("confirmed")
    )


def clamp_non_negative(value: Column) -> Column:
    """Negative to 0; NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def clean_events(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Raw events plus UTC times, parts list and count, classes and quality flags."""
    df = add_utc(
        trim_strings(df),
        {"start_time": "start_time_utc", "end_time": "end_time_utc"},
        params.source_zone,
    )
    if params.clamp_downtime:
        df = df.withColumn("downtime_min", clamp_non_negative(F.col("downtime_min")))
    df = add_parts(df).withColumns(
        {
            **class_columns(F.col("reason"), F.col("downtime_min"), params.labels),
            "data_quality_flags": quality_flags(
                F.col("cost_eur"), F.col("parts_list"), params.labels
            ),
        }
    )
    return fill_parts(df) if params.fill_parts else df
