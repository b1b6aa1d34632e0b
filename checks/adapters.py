"""The test tables in the shape of the library's inputs.

Every adapter derives all of its rows from a given table; remainders only pick
column values, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.times import clock_text

OUTCOMES = ("Restored", "Temporarily Fixed", "Root Cause Identified", "Deferred")
SKILLS = ("Junior", "Intermediate", "Senior", "Expert")
UNPLANNED, PLANNED = "Unplanned Breakdown", "Planned Maintenance"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _parts(variant: Column, n: Column) -> Column:
    """No list, empty text, one part, or two parts with blanks around the comma."""
    one = F.concat(F.lit("PART-"), n.cast("string"))
    two = F.concat(one, F.lit(" , PART-"), (n + 1).cast("string"))
    return F.when(variant == 1, "").when(variant == 2, one).when(variant == 3, two)


def _later(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes)


def events_as_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    k, uid, eid = F.col("k"), F.col("user_id"), F.col("event_id")
    return e.select(
        F.concat(F.lit("EV-"), eid.cast("string")).alias("event_id"),
        F.concat(F.lit("F"), (uid % 3).cast("string")).alias("factory_id"),
        F.concat(F.lit("L"), (uid % 7).cast("string")).alias("line_id"),
        F.col("event_type").alias("maintenance_type"),
        F.when(F.col("event_type") == "error", UNPLANNED).otherwise(PLANNED).alias("reason"),
        clock_text(F.col("ts")).alias("start_time"),
        clock_text(_later(F.col("ts"), k * 3)).alias("end_time"),
        (k * 3).alias("downtime_min"),
        uid.cast("string").alias("technician_id"),
        _parts(eid % 4, k).alias("parts_used"),
        F.when(eid % 20 != 0, F.round(F.col("value") * 30, 2)).alias("cost_eur"),
        _pick(eid % 4, OUTCOMES).alias("outcome"),
        F.date_add(F.to_date("ts"), k % 14 + 1).alias("next_due_date"),
    )


def lineitem_as_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("int")
    ship, okey, line = F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")
    price_cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    return li.select(
        F.concat_ws("-", okey.cast("string"), line.cast("string")).alias("event_id"),
        F.col("l_returnflag").alias("factory_id"),
        F.col("l_linestatus").alias("line_id"),
        _pick(line % 4, ("Preventive", "Corrective", "Calibration", "Inspection")).alias(
            "maintenance_type"
        ),
        F.when(F.col("l_returnflag") == "R", UNPLANNED).otherwise(PLANNED).alias("reason"),
        clock_text(ship).alias("start_time"),
        clock_text(_later(ship, qty)).alias("end_time"),
        qty.alias("downtime_min"),
        F.col("l_suppkey").cast("string").alias("technician_id"),
        _parts(okey % 4, qty).alias("parts_used"),
        F.when(okey % 20 != 0, F.floor(price_cents / 20).cast("double") / 100).alias("cost_eur"),
        _pick(okey % 4, OUTCOMES).alias("outcome"),
        F.date_add(F.to_date(ship), qty % 14 + 1).alias("next_due_date"),
    )


def suppliers_as_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return s.select(
        key.cast("string").alias("operator_id"),
        F.when(nation % 7 != 0, _pick(nation % 4, SKILLS)).alias("skill_level"),
        F.when(key % 11 != 0, (key % 50 + 50).cast("double")).alias("reliability_score"),
    )


def lineitem_as_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (1 - F.col("l_discount")).alias("availability"),
        (1 - F.col("l_tax")).alias("performance"),
        # Above 1 for untaxed lines, so that the range rule has something to find.
        (1.01 - F.col("l_tax")).alias("quality"),
        F.col("l_quantity").alias("produced_qty"),
        F.lit(40.0).alias("planned_qty"),
    )


def defective_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maintenance events, some with one defect, for the checks to find."""
    e = events_as_maintenance(spark, sf_dir)
    n = F.substring("event_id", 4, 20).cast("bigint") % 50
    changes = {
        "event_id": F.when(n == 4, None).when(n == 5, "EV-COPY").otherwise(F.col("event_id")),
        "reason": F.when(n == 6, None)
        .when(n == 8, F.concat(F.lit("  "), "reason", F.lit(" ")))
        .otherwise(F.col("reason")),
        "start_time": F.when(n == 7, "03/11/2025 10:11").otherwise(F.col("start_time")),
        "end_time": F.when(n == 3, "2000-01-01 00:00:00").otherwise(F.col("end_time")),
        "downtime_min": F.when(n == 2, -F.col("downtime_min") - 1)
        .when(n == 9, None)
        .otherwise(F.col("downtime_min")),
        "cost_eur": F.when(n == 1, -F.col("cost_eur") - 1).otherwise(F.col("cost_eur")),
    }
    return e.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in e.columns])
