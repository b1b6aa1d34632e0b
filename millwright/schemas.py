"""Column contracts of the input tables and the two outputs."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
FLAG, DATE, UTC = BooleanType(), DateType(), TimestampNTZType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


# Times stay text at the scan so that a bad value is still visible to the
# quality checks; cleaning parses them.
EVENTS = _table(
    event_id=TEXT,
    factory_id=TEXT,
    line_id=TEXT,
    maintenance_type=TEXT,
    reason=TEXT,
    start_time=TEXT,
    end_time=TEXT,
    downtime_min=INT,
    technician_id=TEXT,
    parts_used=TEXT,
    cost_eur=DOUBLE,
    outcome=TEXT,
    next_due_date=DATE,
)

ROSTER = _table(
    operator_id=TEXT,
    name=TEXT,
    factory_id=TEXT,
    primary_line=TEXT,
    primary_shift=TEXT,
    skill_level=TEXT,
    certifications=TEXT,
    team=TEXT,
    hire_date=DATE,
    overtime_eligible=FLAG,
    hourly_rate_eur=DOUBLE,
    reliability_score=DOUBLE,
)

PRODUCTION = _table(
    availability=DOUBLE,
    performance=DOUBLE,
    quality=DOUBLE,
    produced_qty=DOUBLE,
    planned_qty=DOUBLE,
)

FACT = _table(
    maint_event_id=TEXT,
    factory_id=TEXT,
    line_id=TEXT,
    start_timestamp=UTC,
    end_timestamp=UTC,
    event_date=TEXT,
    event_year_month=TEXT,
    maintenance_type=TEXT,
    reason=TEXT,
    outcome=TEXT,
    is_unplanned_breakdown=FLAG,
    downtime_category=TEXT,
    downtime_min=INT,
    cost_eur=DOUBLE,
    cost_per_downtime_min=DecimalType(32, 2),
    severity_level=TEXT,
    technician_id=TEXT,
    operator_skill_level=TEXT,
    operator_reliability=DOUBLE,
    parts_count=INT,
    parts_list=ArrayType(TEXT),
    next_due_date=DATE,
    days_to_next_due=INT,
    data_quality_flags=TEXT,
    technician_in_roster=FLAG,
    load_timestamp=UTC,
)

SUMMARY_KEYS = ("factory_id", "line_id", "maintenance_type", "event_date")

SUMMARY = _table(
    factory_id=TEXT,
    line_id=TEXT,
    maintenance_type=TEXT,
    event_date=TEXT,
    event_count=LONG,
    total_downtime_min=LONG,
    avg_downtime_min=DOUBLE,
    total_cost_eur=DOUBLE,
    avg_cost_eur=DOUBLE,
    unplanned_count=LONG,
    unplanned_pct=DecimalType(5, 2),
)
