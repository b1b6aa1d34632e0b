import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millwright.schemas import EVENTS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("millwright-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def zone(spark):
    """Set the session time zone for one test."""
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


DEFAULTS = {
    "event_id": "A",
    "factory_id": "F1",
    "line_id": "L1",
    "maintenance_type": "Preventive",
    "reason": "Planned Maintenance",
    "start_time": "2025-01-10 10:00:00",
    "end_time": "2025-01-10 10:30:00",
    "downtime_min": 30,
    "technician_id": "T1",
    "parts_used": "P1,P2",
    "cost_eur": 100.0,
    "outcome": "Restored",
    "next_due_date": None,
}


@pytest.fixture
def events(spark):
    """Events from partial rows; missing columns take harmless defaults."""

    def make(*rows, **same):
        full = [{**DEFAULTS, "event_id": f"E{i}", **same, **r} for i, r in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c] for c in EVENTS.fieldNames()) for r in full], EVENTS)

    return make


@pytest.fixture
def roster(spark):
    def make(*rows):
        return spark.createDataFrame(
            list(rows), "operator_id string, skill_level string, reliability_score double"
        )

    return make
