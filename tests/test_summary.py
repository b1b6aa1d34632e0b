from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright.operators.alerts import breakdown_rate, event_alerts
from millwright.operators.summary import rollup_metrics
from millwright.params import AlertLimits
from millwright.plans.pipeline import fact_of
from millwright.schemas import SUMMARY

BROKEN = "Unplanned Breakdown"


@pytest.fixture
def fact(events, roster):
    e = events(
        {"downtime_min": 10, "cost_eur": 10.10, "reason": BROKEN},
        {"downtime_min": 20, "cost_eur": 20.20},
        {"downtime_min": None, "cost_eur": None, "reason": None},
        {"downtime_min": 5, "cost_eur": 1.0, "line_id": "L2", "reason": BROKEN},
        {"downtime_min": 5, "cost_eur": 1.0, "start_time": "2025-01-11 00:30:00"},
        {"start_time": None},
    )
    return fact_of(e, roster(("T1", "Senior", 90.0)))


def test_metrics_per_group(fact):
    out = rollup_metrics(fact)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in SUMMARY]
    rows = {(r["line_id"], r["event_date"]): tuple(r)[4:] for r in out.collect()}
    assert rows == {
        ("L1", "2025-01-10"): (4, 35, 35 / 3, 31.3, 31.3 / 3, 1, Decimal("25.00")),
        ("L2", "2025-01-10"): (1, 5, 5.0, 1.0, 1.0, 1, Decimal("100.00")),
        ("L1", None): (1, 30, 30.0, 100.0, 100.0, 0, Decimal("0.00")),
    }


def test_group_without_any_cost(events, roster):
    f = fact_of(events({"cost_eur": None, "downtime_min": None}), roster(("T1", "Senior", 9.0)))
    r = rollup_metrics(f).first()
    assert r["total_cost_eur"] is None and r["avg_cost_eur"] is None
    assert r["total_downtime_min"] is None and r["avg_downtime_min"] is None


def test_every_event_is_in_one_group(fact):
    out = rollup_metrics(fact)
    assert out.agg(F.sum("event_count")).first()[0] == fact.count()
    assert rollup_metrics(fact, ["factory_id"]).first()["event_count"] == fact.count()


def test_result_does_not_depend_on_the_partitioning(fact):
    a, b = rollup_metrics(fact.repartition(8)), rollup_metrics(fact.coalesce(1))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_breakdown_alert_is_strict(spark):
    df = spark.sql("SELECT CAST(x AS DECIMAL(5,2)) AS unplanned_pct FROM VALUES 29.99, 30, 30.01 t(x)")
    assert [r[0] for r in breakdown_rate(df).collect()] == [Decimal("30.01")]


def test_breakdown_alert_compares_before_rounding(spark):
    df = spark.sql(
        "SELECT bigint(x) AS unplanned_count, bigint(100000) AS event_count, decimal(30) AS unplanned_pct "
        "FROM VALUES 29999, 30000, 30001 t(x)"
    )
    assert [r[0] for r in breakdown_rate(df).collect()] == [30001]


def test_event_alerts(events):
    e = events(
        {"cost_eur": 5000.0, "downtime_min": 240},
        {"cost_eur": 5000.01, "downtime_min": None},
        {"cost_eur": None, "downtime_min": 241},
        {"cost_eur": 6000.0, "downtime_min": 300},
        {"cost_eur": None, "downtime_min": None},
    )
    got = {r["event_id"]: r["alert_reasons"] for r in event_alerts(e).collect()}
    assert got == {
        "E1": ["high_cost"],
        "E2": ["high_downtime"],
        "E3": ["high_cost", "high_downtime"],
    }
    assert event_alerts(e, AlertLimits(cost=10**6, downtime=10**6)).isEmpty()
