import pytest

from millwright.operators import quality as q
from millwright.params import PLANT_ROWS, ExpectedRows


@pytest.fixture
def dirty(events):
    return events(
        {"event_id": "A"},
        {"event_id": "A", "cost_eur": -1.0},
        {"event_id": "A", "cost_eur": None, "downtime_min": -1},
        {"event_id": None, "downtime_min": None},
        {"event_id": None, "start_time": None},
        {"event_id": "B", "end_time": "2024-01-01 00:00:00"},
        {"event_id": "C", "end_time": None},
        {"event_id": "D"},
    )


def counts(report):
    return {r["rule"]: r["violations"] for r in report.collect()}


EXPECTED = {
    "duplicate_event_id": 2,  # the keys A and NULL
    "end_before_start": 1,
    "negative_cost": 1,
    "cost_not_finite": 0,
    "negative_downtime": 1,
    "null_event_id": 2,
    "null_start_time": 1,
    "null_end_time": 1,
    "null_downtime_min": 1,
}


def test_event_rules(dirty):
    assert counts(q.evaluate(dirty, "events", q.event_rules())) == EXPECTED


def test_fused_report_equals_rule_by_rule(dirty):
    rules = q.event_rules(PLANT_ROWS)
    fused = counts(q.evaluate(dirty, "events", rules))
    assert fused == {r.name: counts(q.evaluate(dirty, "events", [r]))[r.name] for r in rules}
    assert fused["row_count"] == 1


def test_report_columns(dirty):
    report = q.evaluate(dirty, "events", q.event_rules())
    assert report.columns == ["table", "rule", "severity", "violations", "total_rows", "passed"]
    assert {(r["table"], r["total_rows"]) for r in report.collect()} == {("events", 8)}
    assert all(r["passed"] == (r["violations"] == 0) for r in report.collect())


def test_clean_events_pass(events):
    s = q.summaries(q.evaluate(events({}, {}), "events", q.event_rules()))
    assert s["events"] == {
        "table": "events", "total_rows": 2, "passed": True, "fatal": False, "issues": {},
    }
    assert q.gate(s.values())


def test_warnings_do_not_fail_a_table(events):
    s = q.summaries(q.evaluate(events({"cost_eur": -1.0}), "events", q.event_rules()))
    assert s["events"]["passed"] and s["events"]["issues"] == {"negative_cost": 1}


def test_empty_table(events):
    s = q.summaries(q.evaluate(events({}).where("false"), "events", q.event_rules()))
    assert s["events"]["passed"] and s["events"]["total_rows"] == 0


def test_gate(dirty):
    s = q.summaries(q.evaluate(dirty, "events", q.event_rules()))
    assert q.gate(s.values()) is False
    with pytest.raises(q.QualityError):
        q.gate(s.values(), "raise")
    with pytest.raises(ValueError):
        q.gate(s.values(), "ignore")


@pytest.mark.parametrize("bounds, ok", [((2, 3), True), ((0, 2), True), ((3, 9), False), ((0, 1), False)])
def test_row_count_is_inclusive_and_fatal(events, bounds, ok):
    rules = q.event_rules(ExpectedRows(events=bounds))
    s = q.summaries(q.evaluate(events({}, {}), "events", rules))
    if ok:
        assert q.gate(s.values())
    else:
        with pytest.raises(q.QualityError):
            q.gate(s.values(), "warn")


def test_gate_status(dirty, events):
    both = q.evaluate(dirty, "bad", q.event_rules()).unionByName(
        q.evaluate(events({}), "good", q.event_rules())
    )
    got = {r["table"]: tuple(r)[1:] for r in q.gate_status(both).collect()}
    assert got == {"bad": (False, 6, 2, 8), "good": (True, 0, 0, 1)}


def test_production_rules(spark):
    df = spark.createDataFrame(
        [
            (0.0, 1.0, 0.5, 10.0, 10.0),
            (-0.1, 1.1, None, 11.0, 10.0),
            (0.5, 2.0, 0.5, None, 10.0),
        ],
        "availability double, performance double, quality double, produced_qty double, planned_qty double",
    )
    assert counts(q.evaluate(df, "production", q.production_rules())) == {
        "availability_out_of_range": 1,
        "performance_out_of_range": 2,
        "quality_out_of_range": 0,
        "produced_over_planned": 1,
    }


def test_roster_rules(roster):
    df = roster(("T1", "a", 0.0), ("T1", "b", 100.0), ("T2", "c", 100.1), (None, "d", None))
    report = q.evaluate(df, "roster", q.roster_rules())
    assert counts(report) == {"duplicate_operator_id": 1, "reliability_out_of_range": 1}
    assert q.summaries(report)["roster"]["passed"] is False


def test_unparseable_times(events):
    from millwright.operators.clean import clean_events

    raw = events(
        {"start_time": "yesterday"},
        {"start_time": None},
        {"start_time": " 2025-01-10 10:00:00 "},
        {"start_time": "2025-02-30 10:00:00"},
        {"end_time": "2025-01-10T10:00:00"},
    )
    expected = {"unparseable_start_time": 2, "unparseable_end_time": 1}
    assert counts(q.evaluate(clean_events(raw), "events", q.time_rules())) == expected
    assert counts(q.evaluate(raw, "events", q.time_text_rules(raw))) == expected


def test_typed_times_need_no_text_rule(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-01-10 10:00:00' AS start_time, 'x' AS end_time")
    assert [r.name for r in q.time_text_rules(df)] == ["unparseable_end_time"]


def test_required_columns(events):
    df = events({"line_id": None}).drop("factory_id")
    rules = q.required_columns(df, ["event_id", "factory_id", "line_id"])
    assert counts(q.evaluate(df, "events", rules)) == {
        "absent_factory_id": 1,
        "null_event_id": 0,
        "null_line_id": 1,
    }
    empty = df.where("false")
    assert counts(q.evaluate(empty, "events", rules))["absent_factory_id"] == 1


def test_metric_band(events):
    df = events({"cost_eur": 60.0}, {"cost_eur": 50.0}).withColumnRenamed("event_id", "maint_event_id")
    for band, violations in (((110, 110), 0), ((100, 109), 1)):
        assert counts(q.evaluate(df, "fact", q.fact_rules(total_cost=band)))["total_cost"] == violations
    assert counts(q.evaluate(df.where("false"), "fact", q.fact_rules(total_cost=(0, 1))))["total_cost"] == 1


@pytest.mark.parametrize("strategy", ["auto", "spread"])
def test_violating_rows(dirty, strategy):
    rows = q.violations(dirty, q.event_rules(), strategy, rows_per_task=1).collect()
    got = sorted((r["event_id"] or "-", sorted(r["failed_rules"])) for r in rows)
    dup = "duplicate_event_id"
    assert got == [
        ("-", [dup, "null_downtime_min", "null_event_id"]),
        ("-", [dup, "null_event_id", "null_start_time"]),
        ("A", [dup]),
        ("A", [dup, "negative_cost"]),
        ("A", [dup, "negative_downtime"]),
        ("B", ["end_before_start"]),
        ("C", ["null_end_time"]),
    ]
    assert set(rows[0].asDict()) == {*dirty.columns, "failed_rules"}


def test_duplicate_keys_over_several_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    got = {tuple(r) for r in q.duplicate_keys(df, ["a", "b"]).collect()}
    assert got == {(1, 1, 2), (None, 1, 2)}


def test_no_rules(events):
    with pytest.raises(ValueError):
        q.evaluate(events({}), "events", [])


def test_times_are_compared_as_times(events):
    df = events(
        {"end_time": " 2025-01-10 10:30:00"},
        {"start_time": "2025-01-10 10:00:00", "end_time": "10/01/2025 10:30"},
        {"start_time": "2025-01-10 10:00:00", "end_time": "2025-01-10 09:59:59 "},
    )
    assert counts(q.evaluate(df, "events", q.event_rules()))["end_before_start"] == 1


def test_infinite_costs_fail_the_table(events):
    df = events({"cost_eur": float("nan")}, {"cost_eur": float("inf")}, {"cost_eur": -1.0}, {"cost_eur": None})
    assert counts(q.evaluate(df, "events", q.event_rules()))["cost_not_finite"] == 2


def test_names_are_quoted(spark):
    df = spark.createDataFrame([(None,), (1,)], "`cost eur` int")
    assert counts(q.evaluate(df, "t", q.not_null("cost eur"))) == {"null_cost eur": 1}


def test_rules_about_no_row_give_no_rows(events):
    out = q.violations(events({}), [q.RowCount("rows", 5, 9)])
    assert out.collect() == [] and out.dtypes[-1] == ("failed_rules", "array<string>")
