import random
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from millwright.functions.text import split_list
from millwright.operators import clean
from millwright.params import Params


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_local_times_become_utc_in_any_session_zone(events, zone, session_zone):
    zone(session_zone)
    cases = {
        "2025-01-10 10:00:00": datetime(2025, 1, 10, 9, 0),  # winter
        "2025-07-10 10:00:00": datetime(2025, 7, 10, 8, 0),  # summer
        "2025-11-04 00:24:00": datetime(2025, 11, 3, 23, 24),  # previous UTC day
        "2025-03-30 02:30:00": datetime(2025, 3, 30, 1, 30),  # spring gap
        "2025-10-26 02:30:00": datetime(2025, 10, 26, 0, 30),  # autumn overlap: earlier offset
        "2025-03-09 03:30:00": datetime(2025, 3, 9, 2, 30),  # inside New York's gap as UTC
        "2025-02-30 10:00:00": None,
        "03/11/2025 10:11": None,
        "2025-01-10T10:00:00": None,
        "": None,
        None: None,
    }
    df = clean.clean_events(events(*[{"start_time": t} for t in cases]))
    got = {r["event_id"]: r["start_time_utc"] for r in df.collect()}
    assert [got[f"E{i}"] for i in range(len(cases))] == list(cases.values())


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_random_times_agree_with_the_zone_database(spark, zone, session_zone):
    zone(session_zone)
    rng = random.Random(3)
    start = datetime(1985, 1, 1)
    local = [start + timedelta(seconds=rng.randrange(45 * 365 * 86400)) for _ in range(4000)]
    # Every half hour around both changes of one year.
    for day in (datetime(2024, 3, 31), datetime(2024, 10, 27)):
        local += [day + timedelta(minutes=30 * i) for i in range(12)]
    paris, utc = ZoneInfo("Europe/Paris"), ZoneInfo("UTC")
    df = spark.createDataFrame([(str(t),) for t in local], "t string")
    for text, got in clean.add_utc(df, {"t": "u"}, "Europe/Paris").collect():
        wall = datetime.fromisoformat(text).replace(tzinfo=paris)
        assert got == wall.astimezone(utc).replace(tzinfo=None), text


def test_random_lists_agree_with_python(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ,, ") for _ in range(rng.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for text, got in df.select("x", split_list(F.col("x")).alias("l")).collect():
        items = [p.strip(" ") for p in text.split(",")]
        assert got == ([p for p in items if p] or None), repr(text)


def test_zone_free_input_is_used_as_is(spark, zone):
    zone("America/New_York")
    df = spark.sql("SELECT timestamp_ntz'2025-03-09 02:30:00' AS t")
    out = clean.add_utc(df, {"t": "u"}, "UTC")
    assert out.first()["u"] == datetime(2025, 3, 9, 2, 30)
    assert dict(out.dtypes)["u"] == "timestamp_ntz"


@pytest.mark.parametrize(
    "text, items",
    [
        ("P1,P2", ["P1", "P2"]),
        (" P1 , P2 ", ["P1", "P2"]),
        ("P1,,P2,", ["P1", "P2"]),
        (",P1", ["P1"]),
        ("P1 a,P2", ["P1 a", "P2"]),
        ("", None),
        ("   ", None),
        (" , ", None),
        (None, None),
    ],
)
def test_parts_list(events, text, items):
    row = clean.clean_events(events({"parts_used": text})).first()
    assert row["parts_list"] == items
    assert row["parts_count"] == len(items or [])
    assert ("missing_parts" in row["data_quality_flags"]) == (items is None)


def test_split_list_with_a_pattern_character(spark):
    df = spark.createDataFrame([("a| b||c",)], "x string")
    assert df.select(split_list(F.col("x"), "|")).first()[0] == ["a", "b", "c"]


def test_missing_parts_can_become_an_empty_list(events):
    row = clean.clean_events(events({"parts_used": None}), Params(fill_parts=True)).first()
    assert row["parts_list"] == []
    assert row["parts_count"] == 0
    assert row["data_quality_flags"] == "missing_parts"


def test_classes(events):
    df = clean.clean_events(
        events(
            {"reason": "Unplanned Breakdown", "downtime_min": 0},
            {"reason": " Unplanned Breakdown ", "downtime_min": -5},
            {"reason": "Planned Maintenance", "downtime_min": 5},
            {"reason": None, "downtime_min": None},
        )
    ).orderBy("event_id")
    assert [(r["is_unplanned"], r["downtime_category"]) for r in df.collect()] == [
        (True, "monitoring"),
        (True, "downtime"),
        (False, "downtime"),
        (None, "downtime"),
    ]


def test_flags_are_separable(events):
    df = clean.clean_events(
        events(
            {"cost_eur": None, "parts_used": None},
            {"cost_eur": None},
            {"parts_used": ""},
            {},
        )
    ).orderBy("event_id")
    assert [r["data_quality_flags"] for r in df.collect()] == [
        "missing_cost|missing_parts",
        "missing_cost",
        "missing_parts",
        "",
    ]


def test_trim_keeps_other_columns(events):
    row = clean.trim_strings(events({"line_id": "  L1 ", "downtime_min": 7})).first()
    assert (row["line_id"], row["downtime_min"]) == ("L1", 7)


def test_trim_any_column_name(spark):
    df = spark.createDataFrame([(" a ", 1)], "`line.id` string, `x``y` int")
    assert clean.trim_strings(df).first().asDict() == {"line.id": "a", "x`y": 1}


def test_clamp_is_opt_in(events):
    df = events({"downtime_min": -5}, {"downtime_min": None}, {"downtime_min": 5})
    assert [r["downtime_min"] for r in clean.clean_events(df).collect()] == [-5, None, 5]
    clamped = clean.clean_events(df, Params(clamp_downtime=True))
    assert [r["downtime_min"] for r in clamped.collect()] == [0, None, 5]


def test_cost_quality(events):
    df = events({"cost_eur": None}, {"cost_eur": 0.0}, {"cost_eur": 5.0})
    got = [r[0] for r in df.select(clean.cost_quality(F.col("cost_eur"))).collect()]
    assert got == ["pending_cost", "free_or_in_house", "confirmed"]


def test_no_event_is_dropped(events):
    df = events({"cost_eur": None, "downtime_min": None, "start_time": None}, {"downtime_min": 0})
    assert clean.clean_events(df).count() == 2
