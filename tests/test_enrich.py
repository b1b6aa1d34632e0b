import pytest
from pyspark.sql import functions as F

from millwright.operators import enrich, joins
from millwright.params import JoinLimits, Params

STRATEGIES = ["auto", "broadcast", "spread"]
NO_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set(NO_BROADCAST, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset(NO_BROADCAST)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def attributes(df):
    return [
        (r["technician_id"], r["technician_found"], r["operator_skill_level"], r["operator_reliability"])
        for r in df.orderBy("event_id").collect()
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_left_join_with_defaults(events, roster, strategy):
    e = events(
        {"technician_id": "T1"},
        {"technician_id": "T2"},
        {"technician_id": "T9"},
        {"technician_id": None},
    )
    r = roster(("T1", "Senior", 91.5), ("T2", None, None), (None, "Ghost", 1.0))
    assert attributes(enrich.enrich_events(e, r, strategy=strategy)) == [
        ("T1", True, "Senior", 91.5),
        ("T2", True, "Unknown", 50.0),
        ("T9", False, "Unknown", 50.0),
        (None, False, "Unknown", 50.0),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_repeated_roster_key_repeats_events(events, roster, strategy):
    e = events({"technician_id": "T1"})
    r = roster(("T1", "Senior", 90.0), ("T1", "Junior", 70.0))
    assert enrich.enrich_events(e, r, strategy=strategy).count() == 2
    single = joins.one_per_key(r, "operator_id", ["reliability_score"])
    assert attributes(enrich.enrich_events(e, single, strategy=strategy)) == [
        ("T1", True, "Junior", 70.0)
    ]


def test_roster_columns_do_not_clash(events, spark):
    wide = spark.createDataFrame(
        [("T1", "F9", "Senior", 90.0)],
        "operator_id string, factory_id string, skill_level string, reliability_score double",
    )
    row = enrich.enrich_events(events({"technician_id": "T1"}), wide).first()
    assert row["factory_id"] == "F1"


def test_normalised_keys(events, roster):
    df = enrich.enrich_events(
        events({"technician_id": "S-41"}, {"technician_id": "S-42"}),
        roster(("P-41", "Senior", 90.0)),
        normalise=lambda c: F.regexp_extract(c, r"(\d+)$", 1),
    )
    assert [a[:2] for a in attributes(df)] == [("S-41", True), ("S-42", False)]


def skewed(spark, n=30_000):
    """A third of the rows on one key, a third without a key, a third spread out."""
    return spark.range(n).select(
        F.concat(F.lit("E"), F.col("id")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, "T0")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("T"), F.col("id") % 500))
        .alias("technician_id"),
    )


def dimension(spark):
    return spark.range(400).select(
        F.concat(F.lit("T"), F.col("id")).alias("operator_id"),
        F.concat(F.lit("s"), F.col("id")).alias("skill_level"),
        F.col("id").cast("double").alias("reliability_score"),
    )


def test_hot_and_missing_keys_are_spread_and_results_whole(spark, no_auto_broadcast):
    facts, dim = skewed(spark), dimension(spark)
    params = Params(joins=JoinLimits(rows_per_task=500))
    spread = enrich.enrich_events(facts, dim, params, strategy="spread")
    plain = enrich.enrich_events(facts, dim, params, strategy="auto")
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert spread.count() == facts.count()

    assert max(task_sizes(spark, spread)) < 4 * 30_000 / 40
    assert max(task_sizes(spark, plain)) > 30_000 / 3


def task_sizes(spark, df):
    """Rows per task of a 40-partition shuffle, without help at run time."""
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [r["count"] for r in counts]


def test_identical_copies_are_spread(spark, no_auto_broadcast):
    facts = spark.range(0, 30_000, 1, 24).select(
        F.lit("E1").alias("event_id"), F.lit("T1").alias("technician_id")
    )
    params = Params(joins=JoinLimits(rows_per_task=100))
    spread = enrich.enrich_events(facts, dimension(spark), params, strategy="spread")
    assert spread.where("technician_found").count() == 30_000
    assert max(task_sizes(spark, spread)) < 30_000 / 5


def test_strategy_follows_the_measured_size(spark):
    dim = dimension(spark)
    size = joins.measure_bytes(dim)
    assert 400 * 16 < size < 400 * 64
    assert joins.pick_strategy(dim, size) == "broadcast"
    assert joins.pick_strategy(dim, size - 1) == "spread"
    assert joins.measure_bytes(dim.where("false")) == 0


def test_unknown_strategy(events, roster):
    with pytest.raises(ValueError):
        enrich.enrich_events(events({}), roster(("T1", "a", 1.0)), strategy="nested")


def test_match_rate_and_unmatched_keys(events, roster):
    e = events(*[{"technician_id": t} for t in ("T1", "T1", "T2", "T3", "T3", None)])
    r = roster(("T1", "Senior", 90.0))
    assert enrich.match_rate(enrich.enrich_events(e, r)).first().asDict() == {
        "total_events": 6,
        "matched": 2,
        "unmatched": 4,
        "match_pct": 33.33,
    }
    unmatched = enrich.unmatched_keys(e, r, "technician_id", "operator_id")
    assert {tuple(x) for x in unmatched.collect()} == {("T2", 1), ("T3", 2), (None, 1)}


def test_match_rate_of_nothing(events, roster):
    empty = enrich.enrich_events(events({}).where("false"), roster(("T1", "Senior", 90.0)))
    assert enrich.match_rate(empty).first()["match_pct"] is None


def test_registered_spread_queries_do_split(spark):
    from checks.adapters import defective_events
    from checks.queries import SPREAD, hot_technicians
    from millwright.operators.joins import _hot_keys

    events = hot_technicians(spark, "/root/testdata/sf0.001")
    hot = _hot_keys(events, [F.col("technician_id")], ["operator_id"], SPREAD.joins.rows_per_task, None)
    assert {r[0] for r in hot.collect()} >= {"1"}
    ids = defective_events(spark, "/root/testdata/sf0.001")
    repeated = _hot_keys(ids, [F.col("event_id")], ["event_id"], 5, None)
    assert {r[0] for r in repeated.collect()} >= {None, "EV-COPY"}
