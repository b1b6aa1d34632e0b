import pytest
from pyspark.sql import functions as F

from millwright.operators import kpis

BROKEN = "Unplanned Breakdown"


@pytest.fixture
def sample(events):
    return events(
        {"downtime_min": 0, "cost_eur": 100.0, "reason": BROKEN},
        {"downtime_min": 60, "cost_eur": 250.5},
        {"downtime_min": 30, "cost_eur": None, "reason": BROKEN, "line_id": "L2"},
        {"downtime_min": None, "cost_eur": -5.0, "reason": None, "line_id": None},
        {"downtime_min": -10, "cost_eur": 0.0, "event_id": "E1", "factory_id": "F2"},
    )


def row(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_cost(sample):
    assert row(kpis.cost(sample)) == {
        "total_maintenance_cost": 350.5,
        "event_count": 3,
        "avg_cost_per_event": 116.83,
        "min_cost": 0.0,
        "max_cost": 250.5,
    }


def test_downtime(sample):
    assert row(kpis.downtime(sample)) == {
        "total_downtime_minutes": 80,
        "total_productive_downtime_min": 90,
        "total_events": 4,
        "events_with_downtime": 2,
        "monitoring_only_events": 1,
        "total_hours": 1.33,
    }


def test_composition(sample):
    expected = {
        "total_events": 5,
        "unique_events": 4,
        "factory_count": 2,
        "line_count": 2,
        "maintenance_type_count": 1,
    }
    assert row(kpis.composition(sample)) == expected
    assert row(kpis.composition(sample, approx=True)) == expected


def test_unplanned(sample):
    assert row(kpis.unplanned(sample)) == {
        "unplanned_breakdowns": 2,
        "pct_of_total_events": 40.0,
        "total_unplanned_downtime_min": 30,
        "avg_unplanned_downtime_min": 15.0,
        "total_unplanned_cost_eur": 100.0,
        "avg_unplanned_cost_eur": 100.0,
    }


def test_distribution(sample):
    assert row(kpis.downtime_distribution(sample)) == {
        "total_events": 4,
        "events_with_downtime": 2,
        "mean_downtime_min": 20.0,
        "mean_downtime_excluding_zeros": 45.0,
        "min_downtime_min": -10,
        "max_downtime_min": 60,
        "stddev_downtime_min": 27.39,
    }


def test_efficiency(sample):
    got = row(kpis.efficiency(sample))
    assert got["costed_events"] == 1
    assert got["cost_per_downtime_min"] == 4.18


def test_variation(sample):
    assert row(kpis.downtime_variation(sample))["variation_pct"] == 136.93


def test_shares(sample):
    got = {r["reason"]: tuple(r)[1:] for r in kpis.share_of_total(sample).collect()}
    assert got == {
        BROKEN: (2, 40.0, 37.5, 28.94),
        "Planned Maintenance": (2, 40.0, 62.5, 72.5),
        None: (1, 20.0, 0.0, -1.45),
    }


SINGLE = {
    "cost": kpis.cost,
    "downtime": kpis.downtime,
    "composition": kpis.composition,
    "unplanned": kpis.unplanned,
    "distribution": kpis.downtime_distribution,
}


@pytest.mark.parametrize("name", SINGLE)
def test_sql_form_equals_dataframe_form(spark, sample, name):
    for df in (sample, sample.where("false")):
        sql, api = kpis.sql(spark, name, df), SINGLE[name](df)
        assert sql.dtypes == api.dtypes
        assert sql.collect() == api.collect()


def test_no_events(sample):
    none = sample.where("false")
    assert row(kpis.unplanned(none))["pct_of_total_events"] is None
    assert row(kpis.composition(none))["total_events"] == 0
    assert row(kpis.cost(none))["event_count"] == 0
    assert row(kpis.downtime(none))["total_hours"] is None
    assert kpis.share_of_total(none).isEmpty()


def test_no_breakdowns(events):
    got = row(kpis.unplanned(events({}, {})))
    assert got["unplanned_breakdowns"] == 0 and got["pct_of_total_events"] == 0.0
    assert got["total_unplanned_cost_eur"] is None and got["avg_unplanned_downtime_min"] is None


def test_report_fuses_the_single_figures(sample):
    fused = kpis.report(sample).first()
    assert fused["cost"].asDict() == row(kpis.cost(sample))
    assert fused["downtime"].asDict() == row(kpis.downtime(sample))
    assert fused["breakdown"].asDict() == row(kpis.unplanned(sample))
    assert fused["efficiency"].asDict() == row(kpis.efficiency(sample))
    assert fused["distribution"].asDict() == row(kpis.downtime_distribution(sample))


def test_report_can_be_toggled(sample):
    assert kpis.report(sample, ["cost"]).columns == ["cost"]
    with pytest.raises(ValueError):
        kpis.report(sample, ["weather"])


def test_money_sums_do_not_depend_on_row_order(spark, events):
    costs = [0.1, 0.2, 0.3, 1e9, 1234.56] * 20
    df = events(*[{"cost_eur": c} for c in costs])
    a = row(kpis.cost(df.orderBy("cost_eur").coalesce(1)))
    b = row(kpis.cost(df.orderBy(F.desc("cost_eur")).repartition(7)))
    assert a == b
    assert a["total_maintenance_cost"] == 20 * 1_000_001_235.16


def test_deviation_has_the_same_bits_in_any_order(spark):
    """Exact moments: whatever the partitions, and from parts as from the whole."""
    from millwright.operators.kpis import downtime_distribution, downtime_moments, downtime_variation, variation_of

    df = spark.range(5000).selectExpr("CAST(1000000 + (id * id) % 977 AS int) AS downtime_min", "id % 7 AS g")
    one = downtime_variation(df.coalesce(1)).first()
    for n in (3, 8):
        assert downtime_variation(df.repartition(n, "downtime_min")).first() == one
    assert variation_of(downtime_moments(df, ["g"])).first() == one
    assert downtime_distribution(df).first()["stddev_downtime_min"] == round(one["stddev_downtime_min"], 2)
    values = [1000000 + (i * i) % 977 for i in range(5000)]
    middle = sum(values) / 5000
    exact = (sum((v - middle) ** 2 for v in values) / 5000) ** 0.5
    assert abs(one["stddev_downtime_min"] - exact) < 1e-4
    none = downtime_variation(df.limit(0)).first()
    assert none["stddev_downtime_min"] is None and none["variation_pct"] is None
    huge = spark.sql("SELECT CAST(x AS int) AS downtime_min FROM VALUES (2147483647), (-2147483648), (NULL) AS t(x)")
    assert abs(downtime_variation(huge).first()["stddev_downtime_min"] - 2147483647.5) < 1


def test_sketches_merge_within_their_error(spark):
    from millwright.operators.kpis import composition_of, composition_sketches

    df = spark.range(300_000).selectExpr(
        "concat('E', id % 200000) AS event_id", "id % 3 AS factory_id", "id % 900 AS line_id",
        "CAST(NULL AS string) AS maintenance_type", "id % 12 AS month",
    )
    got = composition_of(composition_sketches(df, ["month"])).first()
    assert got["total_events"] == 300_000 and got["factory_count"] == 3 and got["maintenance_type_count"] == 0
    assert abs(got["unique_events"] - 200_000) < 0.02 * 200_000 and abs(got["line_count"] - 900) < 0.02 * 900
    assert composition_of(composition_sketches(df.limit(0))).first()["unique_events"] == 0


def test_shares_read_the_events_once(spark, tmp_path):
    """Groups and totals come from one aggregate: the second is the first one's shuffle, used again."""
    from contextlib import redirect_stdout
    from io import StringIO

    from millwright.operators.kpis import share_of_total

    path = str(tmp_path / "events")
    spark.range(1000).selectExpr("CAST(id % 5 AS string) AS reason", "CAST(id AS int) AS downtime_min", "id / 7 AS cost_eur").write.parquet(path)
    shares = share_of_total(spark.read.parquet(path))
    rows = shares.collect()
    assert len(rows) == 5 and abs(sum(r["cost_pct"] for r in rows) - 100) < 0.05
    text = StringIO()
    with redirect_stdout(text):
        shares.explain()
    final = text.getvalue().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or final.count("FileScan") == 1
