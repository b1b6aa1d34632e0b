from pathlib import Path

import pytest

from millwright.operators.quality import QualityError
from millwright.params import ExpectedRows, JoinLimits, Params
from millwright.plans import pipeline
from millwright.schemas import EVENTS, FACT, SUMMARY
from millwright.sinks.export import write
from millwright.sources.tables import read_table
from millwright.streaming.ingest import ingest_new_files

OUTPUTS = {"fact_parquet", "summary_parquet", "fact_csv", "summary_csv"}


@pytest.fixture
def tables(spark, events, roster):
    return {
        "events": events({}, {"technician_id": "T9"}, {"reason": "Unplanned Breakdown"}),
        "roster": roster(("T1", "Senior", 90.0)),
        "production": spark.sql(
            """SELECT 0.5D AS availability, 0.5D AS performance, 0.5D AS quality,
                      1D AS produced_qty, 2D AS planned_qty"""
        ),
    }


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_run(spark, tables, tmp_path, broadcast_bytes):
    params = Params(joins=JoinLimits(broadcast_bytes=broadcast_bytes, rows_per_task=1))
    report = pipeline.run(spark, tables, str(tmp_path), params)
    assert report.status == "success" and not report.errors
    assert report.row_counts == {"events_raw": 3, "roster_raw": 1, "production_raw": 1, "fact": 3}
    assert all(v["passed"] for v in report.validations.values())
    assert set(report.outputs) == OUTPUTS
    assert set(report.seconds) == {"validate", "fact", "check", "summary", "csv"}
    fact = read_table(spark, report.outputs["fact_parquet"], FACT)
    assert sorted(r["technician_in_roster"] for r in fact.collect()) == [False, True, True]
    summary = read_table(spark, report.outputs["summary_parquet"], SUMMARY).first()
    assert (summary["event_count"], summary["unplanned_count"]) == (3, 1)
    text = read_table(spark, report.outputs["summary_csv"])
    assert text.columns == SUMMARY.fieldNames() and text.count() == 1
    assert read_table(spark, report.outputs["fact_csv"]).columns == FACT.fieldNames()


def test_run_again_replaces_the_outputs(spark, tables, tmp_path):
    for _ in range(2):
        report = pipeline.run(spark, tables, str(tmp_path), partition_by=("event_year_month",))
    assert report.row_counts["fact"] == 3


def test_one_month_can_be_run_again(spark, tables, events, roster, tmp_path):
    options = {"partition_by": ("event_year_month",), "replace_partitions_only": True}
    tables["events"] = events(
        {"start_time": "2025-01-10 10:00:00"}, {"start_time": "2025-02-10 10:00:00"}
    )
    pipeline.run(spark, tables, str(tmp_path), **options)
    tables["events"] = events({"event_id": "E2"}, {}, start_time="2025-02-11 10:00:00")
    report = pipeline.run(spark, tables, str(tmp_path), **options)
    assert report.row_counts["fact"] == 3
    summary = read_table(spark, report.outputs["summary_parquet"], SUMMARY)
    assert {r["event_date"]: r["event_count"] for r in summary.collect()} == {
        "2025-01-10": 1,
        "2025-02-11": 2,
    }


def test_parquet_inputs_keep_their_types(spark, tables, tmp_path):
    for key, name in (
        ("events", "maintenance_events"),
        ("production", "manufacturing_factory_dataset"),
        ("roster", "operators_roster"),
    ):
        write(tables[key], str(tmp_path / f"in/{name}.parquet"))
    typed = tables["events"].selectExpr(
        "* EXCEPT (start_time)", "CAST(start_time AS timestamp_ntz) AS start_time"
    )
    write(typed, str(tmp_path / "in/maintenance_events.parquet"))
    inputs = pipeline.read_inputs(spark, str(tmp_path / "in"), "parquet")
    report = pipeline.run(spark, inputs, str(tmp_path / "out"))
    assert report.row_counts["fact"] == 3
    fact = read_table(spark, report.outputs["fact_parquet"], FACT)
    assert {str(r["start_timestamp"]) for r in fact.collect()} == {"2025-01-10 09:00:00"}


def test_parquet_only(spark, tables, tmp_path):
    report = pipeline.run(spark, tables, str(tmp_path), formats=("parquet",))
    assert set(report.outputs) == {"fact_parquet", "summary_parquet"}


def test_failed_rules_warn_or_raise(spark, tables, events, tmp_path):
    tables["events"] = events({"event_id": None})
    assert pipeline.run(spark, tables, str(tmp_path / "a")).status == "success"
    with pytest.raises(QualityError):
        pipeline.run(spark, tables, str(tmp_path / "b"), Params(on_fail="raise"))
    assert not (tmp_path / "b").exists()


def test_row_count_gate_stops_the_run(spark, tables, tmp_path):
    params = Params(expected_rows=ExpectedRows(events=(90, 100)))
    report = pipeline.run(spark, tables, str(tmp_path), params, raise_errors=False)
    assert report.status == "failed"
    assert "row_count" in report.errors[0]
    assert not report.outputs


def test_stored_fact_is_checked(spark, tables, events, tmp_path):
    good = pipeline.run(spark, tables, str(tmp_path), Params(expected_total_cost=(300, 300)))
    assert good.validations["fact"]["passed"]
    low = pipeline.run(spark, tables, str(tmp_path), Params(expected_total_cost=(0, 299)))
    assert low.status == "success" and low.validations["fact"]["issues"] == {"total_cost": 1}
    tables["events"] = events({"cost_eur": -1.0})
    negative = pipeline.run(spark, tables, str(tmp_path))
    assert negative.validations["events"]["passed"]
    assert not negative.validations["fact"]["passed"]


def test_csv_inputs(spark, tables, events, tmp_path):
    write(tables["events"], str(tmp_path / "in/maintenance_events.csv"), "csv")
    write(tables["production"], str(tmp_path / "in/manufacturing_factory_dataset.csv"), "csv")
    (tmp_path / "in/operators_roster.csv").write_text(
        "operator_id,name,factory_id,primary_line,primary_shift,skill_level,certifications,"
        "team,hire_date,overtime_eligible,hourly_rate_eur,reliability_score\n"
        'T1,x,F1,L1,Day,Senior,"a,b",t,2020-01-01,true,30.5,90.0\n'
        'T2,y,F1,L1,Day,Junior,"a,b",t,2020-01-01,true,30.5,many\n'
    )
    inputs = pipeline.read_inputs(spark, str(tmp_path / "in"))
    report = pipeline.run(spark, inputs, str(tmp_path / "out"))
    assert report.row_counts["fact"] == 3
    assert report.validations["roster"]["issues"] == {"unreadable_values": 1}
    assert report.validations["events"]["issues"] == {}
    fact = read_table(spark, report.outputs["fact_parquet"], FACT)
    assert fact.where("operator_skill_level = 'Senior'").count() == 2


def test_new_files_are_ingested_once(spark, events, roster, tmp_path):
    source, out, check = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))
    people = roster(("T1", "Senior", 90.0))

    def ingest():
        query = ingest_new_files(spark, source, people, out, check)
        query.awaitTermination()
        return read_table(spark, out, FACT)

    write(events({}, {}), source, "csv", mode="append")
    assert ingest().count() == 2
    assert ingest().count() == 2
    write(events({"event_id": "E2", "technician_id": "T9"}), source, "csv", mode="append")
    stored = ingest()
    assert stored.count() == 3
    assert stored.where("technician_in_roster").count() == 2
    batch = pipeline.fact_of(read_table(spark, source, EVENTS, "csv"), people)
    columns = [c for c in FACT.fieldNames() if c != "load_timestamp"]
    assert stored.select(columns).exceptAll(batch.select(columns)).isEmpty()


def test_a_rerun_keeps_the_neighbours(spark, tables, events, tmp_path):
    by_month = {"partition_by": ("event_year_month",), "replace_partitions_only": True, "formats": ("parquet",)}

    def run(*rows):
        tables["events"] = events(*rows)
        report = pipeline.run(spark, tables, str(tmp_path), **by_month)
        assert report.validations["fact"]["passed"]
        return {r[0]: r[1] for r in read_table(spark, report.outputs["fact_parquet"], FACT).select("maint_event_id", "cost_eur").collect()}

    february = [{"event_id": f"F{i}", "start_time": f"2025-02-1{i} 10:00:00", "end_time": f"2025-02-1{i} 11:00:00"} for i in range(5)]
    assert len(run(*february)) == 5
    # The first hour of March in Paris is still February in UTC; F1 is given anew.
    march = [
        {"event_id": "M1", "start_time": "2025-03-01 00:30:00", "end_time": "2025-03-01 02:30:00"},
        {"event_id": "M2", "start_time": "2025-03-05 10:00:00", "end_time": "2025-03-05 11:00:00"},
        {**february[1], "cost_eur": 7.0},
    ]
    stored = run(*march)
    assert set(stored) == {"F0", "F1", "F2", "F3", "F4", "M1", "M2"} and stored["F1"] == 7.0


def test_ids_that_differ_by_blanks_are_one(spark, tables, events, roster, tmp_path):
    tables["events"] = events({"event_id": "E1"}, {"event_id": "E1 ", "technician_id": "T9 "})
    tables["roster"] = roster(("T9 ", "Senior", 90.0), ("T8", "Junior", 50.0), (" T8", "Junior", 50.0))
    report = pipeline.run(spark, tables, str(tmp_path))
    assert report.validations["events"]["issues"]["duplicate_event_id"] == 1
    assert report.validations["roster"]["issues"]["duplicate_operator_id"] == 1
    assert read_table(spark, report.outputs["fact_parquet"], FACT).where("technician_in_roster").count() == 1


def test_unknown_formats_are_refused_at_once(spark, tables, tmp_path):
    with pytest.raises(ValueError):
        pipeline.run(spark, tables, str(tmp_path), formats=("orc",))
    with pytest.raises(ValueError):
        pipeline.run(spark, tables, str(tmp_path), replace_partitions_only=True)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("options", [{}, {"partition_by": ("event_year_month",), "replace_partitions_only": True}])
def test_csv_copies_are_compressed_and_read_alike(spark, tables, tmp_path, options):
    report = pipeline.run(spark, tables, str(tmp_path), **options)
    for key, schema in (("fact", FACT), ("summary", SUMMARY)):
        text = report.outputs[f"{key}_csv"]
        files = [f.name for f in Path(text).rglob("part-*")]
        assert files and all(f.endswith(".csv.gz") for f in files)
        stored = read_table(spark, report.outputs[f"{key}_parquet"], schema).select(*schema.fieldNames())
        columns = ", ".join(f"{c} string" for c in read_table(spark, text).columns)
        read = read_table(spark, text, columns).select(*schema.fieldNames())
        key_column = schema.fieldNames()[0]
        assert sorted(map(str, read.select(key_column).collect())) == sorted(map(str, stored.select(key_column).collect()))
