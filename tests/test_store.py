"""Merging loads into a stored fact: nothing lost, nothing twice, no other partition read."""

import pytest

from millwright.operators.quality import QualityError
from millwright.operators.summary import merged, metrics, partial_metrics, rollup_metrics
from millwright.params import ExpectedRows, Params
from millwright.plans import pipeline
from millwright.schemas import FACT, SUMMARY
from millwright.sinks import store
from millwright.sinks.export import write
from millwright.sinks.store import FactStore
from millwright.sources.tables import read_table
from millwright.streaming import ingest
from millwright.streaming.ingest import add_batch, ingest_new_files, read_repeats

BY_MONTH = {"partition_by": ("event_year_month",), "replace_partitions_only": True, "formats": ("parquet",)}


def event(name, month, **more):
    times = {} if month is None else {"start_time": f"2025-{month}-10 10:00:00", "end_time": f"2025-{month}-10 11:00:00"}
    return {"event_id": name, "start_time": "unknown", "end_time": "unknown", **times, **more}


@pytest.fixture
def load(spark, events, roster, tmp_path):
    def run(*rows, params=Params(), read=True, **options):
        tables = {"events": events(*rows), "roster": roster(("T1", "Senior", 90.0))}
        report = pipeline.run(spark, tables, str(tmp_path), params, **{**BY_MONTH, **options})
        if not read:
            return None
        fact = read_table(spark, report.outputs["fact_parquet"], FACT)
        found = sorted([(r.maint_event_id, r.event_year_month, r.cost_eur) for r in fact.collect()], key=repr)
        assert report.row_counts["fact"] == len(found)
        summary = read_table(spark, report.outputs["summary_parquet"], SUMMARY).select(*SUMMARY.fieldNames())
        assert sorted(map(repr, summary.collect())) == sorted(map(repr, rollup_metrics(fact).collect()))
        return found

    return run


def test_an_event_that_moves_is_there_once(load):
    load(event("e1", "01"), event("e2", "01"))
    assert load(event("e1", "02")) == [("e1", "2025-02", 100.0), ("e2", "2025-01", 100.0)]
    assert load(event("e2", "02", cost_eur=1.0)) == [("e1", "2025-02", 100.0), ("e2", "2025-02", 1.0)]
    # January is empty now, and takes rows again.
    assert load(event("e1", "01")) == [("e1", "2025-01", 100.0), ("e2", "2025-02", 1.0)]


def test_rows_without_month_or_id_survive(load):
    load(event("e1", None), event("e2", "01"), event(None, "01", cost_eur=5.0))
    rows = [("e1", None, 100.0), ("e2", "2025-01", 100.0), ("e3", None, 100.0), (None, "2025-01", 5.0)]
    assert load(event("e3", None)) == sorted(rows, key=repr)
    assert load(event(None, "01", cost_eur=5.0)) == sorted(rows, key=repr)  # says the same: the same event
    more = [*rows, (None, "2025-01", 6.0), (None, None, 5.0)]
    assert load(event(None, "01", cost_eur=6.0), event(None, None, cost_eur=5.0)) == sorted(more, key=repr)
    moved = [("e1", "2025-03", 100.0), *more[1:]]
    assert load(event("e1", "03")) == sorted(moved, key=repr)


def test_repeats_within_a_load_stay_and_are_replaced_together(load):
    load(event("e1", "01", cost_eur=1.0), event("e1", "02", cost_eur=2.0))
    assert load(event("e1", "03")) == [("e1", "2025-03", 100.0)]


def test_other_partitions_are_not_read(load, tmp_path):
    load(event("e1", "01"), event("e2", "02"), event("e3", "03"))
    kept = [p for folder in ("fact_maintenance_events", "summary_maintenance_metrics") for p in (tmp_path / f"{folder}.parquet").glob("event_year_month=2025-02/*.parquet")]
    before = {p: p.read_bytes() for p in kept}
    for p in kept:
        p.write_bytes(b"no parquet")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    load(event("e1", "03"), formats=("parquet",), read=False)
    for p, data in before.items():
        assert p.read_bytes() == b"no parquet"
        p.write_bytes(data)
    assert load(event("e4", "04")) == [("e1", "2025-03", 100.0), ("e2", "2025-02", 100.0), ("e3", "2025-03", 100.0), ("e4", "2025-04", 100.0)]


def test_checked_before_the_overwrite(load, spark, tmp_path):
    load(event("e1", "01"), event("e2", None))
    with pytest.raises(QualityError):
        load(event("e3", "01", cost_eur=-1.0), params=Params(on_fail="raise", expected_rows=ExpectedRows(fact=(9, 9))))
    fact = read_table(spark, str(tmp_path / "fact_maintenance_events.parquet"), FACT)
    assert sorted(r.maint_event_id for r in fact.collect()) == ["e1", "e2"]


def test_a_run_that_broke_off_is_made_good(load, spark, tmp_path, monkeypatch):
    load(event("e1", "01"), event("e2", "02"))
    with monkeypatch.context() as m:
        m.setattr(pipeline._Periods, "update", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(event("e1", "02", cost_eur=7.0))
    # The fact was changed, the summary was not: the next run, of another month, does all.
    assert load(event("e3", "03")) == [("e1", "2025-02", 7.0), ("e2", "2025-02", 100.0), ("e3", "2025-03", 100.0)]


def test_a_full_run_forgets_the_locator(load):
    load(event("e1", "01"), event("e2", "01"))
    load(event("e1", "05"), event("e4", "05"), replace_partitions_only=False)
    assert load(event("e1", "06")) == [("e1", "2025-06", 100.0), ("e4", "2025-05", 100.0)]


def test_a_table_without_locator_gets_one(load, spark, tmp_path):
    load(event("e1", "01"), event("e2", "01"), replace_partitions_only=False)
    assert load(event("e1", "02")) == [("e1", "2025-02", 100.0), ("e2", "2025-01", 100.0)]


def test_partitions_of_several_columns_and_csv(load, spark, tmp_path):
    options = {"partition_by": ("factory_id", "severity_level"), "formats": ("parquet", "csv")}
    load(event("e1", "01"), event("e2", "02", factory_id=None), event("e3", "03", factory_id="a/b=c"), **options)
    rows = load(event("e2", "02", cost_eur=9000.0, factory_id="F2"), event("e3", "03", cost_eur=1.0, factory_id="a/b=c"), **options)
    assert rows == [("e1", "2025-01", 100.0), ("e2", "2025-02", 9000.0), ("e3", "2025-03", 1.0)]
    text = read_table(spark, str(tmp_path / "fact_maintenance_events.csv"))
    assert sorted(r.maint_event_id for r in text.collect()) == ["e1", "e2", "e3"]


def test_nothing_is_left_in_the_scratch_folder(load, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(store, "new_path", lambda spark, label: f"{scratch}/{label}")
    load(event("e1", "01"))
    load(event("e1", "02"))
    assert scratch.exists() and not list(scratch.rglob("*.parquet"))


def test_partials_add_up_to_the_whole(spark, events, roster):
    rows = [{"cost_eur": c, "downtime_min": d} for c, d in ((0.1, 1), (0.2, None), (None, 5), (1e300, 2), (-3.0, 0))]
    fact = pipeline.fact_of(events(*rows * 3), roster(("T1", "Senior", 90.0)))
    halves = [partial_metrics(fact.where(c)) for c in ("maint_event_id < 'E5'", "maint_event_id >= 'E5'")]
    parts = merged(halves[0].unionByName(halves[1]))
    assert parts.dtypes == partial_metrics(fact).dtypes
    assert metrics(parts).collect() == rollup_metrics(fact).collect()


def test_write_counts_what_it_commits(spark, tmp_path):
    df = spark.range(1000, numPartitions=7)
    path = str(tmp_path / "t")
    assert write(df, path) == 1000 and write(df, path, mode="append") == 1000
    assert write(df, path, mode="ignore") == 0 and write(df.limit(0), path) == 0
    assert write(df.withColumn("p", df.id % 3), path + "2", partition_by=["p"]) == 1000


def test_one_id_is_found_in_few_row_groups(spark, tmp_path):
    """Files clustered by id with Bloom filters: a lookup reads a part of the rows."""
    path = str(tmp_path / "t")
    df = spark.range(200_000).selectExpr("concat('EV-', id) AS maint_event_id", "id % 2 AS p", "id AS x")
    write(df, path, partition_by=["p"], cluster_by=["maint_event_id"], bloom=["maint_event_id"])
    found = spark.read.parquet(path).where("maint_event_id = 'EV-777'")
    assert [r.x for r in found.collect()] == [777]
    assert scanned(found) < 200_000 / 2
    assert scanned(spark.read.parquet(path).where("maint_event_id = 'EV-777x'")) == 0


def scanned(df):
    """Rows that the scans of a plan gave, from their metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_locator_grows_by_new_events_only(spark, events, roster, tmp_path):
    table = FactStore(spark, str(tmp_path / "fact"), ("event_year_month",))
    people = roster(("T1", "Senior", 90.0))
    fact = pipeline.fact_of(events(event("e1", "01"), event("e2", "02")), people)
    write(fact, table.path, partition_by=table.partition_by)
    for _ in range(2):
        staged = table.stage(pipeline.fact_of(events(event("e1", "01", cost_eur=3.0)), people))
        assert staged.touched == [("2025-01",)] and (staged.new_count, staged.count) == (1, 1)
        assert table.commit(staged) == []
    entries = spark.read.schema(table._locator_schema()).option("recursiveFileLookup", True).parquet(table.locator)
    assert entries.count() == 2


@pytest.fixture
def stream(spark, events, roster, tmp_path):
    source, out, check = (str(tmp_path / d) for d in ("in", "fact", "checkpoint"))

    def run(*rows, checkpoint=check):
        if rows:
            write(events(*rows), source, "csv", mode="append")
        ingest_new_files(spark, source, roster(("T1", "Senior", 90.0)), out, checkpoint).awaitTermination()
        stored = read_table(spark, out, FACT).collect()
        repeats = read_repeats(spark, out).collect()
        key = lambda rows, *more: sorted([(r.maint_event_id, r.cost_eur, *[r[m] for m in more]) for r in rows], key=repr)
        return key(stored), key(repeats, "repeats")

    return run


def test_a_repeated_id_in_a_later_file_is_reported(stream):
    assert stream(event("e1", "01"), event("e2", "02")) == ([("e1", 100.0), ("e2", 100.0)], [])
    rows = event("e1", "05", cost_eur=9.0), event("e3", "01"), event("e3", "01"), event(None, "01"), event(None, "01", cost_eur=2.0)
    stored = sorted([("e1", 100.0), ("e2", 100.0), ("e3", 100.0), (None, 100.0), (None, 2.0)], key=repr)
    repeats = [("e1", 9.0, "a stored event"), ("e3", 100.0, "its own load")]
    assert stream(*rows) == (stored, repeats)
    assert stream() == (stored, repeats)


def test_a_batch_that_is_given_again_is_stored_once(spark, stream, events, roster, tmp_path):
    """The same batch number after a failure: nothing twice, and the same report."""
    people = roster(("T1", "Senior", 90.0))
    stream(event("e1", "01"))
    table = FactStore(spark, str(tmp_path / "fact"), ("event_year_month",))
    batch = pipeline.fact_of(events(event("e1", "03", cost_eur=4.0), event("e5", "03"), event("e6", "04"), event("e6", "04")), people)
    for _ in range(2):
        add_batch(table, batch, "1")
        stored = [r.maint_event_id for r in read_table(spark, table.path, FACT).collect()]
        assert sorted(stored) == ["e1", "e5", "e6"]
        repeats = [(r.maint_event_id, r.repeats) for r in read_repeats(spark, table.path).collect()]
        assert sorted(repeats) == [("e1", "a stored event"), ("e6", "its own load")]


def test_ingest_and_merge_share_the_table(spark, stream, events, roster, tmp_path):
    stream(event("e1", "01"), event("e2", "02"))
    table = FactStore(spark, str(tmp_path / "fact"), ("event_year_month",))
    table.commit(table.stage(pipeline.fact_of(events(event("e1", "07", cost_eur=8.0)), roster(("T1", "Senior", 90.0)))))
    assert stream(event("e1", "01"), event("e9", "01")) == (
        [("e1", 8.0), ("e2", 100.0), ("e9", 100.0)],
        [("e1", 100.0, "a stored event")],
    )


def test_new_events_of_a_batch_are_not_compared(spark, stream, events, roster, tmp_path, monkeypatch):
    """Only events whose hash is stored or repeated are sorted and held against the table."""
    stream(event("e1", "01"))
    given, counts = ingest.write, {}

    def counted(df, path, *a, **b):
        counts[path.rsplit("/", 1)[-1]] = n = given(df, path, *a, **b)
        return n

    monkeypatch.setattr(ingest, "write", counted)
    rows = [event("e1", "03"), event(None, "03"), event(None, "03"), *[event(f"n{i}", "03") for i in range(20)]]
    table = FactStore(spark, str(tmp_path / "fact"), ("event_year_month",))
    add_batch(table, pipeline.fact_of(events(*rows), roster(("T1", "Senior", 90.0))), "7")
    assert read_table(spark, table.path, FACT).count() == 22
    assert counts["given"] == 23 and counts["numbered"] == 3 and counts["fact"] == 21
