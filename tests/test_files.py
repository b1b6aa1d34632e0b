from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwright.operators import quality as q
from millwright.plans.pipeline import fact_of
from millwright.schemas import EVENTS, FACT
from millwright.sinks.export import _contenders, csv_safe, present, write
from millwright.sources.tables import read_csv_checked, read_table


def part_files(path, suffix):
    return sorted(p for p in path.rglob(f"part-*{suffix}*"))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def fact(events, roster):
    e = events(
        {"start_time": "2025-01-10 10:00:00"},
        {"start_time": "2025-02-10 10:00:00", "parts_used": None, "outcome": 'say "hi", ok'},
    )
    return fact_of(e, roster(("T1", "Senior", 90.0)))


def test_csv_events_round_trip(spark, events, tmp_path):
    df = events({"parts_used": "P1,P2", "outcome": 'a "quoted" one, with comma'}, {"cost_eur": None})
    write(df, str(tmp_path / "e.csv"), "csv")
    assert same(read_table(spark, str(tmp_path / "e.csv"), EVENTS), df)


def test_csv_schema_can_be_inferred(spark, events, tmp_path):
    write(events({"downtime_min": 7}), str(tmp_path / "e.csv"), "csv")
    df = read_table(spark, str(tmp_path / "e.csv"))
    assert df.columns == EVENTS.fieldNames()
    assert df.first()["downtime_min"] == 7


def test_values_that_do_not_convert_are_found(spark, tmp_path):
    path = tmp_path / "roster.csv"
    path.write_text("operator_id,score,hired\nT1,5.5,2020-01-01\nT2,high,soon\nT3,,\n")
    schema = StructType.fromDDL("operator_id string, score double, hired date")
    df = read_csv_checked(spark, str(path), schema)
    report = q.evaluate(df, "roster", [q.Check("unreadable", "unreadable_columns <> ''")])
    assert report.first()["violations"] == 1
    assert [tuple(r) for r in df.orderBy("operator_id").collect()] == [
        ("T1", 5.5, date(2020, 1, 1), ""),
        ("T2", None, None, "score|hired"),
        ("T3", None, None, ""),
    ]
    assert [f.dataType for f in df.schema.fields][:3] == [f.dataType for f in schema.fields]


def test_unknown_formats(spark, fact, tmp_path):
    with pytest.raises(ValueError):
        write(fact, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "x"), fmt="xlsx")


def test_parquet_round_trip_by_month(spark, fact, tmp_path):
    write(fact, str(tmp_path / "f"), partition_by=["event_year_month"])
    assert {p.name for p in (tmp_path / "f").glob("event_year_month=*")} == {
        "event_year_month=2025-01", "event_year_month=2025-02",
    }
    back = read_table(spark, str(tmp_path / "f"), FACT).select(*FACT.fieldNames())
    assert same(back.drop("load_timestamp"), fact.drop("load_timestamp"))


def test_partition_replacement_touches_only_its_own_months(spark, fact, tmp_path):
    path = str(tmp_path / "f")
    write(fact, path, partition_by=["event_year_month"])
    changed = fact.where("event_year_month = '2025-02'").withColumn("outcome", F.lit("new"))
    write(changed, path, partition_by=["event_year_month"], replace_partitions_only=True, rebalance=False)
    rows = read_table(spark, path, FACT).collect()
    assert {r["event_year_month"]: r["outcome"] for r in rows} == {
        "2025-01": "Restored",
        "2025-02": "new",
    }


def test_save_modes(spark, events, tmp_path):
    path, df = str(tmp_path / "e"), events({}, {})
    write(df, path, mode="error")
    with pytest.raises(Exception, match="(?i)exists"):
        write(df, path, mode="error")
    write(df, path, mode="ignore")
    assert read_table(spark, path, EVENTS).count() == 2
    write(df, path, mode="append")
    assert read_table(spark, path, EVENTS).count() == 4
    write(df, path, mode="overwrite")
    assert read_table(spark, path, EVENTS).count() == 2


def test_file_count(spark, tmp_path):
    df = spark.range(1000).repartition(4)
    write(df, str(tmp_path / "many"))
    assert len(part_files(tmp_path / "many", ".parquet")) == 4
    write(df, str(tmp_path / "one"), num_files=1)
    assert len(part_files(tmp_path / "one", ".parquet")) == 1
    write(df, str(tmp_path / "small"), num_files=1, rows_per_file=300)
    assert len(part_files(tmp_path / "small", ".parquet")) == 4


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_csv_safe(spark, zone, session_zone):
    zone(session_zone)
    df = spark.sql(
        """SELECT array('a','b') AS arr, CAST(NULL AS array<string>) AS none, map('k', 1) AS m,
                  named_struct('x', 1) AS s, timestamp_ntz'2025-03-09 02:30:00.123' AS t, 1 AS n"""
    )
    assert csv_safe(df).first().asDict() == {
        "arr": '["a","b"]', "none": None, "m": '{"k":1}', "s": '{"x":1}',
        "t": "2025-03-09 02:30:00", "n": 1,
    }


def test_csv_is_quoted_with_a_header(fact, tmp_path):
    write(fact.where("parts_count = 0"), str(tmp_path / "f.csv"), "csv", num_files=1)
    lines = part_files(tmp_path / "f.csv", ".csv")[0].read_text().splitlines()
    assert lines[0] == ",".join(f'"{c}"' for c in FACT.fieldNames())
    assert '"say ""hi"", ok"' in lines[1]
    assert '"2025-02-10 09:00:00"' in lines[1]


def test_present(spark):
    df = spark.range(100).select("id", (F.col("id") / 3).alias("x"))
    rows = present(df, ["-x"], limit=2).collect()
    assert [tuple(r) for r in rows] == [(99, 33.0), (98, 32.67)]
    assert present(df, ["x"], limit=2, precision=4).collect()[1]["x"] == 0.3333
    money = spark.sql("SELECT 1.25BD AS a, 1.255BD AS b")
    assert [str(v) for v in present(money, ["a"]).first()] == ["1.25", "1.26"]
    assert present(money, ["a"]).dtypes[0] == money.dtypes[0]


@pytest.mark.parametrize("order", [["-x", "id"], ["x", "-id"], ["y", "id"], ["-y", "id"], ["n", "id"]])
@pytest.mark.parametrize("limit", [1, 7, 100, 5000])
def test_narrowing_keeps_the_result(spark, order, limit):
    """With ties on a third of the rows, missing values, and a column of one value."""
    key = F.col("id")
    df = spark.range(3000).select(
        "id",
        F.when(key % 3 == 0, 500).when(key % 3 == 1, key * 7 % 1000).alias("x"),
        F.concat(F.lit("k"), key * 13 % 3000).alias("y"),
        F.lit(1).alias("n"),
    ).repartition(5)
    plain, narrowed = present(df, order, limit), present(df, order, limit, narrow=True)
    assert narrowed.collect() == plain.collect()


def test_narrowing_leaves_out_most_rows(spark):
    df = spark.range(100_000).select("id", (F.col("id") * 7919 % 99_991).alias("x"))
    kept = _contenders(df, ["-x", "id"], 100).count()
    assert 100 <= kept < 300


def test_timestamps_read_back_unchanged(spark, fact, tmp_path, zone):
    write(fact, str(tmp_path / "f"))
    zone("America/New_York")
    first = read_table(spark, str(tmp_path / "f"), FACT).orderBy("maint_event_id").first()
    assert first["start_timestamp"] == datetime(2025, 1, 10, 9, 0)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("extra,b,a\nx,2,one\ny,two,deux\n")
    schema = "a string, b int"
    df = read_csv_checked(spark, str(path), spark.createDataFrame([], schema).schema)
    assert [tuple(r) for r in df.collect()] == [("one", 2, ""), ("deux", None, "b")]
    with pytest.raises(ValueError, match="lacks"):
        read_csv_checked(spark, str(path), spark.createDataFrame([], "a string, c int").schema)


def test_malformed_rows_are_reported(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b,c\n1,2,3\n1,2\n1,2,3,4\n\"x,y\",2,3\n")
    df = read_csv_checked(spark, str(path), spark.createDataFrame([], "a string, c int").schema)
    assert [r["unreadable_columns"] for r in df.select("unreadable_columns").collect()] == [
        "", "malformed row", "malformed row", "",
    ]


def test_files_whose_header_differs_are_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):  # noqa: B017
        read_csv_checked(spark, str(tmp_path), spark.createDataFrame([], "a string, b int").schema).collect()


def test_ties_in_the_leading_column_are_narrowed_too(spark):
    df = spark.range(5000).selectExpr("1 AS lead", "id")
    assert _contenders(df, ["lead", "-id"], 10).count() < 200
    assert present(df, ["lead", "-id"], 3).collect() == present(df, ["lead", "-id"], 3, narrow=False).collect()


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    odd = [
        "one\ntwo", "one\r\ntwo", "a\rb", 'say "yes"', '"', '""', "\\", '\\"', "a,b", "  blanks  ", "\t", "tab\there",
        "ends\n", "\nbegins", "é\U0001f600\n,\"\\n\"", "x" * 100_000 + "\ny", "null", "NULL", "#c", "-",
    ]
    df = spark.createDataFrame([(i, t, i * 0.5) for i, t in enumerate(odd)], "n int, t string, d double")
    for i, out in enumerate((df.repartition(3), df.coalesce(1).select("t", "d", "n"))):
        path = str(tmp_path / f"odd{i}.csv")
        write(out, path, "csv")
        checked = read_csv_checked(spark, path, df.schema)
        assert checked.where("unreadable_columns <> ''").isEmpty()
        for read in (checked, read_table(spark, path, out.schema, "csv")):
            assert [r.t for r in read.orderBy("n").collect()] == odd


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    from millwright.sinks import export

    monkeypatch.setattr(export, "CSV_ROWS", 10)
    write(spark.range(95).coalesce(1), str(tmp_path / "a.csv"), "csv")
    assert len(part_files(tmp_path / "a.csv", ".csv")) == 10


def test_unclosed_lines_without_line_breaks(spark, tmp_path):
    """Files whose values hold no line breaks can be read line by line, in parallel."""
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n2,y\n')
    schema = spark.createDataFrame([], "a int, b string").schema
    rows = read_csv_checked(spark, str(tmp_path / "a.csv"), schema, line_breaks=False).collect()
    assert [r.a for r in rows] == [1, 2]


def test_rows_without_the_clustering_key_take_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        rows = spark.range(10_000).selectExpr("'m' AS month", "if(id % 10 = 0, string(id), null) AS id", "id AS n")
        write(rows, str(tmp_path / "f"), partition_by=["month"], cluster_by=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(str(tmp_path / "f")).groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 10_000 and max(r["count"] for r in files) < 5_000
