"""The physical plans that the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from millwright.operators import kpis, quality, summary
from millwright.plans.pipeline import fact_of
from millwright.schemas import EVENTS
from millwright.sinks.export import write
from millwright.sources.tables import read_table


@pytest.fixture
def stored(spark, events, tmp_path):
    write(events({}, {}, {}), str(tmp_path / "events"))
    return read_table(spark, str(tmp_path / "events"), EVENTS)


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def tree(text):
    return text.split("\n\n\n")[0]


def test_key_figure_filters_and_columns_reach_the_scan(stored, capsys):
    text = plan(kpis.cost(stored), capsys)
    assert "GreaterThanOrEqual(cost_eur,0.0)" in text
    assert re.search(r"ReadSchema: struct<cost_eur:double>", text)


def test_rules_share_one_scan_and_keys_shuffle_alone(stored, capsys):
    rules = quality.event_rules()
    text = plan(quality.evaluate(stored, "events", rules), capsys)
    assert tree(text).count("Scan parquet") == 2  # all predicate rules, and the key
    assert "ReadSchema: struct<event_id:string>" in text
    predicates = [r for r in rules if isinstance(r, quality.Check)]
    assert tree(plan(quality.evaluate(stored, "events", predicates), capsys)).count("Scan") == 1


def test_fused_report_reads_once(stored, capsys):
    assert tree(plan(kpis.report(stored), capsys)).count("Scan parquet") == 1


def test_composition_copies_no_raw_rows(stored, capsys):
    text = tree(plan(kpis.composition(stored), capsys))
    above_expand = text[text.index("Expand") :]
    assert above_expand.index("HashAggregate") < above_expand.index("Scan parquet")


def test_shares_take_totals_from_the_grouped_rows(stored, capsys):
    text = plan(kpis.share_of_total(stored), capsys)
    assert "Window" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_fact_needs_no_shuffle_and_runs_as_generated_code(stored, roster, capsys, spark, tmp_path):
    write(roster(("T1", "Senior", 90.0)), str(tmp_path / "roster"))
    people = spark.read.parquet(str(tmp_path / "roster"))
    text = tree(plan(fact_of(stored, people), capsys))
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    assert "SortMergeJoin" not in text and "Exchange hash" not in text
    assert "Python" not in text


def test_summary_combines_before_its_only_shuffle(stored, roster, capsys):
    df = summary.rollup_metrics(fact_of(stored, roster(("T1", "Senior", 90.0)), strategy="broadcast"))
    text = plan(df, capsys)
    assert tree(text).count("HashAggregate") == 2
    assert len(re.findall(r"\) Exchange\n", text)) == 1


def test_stored_months_are_pruned(spark, stored, roster, tmp_path, capsys):
    fact = fact_of(stored, roster(("T1", "Senior", 90.0)))
    write(fact, str(tmp_path / "fact"), partition_by=["event_year_month"])
    df = spark.read.parquet(str(tmp_path / "fact")).where(F.col("event_year_month") == "2025-01")
    assert re.search(r"PartitionFilters: \[[^\]]*event_year_month", plan(df, capsys))
