from collections import defaultdict

import pytest
from conftest_llm import ODD

from millwright.llm import mixing
from millwright.llm.common import table
from millwright.llm.queries import ORACLE, QUERIES


def plain_targets(sizes):
    """Shares by weight, caps held, the excess reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, held = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(2 * sizes[s] for s in held)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in held else share[s] for s in names}
        held |= over


def check(got, rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    targets = plain_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    by_target = {(sizes[s], round(targets[s], 6)): s for s in sizes}
    for r in got:
        source = by_target[r.source_size, round(r.target, 6)]
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 or len(by_target) < len(sizes)


def test_against_brute_force(spark, rows_of):
    got = mixing.mix(table(spark, "/root/testdata/sf0.001", "documents")).collect()
    check(got, rows_of("documents", "doc_id, text, source"))


def test_sql_says_the_same(spark):
    import duckdb
    from checks.compare import differences

    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert differences(QUERIES["op6_mixing"](spark, "/root/testdata/sf0.001"), con, ORACLE["op6_mixing"]) == []


def test_odd_rows(documents):
    got = mixing.mix(documents(*ODD))
    check(got.collect(), ODD)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mix(documents(*reversed(ODD))).collect()))


def test_small_buckets_give_the_same(documents, monkeypatch):
    rows = [(i, "w " * (i % 7 + 1), "hot" if i % 3 else "x") for i in range(200)]
    want = sorted(map(str, mixing.mix(documents(*rows)).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert sorted(map(str, mixing.mix(documents(*rows)).collect())) == want


def test_sources_without_words_and_empty_tables(documents):
    got = mixing.mix(documents((1, "", "a"), (2, None, "b"))).collect()
    assert {(r.doc_id, r.target, r.taken) for r in got} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert mixing.mix(documents()).collect() == []


@pytest.mark.parametrize("first, last", mixing.RAMPS)
def test_time_is_the_inverse_of_demand(spark, first, last):
    from pyspark.sql import functions as F

    at = F.col("id") / 100
    df = spark.range(101).select(at.alias("part"), mixing.time_of(F.lit(first), F.lit(last), at).alias("t"))
    back = df.select("part", "t", mixing.demand(F.lit(first), F.lit(last), F.col("t")).alias("again")).collect()
    assert all(abs(r.part - r.again) < 1e-9 and 0 <= r.t <= 1 for r in back)


def test_carried_columns_come_once_for_each_copy(documents):
    rows = [(i, f"some words of {i}", "ab"[i % 2]) for i in range(40)]
    copies = {r.doc_id: r.copies for r in mixing.mix(documents(*rows)).collect()}
    carried = mixing.mix(documents(*rows), carry={"doc_id": "doc_id", "text": "text"}).collect()
    assert sorted(r.doc_id for r in carried) == sorted(d for d, n in copies.items() for _ in range(n))
    assert all(r.text == f"some words of {r.doc_id}" for r in carried)
