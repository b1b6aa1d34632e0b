import time
from functools import partial

import pytest
from pyspark.sql import functions as F

from millwright.llm import common, simhash, warc


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("few", [0, 100])
def test_split_join_equals_a_plain_join(spark, how, few):
    rows = spark.range(1000).select(F.col("id").alias("at"), F.expr("if(id < 700, 1, id % 7 + 2)").alias("k"))
    side = rows.where("k < 6").groupBy("k").agg(F.count("*").alias("n"), F.min("at").alias("least"))
    got = common.split_join(rows, side, ["k"], ["at"], how, few=few, most=50)
    want = rows.join(side.drop("n"), "k", how)
    assert sorted(map(tuple, got.select("k", "at", "least").collect()), key=str) == sorted(
        map(tuple, want.select("k", "at", "least").collect()), key=str
    )


def test_split_join_deals_a_hot_key(spark):
    rows = spark.range(1000).select("id", F.lit(1).alias("k"))
    side = rows.groupBy("k").agg(F.count("*").alias("n"))
    plan = common.split_join(rows, side, ["k"], ["id"], few=0, most=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    with_few = common.split_join(rows, side, ["k"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in with_few and "broadcast" in with_few


def test_archives_and_groups_do_not_depend_on_the_join(spark, documents, monkeypatch):
    html = [(1, "u", "x" * 2000), (2, "u", "x" * 2000), (3, "v", "x" * 2000), (4, "v", "y" * 2000), (None, "w", "y" * 2000)]
    pages = spark.createDataFrame(html, "page_id long, url string, html string")
    docs = documents((1, "a b c d"), (2, "a b c d"), (3, "a b c d"), (4, "other words in here"), (None, None), (5, ""))

    def results():
        read = warc.read(common.stored(warc.write(pages), "test"))
        return [sorted(map(str, df.collect())) for df in (read, simhash.near_duplicates(docs))]

    want = results()
    for module in (warc, simhash):
        monkeypatch.setattr(module, "split_join", partial(common.split_join, few=0, most=1))
    monkeypatch.setattr(warc, "COPIES", 1)
    assert results() == want


def test_a_task_gives_memory_back_when_its_rows_are_done(monkeypatch):
    import weakref

    import pyarrow as pa

    from millwright.llm import common

    made, alive, calls = [], [], []

    def task(batches):
        for batch in batches:
            made.append(weakref.ref(batch))
            yield batch

    monkeypatch.setattr(common, "free", lambda: (calls.append(1), alive.append(sum(x() is not None for x in made))))
    batches = (pa.RecordBatch.from_pylist([{"x": i}]) for i in range(3))
    assert sum(b.num_rows for b in common.freeing(task)(batches)) == 3
    assert calls == [1] and alive[0] <= 1


def test_scratch_deletes_single_tables_early(spark):
    import os

    from millwright.llm.common import Scratch, done, stored

    with Scratch(spark) as store:
        for label in ("a-b", "a", "a-b"):
            store(spark.range(3), label)
        paths = [p.removeprefix("file:") for p in store.paths]
        done(stored, "a-b")
        assert all(map(os.path.exists, paths))
        done(store, "a-b")
        assert [os.path.exists(p) for p in paths] == [False, True, False] and len(store.paths) == 1
    assert not any(map(os.path.exists, paths))


def test_done_gives_back_the_disk_of_shuffles(spark):
    files = lambda: set(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split())  # noqa: E731, E501
    with common.Scratch(spark) as store:
        before = files()
        counts = store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
        new = {f for f in files() - before if "/shuffle_" in f}
        assert new
        store.done()
        until = time.time() + 10
        while new & files() and time.time() < until:
            time.sleep(0.1)
        assert not new & files()
        assert counts.count() == 7
