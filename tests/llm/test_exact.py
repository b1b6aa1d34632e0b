import re
from collections import defaultdict
from hashlib import sha256

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from millwright.llm import exact

SPACE = re.compile("[\x20\x09-\x0d]+")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[SPACE.sub(" ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        digest = sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, digest) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


LONG = "".join(f"sentence number {i} had some {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}d words in it.{' ' if i % 7 else chr(10)}" for i in range(3000))
COPIES = [
    (20, "a  b\tc"), (21, "a b c"), (22, "a b\x0b\n c"), (23, " a b c"), (24, "a b c "), (25, "a b c\n"),
    (26, "a b c"), (27, "ab c"), (30, LONG), (31, LONG.replace("\n", " ")), (32, LONG.replace("\n", "")),
    (33, LONG + "x"), (34, "y" + LONG), (35, LONG.replace("number 1500 ", "number 1501 ")), (36, LONG.replace(" ", "  ")),
    (37, "z" * 30_000), (38, "z" * 30_001), (39, "z" * 30_000), (40, "漢" * 9000), (41, "漢" * 9000), (42, "\U0001f600" * 5000),
    *[(100 + i, f"copy {i % 3}") for i in range(60)], (-5, "copy 1"), (None, "copy 2"), (None, ""), (None, None), (50, None),
]


def got(documents, rows, **options):
    return sorted([tuple(r) for r in exact.copies(documents(*rows), **options).collect()], key=repr)


def test_by_brute_force(documents):
    rows = [*ODD, *COPIES]
    assert got(documents, rows) == brute(rows)


@pytest.mark.parametrize("kinds", [1, 3, 50])
def test_hashes_that_collide_change_nothing(documents, kinds):
    """Identifiers are verified: with a hash of a few values, still only equal texts are copies."""
    rows = [*ODD, *COPIES]
    few = lambda c: F.pmod(F.xxhash64(c), F.lit(kinds))
    assert got(documents, rows, hash_of=few) == brute(rows)


def test_hot_groups_are_split(documents):
    rows = [(i, "hot" if i % 3 else f"t {i}") for i in range(300)]
    assert got(documents, rows, rows_per_task=10) == brute(rows)


def test_no_rows(documents):
    assert got(documents, []) == []


def test_chunks_join_to_the_text_and_survive_edits(spark):
    texts = [LONG, "x" + LONG, "", "z" * 10_000, "a", LONG[:100_000]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    rows = {r.i: (r.text, r.c) for r in df.select("i", exact.normal(F.col("text")).alias("text"), exact.chunks(exact.normal(F.col("text"))).alias("c")).collect()}
    for text, c in rows.values():
        assert "".join(c) == text
        assert all(len(x) <= exact.MOST for x in c) and all(len(x) >= exact.LEAST for x in c[:-1])
    assert len(set(rows[0][1]) - set(rows[1][1])) <= 2  # a new first character moves no later cut
    assert len(rows[0][1]) > 20


def test_no_python_workers(documents):
    from contextlib import redirect_stdout
    from io import StringIO

    plan = StringIO()
    with redirect_stdout(plan):
        exact.copies(documents((1, "a"), (2, "a"))).explain("formatted")
    assert not re.search("Python|Arrow|Pandas|BroadcastNestedLoop|Cartesian", plan.getvalue())


def test_query_against_sql(spark):
    from checks.compare import connect, differences
    from millwright.llm.queries import ORACLE, QUERIES

    con = connect("/root/testdata/sf0.01")
    assert differences(QUERIES["op12_exact"](spark, "/root/testdata/sf0.01"), con, ORACLE["op12_exact"]) == []
