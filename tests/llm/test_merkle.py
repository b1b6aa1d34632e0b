import zlib
from hashlib import sha256

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from millwright.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """(root, the siblings of every node on its way up), by brute force."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, way in enumerate(ways):
            run = 3 * (at[i] // 3)
            way.append(("".join(level[run : at[i]]), "".join(level[at[i] + 1 : run + 3])))
            at[i] //= 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return (level[0] if level else None), ways


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    sources = {}
    for doc_id, text, lang, source, n_chars in rows:
        shown = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            shown = text.replace("\n", "")
        one, two = (leaf((doc_id, source, lang, n_chars, t)) for t in (text, shown))
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, one, two))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    kept = [sorted(sources[s], key=lambda r: r[:3]) for s in order]
    trees = [climb([r[2] for r in k]) for k in kept]
    root, above = climb([t[0] for t in trees])
    out = []
    for k, (subroot, ways), upper in zip(kept, trees, above):
        for (known, doc_id, one, two), way in zip(k, ways):
            folded = merkle.fold(two, way + upper)
            proof = h(*[left + right for left, right in way + upper])
            out.append((doc_id if known else None, one, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, Text string, key int, leaf string, pos int"
    return spark.createDataFrame([(*r, "other", 1, "x", 2) for r in rows], schema)


def got(spark, rows, **options):
    out = merkle.audit(frame(spark, rows), merkle.without_breaks(), **options)
    return sorted([tuple(r) for r in out.collect()], key=repr)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_trees_of_all_sizes(spark, height):
    """One to 28 rows a source, so last runs and blocks of every length, over several heights."""
    rows = [(1000 * n + i, f"a\nb {i % 5}\n", "en", f"s{n}", i) for n in (1, 2, 3, 4, 9, 10, 28) for i in range(n)]
    assert got(spark, rows, height=height) == brute(rows)


def test_odd_rows(spark):
    rows = [(i, t, None if n % 2 else "xx", s, None if n % 3 else n) for n, (i, t, s) in enumerate(ODD)]
    rows += [(1, None, None, "", 0), (1, "", None, "", 0), (10, "é\n\U0001f600", "fr", "Ω", 4), (10, "x", "fr", "￿", 4)]
    rows += [(None, "same\n", "en", "b", 1)] * 30  # repeated rows
    assert got(spark, rows, height=1) == brute(rows)


def test_one_row_and_none(spark):
    assert got(spark, [(5, "a\n", "en", "s", 2)]) == brute([(5, "a\n", "en", "s", 2)])
    assert got(spark, []) == []


def test_proofs_fold_to_the_root(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(40)]
    out = merkle.audit(frame(spark, rows), height=2, proofs=True)
    for r in out.collect():
        assert r.verified and merkle.fold(r.leaf, r.proof) == r.root
        assert merkle.fold(h("other"), r.proof) != r.root


def test_only_changed_rows_fail(spark):
    rows = [(i, f"text\n{i}" if i % 3 else f"text {i}", "en", "s", i) for i in range(60)]
    out = {r.doc_id: r.verified for r in merkle.audit(frame(spark, rows), merkle.without_breaks()).collect()}
    assert out == {i: not (i % 3 and zlib.crc32(str(i).encode()) % 2 == 0) for i in range(60)}


def test_any_column_of_a_row_counts(spark):
    rows = [(i, "t", "en", "s", i) for i in range(5)]
    roots = set()
    for change in ({}, {"lang": F.lit("fr")}, {"n_chars": F.lit(7)}, {"text": F.lit(None).cast("string")}):
        roots.add(merkle.audit(frame(spark, rows).withColumns(change)).first().root)
    assert len(roots) == 4


def test_query_against_sql(spark):
    from checks.compare import connect, differences
    from millwright.llm.queries import ORACLE, QUERIES

    con = connect("/root/testdata/sf0.001")
    assert differences(QUERIES["op11_merkle"](spark, "/root/testdata/sf0.001"), con, ORACLE["op11_merkle"]) == []
