import numpy as np
from pyspark.sql import functions as F

from millwright.llm import ann
from millwright.llm.common import table


def plain(rows, every, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = set()
    for q, x in {i: v for i, v in sorted(good, key=lambda r: (r[0], r[1].tolist()), reverse=True) if i % every == 0}.items():
        best = {}
        for i, v in good:
            if i != q and len(v) == len(x):
                # Scaled first, so that squares stay finite.
                a, b = x / np.abs(x).max(), v / np.abs(v).max()
                best[i] = max(best.get(i, -2), float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())))
        ranked = sorted(best.items(), key=lambda r: (-round(r[1], 12), r[0]))[:k]
        out |= {(q, rank, i, round(s, 9)) for rank, (i, s) in enumerate(ranked, 1)}
    return out


def found(df):
    return {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect()}


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, dim int")


def test_recall_against_brute_force(spark, rows_of):
    got = found(ann.nearest(table(spark, "/root/testdata/sf0.001", "embeddings"), F.col("vec_id") % 10 == 0))
    want = plain(rows_of("embeddings", "vec_id, embedding"), 10)
    assert len(got & want) >= 0.98 * len(want) and len(got) == len(want)


def test_small_blocks_agree(spark, rows_of, monkeypatch):
    rows = table(spark, "/root/testdata/sf0.001", "embeddings")
    want = found(ann.nearest(rows, F.col("vec_id") % 10 == 0, bound=9.0))
    monkeypatch.setattr(ann, "VECTORS", 50)
    monkeypatch.setattr(ann, "QUERIES", 3)
    assert found(ann.nearest(rows, F.col("vec_id") % 10 == 0, bound=9.0)) == want


def test_packed_products_against_signs():
    rng = np.random.default_rng(3)
    for dim in (1, 3, 8, 64, 65, 200):
        bits, turned = rng.integers(0, 2, (40, dim)).astype(np.uint8), rng.standard_normal((7, dim))
        turned[0] = 1.0  # rounded without a step
        codes = ann.words(np.packbits(bits, axis=1))
        masks, low, step, off = ann.rounded(turned)
        for j, row in enumerate(turned):
            got = ann.products(codes, masks[j], low[j], step[j], dim)
            want = (2.0 * bits - 1) @ row
            # Off by the rounding of the row, which the bound covers, and no more.
            assert (np.abs(got - want) <= np.sqrt(dim) * off[j] + 1e-9).all()
            assert off[j] <= step[j] / 2 * np.sqrt(dim) + 1e-9


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(5)
    vectors, asked = (ann._units(rng.standard_normal((n, 64))) for n in (2000, 30))
    turn = ann.rotation(64, 7)
    turned = vectors @ turn.T
    codes, align = ann.words(np.packbits(turned > 0, axis=1)), np.abs(turned).sum(axis=1) / 8
    masks, low, step, off = ann.rounded(asked @ turn.T)
    missed = 0
    for j, query in enumerate(asked):
        guess = ann.products(codes, masks[j], low[j], step[j], 64) / align / 8
        bound = 3 * np.sqrt(1 - align * align) / align / np.sqrt(63) + off[j] / align
        missed += int((np.abs(guess - vectors @ query) > bound).sum())
    assert missed <= 0.005 * 30 * 2000


def test_odd_rows_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(1, 40)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, [2 * x for x in rows[3][1]]), (100, rows[3][1])]
    rows += [(0, None), (50, [0.0] * 8), (150, [None] * 8), (200, [float("nan")] * 8), (250, [float("inf")] + [1.0] * 7)]
    rows += [(None, [1.0] * 8), (300, []), (350, [1.0, 2.0]), (351, [1.0, 2.5]), (400, [1e38] * 8), (401, [1e-40] * 8)]
    got = found(ann.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, bound=9.0))
    as_floats = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = plain(as_floats, 50)
    # Scores that differ by rounding only may order either way beyond the ties of equal vectors.
    assert {(q, s) for q, _, _, s in got} == {(q, s) for q, _, _, s in want}
    assert {x for x in got if x[0] == 100} == {x for x in want if x[0] == 100}
    assert {q for q, *_ in got} == {100, 350, 400}


def test_empty_table_and_no_queries(spark):
    assert ann.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert ann.nearest(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    assert ann.nearest(vectors(spark, [(50, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
