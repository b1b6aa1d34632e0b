import math
from hashlib import sha256

import numpy as np
import pytest

from millwright.llm import centroids


def brute(rows, k=16, rounds=3, dim=64):
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cs = [q for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q)[1], []).append(q)
        cs = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(cs)]
    found = [(i, *nearest(q)[::-1]) for i, q in kept]
    sums = {}
    for _, c, d in found:
        sums[c] = sums.get(c, 0) + d
    shas = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted([(i, c, d, sums[c], sum(sums.values()), shas[c]) for i, c, d in found], key=repr)


def frame(spark, rows):
    schema = "vec_id long, embedding array<double>, Embedding string, cluster int, q int"
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], schema)


def got(spark, rows, **options):
    return sorted([tuple(r) for r in centroids.clustered(frame(spark, rows), **options).collect()], key=repr)


def vectors(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(max(n // 20, 2), dim))
    return [(i, (middles[rng.integers(len(middles))] + spread * rng.normal(size=dim)).tolist()) for i in range(n)]


def test_by_brute_force(spark):
    rows = vectors(300, 64, 1)
    rows += [(i, rows[7][1]) for i in range(400, 500)]  # a hot copy
    rows += [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 65), (504, [None] + [0.0] * 63)]
    rows += [(505, [math.nan] + [0.0] * 63), (506, [math.inf] + [0.0] * 63), (507, [-0.0] * 64), (None, [0.5] * 64)]
    rows += [(507, [0.25] * 64), (507, [0.25] * 64), (508, [-1000.7] + [0.0] * 63), (509, [1e-300, -1e-300] * 32)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("lead", [1, 3])
def test_ties_go_to_the_smaller_number(spark, lead):
    rows = [(i, [float(i % 4), float(i // 4 % 4), 0.0]) for i in range(64)]
    assert got(spark, rows, k=5, dim=3, lead=lead) == brute(rows, k=5, dim=3)


def test_all_alike_and_few(spark):
    rows = [(i, [0.3] * 64) for i in range(40)]  # one point: all but one cluster stay empty
    assert got(spark, rows) == brute(rows)
    rows = vectors(5, 64, 2)
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []


def test_bounds_are_below_distances():
    rng = np.random.default_rng(3)
    q, c = rng.integers(-50, 50, (200, 8)), rng.integers(-50, 50, (9, 8))
    axes = np.linalg.eigh(np.cov(q.T.astype(float)))[1][:, ::-1]
    turned = [centroids.rotated(x.astype(float), q.mean(axis=0), axes, 3) for x in (q, c)]
    low = centroids.bounds(*turned[0], *turned[1])
    true = ((q[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    assert (low <= true + 1e-6).all()


def test_the_filter_saves_distances(spark):
    """Vectors of which ten directions hold nearly all, as axes that are worth storing do."""
    rng = np.random.default_rng(4)
    turn, _ = np.linalg.qr(rng.normal(size=(64, 10)))
    points = rng.normal(size=(20, 10))[rng.integers(20, size=2000)] + 0.1 * rng.normal(size=(2000, 10))
    rows = [(i, v) for i, v in enumerate((points @ turn.T + 0.01 * rng.normal(size=(2000, 64))).tolist())]
    counts = centroids.measured(frame(spark, rows))
    assert len(counts) == 4
    assert all(of == 2000 * 16 and n < of / 4 for n, of in counts)


def test_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="not below"):
        got(spark, [(1, [float(1 << 20)] + [0.0] * 63)])


def test_query_against_sql(spark):
    from checks.compare import connect, differences
    from millwright.llm.queries import ORACLE, QUERIES

    con = connect("/root/testdata/sf0.001")
    assert differences(QUERIES["op13_centroids"](spark, "/root/testdata/sf0.001"), con, ORACLE["op13_centroids"]) == []
