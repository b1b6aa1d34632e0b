"""Centroid clustering with a PCA-rotated filter and integer verification.

Vectors become integers, and every distance, sum and mean that decides is an integer.
A rotation by the principal axes, from covariances that the tasks sum over all vectors,
gives each vector its leading coordinates and the norm of the rest. For a vector and a
centroid, the squared distance of the leading coordinates plus the squared difference of
the two rest norms is at most their squared distance. So the centroid with the least such
bound is measured in integers, and after it only those whose bound does not exceed what
was found; the others cannot be nearer. Rounding in the bounds is covered by a margin: it
can cost a needless measurement, never a wrong centroid.

Centroids, their rotation and their new sums are `k` times the dimension numbers; only
they reach the driver. A round reads the stored vectors once and shuffles a few sums a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, stored, take

#: Integers per unit.
SCALE = 64
#: Of the variance, what the stored rotated coordinates hold at least.
SHARE = 0.8
#: Integers must be below this, so that a squared distance of 64 of them fits a long.
LARGEST = 1 << 26
#: Of the norms' squares, what a bound may be off by through rounding.
MARGIN = 1e-9

STORED = "vec_id long, q array<int>, lead array<double>, rest double"


def integers(embeddings: DataFrame, dim: int) -> DataFrame:
    """(vec_id, q): the vectors with `dim` components, all finite, as integers floor(SCALE * x).

    A component that is too large for exact distances is an error.
    """
    rows = take(embeddings, "vec_id", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    # isnan and the infinities compare false with a bound.
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where((F.size("embedding") == dim) & whole)
    fits = lambda x: F.abs(x) < LARGEST / SCALE
    told = F.raise_error(F.lit(f"a component is not below {LARGEST // SCALE}")).cast("int")
    q = F.transform("embedding", lambda x: F.when(fits(x), F.floor(x * SCALE).cast("int")).otherwise(told))
    return rows.select("vec_id", q.alias("q"))


def matrix(lists: pa.Array, dtype) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(lists), -1)


def moments(vectors: DataFrame, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """How many vectors there are, their mean and covariance: one row of sums a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            x = matrix(batch.column("q"), np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        values = np.concatenate([[n], first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["i", "v"])

    sums = vectors.select("q").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    values = np.zeros(1 + dim + dim * dim)
    for row in sums.collect():  # dim squared
        values[row.i] = row.v
    n = int(values[0])
    mean = values[1 : dim + 1] / max(n, 1)
    return n, mean, values[dim + 1 :].reshape(dim, dim) / max(n, 1) - np.outer(mean, mean)


def principal(covariance: np.ndarray, lead: int | None) -> tuple[np.ndarray, int]:
    """The axes, largest variance first, and how many lead: the fewest that hold SHARE, if not given."""
    variance, axes = np.linalg.eigh(covariance)
    held = np.cumsum(np.maximum(variance[::-1], 0))
    fewest = int(np.searchsorted(held, SHARE * held[-1])) + 1
    return axes[:, ::-1].copy(), min(lead or fewest, len(axes))


def rotated(q: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading rotated coordinates, and the norm of the others."""
    turned = (q - mean) @ axes
    return turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(axis=1))


def bounds(lead: np.ndarray, rest: np.ndarray, clead: np.ndarray, crest: np.ndarray) -> np.ndarray:
    """For each vector and centroid, no more than their squared distance and rounding."""
    out = (rest[:, None] - crest[None, :]) ** 2
    for axis in range(lead.shape[1]):
        out += (lead[:, axis, None] - clead[None, :, axis]) ** 2
    return out


def assigned(q: np.ndarray, low: np.ndarray, slack: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, distances measured): nearest, ties to the smaller number.

    low: the bounds; slack: what they may be too large by, for each vector.
    """
    cluster = low.argmin(axis=1)
    distance = ((q - centroids[cluster]) ** 2).sum(axis=1)
    measured = len(q)
    left = low <= (distance + slack)[:, None]
    left[np.arange(len(q)), cluster] = False
    for c in range(len(centroids)):
        at = np.flatnonzero(left[:, c])
        at = at[low[at, c] <= distance[at] + slack[at]]  # others may have come nearer since
        measured += len(at)
        d = ((q[at] - centroids[c]) ** 2).sum(axis=1)
        better = (d < distance[at]) | ((d == distance[at]) & (c < cluster[at]))
        cluster[at[better]], distance[at[better]] = c, d[better]
    return cluster, distance, measured


class Clusters:
    """The centroids, and how a task finds the nearest of them."""

    def __init__(self, centroids: list[list[int]], mean: np.ndarray, axes: np.ndarray, lead: int):
        self.centroids = np.array(centroids, np.int64)
        self.mean, self.axes = mean, axes
        self.lead, self.rest = rotated(self.centroids.astype(np.float64), mean, axes, lead)

    def nearest(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        q = matrix(batch.column("q"), np.int64)
        lead, rest = matrix(batch.column("lead"), np.float64), batch.column("rest").to_numpy()
        low = bounds(lead, rest, self.lead, self.rest)
        norms = (lead**2).sum(axis=1) + rest**2 + ((self.lead**2).sum(axis=1) + self.rest**2).max()
        return q, *assigned(q, low, MARGIN * (norms + (self.mean**2).sum() + 1), self.centroids)


def prepared(vectors: DataFrame, mean: np.ndarray, axes: np.ndarray, lead: int) -> DataFrame:
    """The vectors with their leading rotated coordinates and the norm of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leads, rest = rotated(matrix(batch.column("q"), np.float64), mean, axes, lead)
                offsets = pa.array(np.arange(0, leads.size + 1, max(leads.shape[1], 1)), pa.int32())
                values = pa.ListArray.from_arrays(offsets, pa.array(leads.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, values, pa.array(rest)], names=["vec_id", "q", "lead", "rest"])

    return vectors.mapInArrow(run, STORED)


def started(vectors: DataFrame, k: int) -> list[list[int]]:
    """The k vectors with the smallest hashes of their ids; rows of one id by their integers.

    A row without an id comes after all others.
    """
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(order.alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(k)
    return [list(r.q) for r in rows.collect()]  # k vectors


def moved(rows: DataFrame, clusters: Clusters) -> list[list[int]]:
    """Each centroid as the floor of its vectors' mean; one without vectors stays."""
    k, dim = clusters.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), np.int64)  # the last one counts
        for batch in batches:
            q, cluster, _, _ = clusters.nearest(batch)
            np.add.at(sums, cluster, np.concatenate([q, np.ones((len(q), 1), np.int64)], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], names=["i", "v"])

    found = rows.mapInArrow(run, "i int, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    sums = {r.i: int(r.v) for r in found.collect()}  # k times dim
    out = clusters.centroids.tolist()
    for c in range(k):
        count = sums.get(c * (dim + 1) + dim, 0)
        if count:
            out[c] = [sums[c * (dim + 1) + j] // count for j in range(dim)]
    return out


def clustered(embeddings: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, lead: int | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256, one row per
    vector that takes part.

    embeddings: vec_id and embedding, numbers of any width. Rows whose vector is null, has
    another length, or holds a null or non-finite component are left out; a row without an
    id takes part, and is the last to be a first centroid. Repeated rows stay rows. With
    fewer than k vectors there are as many clusters as vectors. Distances are squared, of
    integers floor(64 * x); ties go to the smaller cluster. A component of 2**20 or more
    is an error, as its distances fit no long.
    """
    spark = embeddings.sparkSession
    schema = "vec_id long, cluster int, distance long"
    with Scratch(spark) as store:
        vectors = store(integers(embeddings, dim), "centroids-integers")
        centroids = started(vectors, k)
        if not centroids:
            none = spark.createDataFrame([], schema)
            zero = F.lit(None).cast("long")
            return none.select("*", zero.alias("cluster_inertia"), zero.alias("inertia"), F.lit(None).cast("string").alias("centroid_sha256"))
        _, mean, covariance = moments(vectors, dim)
        axes, lead = principal(covariance, lead)
        rows = store(prepared(vectors, mean, axes, lead), "centroids-rotated")
        for _ in range(rounds):
            centroids = moved(rows, Clusters(centroids, mean, axes, lead))
        clusters = Clusters(centroids, mean, axes, lead)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, cluster, distance, _ = clusters.nearest(batch)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

        out = stored(rows.mapInArrow(run, schema), "centroids-assigned")
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    inertia = sum(int(r.s) for r in sums)
    facts = [
        (r.cluster, int(r.s), inertia, hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest())
        for r in sums
    ]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def measured(embeddings: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, lead: int | None = None) -> list[tuple[int, int]]:
    """For each assignment, how many distances the filter leaves to be measured, and of how many."""
    vectors = stored(integers(embeddings, dim), "centroids-integers")
    _, mean, covariance = moments(vectors, dim)
    axes, lead = principal(covariance, lead)
    rows = stored(prepared(vectors, mean, axes, lead), "centroids-rotated")
    clusters = Clusters(started(vectors, k), mean, axes, lead)
    found = []
    for _ in range(rounds + 1):

        def run(batches: Iterator[pa.RecordBatch], clusters: Clusters = clusters) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, of = clusters.nearest(batch)[-1], batch.num_rows * len(clusters.centroids)
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([of])], names=["n", "of"])

        counts = rows.mapInArrow(run, "n long, of long")
        found.append(tuple(counts.agg(F.sum("n"), F.sum("of")).first()))
        clusters = Clusters(moved(rows, clusters), mean, axes, lead)
    return found
