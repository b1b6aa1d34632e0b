"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are brought to unit length, centred, and rotated at random; a code keeps the sign
of each coordinate, packed to bits, and two scalars: the residual's length and its inner
product with the code's own direction. A query's rotated residual is rounded to integers
of a few bits, so its product with a code is a sum of population counts over packed words.
From these the inner product is estimated without bias; its error is bounded with high
probability, and what rounding adds to it with certainty. A query's best
estimates are measured exactly first; then every vector whose upper bound reaches the
least of those measures is measured too. Whatever the codes, scores are exact.

Queries and vectors meet block by block: each block of vectors, of bounded size, meets
each block of queries in a task of its own, and every task hands on k rows a query.
Vectors travel with their codes, as they are: the few rows of a block that a query measures
would be more bytes as pairs to be joined than the block's vectors are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import stored, take

INDEX = "vec_id long, dim int, vector array<{}>, code binary, length double, align double, shift double"
#: Rows of a block of vectors, and of queries.
VECTORS, QUERIES = 8192, 1024
#: Queries estimated at a time.
STEP = 128
#: Bits of a rounded coordinate of a query.
LEVELS = 6


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same for the same seed."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """(vec_id, dim, vector) of rows with an id and a finite vector other than zero; floats stay floats."""
    rows = take(vectors, "vec_id", column).toDF("vec_id", "vector").where("vec_id is not null")
    if rows.schema["vector"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & good & F.exists("vector", lambda x: x != 0))
    return rows.select("vec_id", F.size("vector").alias("dim"), "vector")


def centres(rows: DataFrame, sample: int) -> dict[int, np.ndarray]:
    """For each dimension the mean unit vector of the rows whose ids hash lowest."""
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("dim", "vector").collect()
    lists: dict[int, list] = {}
    for dim, vector in found:
        v = np.array(vector) / max(map(abs, vector))
        lists.setdefault(dim, []).append(v / np.linalg.norm(v))
    return {dim: np.mean(vs, axis=0) for dim, vs in lists.items()}


def index(vectors: DataFrame, column: str = "embedding", sample: int = 2000, seed: int = 7) -> tuple[DataFrame, dict]:
    """The index of all usable vectors, stored, and its centres from a bounded sample.

    The sample, of `sample` rows, only sets where vectors are centred; with a dimension
    that it misses, vectors are not centred. Every usable row gets a code.
    """
    rows = usable(vectors, column)
    middle = centres(rows, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                unit, centre, turn = _units(matrix(part.column(2))), middle.get(int(dim), 0.0), rotation(int(dim), seed)
                rest = unit - centre
                length = np.linalg.norm(rest, axis=1)
                turned = rest / np.where(length > 0, length, 1)[:, None] @ turn.T
                bits = turned > 0
                align = np.abs(turned).sum(axis=1) / np.sqrt(dim)
                shift = rest @ np.broadcast_to(centre, (dim,))
                code = pa.array([row.tobytes() for row in np.packbits(bits, axis=1)], pa.binary())
                columns = [*part.columns, code, pa.array(length), pa.array(align), pa.array(shift)]
                names = ["vec_id", "dim", "vector", "code", "length", "align", "shift"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["vector"].dataType.elementType.simpleString()
    return stored(rows.mapInArrow(run, INDEX.format(kind)), "ann-index"), middle


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares then neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def words(packed: np.ndarray) -> np.ndarray:
    """Rows of packed bits as columns of 64-bit words."""
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64).T)


def ones(codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """How many bits each code shares with a mask: one number of each word."""
    total = np.zeros(codes.shape[1], np.int32)
    for word, part in zip(codes, mask, strict=True):
        total += np.bitwise_count(word & part)
    return total


def rounded(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows rounded to low + step * integer: masks of the integers' bits, low, step, and the error's length.

    masks: for each row and bit of the integers, the words that tell which coordinates have it.
    """
    low, high = turned.min(axis=1, keepdims=True), turned.max(axis=1, keepdims=True)
    step = np.maximum((high - low) / ((1 << LEVELS) - 1), 1e-300)
    whole = np.rint((turned - low) / step).astype(np.int32)
    error = np.linalg.norm(low + step * whole - turned, axis=1)
    masks = np.stack([words(np.packbits(whole >> b & 1, axis=1)).T for b in range(LEVELS)], axis=1)
    return masks, low[:, 0], step[:, 0], error


def products(codes: np.ndarray, masks: np.ndarray, low: float, step: float, dim: int) -> np.ndarray:
    """Inner products of a rounded row with all codes, whose bits mean -1 and 1."""
    full = words(np.packbits(np.ones((1, dim), np.uint8), axis=1))[:, 0]
    weighted = sum(ones(codes, mask) << b for b, mask in enumerate(masks))
    whole = sum(int(np.bitwise_count(mask).sum()) << b for b, mask in enumerate(masks))
    return 2 * (low * ones(codes, full) + step * weighted) - (low * dim + step * whole)


def _matcher(middle: dict[int, np.ndarray], k: int, bound: float, seed: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        out: list[tuple] = []
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids = left["vec_id"].to_numpy()
        query_ids = right["query_id"].to_numpy()
        exact, asked = _units(matrix(left["vector"].chunk(0))), _units(matrix(right["vector"].chunk(0)))
        dim = exact.shape[1]
        turn, centre = rotation(dim, seed), np.broadcast_to(middle.get(dim, 0.0), (dim,))
        codes = words(np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(len(ids), -1))
        length, align, shift = (left[c].to_numpy() for c in ("length", "align", "shift"))
        safe = np.where(align > 0, align, 1)
        # Standard deviation of the estimate for a query residual of length 1.
        error = length * np.sqrt(np.maximum(1 - align * align, 0)) / safe / np.sqrt(max(dim - 1, 1)) * bound + 1e-9
        scale = length / safe / np.sqrt(dim)
        for at in range(0, len(asked), STEP):
            rest = asked[at : at + STEP] - centre
            masks, low, step, off = rounded(rest @ turn.T)
            base = asked[at : at + STEP] @ centre
            for j, residual in enumerate(np.linalg.norm(rest, axis=1)):
                query, own = asked[at + j], query_ids[at + j]
                guess = scale * products(codes, masks[j], low[j], step[j], dim) + shift + base[j]
                guess = np.where(ids == own, -np.inf, guess)
                first = np.argpartition(-guess, min(4 * k, len(ids) - 1))[: 4 * k]
                measure = (exact[first] * query).sum(axis=1)
                measure = np.sort(_best_of_ids(ids[first], measure, own))[::-1]
                least = measure[k - 1] if len(measure) >= k else -np.inf
                reach = guess + error * residual + length / safe * off[j]
                rows = np.flatnonzero((reach >= least) & (ids != own))
                # Candidates are measured from their original vectors, in parts of bounded size.
                score = np.concatenate(
                    [(exact[rows[i : i + 65536]] * query).sum(axis=1) for i in range(0, len(rows), 65536)] or [np.zeros(0)]
                )
                seen: set[int] = set()
                for i in np.lexsort((ids[rows], -score)):
                    if ids[rows[i]] not in seen:
                        seen.add(ids[rows[i]])
                        out.append((own, ids[rows[i]], float(np.clip(score[i], -1, 1))))
                        if len(seen) == k:
                            break
        if not out:
            return schema.empty_table()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return match


def _best_of_ids(ids: np.ndarray, score: np.ndarray, own: int) -> np.ndarray:
    """The best score of each id but the query's own."""
    order = np.lexsort((-score, ids))
    ids, score = ids[order], score[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return score[first & (ids != own)]


def nearest(
    vectors: DataFrame,
    asked: Column,
    column: str = "embedding",
    k: int = 5,
    bound: float = 3.0,
    sample: int = 2000,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine of each row that `asked` holds for.

    asked: a condition on vec_id. Rows without an id, and vectors that are null, empty or
    zero or hold a null or non-finite number, take no part. Vectors are compared within
    their dimension. An id is found once a query, with its best score; a query's own id
    is never found; of repeated query ids the smallest vector asks. Ties go to the
    smaller vec_id. bound: standard deviations that the error bound takes.
    """
    rows, middle = index(vectors, column, sample, seed)
    total, many = rows.agg(F.count("*"), F.count(F.when(asked, 1))).first()
    across, down = max(1, -(-total // VECTORS)), max(1, -(-many // QUERIES))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("a", F.pmod(F.monotonically_increasing_id(), F.lit(across)).cast("int"))
    left = left.withColumn("b", spread(down))
    queries = rows.where(asked).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("dim", "vector")).alias("v"))
    queries = queries.select("query_id", "v.dim", "v.vector")
    queries = queries.withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(down)).cast("int")).withColumn("a", spread(across))
    cell = ["dim", "a", "b"]
    found = left.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(
        _matcher(middle, k, bound, seed), "query_id long, vec_id long, score double"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
