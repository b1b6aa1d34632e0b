"""Toxicity by FTRL-proximal logistic regression over hashed word and skip-grams.

Words lose case and outer punctuation. A text's features are its distinct words, pairs
of neighbours, and pairs that skip one or two words, hashed to 2**bits coordinates.
Each coordinate has its own learning rate, and L1 keeps most weights at zero, so the
model that scoring tasks get is a short array of non-zero coordinates.

Training takes a bounded sample: `sample` labelled rows, those whose ids hash lowest.
It is dealt to `shards` tasks. In each round, every shard goes through its rows
from the common state, and the states are averaged per coordinate. States stay in shared
storage, where the tasks of the next round read them; the driver gets the weights only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, islice
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, delete, free, freeing, new_path, slices, take

#: Odd multipliers that tell the kinds of feature apart.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
#: Bytes of text whose features are made at a time.
PART = 1 << 20
#: Coordinates in a row of a stored state.
BLOCK = 1 << 14
STATE = "shard int, block int, z array<double>, n array<double>"


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    skips: tuple[int, ...] = (1, 2, 3)
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    #: Passes over the sample: as many as make `visits` row visits, within these bounds.
    rounds: tuple[int, int] = (5, 30)
    visits: int = 60_000
    shards: int = 2
    sample: int = 24_000
    #: Features in fewer texts than this are left out.
    rare: int = 3


@dataclass(frozen=True)
class Model:
    bits: int
    skips: tuple[int, ...]
    bias: float
    index: np.ndarray
    weight: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(MIX[0])
    return x ^ (x >> np.uint64(29))


def features(texts: pa.Array, bits: int, skips: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every feature, repeats included; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy()
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    words = lists.flatten().dictionary_encode()
    names = [w.lower().strip(".,;:!?\"'`()[]{}<>*#%&$|-_") for w in words.dictionary.to_pylist()]
    hashes = np.array([xxhash.xxh64_intdigest(n, 7) for n in names] or [0], np.uint64)
    named = np.array([bool(n) for n in names] or [False])
    code = words.indices.to_numpy()
    row, code = row[named[code]], code[named[code]]
    h = hashes[code]
    rows, found = [row], [_mixed(h)]
    for k in skips:
        same = row[:-k] == row[k:] if len(row) > k else np.zeros(0, bool)
        rows.append(row[: len(same)][same])
        pair = h[: len(same)][same] * np.uint64(MIX[1]) + h[k:][same] * np.uint64(MIX[2])
        found.append(_mixed(pair + np.uint64(k * MIX[3] & (1 << 64) - 1)))
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def coordinates(texts: pa.Array, s: Settings) -> pa.ListArray:
    """The distinct coordinates of each text, ascending."""
    row, index = features(texts, s.bits, s.skips)
    pairs = np.unique(row << s.bits | index)
    offsets = np.searchsorted(pairs, np.arange(len(texts) + 1) << s.bits)
    values = (pairs & (1 << s.bits) - 1).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def ftrl(rows, state: tuple[np.ndarray, np.ndarray], s: Settings) -> None:
    """One pass over (coordinates, label) that updates z and n in place."""
    z, n = state
    for index, label in rows:
        zi, ni = z[index], n[index]
        weight = -np.sign(zi) * np.maximum(np.abs(zi) - s.l1, 0) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2)
        bias = -z[-1] / ((s.beta + math.sqrt(n[-1])) / s.alpha)
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + weight.sum()))))
        g = p - label
        root = np.sqrt(ni + g * g)
        z[index] += g - (root - np.sqrt(ni)) / s.alpha * weight
        n[index] += g * g
        z[-1] += g - (math.sqrt(n[-1] + g * g) - math.sqrt(n[-1])) / s.alpha * bias
        n[-1] += g * g


def _learner(start, s: Settings):
    """One round over a shard, from a state on that it updates; returns the shard's share of the next."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = start.value
        seen = 0
        for batch in batches:  # in the order of `turn`
            lists = batch.column("index")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            labels = batch.column("toxic").to_pylist()
            ftrl(((values[at[i] : at[i + 1]], float(y > 0)) for i, y in enumerate(labels)), (z, n), s)
            seen += batch.num_rows
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(z * float(seen)), pa.array(n * float(seen))], names=["z", "n"])

    return learn


def _added(batches: Iterator[pa.RecordBatch], state: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Adds the stored states, which come first, to state; returns the rows after them."""
    for batch in batches:
        held = batch.num_rows - batch.column("block").null_count
        for i in range(held):
            at = batch.column("block")[i].as_py() * BLOCK
            for name, sums in zip("zn", state):
                values = batch.column(name)[i].values.to_numpy()
                sums[at : at + len(values)] += values
        if batch.num_rows > held:
            yield batch.slice(held)


def _round(k: int, size: int, first: float | None, total: int, s: Settings):
    """A round over shard k and the states of the round before, or from first on, the bias's z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(size), np.zeros(size)
        rows = _added(batches, (z, n))
        ahead = [*islice(rows, 1)]  # all states are read then
        if first is None:
            z /= total
            n /= total
        else:
            z[-1], n[-1] = first, 1.0
        rows = chain(ahead, rows)
        del ahead
        for state in _learner(SimpleNamespace(value=(z, n)), s)(rows):
            cuts = pa.array([*range(0, size, BLOCK), size], pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, state.column(name)) for name in "zn"]
            blocks = pa.array(range(len(cuts) - 1), pa.int32())
            shard = pa.array([k] * len(blocks), pa.int32())
            yield pa.RecordBatch.from_arrays([shard, blocks, *lists], names=["shard", "block", "z", "n"])

    return run


def _weights(size: int, total: int, s: Settings):
    """(at, weight) of every coordinate with a weight from the states of the last round; the bias has the last place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(size), np.zeros(size)
        for _ in _added(batches, (z, n)):
            pass
        z /= total
        n /= total
        weight = -np.sign(z) * np.maximum(np.abs(z) - s.l1, 0) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        weight[-1] = -z[-1] / ((s.beta + math.sqrt(n[-1])) / s.alpha)
        at = np.flatnonzero(np.append(weight[:-1], 1.0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(weight[at])], names=["at", "weight"])

    return run


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic).

    Rows without an id, a label or a text are not learnt from; of repeated labels the
    largest counts. Without any row of either class the model says "not toxic" always.
    """
    with Scratch(docs.sparkSession) as store:
        return _trained(docs, labels, settings or Settings(), store)


def _trained(docs: DataFrame, labels: DataFrame, s: Settings, store: Scratch) -> Model:
    known = take(labels, "doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = known.orderBy(order, "doc_id").limit(s.sample)
    texts = take(docs, "doc_id", "text").where("text is not null")
    sampled = store(texts.join(F.broadcast(chosen), "doc_id"), "toxicity-sample")  # s.sample ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column("text")), PART):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), coordinates(part.column("text"), s)],
                    names=["doc_id", "toxic", "index"],
                )

    rows = sampled.mapInArrow(freeing(run), "doc_id long, toxic int, index array<int>")
    total, toxic = sampled.agg(F.count("*"), F.sum(F.expr("int(toxic > 0)"))).first()
    none = Model(s.bits, s.skips, -20.0, np.zeros(0, np.int64), np.zeros(0))
    if not total or not toxic or toxic == total:
        return none
    often = rows.select(F.explode("index").alias("i")).groupBy("i").count()
    often = often.where(F.col("count") >= s.rare)
    active = np.sort(often.select("i").toArrow()["i"].to_numpy())  # of 2**bits
    if not len(active):
        return none
    spark = docs.sparkSession
    known_at = spark.sparkContext.broadcast(active)

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = known_at.value
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column("text")), PART):
                lists = coordinates(part.column("text"), s)
                values = lists.values.to_numpy()
                at = np.minimum(np.searchsorted(active, values), len(active) - 1).astype(np.int32)
                kept = active[at] == values
                before = np.concatenate([[0], np.cumsum(kept)])[lists.offsets.to_numpy()]
                new = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(at[kept]))
                names = [str(i) for i in part.column("doc_id").to_pylist()]
                shard = pa.array([xxhash.xxh64_intdigest(i) % s.shards for i in names], pa.int32())
                # An unsigned hash, as the signed number of the same place in the order.
                turn = pa.array([xxhash.xxh64_intdigest(i, 1) - (1 << 63) for i in names], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("toxic"), new, turn, shard],
                    names=["doc_id", "toxic", "index", "turn", "shard"],
                )

    schema = "doc_id long, toxic int, index array<int>, turn long, shard int"
    # From the texts again: one Python process a task, and no lists that go back and forth.
    rows = sampled.mapInArrow(freeing(renumber), schema)
    # A folder for each shard, so that no round shuffles; a shard is a bounded part of the sample.
    path = new_path(spark, "toxicity-shards")
    store.paths.append(path)
    rows.repartition(s.shards, "shard").write.partitionBy("shard").parquet(path)
    known_at.destroy()
    stored = spark.read.schema(schema).parquet(path)
    size = len(active) + 1
    in_order = [F.col("block").asc_nulls_last(), "shard", "turn", "doc_id"]
    first, states = -math.log(toxic / (total - toxic)) * (s.beta + 1.0) / s.alpha, None
    for _ in range(min(max(-(-s.visits // total), s.rounds[0]), s.rounds[1])):
        ends = []
        for k in range(s.shards):
            shard = stored.where(F.col("shard") == k).withColumn("block", F.lit(None).cast("int"))
            shard = shard.withColumn("z", F.lit(None).cast("array<double>")).withColumn("n", F.col("z"))
            both = shard if states is None else shard.unionByName(states, allowMissingColumns=True)
            both = both.coalesce(1).sortWithinPartitions(*in_order).select("block", "z", "n", "toxic", "index")
            ends.append(both.mapInArrow(freeing(_round(k, size, first if states is None else None, total, s)), STATE))
        # A task for each shard, 16 bytes for each of 2**bits coordinates at most.
        path = new_path(spark, "toxicity-states")
        store.paths.append(path)
        reduce(DataFrame.union, ends).write.save(path, format="parquet")
        if states is not None:
            delete(spark, store.paths.pop(-2))
        states = spark.read.schema(STATE).parquet(path)
    ordered = states.coalesce(1).sortWithinPartitions("block", "shard")
    found = ordered.mapInArrow(freeing(_weights(size, total, s)), "at int, weight double").toArrow()
    at, weight = found["at"].to_numpy(), found["weight"].to_numpy()
    bias, at, weight = float(weight[-1]), at[:-1], weight[:-1]
    return Model(s.bits, s.skips, bias, active[at].astype(np.int64), weight)


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Probability of toxicity for each text; null counts as empty."""
    total = np.full(len(texts), model.bias)
    if len(model.index):
        row, index = features(texts, model.bits, model.skips)
        at = np.minimum(np.searchsorted(model.index, index), len(model.index) - 1)
        hit = model.index[at] == index
        pairs = np.unique(row[hit] * len(model.index) + at[hit])  # each feature counts once a text
        np.add.at(total, pairs // len(model.index), model.weight[pairs % len(model.index)])
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score_column(text: Column, model: Model) -> Column:
    """The probability as a column, for any DataFrame of texts."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [scores(b.column(0), model) for b in slices(batch, pc.binary_length(texts), PART)]
        free()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def held_out() -> Column:
    """Whether a row's label is kept for testing: a fifth, by the id's checksum."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Learns from labelled rows that are not held out. A null text scores as an empty
    one; a null doc_id is not held out; repeated rows stay rows.
    """
    model = train(docs, take(labels, "doc_id", "toxic").where(~held_out()), settings)
    scored = take(docs, "doc_id", "text").select("doc_id", score_column(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
