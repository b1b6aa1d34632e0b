"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

The fingerprint's 64 bits are three segments of 22, 21 and 21 bits. Two fingerprints
that differ in two bits at most agree wholly in some segment and then differ in one
bit at most of the next, by the pigeonhole principle. A segment, padded to 23 bits, is
a word of the perfect binary Golay code: every word lies within three bits of exactly
one of 4096 codewords. A segment's keys are the indices of the codewords that it and
its one-bit neighbours decode to; words two bits apart share a neighbour, and so a key.
Rows that share (exact segment, codeword index of the next) are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, bytes_of, split_join, stored, take
from millwright.llm.components import components

#: Places of the segments: first bit and number of bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b110001110101
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 14
#: Above so many fingerprints in a bucket, links are found by common neighbours.
PAIRED = 256


def fingerprint(text: bytes, size: int = 3) -> int:
    """Of a UTF-8 text; words are lower-cased A-Z runs without ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    shingles = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    n = len(words) - size + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp and columns to keep: the fingerprint is a signed long; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, size) for t in bytes_of(batch.column(0))]
            fp = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], fp], names=[*batch.schema.names[1:], "fp"])

    rows = take(docs, "text", "doc_id", *keep)
    return rows.mapInArrow(run, rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema)


def remainder(words: np.ndarray) -> np.ndarray:
    """Of 23-bit polynomials divided by the generator: their syndromes."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where((words >> bit) & 1, GENERATOR << (bit - 11), 0)
    return words


def corrections() -> np.ndarray:
    """The error of three bits at most for each of the 2048 syndromes."""
    errors = [sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(23), k)]
    errors = np.array(errors, np.int64)
    table = np.zeros(2048, np.int64)
    table[remainder(errors)] = errors
    return table


def codeword_index(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which of the 4096 codewords is nearest: its 12 message bits."""
    return (words ^ table[remainder(words)]) >> 11


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): for each fingerprint its distinct bucket keys of the three segments."""
    table = corrections()
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, found = [], []
    for i, part in enumerate(parts):
        j = (i + 1) % len(SEGMENTS)
        flips = np.array([0, *(1 << b for b in range(SEGMENTS[j][1]))], np.int64)
        index = np.sort(codeword_index(parts[j][:, None] ^ flips, table), axis=1)
        first = np.ones(index.shape, bool)
        first[:, 1:] = index[:, 1:] != index[:, :-1]
        row, at = np.nonzero(first)
        rows.append(row)
        found.append((i << 34) | (part[row] << 12) | index[row, at])
    return np.concatenate(rows), np.concatenate(found)


def _keyed(fps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            row, key = keys(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[row])], names=["key", "fp"])

    return fps.mapInArrow(run, "key long, fp long")


def _neighbours(fps: DataFrame) -> DataFrame:
    """(near, fp): each fingerprint with itself and the 64 that differ in one bit."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
    return fps.select("fp", F.explode(flips).alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("near"), "fp")


def links(fps: DataFrame, max_bits: int = 2, paired: int = PAIRED, store=stored) -> DataFrame:
    """Edges (src, dst) that connect exactly the fingerprints that differ in few bits.

    fps: distinct `fp`. Buckets of up to `paired` fingerprints are compared pair by
    pair. In a larger one, every two that differ in two bits at most have a common
    one-bit neighbour; no neighbour has more than 65 fingerprints, which are linked
    to the smallest. So no bucket is dropped and none costs its square.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments guarantee distances up to 2 bits")
    keyed = store(_keyed(fps), "simhash-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    held = store(keyed.join(sizes, "key"), "simhash-buckets")
    small = held.where(F.col("n") <= paired).select("key", "fp")
    other = small.select("key", F.col("fp").alias("other"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits
    pairs = small.join(other, "key").where((F.col("fp") < F.col("other")) & near).select("fp", "other")
    pairs = pairs.toDF("src", "dst")
    large = held.where(F.col("n") > paired).select("fp").distinct()
    if max_bits == 0:
        return pairs
    if max_bits == 1:
        hubs = _neighbours(large).where("fp != near").toDF("dst", "src")
        return pairs.union(hubs.join(large.toDF("dst"), "dst", "left_semi").select("src", "dst"))
    stars = _neighbours(large).groupBy("near").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.explode("all").alias("src"), F.array_min("all").alias("dst")).where("src != dst")
    return pairs.union(stars)


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fingerprint, component_id, group and columns to keep, for every row of docs.

    component_id: the smallest doc_id that links reach, itself included. group: one of
    the component's fingerprints, as a number. Null and empty texts have fingerprint zero
    and link like any other; repeated rows stay rows; null doc_ids are carried, and count
    for component_id only if no other is there. An empty table gives no rows. Copies meet
    once per fingerprint before any comparison, so a group of any size costs as much as
    one document there.
    """
    rows = stored(fingerprints(docs, size, keep), "simhash")
    with Scratch(docs.sparkSession) as store:
        distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
        roots = components(links(distinct.select("fp"), max_bits, store=store), "simhash-components")
        roots = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        roots = roots.select("fp", "least", "n", F.coalesce("root", "fp").alias("group"))
        least = roots.groupBy("group").agg(F.min("least").alias("component_id"))
        ids = stored(roots.join(least, "group").select("fp", "component_id", "group", "n"), "simhash-ids")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    rows = split_join(rows, ids, ["fp"], ["doc_id", *keep])
    return rows.select("doc_id", text.alias("fingerprint"), "component_id", "group", *keep)
