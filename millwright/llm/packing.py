"""Bulk-synchronous best-fit packing of token sequences.

Pieces and gaps (what is still free in an open sequence) are range-sorted by size and
numbered within their size. A round sweeps the sizes of pieces from the largest down;
each size takes the successor gaps, the smallest that hold it, and moves on to the next
larger gaps when those run out. Pieces that want the same gap are told apart by rank:
the first ranks get it, the rest go on. Then the gaps are updated and ranked anew, until
no piece is left. When no gap holds any piece, as many sequences as the rest needs at
least are opened for the largest pieces. A sweep handles sizes, of which there are at
most `capacity`; all rows stay distributed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm.common import Scratch, freeing, ranked, slices, stored, take

#: Fixed value: how byte-level vocabularies of this family split a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text encoded at a time.
PART = 4 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """The ids of a tokenizer file.

    Byte-level BPE without a normalizer goes through a faster library with the same
    vocabulary, which merges in the order of the ids: only if the file's merges make all longer
    entries of the vocabulary in that order. Texts that hold a special token, and all other kinds of
    tokenizer, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        self.fast = None
        if plain and spec["model"]["type"] == "BPE" and not spec["normalizer"]:
            letters = byte_letters()
            vocabulary = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.specials}
            made = [vocabulary.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
            ordered = None not in made and all(a < b for a, b in zip(made, made[1:], strict=False))
            if not ordered or len(made) != sum(len(w) > 1 for w in vocabulary):
                return
            ranks = {bytes(letters[c] for c in w): i for w, i in vocabulary.items()}
            self.fast = tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(x in text for x in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what the others leave."""
    first = length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids and an end id."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, pc.binary_length(batch.column(1)), PART):
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                    for k, (start, n) in enumerate(cut(len(ids), capacity)):
                        rows.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return take(docs, "doc_id", "text").mapInArrow(freeing(run), schema)


def sweep(pieces: dict[int, int], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """One round over sizes: (gap, first gap rank, gaps, piece size, pieces for each).

    pieces and gaps: how many there are of each size. Every gap gets pieces of one size
    at most, as many as it holds. The last gap of an entry may get fewer than the rest.
    """
    free = sorted(gaps)
    taken = dict.fromkeys(free, 0)
    out = []
    for size in sorted(pieces, reverse=True):
        left = pieces[size]
        for gap in free[np.searchsorted(free, size) :]:
            if not left:
                break
            each = gap // size
            n = min(gaps[gap] - taken[gap], -(-left // each))
            if n:
                out.append((gap, taken[gap], n, size, each))
                taken[gap] += n
                left -= min(left, n * each)
    return out


def _sizes(df: DataFrame, column: str) -> dict[int, int]:
    """How many rows of each size; sizes are at most the capacity."""
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def assign(items: DataFrame, capacity: int, store=stored) -> DataFrame:
    """(size, rank, sequence_id, offset): a place for every ranked item.

    items: columns size, from 1 to capacity, and rank, from 0 within a size. Items of a
    size are interchangeable, so each round takes their ranks in order.
    """
    spark = items.sparkSession
    left = {k: v for k, v in _sizes(items, "size").items()}
    used = dict.fromkeys(left, 0)
    placed, opened, bins = [], 0, None
    while any(left.values()):
        todo = {k: v for k, v in left.items() if v}
        gaps = _sizes(bins, "gap") if bins is not None else {}
        plan = sweep(todo, gaps)
        if plan:
            rows, filled = [], dict.fromkeys(left, 0)
            for gap, first, n, size, each in plan:
                start = used[size] + filled[size]
                count = min(n * each, todo[size] - filled[size])
                filled[size] += count
                rows.append((gap, first, first + n, size, each, start, start + count))
            schema = "p_gap int, p_first long, p_last long, size int, each int, start long, stop long"
            matched = F.broadcast(spark.createDataFrame(rows, schema))  # an entry for each pair of sizes that met
            numbered = ranked(bins, "gap", ["bin"], "packing-gaps", store)
            on = (F.col("gap") == F.col("p_gap")) & (F.col("rank") >= F.col("p_first")) & (F.col("rank") < F.col("p_last"))
            met = numbered.join(matched, on, "left")
            at = F.col("start") + (F.col("rank") - F.col("p_first")) * F.col("each")
            met = met.withColumn("at", at).withColumn("n", F.least("each", F.col("stop") - F.col("at")))
            met = store(met.select("bin", "gap", "size", "at", F.coalesce("n", F.lit(0)).alias("n")), "packing-round")
            k = F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("k")
            new = met.where("n > 0").select("size", "at", "bin", "gap", k)
            offset = F.lit(capacity) - F.col("gap") + F.col("k") * F.col("size")
            placed.append(new.select("size", (F.col("at") + F.col("k")).alias("rank"), "bin", offset.alias("offset")))
            gap = (F.col("gap") - F.coalesce("size", F.lit(0)) * F.col("n")).cast("int")
            bins = met.select("bin", gap.alias("gap"))
        else:
            # No gap holds anything: the largest pieces open the sequences that the rest needs at least.
            need, rows, filled = -(-sum(k * v for k, v in todo.items()) // capacity), [], dict.fromkeys(left, 0)
            for size in sorted(todo, reverse=True):
                filled[size] = n = min(need, todo[size])
                rows.append((size, used[size], used[size] + n, opened - used[size]))
                opened, need = opened + n, need - n
                if not need:
                    break
            starts = F.broadcast(spark.createDataFrame(rows, "o_size int, o_first long, o_last long, shift long"))
            on = (F.col("size") == F.col("o_size")) & (F.col("rank") >= F.col("o_first")) & (F.col("rank") < F.col("o_last"))
            new = store(items.join(starts, on).select("size", "rank", (F.col("rank") + F.col("shift")).alias("bin")), "packing-open")
            placed.append(new.withColumn("offset", F.lit(0)))
            fresh = new.select("bin", (F.lit(capacity) - F.col("size")).cast("int").alias("gap"))
            bins = fresh if bins is None else bins.union(fresh)
        for size, n in filled.items():
            left[size] -= n
            used[size] += n
        least = min((size for size, n in left.items() if n), default=capacity)
        bins = bins.where(F.col("gap") >= least)  # others are full for good
    schema = "size int, rank long, bin long, offset int"
    out = spark.createDataFrame([], schema)
    for one in placed:
        out = out.union(one.select("size", "rank", "bin", "offset"))
    return out.select("size", "rank", F.col("bin").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A null text is empty, and then only the end id is packed. Repeated rows and null ids
    are packed like any others; an empty table gives no rows. Only documents longer than
    the capacity are cut; their full pieces have sequences of their own.
    """
    cuts = pieces(docs, tokenizer, capacity, end).withColumn("uid", F.monotonically_increasing_id())
    cuts = stored(cuts, "packing-pieces")
    part = cuts.where(F.col("length") < capacity).select("uid", F.col("length").cast("int").alias("size"))
    with Scratch(docs.sparkSession) as store:
        items = store(ranked(part, "size", ["uid"], "packing-items", store), "packing-ranks")
        places = assign(items.select("size", "rank"), capacity, store)
        placed = items.join(places, ["size", "rank"]).select("uid", F.col("sequence_id") * 2, "offset")
        placed = stored(placed.toDF("uid", "sequence_id", "offset"), "packing-places")
    whole = cuts.where(F.col("length") == capacity).select(
        *cuts.columns, (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    both = cuts.where(F.col("length") < capacity).join(placed, "uid").select(*whole.columns)
    return both.union(whole).drop("uid")
