"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over the training time from 0 to 1. Its integral is
the source's share of the token demand; sources whose share exceeds what they may give
are held at that, and the excess is shared anew. Within a source, documents come in a
fixed pseudo-random order, whole copies first. A copy that starts after c tokens of its
source stands at the time at which the source's cumulative demand reaches c: the inverse
of the integrated schedule. Documents are range-sorted by that time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import WORD, Scratch, identified, ranked, small, stored, take

#: Weights of the schedules that sources get in turn, at the start and at the end; the
#: weight between is linear, and its integral the mean: 3, 1 and 2.
RAMPS = ((4.0, 2.0), (1.0, 1.0), (1.5, 2.5))
#: Documents of a source that one task numbers, about.
BUCKET_ROWS = 200_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sources(sized: DataFrame, ramps: Sequence[tuple[float, float]], share: float, most: float, store) -> DataFrame:
    """(source, source_size, documents, first, last, target): one row for each source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    sums = store(sums.withColumn("key", F.coalesce(F.hex("source"), F.lit("~"))), "mixing-sums")
    turn = F.pmod(F.col("rank"), F.lit(len(ramps))).cast("int")
    table = F.array(*[F.struct(F.lit(float(a)).alias("first"), F.lit(float(b)).alias("last")) for a, b in ramps])
    # Hexadecimal UTF-8 sorts as code points do, and "~" comes after all of it.
    placed = ranked(sums.withColumn("all", F.lit(0)), "all", ["key"], "mixing-sources", store).drop("all", "key")
    placed = placed.withColumn("ramp", F.element_at(table, turn + 1)).select(
        "source", "source_size", "documents", "ramp.first", "ramp.last",
        ((F.col("ramp.first") + F.col("ramp.last")) / 2).alias("weight"),
        (most * F.col("source_size")).alias("cap"),
    )
    placed = store(placed, "mixing-weights")
    total = share * (placed.agg(F.sum("source_size")).first()[0] or 0)
    # Shares by weight; those above their cap are held there, and the rest shared anew.
    held, free_weight, free_total = -1, 0.0, 0.0
    over = F.lit(False)
    while True:
        row = placed.agg(
            F.sum(F.when(over, 1).otherwise(0)), F.sum(F.when(over, F.col("cap")).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
        ).first()
        if (row[0] or 0) == held:
            break
        held, free_total, free_weight = row[0] or 0, total - (row[1] or 0), row[2] or 0.0
        if not free_weight:
            break
        over = over | (F.lit(free_total) * F.col("weight") / F.lit(free_weight) > F.col("cap"))
    free = F.lit(free_total) * F.col("weight") / F.lit(free_weight) if free_weight else F.col("cap")
    return placed.withColumn("target", F.when(over, F.col("cap")).otherwise(free).cast("double"))


def demand(first: Column, last: Column, time: Column) -> Column:
    """Part of a source's demand that has come by a time."""
    return (first * time + (last - first) * time * time / 2) / ((first + last) / 2)


def time_of(first: Column, last: Column, part: Column) -> Column:
    """The time by which that part of a source's demand has come: demand's inverse."""
    area = part * (first + last) / 2
    return 2 * area / (first + F.sqrt(first * first + 2 * (last - first) * area))


def mix(
    docs: DataFrame,
    ramps: Sequence[tuple[float, float]] = RAMPS,
    share: float = 1.5,
    most: float = 2.0,
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and position of every row of docs.

    size: words of the text, none if null. share: words to take, as a multiple of all
    words. most: copies of a document that may be taken. A source's target is reached by
    its documents in pseudo-random order: each gets the whole copies that the ratio of
    target to size gives, and the first ones in that order one more, up to the document
    that crosses the target, which is in if at least half of it is. position: when its
    first copy comes, null if none does. carry: more columns to keep, by new name.
    Repeated rows and null ids are rows like others, in the order of text and id; a null
    source comes last. Sources without words have target 0 and take nothing.
    """
    carry = dict(carry or {})
    own = ["file", "at"] if carry else []
    if carry:
        whole = identified(docs, *dict.fromkeys(["doc_id", "source", "text", *carry.values()]))
        whole = whole.select("*", *[F.col(old).alias(f"keep_{new}") for new, old in carry.items()])
    else:
        whole = take(docs, "doc_id", "source", "text")
    size, text_key = words_of(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")
    sized = stored(whole.select("doc_id", "source", size, text_key, *own), "mixing-sizes")
    with Scratch(docs.sparkSession) as store:
        sources = stored(_sources(sized, ramps, share, most, store), "mixing-targets")
    # Number the documents of each source: buckets of the order first, then within them.
    order = F.md5(F.concat_ws(":", F.lit("mix"), F.col("doc_id").cast("string")))
    largest = sources.agg(F.max("documents")).first()[0] or 0
    bits = max(4, (largest // BUCKET_ROWS).bit_length())
    digits = -(-bits // 4)
    rows = sized.withColumn("order", order).withColumn("bucket", F.substring("order", 1, digits))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0))).drop("sum")
    inner = Window.partitionBy("source", "bucket").orderBy("order", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    starts = starts.select(F.col("source").alias("s1"), F.col("bucket").alias("b1"), "start")
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("s1")) & (F.col("bucket") == F.col("b1")))
    targets = sources.withColumnRenamed("source", "s2")
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("s2"))).withColumn("c", F.col("start") + F.col("within"))
    size, total, target = F.col("size"), F.col("source_size"), F.col("target")
    # Whole passes over the source, and how far the last, broken one goes.
    passes = F.when(total > 0, F.floor(target / total)).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("passes", passes).withColumn("rest", target - F.col("passes") * total)
    extra = (size > 0) & (F.col("c") + size / 2 <= F.col("rest"))
    rows = rows.withColumn("copies", F.when(size > 0, F.col("passes") + extra.cast("long")).otherwise(F.lit(0)).cast("int"))
    # The first copy starts c words into the source's stream, the next a pass later.
    part = F.least(F.col("c") / target, F.lit(1.0))
    position = F.when(F.col("copies") > 0, time_of(F.col("first"), F.col("last"), part))
    rows = rows.withColumn("position", position)
    result = rows.select(
        *own, "doc_id", "size", "source_size", "target",
        (size * F.col("copies")).alias("taken"), "copies", "position", "c", "first", "last",
    )
    if not carry:
        return result.repartitionByRange("position", "doc_id").drop("c", "first", "last")
    # One row for each copy, at its own time, with the columns asked for.
    copy = result.where("copies > 0").select("*", F.posexplode(F.sequence(F.lit(1), F.col("copies"))).alias("pass", "nth"))
    start = F.col("c") + F.col("pass") * F.col("source_size")
    at = time_of(F.col("first"), F.col("last"), F.least(start / F.col("target"), F.lit(1.0)))
    copy = small(stored(copy.select(*own, at.alias("position"), "pass"), "mixing-copies"))
    out = whole.select(*own, *[f"keep_{new}" for new in carry]).join(copy, own)
    order = ["position", *own, "pass"]
    out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    return out.select(*[F.col(f"keep_{new}").alias(new) for new in carry])
