"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only.

A text, its white space made single spaces, is cut where its own characters say so: after
LEAST characters at the first place that matches BREAK, and at MOST at the latest. So an
edit moves no cut that is far from it, and equal texts have equal chunks.

Every different chunk goes through one shuffle, combined before it, and gets a verified
identifier: its 64-bit hash, and its place among the different chunks that share that
hash. A text is then its recipe, the ordered list of its chunks' identifiers. Recipes, a
hundredth of the texts, are what is grouped, compared item by item and joined; long
documents are not moved again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, identified, small, stored
from millwright.operators.joins import left_lookup

#: Characters of a chunk, but for the last one of a text.
LEAST, MOST = 100, 4000
#: Where a chunk may end: after three characters of these kinds, about one place in 300.
BREAK = r"(?<=[aeiou][dgkmy] |[。、]..)"
#: Rows of one group of copies that a task takes.
ROWS_PER_TASK = 1_000_000


def normal(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    # A lone space needs no change, so only other runs are matched.
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The text's chunks, in order; joined, they are the text. An empty text has none."""
    body = rf"(?s).{{{least},{most}}}?{BREAK}|.{{{most}}}|.+"
    return F.regexp_extract_all(text, F.lit(body), F.lit(0))


def shared_hashes(parts: DataFrame, store) -> DataFrame | None:
    """(h, chunk, turn): the chunks whose hash other chunks have too, numbered for each hash.

    parts: an array `chunks` of (h, chunk). Each different chunk is shuffled once; of random
    64-bit hashes, a few in 10**10 are shared, and nothing more is to be done without any.
    """
    each = parts.select(F.explode("chunks").alias("c")).select("c.h", "c.chunk")
    several = each.distinct().groupBy("h").agg(F.count("*").alias("n"))
    several = store(several.where("n > 1").select("h"), "exact-several")
    if several.isEmpty():
        return None
    turn = (F.row_number().over(Window.partitionBy("h").orderBy("chunk")) - 1).alias("turn")
    return store(each.join(small(several), "h").distinct().select("h", "chunk", turn), "exact-shared")


def recipes(docs: DataFrame, hash_of: Callable[[Column], Column], store) -> DataFrame:
    """doc_id, file, at, text_sha256 and the recipe of every row: chunk hashes, and `turns`,
    what tells chunks of one hash apart, null where no chunk of the text needs it."""
    rows = identified(docs, "doc_id", "text").withColumn("text", normal(F.col("text")))
    parts = rows.select(
        "doc_id", "file", "at", F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks(F.col("text")), lambda c: F.struct(hash_of(c).alias("h"), c.alias("chunk"))).alias("chunks"),
    )
    parts = store(parts, "exact-chunks")
    shared = shared_hashes(parts, store)
    plain = parts.select("doc_id", "file", "at", "text_sha256", F.col("chunks.h").alias("hashes"))
    if shared is None:
        return plain.withColumn("turns", F.lit(None).cast("array<int>"))
    each = parts.select("file", "at", F.posexplode("chunks").alias("pos", "c")).select("file", "at", "pos", "c.h", "c.chunk")
    told = each.join(small(shared, 10_000), ["h", "chunk"]).where("turn > 0")
    told = told.groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("pos", "turn"))).alias("t"))
    # Positions and turns one after the other: one list that differs wherever they do.
    turns = F.flatten(F.transform("t", lambda x: F.array(x["pos"], x["turn"])))
    told = store(told.select("file", "at", turns.alias("turns")), "exact-turns")
    return plain.join(told, ["file", "at"], "left")


def copies(docs: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of docs.

    Texts are equal when they are the same after each run of ASCII white space is made one
    space; white space at the ends counts, as one space. A null text is an empty one. Of
    equal texts the row with the smallest doc_id stays; rows without an id come after all
    others, and of rows that repeat the smallest id one stays.
    """
    with Scratch(docs.sparkSession) as store:
        rows = stored(recipes(docs, hash_of, store), "exact-recipes")
    recipe = ["hashes", "turns"]
    # Nulls last; which of repeated rows stays is told by its place in the stored table.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at")).alias("first")
    groups = rows.groupBy(*recipe).agg(first, F.count("*").alias("rows"))
    groups = stored(groups.where("rows > 1").select(*[F.col(c).alias(f"of_{c}") for c in recipe], "first", "rows"), "exact-groups")
    # A recipe is compared item by item; groups with very many rows are split over tasks.
    joined = left_lookup(
        rows, groups, [F.col(c) for c in recipe], [f"of_{c}" for c in recipe],
        "spread", rows_per_task, null_safe=True, key_counts=groups,
    )
    alone = F.col("first").isNull()
    same = (F.col("first.file") == F.col("file")) & (F.col("first.at") == F.col("at"))
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        (alone | same).alias("kept"),
        "text_sha256",
    )
