"""Merkle manifest of a dataset: a digest of every row, a tree for every source, one root.

Rows are leaves. Within a source they stand in the order of doc_id, and runs of FANOUT
nodes become their digest until one is left, the source's subroot; the subroots, in the
order of the sources, likewise become the root.

A superblock is FANOUT**height neighbours of one level of one source. Going up, each
superblock is reduced by one task to its top node, and the tops are the next level's rows.
Going down, the nodes of a superblock and the outer nodes that its proofs need (the
siblings on the way from its top to the root) are cogrouped by superblock: one function
finishes the local reduction, joins the proofs and folds them. So no task holds more than
a superblock and one path, whatever share of the rows one source has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import Scratch, ranked, stored, take

#: Nodes that become one.
FANOUT = 3
#: Levels that a superblock spans.
HEIGHT = 6
#: What a leaf's digest covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The row of a superblock's outer nodes that carries its source's subroot.
SUBROOT = -1

OUTER = "key string, block long, step int, left string, right string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fold(leaf: str, proof) -> str:
    """The root that a leaf and its (left, right) siblings, from the leaf's level up, give."""
    for left, right in proof:
        leaf = digest(left, leaf, right)
    return leaf


def leaf_of(**values: Column) -> Column:
    """The digest of a row: for each of FIELDS `-` if null, else its bytes, `:` and itself."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(values.get(c, F.col(c))) for c in FIELDS]), 256)


def levels_of(nodes: list[str], block: int, height: int) -> list[list[str]]:
    """A superblock's nodes, level by level, up to its only one.

    The first superblock of a level is either full or the only one, so it ends where one
    node is left; a later one always spans all levels, as its neighbours do.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 or (block and len(levels) <= height):
        below = levels[-1]
        levels.append([digest(*below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def siblings(levels: list[list[str]], at: int) -> Iterator[tuple[str, str]]:
    """Joined digests left and right of a node's way up, for each level but the last."""
    for nodes in levels[:-1]:
        run = nodes[at - at % FANOUT : at - at % FANOUT + FANOUT]
        yield "".join(run[: at % FANOUT]), "".join(run[at % FANOUT + 1 :])
        at //= FANOUT


def _climbed(nodes: DataFrame, height: int) -> DataFrame:
    """(key, pos, node): the top of every superblock."""

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        levels = levels_of(rows.sort_values("pos")["node"].tolist(), key[1], height)
        return pd.DataFrame({"key": [key[0]], "pos": [key[1]], "node": [levels[-1][0]]})

    return _blocks(nodes, height).applyInPandas(reduce, "key string, pos long, node string")


def _blocks(nodes: DataFrame, height: int):
    rows = nodes.select("key", "pos", "node", F.expr(f"pos div {FANOUT**height}").alias("block"))
    return rows.groupBy("key", "block")


def _tower(nodes: DataFrame, height: int, store) -> list[DataFrame]:
    """The nodes given and the tops of each step up, until every key has one node."""
    tower = [nodes]
    while (tower[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        tower.append(store(_climbed(tower[-1], height), "merkle-nodes"))
    return tower


def _outer(outer: pd.DataFrame) -> tuple[str, list[tuple[str, str]]]:
    """A superblock's subroot, and the siblings on its way to the root."""
    outer = outer.sort_values("step")
    way = outer[outer["step"] != SUBROOT]
    return outer["left"].iloc[0], list(zip(way["left"], way["right"]))


def _descended(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The outer nodes of the superblocks that these nodes are the tops of.

    nodes with a `child` are sources' subroots: what lies below them has that key.
    """
    if "child" not in nodes.columns:
        nodes = nodes.withColumn("child", F.lit(None).cast("string"))
    nodes = nodes.withColumn("block", F.expr(f"pos div {FANOUT**height}"))

    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = levels_of(rows["node"].tolist(), key[1], height)
        subroot, way = _outer(outer)
        found = []
        for at, (pos, node, child) in enumerate(zip(rows["pos"], rows["node"], rows["child"])):
            place = (key[0], pos) if child is None else (child, 0)
            found.append((*place, SUBROOT, subroot if child is None else node, ""))
            steps = [*siblings(levels, at), *way]
            found += [(*place, i, left, right) for i, (left, right) in enumerate(steps)]
        return pd.DataFrame(found, columns=["key", "block", "step", "left", "right"])

    return nodes.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(finish, OUTER)


def leaves(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """(key, doc_id, leaf, shown): a row's source as a key that sorts as sources do, its
    digest, and the digest with `presented` in place of its text."""
    rows = take(docs, *FIELDS)
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaf = leaf_of()
    shown = leaf if presented is None else F.when(presented.eqNullSafe(F.col("text")), leaf).otherwise(leaf_of(text=presented))
    return rows.select(key.alias("key"), "doc_id", leaf.alias("leaf"), shown.alias("shown"))


def audit(docs: DataFrame, presented: Column | None = None, height: int = HEIGHT, proofs: bool = False) -> DataFrame:
    """A manifest of docs, and every row as presented held against it.

    presented: a column over FIELDS, the text that is held against the manifest; the row's
    own text by default. One row per row of docs: doc_id; leaf; subroot; root;
    proof_sha256, the digest of the leaf's siblings up to the root, left to right;
    folded_root, from the presented row and those siblings; verified, whether that is
    root. `proofs` adds the (left, right) siblings of each level, for `fold`.

    Null fields are told from empty ones; a null source is a source, before all others,
    and null ids come first. Rows that repeat an id stand in the order of their digests,
    rows that repeat in everything beside each other. A lone row has no siblings, and is
    its root. Without rows there is no root and no row. Columns beside FIELDS are not
    covered.
    """
    spark = docs.sparkSession
    id_type = take(docs, "doc_id").schema["doc_id"].dataType.simpleString()
    with Scratch(spark) as store:
        # Numbers parts rows that repeat in everything, so that a sort can part them, too.
        rows = store(leaves(docs, presented).withColumn("n", F.monotonically_increasing_id()), "merkle-rows")
        nodes = stored(ranked(rows, "key", ("doc_id", "leaf", "n"), "merkle-ranked", store), "merkle-leaves")
        nodes = nodes.select("key", F.col("rank").alias("pos"), F.col("leaf").alias("node"), "doc_id", "shown")
        tower = _tower(nodes, height, store)
        subroots = tower[-1].select("key", "node", F.lit("").alias("all"))
        subroots = ranked(subroots, "all", ("key",), "merkle-subroots", store)
        subroots = store(subroots.select(F.lit("").alias("key"), F.col("rank").alias("pos"), "node", F.col("key").alias("child")), "merkle-sources")
        tops = _tower(subroots, height, store)
        top = tops[-1].first()
        outer = spark.createDataFrame([("", 0, SUBROOT, "", "")], OUTER)
        for above in [*reversed(tops), *reversed(tower[1:])]:
            outer = store(_descended(above, outer, height), "merkle-outer")
        outer = stored(outer, "merkle-proofs")

    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = levels_of(rows["node"].tolist(), key[1], height)
        subroot, way = _outer(outer)
        upper = "".join(left + right for left, right in way)
        proof, folded, ways = [], [], []
        for at, shown in enumerate(rows["shown"]):
            steps = list(siblings(levels, at))
            proof.append(digest(*[left + right for left, right in steps], upper))
            folded.append(fold(fold(shown, steps), way))
            if proofs:
                ways.append([{"left": left, "right": right} for left, right in (*steps, *way)])
        out = pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["node"], "subroot": subroot, "proof_sha256": proof, "folded_root": folded})
        return out.assign(proof=ways) if proofs else out

    schema = f"doc_id {id_type}, leaf string, subroot string, proof_sha256 string, folded_root string"
    if proofs:
        schema += ", proof array<struct<left:string,right:string>>"
    blocked = nodes.withColumn("block", F.expr(f"pos div {FANOUT**height}"))
    out = blocked.groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(finish, schema)
    root = F.lit(top["node"] if top else None).cast("string")
    more = ["proof"] if proofs else []
    return out.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        F.col("folded_root").eqNullSafe(root).alias("verified"), *more,
    )


def without_breaks() -> Column:
    """The text without its \\n where 2 divides the id's checksum: changes to be found."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
