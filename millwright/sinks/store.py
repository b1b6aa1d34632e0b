"""A partitioned fact table that later loads add to: where an event is, and merging.

Beside the table stands a locator: for every event the 64-bit hash of what identifies it,
and the partition it was stored in. It is only ever added to, and always before the table
is, so it names every partition that holds an event, and perhaps some that did once. A
load joins its own hashes with it, and reads, compares exactly and rewrites nothing but
the partitions found, so an event that is sent again is found in whatever partition it
lies, and no other partition is read.

An event is identified by its id; one without an id by what it says of itself. What the
roster adds, and the load time, do not count.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millwright.functions.text import column
from millwright.schemas import FACT
from millwright.sinks.export import write
from millwright.sinks.scratch import delete, exists, new_path, partition_path
from millwright.sources.tables import read_table

ID = "maint_event_id"
OWN = (
    "factory_id", "line_id", "start_timestamp", "end_timestamp", "maintenance_type", "reason", "outcome",
    "downtime_min", "cost_eur", "technician_id", "parts_list", "next_due_date",
)

Partition = tuple


def key_hash() -> Column:
    """The hash of what identifies an event."""
    own = F.xxhash64(F.lit(1), *[F.col(c) for c in OWN])
    return F.when(F.col(ID).isNotNull(), F.xxhash64(ID)).otherwise(own)


def identities() -> list[Column]:
    """What identifies an event, exactly: its id, and for events without one all it says."""
    return [F.col(ID).alias("__id"), F.when(F.col(ID).isNull(), F.struct(*OWN)).alias("__own")]


def not_among(rows: DataFrame, others: DataFrame, how: str = "left_anti") -> DataFrame:
    """The rows whose event the others do not hold; with ``left_semi`` those they hold."""
    # The hash first: sorting by it seldom comes to the other keys.
    keys = others.select(key_hash().alias("__hash"), *identities())
    own = rows.select("*", key_hash().alias("__hash_row"), *[i.alias(f"{n}_row") for i, n in zip(identities(), ("__id", "__own"))])
    same = F.col("__hash_row") == F.col("__hash")
    same = same & F.col("__id_row").eqNullSafe(F.col("__id")) & F.col("__own_row").eqNullSafe(F.col("__own"))
    return own.join(keys, same, how).select(*rows.columns)


def within(partition_by: Sequence[str], partitions: Sequence[Partition]) -> Column:
    """Whether a row is in one of the partitions, as a condition that prunes all others."""
    if len(partition_by) == 1:
        known = [v for (v,) in partitions if v is not None]
        inside = column(partition_by[0]).isin(known) if known else F.lit(False)
        return inside | column(partition_by[0]).isNull() if len(known) < len(partitions) else inside
    each = [
        reduce(lambda a, b: a & b, [column(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, values)])
        for values in partitions
    ]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def partitions_of(df: DataFrame, partition_by: Sequence[str]) -> list[Partition]:
    """The partitions that rows are in: as many as the table has folders, which Spark's driver lists anyway."""
    return [tuple(r) for r in df.select(*partition_by).distinct().collect()]


@dataclass(frozen=True)
class FactStore:
    """The fact at ``path``, partitioned by columns of ``schema``, and its locator."""

    spark: SparkSession
    path: str
    partition_by: tuple[str, ...]
    schema: StructType = FACT

    @property
    def locator(self) -> str:
        return self.path.rstrip("/") + ".locator"

    def rows(self, partitions: Sequence[Partition] | None = None) -> DataFrame:
        """What is stored, in all or some partitions."""
        stored = read_table(self.spark, self.path, self.schema, "parquet")
        return stored if partitions is None else stored.where(within(self.partition_by, partitions))

    def _locator_schema(self) -> StructType:
        fields = StructType().add("h", "long")
        for c in self.partition_by:
            fields = fields.add(c, self.schema[c].dataType)
        return fields.add("load", "string")

    def located(self, hashes: DataFrame) -> DataFrame:
        """(h, partition, load) of every event that may be one of those with these hashes."""
        self.locate_all()
        known = self.spark.read.schema(self._locator_schema()).option("recursiveFileLookup", True).parquet(self.locator)
        return known.join(hashes.distinct(), "h", "left_semi")

    def locate_all(self) -> None:
        """The locator made from the table, if there is none that is complete."""
        if not exists(self.spark, f"{self.locator}/first/_SUCCESS"):
            delete(self.spark, self.locator)
            rows = self.rows() if exists(self.spark, self.path) else self.spark.createDataFrame([], self.schema)
            self._write(rows.select(key_hash().alias("h"), *self.partition_by), "", f"{self.locator}/first")

    def record(self, rows: DataFrame, located: DataFrame, load: str = "") -> None:
        """Adds where these rows are about to be stored, unless it is known."""
        new = rows.select(key_hash().alias("h"), *self.partition_by)
        known = located.select(F.col("h").alias("__h"), *[column(c).alias(f"__{c}") for c in self.partition_by]).distinct()
        same = reduce(
            lambda a, b: a & b,
            [F.col("h") == F.col("__h"), *[column(c).eqNullSafe(column(f"__{c}")) for c in self.partition_by]],
        )
        self._write(new.join(known, same, "left_anti"), load, f"{self.locator}/more/{uuid.uuid4().hex}")

    def _write(self, keys: DataFrame, load: str, path: str) -> None:
        # In ranges of the hash, so that a reader of a few hashes can skip row groups.
        keys = keys.distinct().withColumn("load", F.lit(load)).repartitionByRange("h").sortWithinPartitions("h")
        write(keys, path)

    def forget(self) -> None:
        """Removes the locator, before something else writes the table."""
        delete(self.spark, self.locator)

    def stage(self, new: DataFrame) -> Staged:
        """All rows that the touched partitions are to hold, stored aside.

        Touched are the partitions of the new rows and those that hold an event which is
        given anew; their other events are kept. Nothing of the table is changed yet.
        """
        stage = new_path(self.spark, "merge")
        n_new = write(new.select(*self.schema.fieldNames()), f"{stage}/new")
        given = read_table(self.spark, f"{stage}/new", self.schema)
        write(self.located(given.select(key_hash().alias("h"))), f"{stage}/located")
        located = read_table(self.spark, f"{stage}/located", self._locator_schema())
        touched = sorted({*partitions_of(given, self.partition_by), *partitions_of(located, self.partition_by)}, key=repr)
        n_kept = write(not_among(self.rows(touched), given).select(*self.schema.fieldNames()), f"{stage}/kept")
        rows = given.unionByName(read_table(self.spark, f"{stage}/kept", self.schema))
        return Staged(rows, given, located, touched, n_new, n_new + n_kept, stage)

    def commit(self, staged: Staged) -> list[Partition]:
        """Puts the staged rows in place of their partitions; the emptied ones, which are removed.

        A run that ends in between is made good by running it again: the locator already
        names all partitions concerned. Until then the staged rows stay in their folder.
        """
        self.record(staged.new, staged.located)
        n = write(
            staged.rows, self.path, partition_by=self.partition_by, replace_partitions_only=True,
            cluster_by=(ID,), bloom=(ID,),
        )
        if n != staged.count:
            raise RuntimeError(f"{n} rows written of {staged.count}, which are kept in {staged.folder}")
        filled = set(partitions_of(staged.rows, self.partition_by))
        emptied = [p for p in staged.touched if p not in filled]
        drop_partitions(self.spark, self.path, self.partition_by, emptied)
        self.discard(staged)
        return emptied

    def discard(self, staged: Staged) -> None:
        delete(self.spark, staged.folder)


@dataclass(frozen=True)
class Staged:
    """What a merge is about to store."""

    rows: DataFrame
    new: DataFrame
    located: DataFrame
    touched: list[Partition]
    new_count: int
    count: int
    folder: str


def drop_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], partitions: Sequence[Partition]) -> None:
    for values in partitions:
        delete(spark, partition_path(spark, path, partition_by, values))
