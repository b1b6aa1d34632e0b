"""Incremental runs of the same flow over files that keep arriving.

The batch functions work on a streaming DataFrame unchanged, the roster joins as a static
side, and the checkpoint remembers which files were taken. Each micro-batch is held
against the events stored before, through the locator beside the fact: an event that is
sent again is reported, and not stored twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from millwright.functions.text import column
from millwright.params import Params
from millwright.plans.pipeline import fact_of
from millwright.schemas import EVENTS, FACT
from millwright.sinks.export import write
from millwright.sinks.scratch import delete, exists, new_path
from millwright.sinks.store import FactStore, identities, key_hash, not_among, partitions_of
from millwright.sources.tables import csv_options, read_table


def ingest_new_files(
    spark: SparkSession,
    input_dir: str,
    roster: DataFrame,
    fact_path: str,
    checkpoint_dir: str,
    params: Params = Params(),
    fmt: str = "csv",
    partition_by: Sequence[str] = ("event_year_month",),
) -> StreamingQuery:
    """Append the events of files not seen before to the fact, then stop.

    A CSV's header must name the columns in their declared order; another one is an
    error, and so is a value that does not convert.

    An event whose id is stored already, by an earlier batch or earlier in its own, goes
    to a table beside the fact instead, see ``read_repeats``; of repeats within a batch
    the first by start time and content is stored. Events without an id repeat each other
    when they say the same.

    The roster is read afresh by each run; facts already stored keep the
    attributes they were written with.
    """
    reader = spark.readStream.schema(EVENTS).format(fmt)
    if fmt == "csv":
        reader = reader.options(**csv_options(), enforceSchema=False, mode="FAILFAST")
    fact = fact_of(reader.load(input_dir), roster, params)
    store = FactStore(spark, fact_path, tuple(partition_by))

    def load(batch: DataFrame, number: int) -> None:
        add_batch(store, batch, str(number))

    return (
        fact.writeStream.option("checkpointLocation", checkpoint_dir)
        .foreachBatch(load)
        .trigger(availableNow=True)
        .start()
    )


def repeats_of(fact_path: str) -> str:
    return fact_path.rstrip("/") + ".repeats"


def read_repeats(spark: SparkSession, fact_path: str) -> DataFrame:
    """The events that were sent again, what they repeat, and the load that sent them."""
    schema = StructType([*FACT.fields, StructField("repeats", StringType()), StructField("load", StringType())])
    return read_table(spark, repeats_of(fact_path), schema, "parquet")


def add_batch(store: FactStore, batch: DataFrame, load: str) -> None:
    """Append the events that are not stored yet; report the others under ``load``.

    A batch may be given again after a failure, whatever of it was stored: what is there
    is not stored twice, and what was there before the batch is reported all the same.
    """
    spark = store.spark
    stage = new_path(spark, "batch")
    hashed = StructType([*FACT.fields, StructField("h", LongType())])
    write(batch.select(*FACT.fieldNames(), key_hash().alias("h")), f"{stage}/given")
    given = read_table(spark, f"{stage}/given", hashed)
    write(store.located(given.select("h")), f"{stage}/located")
    located = read_table(spark, f"{stage}/located", store._locator_schema())
    # An event whose hash is stored nowhere and comes once is new. Only the others are compared.
    twice = given.groupBy("h").count().where("count > 1").select("h")
    write(located.select("h").union(twice).distinct(), f"{stage}/doubted")
    doubted = read_table(spark, f"{stage}/doubted", "h long")
    alone = given.join(doubted, "h", "left_anti").select(*FACT.fieldNames())
    # One of each event, the same one whenever the batch is given again; a window over
    # an event's own rows only, which a re-sent file repeats a few times.
    order = [F.col("start_timestamp"), *[F.to_json(F.struct(column(c))) for c in FACT.fieldNames() if c != "load_timestamp"]]
    turn = F.row_number().over(Window.partitionBy(*identities()).orderBy(*order))
    write(given.join(doubted, "h", "left_semi").withColumn("turn", turn), f"{stage}/numbered")
    numbered = read_table(spark, f"{stage}/numbered", StructType([*hashed.fields, StructField("turn", IntegerType())]))
    first, again = (numbered.where(c).drop("turn") for c in ("turn = 1", "turn > 1"))

    # The locator may name partitions that held an event once, and its hashes may collide:
    # what counts is what the partitions hold.
    there = first.limit(0)
    if exists(spark, store.path):
        stored = store.rows(partitions_of(located, store.partition_by))
        write(not_among(first, stored, "left_semi"), f"{stage}/there")
        there = read_table(spark, f"{stage}/there", hashed)
    write(not_among(first, there).select(*FACT.fieldNames()), f"{stage}/fresh")
    fresh = alone.unionByName(read_table(spark, f"{stage}/fresh", FACT))
    # What an earlier try of this batch stored is no repeat of it.
    before = located.where(F.col("load") != load).select("h").distinct()
    told = there.join(before, "h", "left_semi")
    reported = told.withColumn("repeats", F.lit("a stored event")).unionByName(again.withColumn("repeats", F.lit("its own load")))
    reported = reported.select(*FACT.fieldNames(), "repeats", F.lit(load).alias("load"))
    write(reported, repeats_of(store.path), partition_by=["load"], replace_partitions_only=True)
    store.record(fresh, located, load)
    write(fresh, store.path, mode="append", partition_by=store.partition_by)
    delete(spark, stage)
