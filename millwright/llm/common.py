"""What the operators share: reading tables, exact columns, shared storage, ranks."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def take(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, found by exact name: others may clash, even up to case."""
    have = df.columns
    numbered = df.toDF(*[f"_{i}" for i in range(len(have))])
    return numbered.select(*[F.col(f"_{have.index(n)}").alias(n) for n in names])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session may make its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="millwright-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/millwright/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to shared storage and read back: lineage ends here."""
    return _written(df, label)[0]


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


class Scratch:
    """Stores like `stored`, and deletes what it stored at the end of its block.

    Nothing that is still to be computed may read a table of a block that has ended.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        out, path = _written(df, label)
        self.paths.append(path)
        return out

    def done(self, *labels: str) -> None:
        """Deletes what was stored under these labels already now, and the shuffle files of ended queries."""
        for path in [p for p in self.paths if p.rpartition("/")[2].rpartition("-")[0] in labels]:
            delete(self.spark, path)
            self.paths.remove(path)
        forget_shuffles(self.spark)


def done(store, *labels: str) -> None:
    """No later step reads the tables of these labels; a store that is no `Scratch` keeps them."""
    if isinstance(store, Scratch):
        store.done(*labels)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffle files that no query reads any more.

    The cleaner is told by the driver's JVM, when that collects its garbage; a driver with
    little to do does so seldom, and files of all queries until then stay on the executors' disks.
    What the last query holds becomes garbage in the first turn and is found in the second.
    """
    for wait in (0.1, 0.0):
        spark._jvm.System.gc()
        time.sleep(wait)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def identified(docs: DataFrame, *names: str) -> DataFrame:
    """These columns, and `file` and `at`: together one row's own, whenever they are read.

    A Parquet table knows them; the rows of any other DataFrame are written to one.
    """
    try:
        place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
        rows = docs.select("*", *place)
    except AnalysisException:
        rows = stored(take(docs, *names), "rows")
        rows = rows.select("*", *place)
    have = rows.columns  # the place is last, whatever the others are called
    numbered = rows.toDF(*[f"_{i}" for i in range(len(have))])
    own = [F.col(f"_{len(have) - 2}").alias("file"), F.col(f"_{len(have) - 1}").alias("at")]
    return numbered.select(*[F.col(f"_{have.index(n)}").alias(n) for n in names], *own)


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """df, to be broadcast if it was counted to have few rows (of a few numbers each)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def split_join(
    rows: DataFrame, side: DataFrame, keys: list[str], apart: list[str], how: str = "inner", few: int = 100_000, most: int = 1_000_000
) -> DataFrame:
    """rows joined with side, which has one row a key, with `n`: how many rows have it.

    A side of up to `few` rows is broadcast. Else both are shuffled, and the rows of a key
    that more than `most` have are dealt over several tasks by the columns `apart`; such
    keys are at most rows / most. side is read several times: store it before.
    """
    if side.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(side.drop("n")), keys, how)
    parts = F.ceil(F.col("n") / most).cast("int")
    hot = small(side.where(F.col("n") > most).select(*keys, parts.alias("_parts")))
    salt = F.pmod(F.xxhash64(*apart), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = rows.join(hot, keys, "left").withColumn("_salt", salt).drop("_parts")
    whole = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))).drop("n")
    return dealt.join(whole, [*keys, "_salt"], how).drop("_salt")


def let(value: Column, body) -> Column:
    """body(value) with the value evaluated once per row, whatever body does with it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slices(batch: pa.RecordBatch, size_of: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `most` bytes each, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(size_of.to_pylist()):
        if i > start and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def free() -> None:
    """Gives memory that this Python process has let go of back to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def freeing(task: Callable) -> Callable:
    """task, for mapInArrow, that leaves no memory held when its rows are done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        free()

    return run


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def ranked(df: DataFrame, by: str, tie: Iterable[str], label: str, store=stored) -> DataFrame:
    """df with `rank`: from 0 within each value of `by`, in the order of `tie`.

    Rows are range-sorted by (by, tie), so a value held by a third of all rows is
    spread over many tasks; each task numbers its own rows, and a count per task and
    value gives the offsets. `tie` should be unique; rows equal in it get any order.
    """
    keys = [by, *tie]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ordered.select("*", F.lit(0).alias("_part"), F.lit(0).cast("long").alias("_pos"))
    part = ordered.withColumn("_part", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            pos = pa.array(range(at, at + batch.num_rows), pa.int64())
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pos], names=[*batch.schema.names, "_pos"]
            )

    kept = store(part.mapInArrow(number, schema.schema), label)
    first = kept.groupBy(by, "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    # A range-sorted value fills neighbouring tasks: as many rows as values and tasks.
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = first.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    offsets = offsets.select(F.col(by).alias("_by"), F.col("_part").alias("_p"), "_first", "_before")
    joined = kept.join(offsets, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_p")))
    return joined.select(*df.columns, (F.col("_pos") - F.col("_first") + F.col("_before")).alias("rank"))
