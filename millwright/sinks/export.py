"""Writers and presentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DecimalType,
    FractionalType,
    MapType,
    NumericType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from millwright.functions.text import column
from millwright.functions.times import clock_text
from millwright.sinks.scratch import exists
from millwright.sources.tables import csv_options


def csv_safe(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text and timestamps as ``yyyy-MM-dd HH:mm:ss``."""

    def flat(f):
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.to_json(column(f.name)).alias(f.name)
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            return clock_text(column(f.name)).alias(f.name)
        return column(f.name)

    return df.select(*[flat(f) for f in df.schema.fields])


#: Rows of a CSV file at most, unless told.
CSV_ROWS = 1_000_000


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    num_files: int | None = None,
    rows_per_file: int | None = None,
    replace_partitions_only: bool = False,
    rebalance: bool = True,
    cluster_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
    codec: str | None = None,
) -> int:
    """Write Parquet or CSV in parallel; the number of rows that the write committed.

    ``partition_by`` lays the files out by column; ``rebalance`` gathers a
    partition's rows into few files and splits a partition that is too large
    for one task. It costs a shuffle, so switch it off for input that already
    arrives by partition. ``replace_partitions_only`` limits an overwrite to the
    partitions present in ``df``, so a re-run replaces just its own days.
    ``num_files`` is for small extracts that must arrive as a fixed file count.
    ``cluster_by`` sorts rows into files by ranges of these columns, within their
    partitions, and ``bloom`` adds Bloom filters on columns to Parquet files: a reader
    that looks for few values then skips most files and row groups. ``codec`` names the
    format's compression; CSV is plain without.

    The count is a metric of the write itself, taken in its last stage, where a task that
    is run again counts once; with mode "ignore" on an existing table it is 0.
    """
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported format: {fmt}")
    out = csv_safe(df) if fmt == "csv" else df
    if num_files is not None:
        out = out.repartition(num_files)  # a coalesce would narrow the work upstream too
    elif cluster_by:
        keys = [*partition_by, *cluster_by]
        # Rows that are equal in the keys, such as all without one, may take several ranges.
        rest = F.xxhash64(*[column(f.name) for f in out.schema.fields if isinstance(f.dataType, AtomicType)])
        out = out.repartitionByRange(*keys, rest).sortWithinPartitions(*keys)
    elif partition_by and rebalance:
        out = out.hint("rebalance", *partition_by)
    if mode == "ignore" and exists(df.sparkSession, path):
        return 0
    committed = Observation()
    out = out.observe(committed, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode).format(fmt)
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    if fmt == "csv":
        writer = writer.options(**csv_options(), quoteAll=True)
        rows_per_file = rows_per_file or CSV_ROWS  # a task reads a whole file
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if replace_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return committed.get["rows"]


#: Rows that one task merges in little time.
MERGED_ROWS = 5_000_000


def _tasks(df: DataFrame) -> int:
    """About how many tasks read what a plan reads, from its estimated bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size // (128 << 20) + 1


def present(
    df: DataFrame,
    order_by: Sequence[str],
    limit: int = 10_000,
    precision: int = 2,
    narrow: bool | None = None,
) -> DataFrame:
    """The first ``limit`` rows in order, with fractional columns rounded for display.

    A name in ``order_by`` with a leading ``-`` sorts descending; NULLs come last
    either way. Every task hands its own best ``limit`` rows to one merging task;
    ``narrow`` first leaves out the rows that cannot be in the result, at the price
    of a second pass; by default only when the merging task would get more than
    MERGED_ROWS of them.
    """
    if narrow is None:
        narrow = limit * _tasks(df) > MERGED_ROWS
    top = _contenders(df, order_by, limit) if narrow else df
    top = top.orderBy(*[_order(c) for c in order_by]).limit(limit)

    def shown(f: StructField) -> Column:
        fine = isinstance(f.dataType, DecimalType) and f.dataType.scale <= precision
        if isinstance(f.dataType, FractionalType) and not fine:
            return F.round(column(f.name), precision).alias(f.name)
        return column(f.name)

    return top.select(*[shown(f) for f in df.schema.fields])


def _order(name: str) -> Column:
    if name.startswith("-"):
        return F.desc_nulls_last(name[1:])
    return F.asc_nulls_last(name)


def _contenders(df: DataFrame, order_by: Sequence[str], limit: int) -> DataFrame:
    """All rows that may be among the first ``limit``, and few others.

    Rows are hashed into four times ``limit`` groups, each with its best row in the
    whole order. Once ``limit`` groups have their best at or before some bound, so
    have at least ``limit`` rows: no row behind the bound can be in the result. Ties
    in the leading column do not weaken the bound; rows equal in the whole order do.
    """
    names = [c.removeprefix("-") for c in order_by]
    groups = F.pmod(F.xxhash64(*[column(n) for n in names]), F.lit(4 * limit))
    best = df.groupBy(groups.alias("__group")).agg(F.min(_rank(df, order_by)).alias("__best"))
    first = best.orderBy("__best").limit(limit)
    bound = first.agg(F.when(F.count(F.lit(1)) == limit, F.max("__best"))).scalar()
    return df.where(bound.isNull() | (_rank(df, order_by) <= bound))


def _rank(df: DataFrame, order_by: Sequence[str]) -> Column:
    """The order as one value that sorts upwards: numbers turned round where it descends."""
    parts = []
    for i, c in enumerate(order_by):
        name = c.removeprefix("-")
        value = column(name)
        parts.append(value.isNull().alias(f"n{i}"))
        if not c.startswith("-"):
            parts.append(value.alias(f"v{i}"))
        elif isinstance(df.schema[name].dataType, NumericType):
            parts.append((-value).alias(f"v{i}"))
        else:
            # What cannot be turned round bounds no further: equal here, told apart later.
            break
    return F.struct(*parts)
