"""Row-preserving joins that hold up when the lookup is large or a key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType

from millwright.functions.text import column
from millwright.sinks.scratch import checkpointed

_SALT, _DIM_SALT, _SPLITS, _HOT = "__salt", "__dim_salt", "__splits", "__hot_"
# Rows with a NULL key match nothing, so they may go anywhere.
_NULL_SPREAD = 1 << 16


def measure_bytes(df: DataFrame) -> int:
    """Data volume of ``df`` in bytes, measured by one aggregate over it (runs a job)."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        size = F.lit(8)
        if not isinstance(f.dataType, AtomicType):
            size = F.octet_length(F.to_json(F.struct(column(f.name))))
        elif isinstance(f.dataType, StringType):
            size = F.octet_length(column(f.name)) + 8
        width = width + F.coalesce(size, F.lit(8))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("n")).first()["n"]


def pick_strategy(dim: DataFrame, broadcast_bytes: int) -> str:
    """``broadcast`` if ``dim`` is measured to fit the limit, else ``spread``."""
    return "broadcast" if measure_bytes(dim) <= broadcast_bytes else "spread"


def left_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[Column],
    dim_keys: Sequence[str],
    strategy: str = "auto",
    rows_per_task: int = 5_000_000,
    null_safe: bool = False,
    key_counts: DataFrame | None = None,
) -> DataFrame:
    """``facts`` left-joined to ``dim`` on equal keys; all columns of both.

    ``auto``       no hint: the optimizer broadcasts by its own size threshold,
                   and splits skewed partitions at run time beyond it.
    ``broadcast``  for a ``dim`` whose size was checked (see ``pick_strategy``).
    ``spread``     shuffle join with hot keys split over many tasks; runs a job to
                   find them, unless ``key_counts`` has the facts' ``rows`` per key
                   (keys named as in ``dim``; rare keys may be left out).

    Column names must not overlap. NULL keys match nothing unless ``null_safe``.
    """
    if strategy == "spread":
        hot = _hot_keys(facts, fact_keys, dim_keys, rows_per_task, key_counts)
        return _spread(facts, dim, fact_keys, dim_keys, hot, null_safe)
    if strategy not in ("auto", "broadcast"):
        raise ValueError(f"unknown join strategy: {strategy}")
    small = F.broadcast(dim) if strategy == "broadcast" else dim
    return facts.join(small, _same(fact_keys, dim_keys, null_safe), "left")


def _same(left: Sequence[Column], right: Sequence[str], null_safe: bool) -> Column:
    pairs = [
        a.eqNullSafe(F.col(b)) if null_safe else a == F.col(b) for a, b in zip(left, right)
    ]
    return reduce(lambda x, y: x & y, pairs)


def _hot_keys(
    facts: DataFrame,
    fact_keys: Sequence[Column],
    dim_keys: Sequence[str],
    rows_per_task: int,
    key_counts: DataFrame | None,
) -> DataFrame:
    """Keys with more rows than one task should take, and into how many to split them.

    There are at most rows/rows_per_task of them, so the list can be broadcast
    whatever the input. Counting combines map-side and reads the keys only. The
    list is stored first: a broadcast has a time limit that a count of all keys
    may exceed.
    """
    if key_counts is None:
        key_counts = facts.groupBy(*[k.alias(d) for k, d in zip(fact_keys, dim_keys)]).agg(
            F.count(F.lit(1)).alias("rows")
        )
    hot = key_counts.where(F.col("rows") > rows_per_task).select(
        *[F.col(d).alias(f"{_HOT}{i}") for i, d in enumerate(dim_keys)],
        F.ceil(F.col("rows") / rows_per_task).alias(_SPLITS),
    )
    return checkpointed(hot)


def _spread(
    facts: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[Column],
    dim_keys: Sequence[str],
    hot: DataFrame,
    null_safe: bool,
) -> DataFrame:
    hot_keys = [c for c in hot.columns if c != _SPLITS]
    splits = F.coalesce(F.col(_SPLITS), F.lit(1))
    fact_splits = splits
    if not null_safe:
        unmatched = reduce(lambda x, y: x | y, [k.isNull() for k in fact_keys])
        fact_splits = F.when(unmatched, F.lit(_NULL_SPREAD)).otherwise(splits)
    # The salt depends on the row and on the number of its input partition, which
    # parts even identical copies, but not on the row's position: a task that is
    # run again after a lost executor sends every row to the same place.
    plain = [column(f.name) for f in facts.schema.fields if isinstance(f.dataType, AtomicType)]
    salted_facts = facts.join(
        F.broadcast(hot), _same(fact_keys, hot_keys, null_safe), "left"
    )
    salt = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), fact_splits)
    salted_facts = salted_facts.withColumn(_SALT, salt).drop(*hot.columns)
    salted_dim = dim.join(
        F.broadcast(hot), _same([F.col(k) for k in dim_keys], hot_keys, null_safe), "left"
    )
    salted_dim = salted_dim.withColumn(
        _DIM_SALT, F.explode(F.sequence(F.lit(0), splits - 1))
    ).drop(*hot.columns)
    return salted_facts.join(
        salted_dim,
        _same([*fact_keys, F.col(_SALT)], [*dim_keys, _DIM_SALT], null_safe),
        "left",
    ).drop(_SALT, _DIM_SALT)


def one_per_key(dim: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by`` (then by the other columns).

    An aggregate rather than a ranking window: a repeated key combines map-side.
    """
    rest = [c for c in dim.columns if c != key and c not in order_by]
    return (
        dim.groupBy(key)
        .agg(F.min(F.struct(*order_by, *rest)).alias("__row"))
        .select(*[F.col(key) if c == key else F.col(f"__row.`{c}`").alias(c) for c in dim.columns])
    )
