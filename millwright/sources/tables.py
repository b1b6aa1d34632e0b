"""Table readers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millwright.functions.text import column, flag_text


def csv_options(line_breaks: bool = True) -> dict[str, object]:
    """How CSV is written and read: quotes doubled, nothing trimmed, backslashes plain.

    With ``line_breaks`` a quoted value may span lines. A file is then read by one task,
    so writers here bound their files; a very large file from elsewhere whose values hold
    no line breaks is read in parallel without.
    """
    return {
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": line_breaks,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """CSV (with header) or Parquet as a DataFrame.

    The format follows the path's suffix unless given. CSV without a schema is
    inferred, at the price of one more scan; see ``csv_options`` for ``line_breaks``.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {fmt}")
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(**csv_options(line_breaks))
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


MALFORMED = "__malformed"


def csv_header(spark: SparkSession, path: str, line_breaks: bool = True) -> list[str]:
    """The column names in a CSV's header; every file under the path has the same."""
    return spark.read.options(**csv_options(line_breaks)).csv(path).columns


def read_csv_text(spark: SparkSession, path: str, schema: StructType, line_breaks: bool = True) -> DataFrame:
    """The declared columns of a CSV, found by name in its header, all as text.

    Columns may stand in any order, and undeclared ones are left out; an absent one
    is an error. A row with too few or too many fields has ``__malformed`` set.
    """
    header = csv_header(spark, path, line_breaks)
    absent = [f.name for f in schema.fields if f.name not in header]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    text = StructType([StructField(c, StringType()) for c in [*header, MALFORMED]])
    reader = spark.read.options(**csv_options(line_breaks), columnNameOfCorruptRecord=MALFORMED)
    # Each file's header must be this one, so that no file is read in another order; and
    # all fields are parsed, as a row cannot be seen to be malformed otherwise.
    rows = reader.options(enforceSchema=False, columnPruning=False).schema(text).csv(path)
    return rows.select(*[column(f.name) for f in schema.fields], F.col(MALFORMED).isNotNull().alias(MALFORMED))


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: StructType,
    unreadable: str = "unreadable_columns",
    line_breaks: bool = True,
) -> DataFrame:
    """CSV with its declared types, and the names of the columns that did not convert.

    A plain typed read turns such values into NULL unseen. Here the text is
    converted by expressions, so a rule on ``unreadable`` (names joined by '|',
    '' when all converted) finds them whichever columns a query uses. A row with too
    few or too many fields is named ``malformed row`` there.
    """
    raw = read_csv_text(spark, path, schema, line_breaks)
    return typed(raw, schema, unreadable, (F.col(MALFORMED), "malformed row"))


def typed(raw: DataFrame, schema: StructType, unreadable: str, *more) -> DataFrame:
    """Text columns converted to their declared types, and which of them did not convert."""
    values = {
        f.name: column(f.name).try_cast(f.dataType)
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    }
    lost = [(column(c).isNotNull() & v.isNull(), c) for c, v in values.items()]
    return raw.select(
        *[values.get(c, column(c)).alias(c) for c in schema.fieldNames()],
        flag_text(*lost, *more).alias(unreadable),
    )


def rows_with(spark: SparkSession, path: str, name: str, values: Sequence, schema=None) -> DataFrame:
    """The rows of a Parquet table whose column holds one of a few values.

    Each value is a condition of its own, which reaches the scan and, where the files have
    them, the columns' ranges and Bloom filters; a long list would reach it as a range only.
    """
    each = [column(name) == F.lit(v) for v in values]
    return read_table(spark, path, schema, "parquet").where(reduce(lambda a, b: a | b, each, F.lit(False)))
