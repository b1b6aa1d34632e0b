"""Text helpers."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """A column name as SQL text, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def split_list(text: Column, sep: str = ",") -> Column:
    """Delimited text as an array of trimmed, non-blank items; NULL when none is left.

    The replacement does the trimming and drops blank items, so no lambda runs per
    item. Its pattern is compiled once, unlike that of a split, which is only
    cheap for a plain separator.
    """
    body = F.btrim(text, F.lit(sep + " "))
    plain = "".join("\\" + c for c in sep)
    even = F.regexp_replace(body, rf" *(?:{re.escape(sep)} *)+", plain)
    return F.when(body != "", F.split(even, re.escape(sep)))


def flag_text(*flags: tuple[Column, str], sep: str = "|") -> Column:
    """Names of the conditions that hold, joined by ``sep``; '' when none does."""
    return F.concat_ws(sep, *[F.when(cond, F.lit(name)) for cond, name in flags])


def flag_array(*flags: tuple[Column, str]) -> Column:
    """Names of the conditions that hold, as an array."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in flags]))
