"""Local wall-clock times to UTC, independent of the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Fixed value: the accepted text layout, yyyy-MM-dd HH:mm:ss.
TIME_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
# The same with a fraction of the second, where only the order of two times matters.
FINE_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,9})?$"


def _as_if_utc(value: Column, dtype: DataType) -> Column:
    """The instant at which a UTC clock shows ``value``; NULL for any other text layout."""
    if isinstance(dtype, StringType):
        return F.when(value.rlike(TIME_LAYOUT), F.concat(value, F.lit("Z")).try_cast("timestamp"))
    return F.concat(value.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def clock_text(ts: Column) -> Column:
    """Zone-free timestamp as ``yyyy-MM-dd HH:mm:ss``, fractions dropped.

    A cast, since the formatting functions first move the value into the session
    time zone, where a clock change may alter it.
    """
    return F.substring_index(ts.cast("string"), ".", 1)


def day_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def month_text(ts: Column) -> Column:
    return F.substring_index(day_text(ts), "-", 2)


def utc_now() -> Column:
    """Start time of the running query, in UTC."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def local_to_utc(value: Column, dtype: DataType, zone: str) -> Column:
    """Wall-clock time in ``zone`` as a zone-free UTC timestamp.

    A time inside the spring gap moves forward by the gap; one inside the autumn
    overlap takes the earlier (summer) offset. ``convert_timezone`` gives the
    same, but looks both zones up for every row; here the zone is looked up once,
    and neither step involves the session time zone.
    """
    utc = F.to_utc_timestamp(_as_if_utc(value, dtype), zone)
    return F.expr("timestamp_ntz'1970-01-01'") + F.unix_micros(utc) * F.expr(
        "interval '0.000001' second"
    )
