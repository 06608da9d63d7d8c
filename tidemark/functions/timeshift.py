"""Offset-text parsing and time shifts.

UTC offsets arrive as text in several shapes (``+0``, ``-5``, ``+5:30``,
``-4.0``). Spark's ``CAST(.. AS INTERVAL)`` returns NULL for these silently, so
the text is parsed once into a number of seconds and added with
``make_dt_interval``. The sign applies to the minutes too (``-3:30`` is minus
three and a half hours). The whole text must be an offset of less than a day;
anything else gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import as_col

# Signed decimal hours with an optional ':minutes' tail, and nothing else.
DAY_SECONDS = 86_400
OFFSET_PATTERN = r"^[+-]?([0-9]{1,2}(?:[.][0-9]{1,9})?)(?::([0-5]?[0-9]))?$"


def offset_seconds(offset_text) -> Column:
    """Signed offset in seconds as ``decimal(18,6)``; NULL when not parseable."""
    text = F.trim(as_col(offset_text))
    hours = F.nullif(F.regexp_extract(text, OFFSET_PATTERN, 1), F.lit("")).cast("decimal(11,9)")
    minutes = F.coalesce(
        F.nullif(F.regexp_extract(text, OFFSET_PATTERN, 2), F.lit("")).cast("int"),
        F.lit(0),
    )
    sign = F.when(text.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    seconds = (sign * (hours * F.lit(3600) + minutes * F.lit(60))).cast("decimal(18,6)")
    return F.when(F.abs(seconds) < F.lit(DAY_SECONDS), seconds)


def seconds_interval(seconds) -> Column:
    """Day-time interval of ``seconds`` (NULL stays NULL)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), as_col(seconds).cast("decimal(18,6)"))


def shift_by_offset(ts, offset_text) -> Column:
    """``ts + offset`` where the offset is the text form above."""
    return as_col(ts) + seconds_interval(offset_seconds(offset_text))


def shift_by_seconds(ts, seconds) -> Column:
    """``ts + seconds`` for an already parsed offset column."""
    return as_col(ts) + seconds_interval(seconds)


def hour_floor(ts) -> Column:
    """Truncate a ``timestamp_ntz`` to the hour without touching time zones."""
    c = as_col(ts)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
    )


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a string or naive ``datetime``."""
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def utc_now_ntz(spark) -> Column:
    """Wall-clock UTC now as ``timestamp_ntz`` (``now() AT TIME ZONE 'UTC'``)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.localtimestamp())


def hours_before(ts, hours: int) -> Column:
    return as_col(ts) - F.make_dt_interval(F.lit(0), F.lit(hours))
