"""Retention: keep forecasts, and observed rows newer than a cutoff.

``flag = TRUE OR (flag = FALSE AND local_time > as_of - N hours)`` with SQL
three-valued logic: a NULL flag drops the row, an observed row with a NULL
local time is dropped, a forecast with a NULL local time is kept. The cutoff
compares a *local* time with a UTC ``as_of`` on purpose (the source pipeline
does the same). The comparison is strict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timeshift import hours_before, ntz_literal, utc_now_ntz
from tidemark.schemas import RETENTION_HOURS


def cutoff(df: DataFrame, as_of=None, hours: int = RETENTION_HOURS):
    now = utc_now_ntz(df.sparkSession) if as_of is None else ntz_literal(as_of)
    return hours_before(now, hours)


def retain(
    df: DataFrame,
    as_of=None,
    hours: int = RETENTION_HOURS,
    flag_col: str = "is_forecast",
    local_col: str = "time_local_tz",
) -> DataFrame:
    flag = F.col(flag_col)
    recent = F.col(local_col) > cutoff(df, as_of, hours)
    return df.filter((flag == F.lit(True)) | ((flag == F.lit(False)) & recent))
