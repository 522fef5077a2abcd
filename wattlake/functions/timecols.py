"""Time expressions on ``timestamp_ntz`` columns (UTC wall time).

Every helper is a built-in Column expression, so it stays inside whole-stage
codegen and gives the same answer whatever the session time zone is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.schemas import SEASONS


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(c: str | Column) -> Column:
    """Truncate to the hour, keeping ``timestamp_ntz``."""
    t = _c(c)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def minute_floor(c: str | Column, minutes: int) -> Column:
    """Truncate to a ``minutes`` bucket inside the hour (5 -> 5-minute buckets)."""
    t = _c(c)
    m = (F.floor(F.minute(t) / minutes) * minutes).cast("int")
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), m, F.lit(0))


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970-01-01 of a UTC wall-time value (zone independent)."""
    return F.unix_timestamp(_c(c))


def add_hours(c: str | Column, hours: int | Column) -> Column:
    h = F.lit(hours) if isinstance(hours, int) else hours
    return _c(c) + F.make_dt_interval(F.lit(0), h)


def sql_day_of_week(c: str | Column) -> Column:
    """Sunday = 0 ... Saturday = 6 (SQL ``EXTRACT(DOW)`` convention)."""
    return (F.dayofweek(_c(c)) - 1).cast("int")


def ml_day_of_week(c: str | Column) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek`` convention)."""
    return F.weekday(_c(c)).cast("int")


def season_number(month: Column) -> Column:
    expr = None
    for num, _name, months in SEASONS[:-1]:
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(num)) if expr is None else expr.when(cond, F.lit(num))
    return expr.otherwise(F.lit(SEASONS[-1][0])).cast("int")


def season_name(month: Column) -> Column:
    expr = None
    for _num, name, months in SEASONS[:-1]:
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(SEASONS[-1][1]))


def calendar_columns(c: str | Column = "time") -> dict[str, Column]:
    """P5 + P6: hour, day_of_week (Sunday=0), is_weekend, month, season."""
    t = _c(c)
    dow = sql_day_of_week(t)
    month = F.month(t).cast("int")
    return {
        "hour": F.hour(t).cast("int"),
        "day_of_week": dow,
        "is_weekend": dow.isin(0, 6),
        "month": month,
        "season": season_number(month),
        "season_name": season_name(month),
    }


def cyclic(x: Column, period: int) -> tuple[Column, Column]:
    """sin/cos encoding of ``x`` with the given period."""
    angle = F.lit(2 * math.pi) * x.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def parse_local_time(text: Column, source_tz: str | Column, formats: list[str] | None = None) -> Column:
    """Parse wall-clock text in ``source_tz`` and return UTC wall time (NTZ).

    ``formats`` are tried in order; the ISO form is always tried first.
    """
    t = F.trim(text)
    candidates = [F.try_to_timestamp(t)]
    for fmt in formats or []:
        candidates.append(F.try_to_timestamp(t, F.lit(fmt)))
    local = F.coalesce(*candidates)
    tz = F.lit(source_tz) if isinstance(source_tz, str) else source_tz
    # to_utc_timestamp reads the wall clock of ``tz`` and shifts it to UTC.
    return F.to_utc_timestamp(local, tz).cast("timestamp_ntz")
