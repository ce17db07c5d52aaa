"""Calendar functions: parts of a date, cyclic encodings, spines.

All are built-in column expressions, so they stay inside whole-stage
codegen.  A date dimension is a pure function of the date key, so the
star uses these expressions instead of joining a date table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import schema as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(d: str | Column, week_start: int = 1) -> Column:
    """Monday=1 ... Sunday=7 (``week_start`` shifts the numbering)."""
    iso = F.weekday(_c(d)) + F.lit(1)  # weekday(): Monday=0
    if week_start == 1:
        return iso.cast("int")
    return (((iso - F.lit(week_start)) % 7) + 1).cast("int")


def quarter_label(d: str | Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(d)).cast("string"))


def week_label(d: str | Column) -> Column:
    """Week of the calendar year, from Monday on; the first and the last week of
    a year can be short.  (An ISO week next to a calendar year would give days
    of both ends of a year one label.)"""
    new_year = F.weekday(F.trunc(_c(d), "year"))
    week = F.floor((F.dayofyear(_c(d)) - 1 + new_year) / F.lit(7)) + 1
    return F.concat(F.lit("Week "), week.cast("string"))


def is_workday(dow: Column) -> Column:
    return F.when(dow <= 5, F.lit("WorkDay")).otherwise(F.lit("WeekEnd"))


def calendar_parts(d: str | Column) -> dict[str, Column]:
    """The date-dimension attributes of a date, as named expressions."""
    d = _c(d)
    dow = day_of_week(d)
    return {
        "CalendarYear": F.year(d),
        "CalendarQuarterLabel": quarter_label(d),
        "CalendarMonthLabel": F.date_format(d, "MMMM"),
        "CalendarWeekLabel": week_label(d),
        "MonthNumber": F.month(d),
        "CalendarDayOfWeekNumber": dow,
        "CalendarDayOfWeekLabel": F.date_format(d, "EEEE"),
        "IsWorkDay": is_workday(dow),
    }


def with_calendar(df: DataFrame, date_col: str = "DateKey",
                  columns: list[str] | None = None) -> DataFrame:
    """``join_date``: attach date attributes by projection (no join)."""
    parts = calendar_parts(date_col)
    wanted = columns or list(parts)
    return df.withColumns({k: parts[k] for k in wanted})


def cyclic(x: str | Column, period: int) -> tuple[Column, Column]:
    """sin / cos of 2*pi*x/period."""
    angle = F.lit(2 * math.pi) * _c(x).cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def with_cyclic(df: DataFrame, col: str, period: int, drop: bool = False) -> DataFrame:
    s, c = cyclic(col, period)
    out = df.withColumns({f"sin_{col}": s, f"cos_{col}": c})
    return out.drop(col) if drop else out


def date_spine(spark: SparkSession, min_date: str, max_date: str,
               name: str = "DateKey") -> DataFrame:
    """Inclusive daily range as a one-column DataFrame."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(min_date)), F.to_date(F.lit(max_date)),
                             F.expr("INTERVAL 1 DAY"))).alias(name))


def date_spine_of(df: DataFrame, date_col: str = "DateKey", name: str = "DateKey") -> DataFrame:
    """Daily spine from the min to the max date present in ``df``.

    The bounds come from one global aggregate (partial per task, one row
    out); the spine holds one row per day, so its size is bounded by the
    calendar, not by the data.
    """
    bounds = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias(name))


def workday_onehot(dow: Column) -> dict[str, Column]:
    return {
        "IsWorkDay_WeekEnd": F.when(dow > 5, 1).otherwise(0),
        "IsWorkDay_WorkDay": F.when(dow <= 5, 1).otherwise(0),
    }


def create_facts(spine: DataFrame, date_col: str = "DateKey") -> DataFrame:
    """Calendar facts knowable for any future day: workday one-hot plus the
    six cyclic columns (month/12, day-of-week/7, quarter/4)."""
    d = F.col(date_col)
    dow = day_of_week(d)
    cols = {**workday_onehot(dow)}
    for name, val, period in (("MonthNumber", F.month(d), S.MONTHS_IN_YEAR),
                              ("CalendarDayOfWeekNumber", dow, S.DAYS_IN_WEEK),
                              ("CalendarQuarterLabel", F.quarter(d), S.QUARTERS_IN_YEAR)):
        s, c = cyclic(val, period)
        cols[f"sin_{name}"] = s
        cols[f"cos_{name}"] = c
    return spine.select(date_col, *[v.alias(k) for k, v in cols.items()])
