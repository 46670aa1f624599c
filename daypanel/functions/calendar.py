"""Calendar parts, seasons, cyclic encodings and date ranges."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}


def season(month: Column) -> Column:
    winter, spring, summer = (list(SEASONS[s]) for s in ("Winter", "Spring", "Summer"))
    return (
        F.when(month.isin(winter), "Winter")
        .when(month.isin(spring), "Spring")
        .when(month.isin(summer), "Summer")
        .otherwise("Autumn")
    )


def season_order(column: Column) -> Column:
    """Sort key of a season name, the year starting in winter."""
    return F.array_position(F.array(*[F.lit(s) for s in SEASONS]), column)


def cyclic(column: Column, period: float) -> tuple[Column, Column]:
    angle = column * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def add_seasonal_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Calendar parts (Monday is weekday 0, ISO weeks), season and four cyclic columns."""
    day = F.col(date)
    month_sin, month_cos = cyclic(F.month(day), 12)
    doy_sin, doy_cos = cyclic(F.dayofyear(day), 365.25)
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "quarter": F.quarter(day),
            "day_of_year": F.dayofyear(day),
            "week_of_year": F.weekofyear(day),
            "day_of_week": F.weekday(day),
            "season": season(F.month(day)),
            "month_sin": month_sin,
            "month_cos": month_cos,
            "doy_sin": doy_sin,
            "doy_cos": doy_cos,
        }
    )


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_end(day: Column) -> Column:
    """The Sunday that closes the week of a day."""
    return F.next_day(F.date_sub(day, 1), "Sun")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def date_range(start: Column, end: Column) -> Column:
    """One row per day, both ends included; a generator, so no join is needed."""
    return F.explode(F.sequence(start, end))


def rolling_dates(start: Column, days_ahead: int = 30) -> Column:
    return date_range(start, F.date_add(start, days_ahead))


def month_dates(first: Column) -> Column:
    return date_range(F.trunc(first, "month"), F.last_day(first))


def next_month(latest_month_start: Column) -> Column:
    """``YYYY-MM`` of the month after the latest summarised one."""
    return F.date_format(F.add_months(latest_month_start, 1), "yyyy-MM")


def valid_range(start: Column, end: Column, as_of: Column) -> Column:
    """Both texts are ISO days, start lies before end and end is not in the future."""
    first = F.try_to_date(start, "yyyy-MM-dd")
    last = F.try_to_date(end, "yyyy-MM-dd")
    return F.coalesce((first < last) & (last <= as_of), F.lit(False))


def check_range(start: str, end: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """The same test for job arguments; raises on a bad window."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if first >= last:
        raise ValueError(f"start {start} must lie before end {end}")
    if last > as_of:
        raise ValueError(f"end {end} lies after {as_of}")
    return first, last
