"""Dates kept as yyyyMMdd numbers, calendar flags and day arithmetic; safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, functions as F


def int_to_date(c: Column) -> Column:
    """yyyyMMdd number to date; 0, null and impossible dates give null."""
    return F.try_to_date(F.lpad(c.cast("string"), 8, "0"), "yyyyMMdd")


def date_to_int(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def weekday(c: Column) -> Column:
    """Monday is 0."""
    return F.weekday(c)


def is_weekend(c: Column, with_friday: bool = False) -> Column:
    return F.weekday(c) >= (4 if with_friday else 5)


def in_dates(c: Column, days: Iterable[date | str]) -> Column:
    """Holiday indicator, 1 or 0; null dates count as 0."""
    return F.coalesce(c.isin([F.lit(str(d)).cast("date") for d in days]).cast("int"), F.lit(0))


def near_weekend_or_holiday(c: Column, holidays: Iterable[date | str]) -> dict[str, Column]:
    """Flags for the day before, the day itself and the day after."""
    days = list(holidays)
    flag = lambda d: (is_weekend(d) | (in_dates(d, days) == 1)).cast("int")
    return {"prev_off": flag(F.date_sub(c, 1)), "day_off": flag(c), "next_off": flag(F.date_add(c, 1))}


def key_of(*parts: Column, sep: str = "-") -> Column:
    """A joined key; null if any part is null (concat_ws alone would drop the part)."""
    whole = F.concat_ws(sep, *parts)
    for p in parts:
        whole = F.when(p.isNotNull(), whole)
    return whole
