"""Filters on dates, ratios, spread, volume and completeness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import ranks


def within_days(df: DataFrame, lead: str, stay: str, lead_range: tuple[int, int], stay_range: tuple[int, int], slack: int = 0) -> DataFrame:
    """Lead days in range, and stay in range or missing; ``slack`` widens the upper ends for shifted features."""
    (a, b), (c, d) = lead_range, stay_range
    return df.where(F.col(lead).between(a, b + slack) & (F.col(stay).between(c, d + slack) | F.col(stay).isNull()))


def with_group(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """``df`` with aggregates of each row's group beside it: rows computed once, partial aggregation and a join by key, so a hot group's rows aren't gathered and sorted in one task. Null keys are a group."""
    df = ranks.kept(df)
    side = df.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(*aggs)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys))
    return df.join(side, same).drop(*(f"_key_{k}" for k in keys))


def fresh(df: DataFrame, day: str, today: Column, stale_after: int, whole_days: bool = False) -> DataFrame:
    """Rows observed in the last ``stale_after`` days; 0 keeps all. ``whole_days``: up to yesterday, as today is still changing."""
    recent = df if stale_after == 0 else df.where(F.col(day) >= F.date_sub(today, stale_after))
    return recent.where(F.col(day) <= F.date_sub(today, 1)) if whole_days else recent


def sold_at(df: DataFrame, place: str, places: Sequence[str], currency: str | None = None, wanted: str | None = None) -> DataFrame:
    """Rows of the listed points of sale and, if stated, one currency."""
    rows = df.where(F.col(place).isin(list(places)))
    return rows if currency is None else rows.where(F.col(currency) == wanted)


def not_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose boolean flag is false; an unknown one is dropped too."""
    return df.where(~F.col(flag))


def ratio_filter(df: DataFrame, keys: Sequence[str], value: str, most: float, center: str = "mean", counts: str | None = None, least_count: int = 0) -> DataFrame:
    """Value over its group's mean, median or approximate median under ``most``.

    With ``least_count``, only rows that are over it and also counted fewer than ``least_count`` times go.
    """
    if center == "median":
        df = ranks.kept(df)
        joined = ranks.with_quantiles(df, df, value, {"_middle": 0.5}, keys)
    else:
        middle = {"mean": F.avg(value), "approx_median": F.percentile_approx(value, F.lit(0.5), F.lit(10_000))}[center]
        joined = with_group(df, keys, middle.alias("_middle"))
    out = joined.withColumn("ratio", F.try_divide(F.col(value), F.col("_middle"))).drop("_middle")
    return keep_below(out, most, counts, least_count)


def keep_below(df: DataFrame, most: float, counts: str | None = None, least_count: int = 0) -> DataFrame:
    """Rows with a ``ratio`` under ``most``; with ``least_count``, a row over it goes only if it was counted fewer times."""
    if least_count == 0:
        return df.where(F.col("ratio") < most)
    return df.where(~((F.col("ratio") >= most) & (F.col(counts) < least_count)))


def previous_ratio_filter(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, most: float) -> DataFrame:
    """Value over the previous observed value at most ``most``; a group's first row stays. Rows are ordered over range partitions, so a hot group isn't sorted in one task."""
    out = ranks.previous(df, keys, order, value, "prev_value")
    return out.where(F.col("prev_value").isNull() | (F.try_divide(F.col(value), F.col("prev_value")) <= most))


def spread(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Relative standard deviation (sample) per key; keys without one are dropped."""
    return df.groupBy(*keys).agg(F.try_divide(F.stddev(value), F.avg(value)).alias("rsd")).dropna(subset=["rsd"])


def low_spread(df: DataFrame, keys: Sequence[str], value: str, most: float) -> DataFrame:
    df = ranks.kept(df)
    good = spread(df, keys, value).where(F.col("rsd") < most)
    return df.join(good.select(*keys), list(keys), "left_semi")


def full_combos(df: DataFrame, keys: Sequence[str], combo: Sequence[str], wanted: int) -> DataFrame:
    """Rows of keys that occur with all ``wanted`` combinations; null parts count as a combination of their own."""
    df = ranks.kept(df)
    good = df.groupBy(*keys).agg(F.count_distinct(F.struct(*combo)).alias("_n")).where(F.col("_n") == wanted)
    return df.join(good.select(*keys), list(keys), "left_semi")


def volume_ranks(df: DataFrame, keys: Sequence[str], volume: str) -> DataFrame:
    """Keys by total volume, greatest first; ranked after aggregation, so the one-task sort sees keys only."""
    total = df.groupBy(*keys).agg(F.sum(volume).alias("volume"))
    return total.withColumn("volume_rank", F.row_number().over(W.orderBy(F.desc("volume"), *keys)))


def top_by_volume(df: DataFrame, keys: Sequence[str], volume: str, most: int) -> DataFrame:
    df = ranks.kept(df)
    return df.join(volume_ranks(df, keys, volume).where(F.col("volume_rank") <= most), list(keys))


def percentile_clip(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, counts: str, most_count: int) -> DataFrame:
    """Rows at or above the low percentile; rows above the high one go only if counted ``most_count`` times or fewer."""
    df = ranks.kept(df)
    bounds = ranks.quantiles(df, value, {"_lo": low, "_hi": high}, keys)
    return df.join(bounds, list(keys)).where((F.col(value) >= F.col("_lo")) & ~((F.col(value) > F.col("_hi")) & (F.col(counts) <= most_count))).drop("_lo", "_hi")
