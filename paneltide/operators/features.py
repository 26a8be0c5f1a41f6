"""Lagged, trailing and expanding features. A row's own target is never in its frame."""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import ranks


def shifted(df: DataFrame, value: str, axes: Mapping[str, tuple[Sequence[str], str]], lags: Sequence[int], leads: Sequence[int] = ()) -> DataFrame:
    """Per axis (name -> partition columns, order column): lagged and led values, and days to the lagged row."""
    out = df
    for name, (keys, order) in axes.items():
        w = W.partitionBy(*keys).orderBy(order)
        for n in lags:
            out = out.withColumn(f"{name}_prev_{n}", F.lag(value, n).over(w))
        for n in leads:
            out = out.withColumn(f"{name}_next_{n}", F.lead(value, n).over(w))
        out = out.withColumn(f"{name}_gap", F.datediff(F.col(order), F.lag(order).over(w)))
    return out


def target_encode(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "encoded") -> DataFrame:
    """Expanding mean of the target before this row."""
    return df.withColumn(name, F.avg(value).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)))


def trailing_rows(df: DataFrame, keys: Sequence[str], order: str, value: str, rows: int = 4) -> DataFrame:
    """Mean and deviation of the previous ``rows`` observed rows."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(-rows, -1)
    return df.withColumn("trail_mean", F.avg(value).over(w)).withColumn("trail_std", F.stddev(value).over(w))


def trailing_days(df: DataFrame, keys: Sequence[str], day: str, value: str, days: int) -> DataFrame:
    """Mean over the ``days`` calendar days before this row's day; same-day rows stay out."""
    seconds = F.unix_date(day)
    return df.withColumn("trail_days_mean", F.avg(value).over(W.partitionBy(*keys).orderBy(seconds).rangeBetween(-days, -1)))


def trailing_days_median(df: DataFrame, keys: Sequence[str], day: str, value: str, days: int, block_days: int = 256, name: str = "trail_days_median") -> DataFrame:
    """Median over the ``days`` calendar days before this row's day; same-day rows stay out, null where there is none.

    A key's values are counted per day and dealt to blocks of days, each with the days before it that it needs; a
    sorted array is slid over a block's days, so a day's values are merged in once and out once. The days' medians
    then meet the rows by key and day. A hot key is spread over its blocks.
    """
    df = ranks.kept(df)
    named = [f"_k{i}" for i in range(len(keys))]
    number = F.unix_date(day)
    counts = df.where(F.col(day).isNotNull()).groupBy(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), number.alias("_day"), F.col(value).cast("double").alias("_value")).agg(F.count("*").alias("_n"))
    own, last = F.floor(F.col("_day") / block_days).cast("long"), F.floor((F.col("_day") + days) / block_days).cast("long")
    dealt = counts.withColumn("_block", F.explode(F.sequence(own, last)))
    kinds = dict(counts.dtypes)

    def slide(pdf: pd.DataFrame) -> pd.DataFrame:
        block = pdf["_block"].iloc[0]
        number, x, n = (pdf[c].to_numpy() for c in ("_day", "_value", "_n"))
        at, known = np.unique(number), ~np.isnan(x)
        order = np.lexsort((x[known], number[known]))
        values, of_day = np.repeat(x[known][order], n[known][order]), np.repeat(number[known][order], n[known][order])
        seen = np.unique(of_day)
        per_day = dict(zip(seen.tolist(), np.split(values, np.searchsorted(of_day, seen)[1:]), strict=True)) if len(seen) else {}
        held, inside, waiting, out = np.empty(0), deque(), deque(seen.tolist()), []
        wanted = at[at // block_days == block].tolist()
        for d in wanted:
            while waiting and waiting[0] < d:
                e = waiting.popleft()
                held = np.insert(held, np.searchsorted(held, per_day[e]), per_day[e])
                inside.append(e)
            while inside and inside[0] < d - days:
                gone = per_day[inside.popleft()]
                ties = np.arange(len(gone)) - np.searchsorted(gone, gone)  # the n-th of equal values goes with the n-th held
                held = np.delete(held, np.searchsorted(held, gone) + ties)
            half = len(held) // 2
            out.append(None if not len(held) else float(held[half]) if len(held) % 2 else float(held[half - 1] + held[half]) / 2)
        key = {c: pd.Series([pdf[c].iloc[0]] * len(wanted), dtype=object) for c in named}
        return pd.DataFrame({**key, "_day": wanted, "_median": pd.array(out, dtype="Float64")})

    found = dealt.groupBy(*named, "_block").applyInPandas(slide, "".join(f"{n} {kinds[n]}, " for n in named) + "_day int, _median double")
    same = number == F.col("_day")
    for k, n in zip(keys, named, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return df.join(found, same, "left").drop(*named, "_day").withColumnRenamed("_median", name)


def estimate_from_shift(df: DataFrame, prev: str, prev_change: str, trail: str) -> DataFrame:
    """Neighbour's value plus its last change, else the trailing mean."""
    return df.withColumn("estimate", F.coalesce(F.col(prev) + F.col(prev_change), F.col(trail)))


def row_mean(*columns: str) -> Column:
    """Mean of the columns that aren't null; null if all are."""
    known = F.filter(F.array(*columns), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def impute(df: DataFrame, name: str, *chain: Column) -> DataFrame:
    """The first of the chain that isn't null; rows without any are dropped."""
    return df.withColumn(name, F.coalesce(*chain)).dropna(subset=[name])
