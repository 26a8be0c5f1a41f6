"""Lowest values, ranks within groups, latest rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from . import ranks


def lowest_per_group(df: DataFrame, keys: Sequence[str], search: str, value: str) -> DataFrame:
    """Distinct searches, rows and least value per group."""
    return df.groupBy(*keys).agg(F.count_distinct(search).alias("search_counts"), F.count("*").alias("solution_counts"), F.min(value).alias("min_value"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[Column | str] = ()) -> DataFrame:
    """The row of the greatest ``order`` per key; ties go by ``ties``."""
    w = W.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *ties)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, search: str, most: int = 3, approx: bool = False) -> DataFrame:
    """Dense rank of the value up to ``most``, with whole-group counts of searches and rows.

    The rows are computed once and kept. Ranks are found on distinct values, of which each task hands on
    ``most`` per group, and counts by partial aggregation; ranks take the counts along and meet the rows by key, so
    no task gathers a hot group. Null values rank first.
    """
    df = ranks.kept(df)
    named = [f"_k{i}" for i in range(len(keys))]
    distinct = df.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), F.col(value).alias("_value")).distinct()
    ranked = distinct.withColumn("value_rank", F.row_number().over(W.partitionBy(*named).orderBy("_value"))).where(F.col("value_rank") <= most)
    same = F.col(value).eqNullSafe(F.col("_value"))
    for k, n in zip(keys, named, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    searches = F.approx_count_distinct(search) if approx else F.count_distinct(search)
    totals = df.groupBy(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys))).agg(searches.alias("group_searches"), F.count("*").alias("group_rows"))
    here = F.lit(True)
    for i, n in enumerate(named):
        here = here & F.col(n).eqNullSafe(F.col(f"_t{i}"))
    whole = ranked.join(totals, here).drop(*(f"_t{i}" for i in range(len(keys))))  # ``most`` rows a group
    return df.join(whole, same).drop(*named, "_value")


def rank_panel(df: DataFrame, keys: Sequence[str], value: str, carrier: str) -> DataFrame:
    """One row per key and rank: value, sorted set of carriers, group counts."""
    return df.groupBy(*keys, "value_rank").agg(
        F.min(value).alias("value"), F.array_sort(F.collect_set(carrier)).alias("carriers"), F.min("group_searches").alias("group_searches"), F.min("group_rows").alias("group_rows")
    )


def collapse_ranks(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rank 1 with the next rank's value and carriers beside it, and how the carriers relate."""
    w = W.partitionBy(*keys).orderBy("value_rank")
    wide = panel.withColumn("next_value", F.lead("value").over(w)).withColumn("next_carriers", F.lead("carriers").over(w)).where("value_rank = 1")
    return (
        wide.withColumn("value_step", F.col("next_value") - F.col("value"))
        .withColumn("same_carriers", (F.col("carriers") == F.col("next_carriers")).cast("int"))
        .withColumn("shared_carriers", (F.size(F.array_intersect("carriers", "next_carriers")) > 0).cast("int"))
    )


def argmin_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All rows that hold their group's least value (ties kept); rows with a null key never match."""
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.withColumn("_r", F.rank().over(W.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last()))).where(F.col("_r") == 1).where(F.col(value).isNotNull()).drop("_r")
