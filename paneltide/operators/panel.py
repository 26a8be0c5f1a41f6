"""Observation-date by service-date panels: grids, coverage, rolling sums, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from . import ranks


def date_grid(spark: SparkSession, first: str, last: str, stays: Sequence[int], lead_days: int) -> DataFrame:
    """Every (service day, stay, observation day up to ``lead_days`` before it): generated by nested sequences."""
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}')) AS service_day")
    days = days.withColumn("stay", F.explode(F.array(*map(F.lit, stays))))
    return days.withColumn("seen_day", F.explode(F.sequence(F.date_sub("service_day", lead_days), F.date_sub("service_day", 1))))


def key_grid(df: DataFrame, keys: Sequence[str], day: str, first: Column, last: Column) -> DataFrame:
    """Every day of the span for every distinct key."""
    return df.select(*keys).distinct().withColumn(day, F.explode(F.sequence(first, last)))


def densify(grid: DataFrame, observed: DataFrame, on: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The grid with measures, 0 where nothing was observed."""
    return grid.join(observed.select(*on, *measures), list(on), "left").fillna(0, subset=list(measures))


def coverage(df: DataFrame, keys: Sequence[str], day: str, num_days: int) -> DataFrame:
    """Share of ``num_days`` observation days on which each key was seen."""
    return df.groupBy(*keys).agg(F.count_distinct(day).alias("days_seen"), F.count("*").alias("observations")).withColumn("coverage", F.col("days_seen") / F.lit(num_days))


def coverage_of_span(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Share of days on which each key was seen: of all calendar days of the span (``coverage``), and of those on which anything was seen at all (``coverage_adjusted``), so that days missing from the source don't count against a key."""
    span = df.agg((F.datediff(F.max(day), F.min(day)) + 1).alias("span_days"), F.count_distinct(day).alias("source_days"))
    seen = df.groupBy(*keys).agg(F.count_distinct(day).alias("days_seen"), F.count("*").alias("observations"))
    out = seen.crossJoin(F.broadcast(span))  # one row
    return out.withColumn("coverage", F.try_divide("days_seen", "span_days")).withColumn("coverage_adjusted", F.try_divide("days_seen", "source_days"))


def expected_days(lead: Column, first_lead: int, last_lead: int, num_days: int) -> Column:
    """How often a lead time can be seen in a span: ramps at both ends, else every day."""
    return F.when(lead < first_lead + num_days, lead - first_lead + 1).when(lead > last_lead - num_days, last_lead - lead + 1).otherwise(F.lit(num_days))


def lead_grid(df: DataFrame, keys: Sequence[str], lead: str, first: int, last: int) -> DataFrame:
    """Observations per key and lead time, 0 where there are none."""
    seen = ranks.kept(df.groupBy(*keys, lead).agg(F.count("*").alias("observations")))  # counts only; keys are read off them too
    grid = seen.select(*keys).distinct().withColumn(lead, F.explode(F.sequence(F.lit(first), F.lit(last))))
    return densify(grid, seen, [*keys, lead], ["observations"])


def rolling(df: DataFrame, keys: Sequence[str], order: str, value: str, window: int, whole_only: bool = True) -> DataFrame:
    """Sum and mean over the last ``window`` rows; rows with an incomplete window are dropped if ``whole_only``."""
    w = W.partitionBy(*keys).orderBy(order)
    frame = w.rowsBetween(1 - window, 0)
    out = df.withColumn("rolling_sum", F.sum(value).over(frame)).withColumn("rolling_mean", F.avg(value).over(frame)).withColumn("_n", F.row_number().over(w))
    return (out.where(F.col("_n") >= window) if whole_only else out).drop("_n")


def gap_stats(df: DataFrame, keys: Sequence[str], order: str, flag: str) -> DataFrame:
    """Number, mean and greatest length of the runs of 0 in a dense series: gaps and islands, linear in rows."""
    w, v = W.partitionBy(*keys).orderBy(order), W.partitionBy(*keys, flag).orderBy(order)
    islands = df.withColumn("_g", F.row_number().over(w) - F.row_number().over(v)).where(F.col(flag) == 0).groupBy(*keys, "_g").agg(F.count("*").alias("_len"))
    gaps = islands.groupBy(*keys).agg(F.count("*").alias("num_gaps"), F.avg("_len").alias("avg_gap"), F.max("_len").alias("max_gap"))
    return df.select(*keys).distinct().join(gaps, list(keys), "left").fillna(0, subset=["num_gaps", "avg_gap", "max_gap"])


def expanding_counts(df: DataFrame, keys: Sequence[str], order: str, flag: str) -> DataFrame:
    """Per row how many rows there were so far and how many had the flag set: what an ever longer list would be kept for, in constant space."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("rows_so_far", F.count("*").over(w)).withColumn("set_so_far", F.sum(flag).over(w))


def running_gaps(df: DataFrame, keys: Sequence[str], order: str, flag: str) -> DataFrame:
    """At every row of a dense series the number, mean and greatest length of the runs of 0 so far, the run under way included, and the last two as shares of the rows so far.

    Running islands: a run is as long as the rows since the flag was last set; all gaps together are as long as
    the zeros so far. Each row adds to a few numbers, so no history is kept, and the two windows share one sort.
    """
    w = W.partitionBy(*keys).orderBy(order)
    so_far = w.rowsBetween(W.unboundedPreceding, 0)
    gap = F.col(flag) == 0
    out = df.withColumn("rows_so_far", F.row_number().over(w)).withColumn("_begins", (gap & (F.coalesce(F.lag(flag).over(w), F.lit(1)) != 0)).cast("int"))
    out = out.withColumn("_run", F.col("rows_so_far") - F.coalesce(F.max(F.when(~gap, F.col("rows_so_far"))).over(so_far), F.lit(0)))
    out = out.withColumn("num_gaps", F.sum("_begins").over(so_far)).withColumn("max_gap", F.max("_run").over(so_far)).withColumn("_zeros", F.sum(gap.cast("int")).over(so_far))
    out = out.withColumn("avg_gap", F.coalesce(F.try_divide("_zeros", "num_gaps"), F.lit(0.0)))
    return out.withColumn("max_gap_share", F.col("max_gap") / F.col("rows_so_far")).withColumn("num_gaps_share", F.col("num_gaps") / F.col("rows_so_far")).drop("_begins", "_run", "_zeros")
