"""Shares, cumulative distributions, histograms. One-task windows run over aggregated keys only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def cumulative_shares(totals: DataFrame, by: str, ties: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rank by ``by`` (greatest first), share and running share of the total; ``within`` groups."""
    part = W.partitionBy(*within)
    order = part.orderBy(F.desc(by), *ties)
    run = order.rowsBetween(W.unboundedPreceding, 0)
    out = totals.withColumn("rank", F.row_number().over(order)).withColumn("share", F.try_divide(F.col(by), F.sum(by).over(part)))
    return out.withColumn("cum_share", F.try_divide(F.sum(by).over(run), F.sum(by).over(part)))


def reverse_cdf(totals: DataFrame, by: str, ties: Sequence[str]) -> DataFrame:
    """Share of the total held by this key and all smaller ones."""
    run = W.orderBy(F.asc(by), *ties).rowsBetween(W.unboundedPreceding, 0)
    return totals.withColumn("reverse_cum_share", F.sum(by).over(run) / F.sum(by).over(W.partitionBy()))


def _placed(totals: DataFrame, by: str) -> DataFrame:
    """Distinct values with the number of keys that hold them, hold less, and all: the one-task window sees distinct values only."""
    counts = totals.groupBy(by).agg(F.count("*").alias("_n"))
    before = W.orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("_less", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_all", F.sum("_n").over(W.partitionBy()))


def _percent(less: str, total: str) -> Column:
    return F.coalesce(F.try_divide(F.col(less), F.col(total) - 1), F.lit(0.0))


def cumulative_distribution(totals: DataFrame, by: str) -> DataFrame:
    """Share of keys up to each key's value (``cume``) and percent rank (``pct``)."""
    placed = _placed(totals, by).select(F.col(by).alias("_by"), ((F.col("_less") + F.col("_n")) / F.col("_all")).alias("cume"), _percent("_less", "_all").alias("pct"))
    return totals.join(placed, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def log_histogram(totals: DataFrame, by: str) -> DataFrame:
    """Bins of log10 to one decimal: keys per bin, greatest percent rank, and the next bin's."""
    ranked = _placed(totals.where(F.col(by) > 0), by).withColumn("pct", _percent("_less", "_all")).withColumn("log_bin", F.round(F.log10(by), 1))
    bins = ranked.groupBy("log_bin").agg(F.sum("_n").alias("keys"), F.max("pct").alias("cdf"))
    return bins.withColumn("next_cdf", F.coalesce(F.lead("cdf").over(W.orderBy("log_bin")), F.lit(1.0))).withColumn("bin_value", F.pow(F.lit(10.0), F.col("log_bin")))


def bucket_histogram(df: DataFrame, value: str, splits: Sequence[float]) -> DataFrame:
    """Rows per bucket [a, b); the last bucket is closed; values outside are left out."""
    bucket = F.lit(None).cast("int")
    for i, (a, b) in enumerate(zip(splits, splits[1:], strict=False)):
        inside = (F.col(value) >= a) & ((F.col(value) <= b) if i == len(splits) - 2 else (F.col(value) < b))
        bucket = F.when(inside, F.lit(i)).otherwise(bucket)
    return df.select(bucket.alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("rows"))


def volume_threshold(shares: DataFrame, levels: Sequence[float]) -> DataFrame:
    """Smallest rank whose running share reaches each level: one aggregate, no loop."""
    one = shares.agg(*(F.min(F.when(F.col("cum_share") >= x, F.col("rank"))).alias(f"l{i}") for i, x in enumerate(levels)))
    return one.select(F.explode(F.array(*(F.struct(F.lit(float(x)).alias("level"), F.col(f"l{i}").cast("long").alias("rank")) for i, x in enumerate(levels)))).alias("e")).select("e.*")


def flight_type(origin: str, destination: str, home: str) -> Column:
    """Both ends at home: domestic; one: international; none: out-of-pos."""
    a, b, h = F.col(origin), F.col(destination), F.col(home)
    return F.when((a == h) & (b == h), "domestic").when((a == h) | (b == h), "international").otherwise("out-of-pos")


def subset_summary(df: DataFrame, subsets: Mapping[str, Column], search: str) -> DataFrame:
    """Rows and distinct searches of several subsets in one pass, one row each."""
    aggs = [x for n, c in subsets.items() for x in (F.count(F.when(c, 1)).alias(f"{n}_r"), F.count_distinct(F.when(c, F.col(search))).alias(f"{n}_s"))]
    rows = F.array(*(F.struct(F.lit(n).alias("subset"), F.col(f"{n}_r").alias("solutions"), F.col(f"{n}_s").alias("searches")) for n in subsets))
    return df.agg(*aggs).select(F.explode(rows).alias("e")).select("e.*")


def search_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct column combinations, without rows that hold a null and with them: found once, by partial aggregation, and counted."""
    each = df.select(*columns).distinct()
    return each.agg(F.count(F.when(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)), 1)).alias("searches_non_null"), F.count("*").alias("searches"))


def correlations(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Every pair of columns (a before b as listed): Pearson correlation and number of rows that know both, all in one partial aggregate; null where either doesn't vary."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
        aggs += [F.covar_pop(x, y).alias(f"_c{i}"), F.stddev_pop(x).alias(f"_x{i}"), F.stddev_pop(y).alias(f"_y{i}"), F.count(x).alias(f"_n{i}")]
    spread = lambda i: F.col(f"_x{i}") * F.col(f"_y{i}")
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when(spread(i) > 0, F.col(f"_c{i}") / spread(i)).alias("corr"), F.col(f"_n{i}").alias("n")) for i, (a, b) in enumerate(pairs)]
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*rows)).alias("e")).select(*keys, "e.*")


def matrix(pairs: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Correlations as a matrix: one row per column, one column per column; 1 on the diagonal where a column varies with any other."""
    both = pairs.select(*keys, "a", "b", "corr").unionByName(pairs.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), "corr"))
    known = both.where("corr is not null").select(*keys, "a", F.col("a").alias("b"), F.lit(1.0).alias("corr")).distinct()
    return both.unionByName(known).groupBy(*keys, F.col("a").alias("column")).pivot("b", list(columns)).agg(F.max("corr"))
