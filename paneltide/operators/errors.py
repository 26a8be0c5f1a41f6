"""Errors of predictions and estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from . import ranks


def with_errors(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    err = F.col(predicted) - F.col(actual)
    return df.withColumn("err", err).withColumn("abs_err", F.abs(err)).withColumn("abs_pct_err", F.try_divide(100 * F.abs(err), F.col(actual)))


def error_stats(df: DataFrame, keys: Sequence[str] = (), market: str | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, deviation, extremes and median of the percentage error; the median is exact by selection over range partitions, or approximate."""
    x = F.col("abs_pct_err")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mape"), F.stddev(x).alias("std"), F.min(x).alias("least"), F.max(x).alias("most")]
    distinct = [F.count_distinct(market).alias("markets")] if market else []
    if approx:
        return df.groupBy(*keys).agg(*aggs, F.percentile_approx(x, F.lit(0.5), F.lit(100)).alias("median"), *distinct)
    rows = ranks.kept(df.select(*dict.fromkeys([*keys, *([market] if market else []), "abs_pct_err"])))
    out = ranks.with_quantiles(rows.groupBy(*keys).agg(*aggs, *distinct), rows, "abs_pct_err", {"median": 0.5}, keys)
    return out.select(*keys, "n", "mape", "std", "least", "most", "median", *(["markets"] if market else []))


def within(df: DataFrame, keys: Sequence[str], pct: float) -> DataFrame:
    """Share of rows whose error is at most ``pct`` percent."""
    return df.groupBy(*keys).agg(F.avg((F.col("abs_pct_err") <= pct).cast("double")).alias("share_within"), F.count("abs_pct_err").alias("n"))


def regression_metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """R2, MAE, median absolute error (exact, by selection over range partitions) and MAPE."""
    p, a = F.col(predicted), F.col(actual)
    rows = ranks.kept(df.select(p.alias(predicted), a.alias(actual), F.abs(p - a).alias("_off")))
    whole = rows.agg(
        (1 - F.try_divide(F.sum((p - a) ** 2), F.var_pop(a) * F.count(a))).alias("r2"), F.avg(F.abs(p - a)).alias("mae"), F.avg(F.try_divide(100 * F.abs(p - a), a)).alias("mape")
    )
    return ranks.with_quantiles(whole, rows, "_off", {"mdae": 0.5}).select("r2", "mae", "mdae", "mape")


def restriction_grid(df: DataFrame, ratios: Sequence[float], ranks: Sequence[int]) -> DataFrame:
    """Error statistics for every pair of a ratio and a rank limit: conditional aggregates over one scan."""
    cells = [(r, k) for r in ratios for k in ranks]
    ok = lambda r, k: (F.col("ratio") < r) & (F.col("volume_rank") <= k)
    aggs = [x for i, (r, k) in enumerate(cells) for x in (F.count(F.when(ok(r, k), F.col("abs_pct_err"))).alias(f"n{i}"), F.avg(F.when(ok(r, k), F.col("abs_pct_err"))).alias(f"m{i}"))]
    rows = F.array(*(F.struct(F.lit(float(r)).alias("ratio"), F.lit(k).alias("ranks"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mape")) for i, (r, k) in enumerate(cells)))
    return df.agg(*aggs).select(F.explode(rows).alias("e")).select("e.*")
