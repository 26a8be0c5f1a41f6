"""Sketches per key and day that merge over days: quantiles (KLL), distinct counts (HLL), moments.

A day's rows are read once; a span of days, or a coarser key, is merged from the stored sketches alone. A quantile's
rank is off by about 2.3 / k ** 0.9 at most (99 %; 0.0047 at k = 1000), whatever was merged; a group of fewer
values than k is exact, without interpolation. A distinct count is off by 1.04 / 2 ** (lg_k / 2) as a standard
deviation (0.016 at lg_k = 12), up to some hundred values hardly at all. Null values and null columns add nothing; a
group without any has null quantiles and 0 distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import ranks
from .restrict import keep_below


def rank_error(k: int) -> float:
    """Bound of the rank error of a quantile of a sketch of size ``k`` (99 %)."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


def sketch(df: DataFrame, keys: Sequence[str], values: Sequence[str] = (), distinct: Mapping[str, Column] | Sequence[str] = (), k: int = 1000, lg_k: int = 12, deal: int = 0) -> DataFrame:
    """One row per key (a day among them): ``rows``; per value its number, mean, squared deviations, extremes and KLL sketch; per distinct column its HLL sketch. One aggregate with partial sketches, so a hot key is not gathered.

    With many keys, every task that reads rows would hand on a sketch of every key. ``deal`` first deals a key's rows to
    that many tasks at most, so that a key has that many partial sketches however many rows there are.
    """
    kinds = dict(df.dtypes)
    plain = ("int", "bigint", "string", "binary")  # others are counted by their text
    named = dict(distinct) if isinstance(distinct, Mapping) else {c: F.col(c) if kinds[c] in plain else F.col(c).cast("string") for c in distinct}
    aggs = [F.count("*").alias("rows")]
    for v in values:
        x = F.col(v).cast("double")
        aggs += [F.count(x).alias(f"{v}_n"), F.avg(x).alias(f"{v}_mean"), (F.var_pop(x) * F.count(x)).alias(f"{v}_m2"), F.min(x).alias(f"{v}_least"), F.max(x).alias(f"{v}_most"), F.kll_sketch_agg_double(x, F.lit(k)).alias(f"{v}_kll")]
    aggs += [F.hll_sketch_agg(c, F.lit(lg_k)).alias(f"{n}_hll") for n, c in named.items()]
    if deal:
        needed = df.select(*keys, *values, *(c.alias(f"_d{i}") for i, c in enumerate(named.values())))
        aggs[len(aggs) - len(named) :] = [F.hll_sketch_agg(f"_d{i}", F.lit(lg_k)).alias(f"{n}_hll") for i, n in enumerate(named)]
        df = needed.withColumn("_to", F.pmod(F.monotonically_increasing_id(), F.lit(deal))).repartition(*keys, "_to").drop("_to")
    return df.groupBy(*keys).agg(*aggs)


def merge(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys: of a span of days, if ``keys`` has no day. The result can be merged again."""
    columns = sketches.columns
    aggs = [F.sum("rows").alias("rows")]
    for v in [c.removesuffix("_kll") for c in columns if c.endswith("_kll")]:
        n, mean, m2 = F.col(f"{v}_n"), F.col(f"{v}_mean"), F.col(f"{v}_m2")
        whole = F.try_divide(F.sum(n * mean), F.sum(n))
        aggs += [F.sum(n).alias(f"{v}_n"), whole.alias(f"{v}_mean")]
        # within the parts, and between their means
        between = F.try_divide(F.sum(n * mean * mean), F.sum(n)) - whole * whole
        aggs += [(F.sum(m2) + F.sum(n) * F.greatest(between, F.lit(0.0))).alias(f"{v}_m2"), F.min(f"{v}_least").alias(f"{v}_least"), F.max(f"{v}_most").alias(f"{v}_most"), F.kll_merge_agg_double(f"{v}_kll").alias(f"{v}_kll")]
    aggs += [F.hll_union_agg(c).alias(c) for c in columns if c.endswith("_hll")]
    return sketches.groupBy(*keys).agg(*aggs)


def quantile(value: str, q: float) -> Column:
    """Quantile of a sketched value: one that occurred; null where there are none."""
    return F.when(F.col(f"{value}_n") > 0, F.kll_sketch_get_quantile_double(f"{value}_kll", F.lit(q)))


def distinct_count(name: str) -> Column:
    return F.hll_sketch_estimate(f"{name}_hll")


def statistics(sketches: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and quantiles of a value per key, from sketches alone."""
    n = F.col(f"{value}_n")
    std = F.when(n > 1, F.sqrt(F.col(f"{value}_m2") / (n - 1)))
    picked = [quantile(value, q).alias(name) for name, q in (quantiles or {"median": 0.5}).items()]
    return sketches.select(*keys, n.alias("n"), F.col(f"{value}_mean").alias("mean"), std.alias("std"), F.col(f"{value}_least").alias("least"), F.col(f"{value}_most").alias("most"), *picked)


def exact_median(df: DataFrame, sketches: DataFrame, keys: Sequence[str], value: str, error: float) -> DataFrame:
    """Per key the lower median ``_middle`` of ``df``'s values, exactly; ``sketches`` are those of the same rows.

    Sketches bracket it by ``error`` in rank on both sides. Values below a bracket are counted, those in it placed over range
    partitions, and the one in the middle is picked. A key whose median lies outside its bracket gets all values for one.
    """
    low, high, x = quantile(value, max(0.0, 0.5 - error)), quantile(value, min(1.0, 0.5 + error)), F.col(value)
    guess = merge(sketches, keys).where(F.col(f"{value}_n") > 0).select(*keys, low.alias("_lo"), high.alias("_hi"))
    known = df.select(*keys, value).where(x.isNotNull())
    place = F.floor((F.col("_all") - 1) / 2)
    counted = known.join(guess, list(keys)).groupBy(*keys).agg(F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.count("*").alias("_all"), F.count_if(x < F.col("_lo")).alias("_below"), F.count_if(x <= F.col("_hi")).alias("_up_to"))
    missed = (place < F.col("_below")) | (place >= F.col("_up_to"))
    brackets = ranks.kept(counted.select(*keys, *(F.when(~missed, F.col(c)).alias(c) for c in ("_lo", "_hi")), F.when(missed, 0).otherwise(F.col("_below")).alias("_below"), place.alias("_place")))  # a row a key
    inside = known.join(brackets, list(keys)).where(F.col("_lo").isNull() | x.between(F.col("_lo"), F.col("_hi")))
    spots = ranks.placed(inside.select(*keys, value), value, keys).join(brackets, list(keys))
    here = F.col("_place") - F.col("_below")
    return spots.where((F.col("less") <= here) & (here < F.col("less") + F.col("n"))).select(*keys, x.alias("_middle"))


def ratio_to_median(df: DataFrame, sketches: DataFrame, keys: Sequence[str], value: str, most: float, counts: str | None = None, least_count: int = 0, error: float | None = None) -> DataFrame:
    """Rows under ``most`` times their key's median, which is read off sketches (of any span, say the last month's); keys without one drop out. With ``least_count``, a row over it goes only if it was counted fewer times.

    With ``error`` (in rank) the sketches are of the rows themselves, and the exact (lower) median is picked within it.
    """
    middle = merge(sketches, keys).select(*keys, quantile(value, 0.5).alias("_middle")) if error is None else exact_median(df, sketches, keys, value, error)
    joined = df.join(middle, list(keys)).withColumn("ratio", F.try_divide(F.col(value), F.col("_middle"))).drop("_middle")
    return keep_below(joined, most, counts, least_count)


def rank_bounds(df: DataFrame, estimates: DataFrame, keys: Sequence[str], value: str, estimate: str) -> DataFrame:
    """Per key how exact an estimated quantile is: shares of the values below it (``strict``) and up to it (``weak``)."""
    joined = df.join(estimates.select(*keys, F.col(estimate).alias("_e")), list(keys)) if keys else df.crossJoin(F.broadcast(estimates.select(F.col(estimate).alias("_e"))))  # one row
    known = joined.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.avg((F.col(value) < F.col("_e")).cast("double")).alias("strict"), F.avg((F.col(value) <= F.col("_e")).cast("double")).alias("weak"))
