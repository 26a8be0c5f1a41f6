"""Ranks and running totals over range partitions: rows are dealt by their order, each partition counts for itself, and what came before a partition is added. No window gathers all rows, or a hot key, in one task."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources import readers

#: kind -> (aggregate of rows, aggregate of those, two of them joined as columns, as Python values)
KINDS: dict[str, tuple[Callable, Callable, Callable, Callable]] = {
    "count": (F.count, F.sum, lambda a, b: a + b, lambda a, b: a + b),
    "sum": (F.sum, F.sum, lambda a, b: a + b, lambda a, b: a + b),
    "xor": (F.bit_xor, F.bit_xor, lambda a, b: a.bitwiseXOR(b), lambda a, b: a ^ b),
    "min": (F.min, F.min, F.least, min),
    "max": (F.max, F.max, F.greatest, max),
}


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder as Parquet, for those who read it several times: whoever reads it scans his columns only."""
    path = f"{readers.scratch_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` in range partitions by ``order``, sorted in each, with the partition's number ``_part``; kept in the shared folder, so that the borders are the same for whoever reads it."""
    readers.scratch_folder(df.sparkSession)
    return df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint().withColumn("_part", F.spark_partition_id())


def numbered(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``ranged`` for those who sort for themselves: rows with their partition's number are kept as Parquet, unsorted and in fewer bytes, and are read in any layout."""
    return kept(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def _both(join: Callable, a: Column, b: Column) -> Column:
    return F.coalesce(join(a, b), a, b)


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)), F.col("_part") == F.col("_at"))


def before_parts(df: DataFrame, keys: Sequence[str], totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per partition, and key that began in an earlier one (one a partition at most): totals of the earlier partitions. ``df``: from ``ranged`` or ``numbered``, by the keys first."""
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    parts = df.groupBy(F.col("_part").alias("_at"), *named).agg(*(KINDS[kind][0](c).alias(f"_b_{n}") for n, (kind, c) in totals.items()))
    if keys:
        earlier = W.partitionBy(*(f"_key{i}" for i in range(len(keys)))).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
        out = parts.withColumn("_first", F.min("_at").over(earlier)).withColumns({f"_b_{n}": KINDS[kind][1](f"_b_{n}").over(earlier) for n, (kind, _) in totals.items()})
        return out.where("_first is not null").drop("_first")
    rows, so_far = [], dict.fromkeys(totals)
    for r in sorted(parts.collect(), key=lambda r: r["_at"]):  # a row a partition
        rows.append((r["_at"], *so_far.values()))
        for n, (kind, _) in totals.items():
            a, b = so_far[n], r[f"_b_{n}"]
            so_far[n] = b if a is None else a if b is None else KINDS[kind][3](a, b)
    return df.sparkSession.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in parts.dtypes))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Per row the totals (name -> kind of ``KINDS`` and column) of its key's rows up to it, in the order of ``order``.

    The order should be total: rows that it doesn't tell apart are put in any order. Null keys are a key.
    """
    rows = numbered(df, [*keys, *order])
    w = W.partitionBy("_part", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    own = rows.withColumns({n: KINDS[kind][0](c).over(w) for n, (kind, c) in totals.items()})
    joined = own.join(F.broadcast(before_parts(rows, keys, totals)), _same(keys), "left")  # a row a partition
    out = joined.withColumns({n: _both(KINDS[kind][2], F.col(n), F.col(f"_b_{n}")) for n, (kind, _) in totals.items()})
    return out.select(*df.columns, *totals)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Per row the value of the row before it of its key; null for a key's first. A partition's first row takes it from the last partition that holds its key."""
    rows = numbered(df, [*keys, *order])
    w = W.partitionBy("_part", *keys).orderBy(*order)
    own = rows.withColumn(name, F.lag(value).over(w)).withColumn("_opens", F.row_number().over(w) == 1)
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    lasts = rows.groupBy(F.col("_part").alias("_at"), *named).agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last"))
    before = W.partitionBy(*(f"_key{i}" for i in range(len(keys)))).orderBy("_at")
    carried = lasts.withColumn("_carried", F.lag("_last").over(before)).where("_carried is not null").drop("_last")
    out = own.join(F.broadcast(carried), _same(keys), "left")  # a row a partition
    return out.withColumn(name, F.when(F.col("_opens"), F.col("_carried.v")).otherwise(F.col(name))).select(*df.columns, name)


def row_numbers(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """Row numbers from 1, over the whole table or per key."""
    return running(df.withColumn("_one", F.lit(1)), keys, order, {name: ("count", "_one")}).drop("_one")


def placed(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values (per key) that aren't null, with the rows that hold them (``n``), hold less (``less``), and all (``total``)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    up_to = running(counts, keys, [value], {"up_to": ("sum", "n")}).withColumn("less", F.col("up_to") - F.col("n")).drop("up_to")
    if not keys:
        return up_to.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))  # one row
    whole = counts.groupBy(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys))).agg(F.sum("n").alias("total"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)))
    return up_to.join(whole, same).drop(*(f"_key{i}" for i in range(len(keys))))


def quantiles(df: DataFrame, value: str, probabilities: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (name -> probability) with interpolation, per key: the values at the wanted places are picked from ``placed``, so no task holds a key's values. Keys without values are left out; without keys there is one row at any rate."""
    spots = placed(df, value, keys)
    at = lambda place: F.max(F.when((F.col("less") <= place) & (place < F.col("less") + F.col("n")), F.col(value).cast("double")))
    aggs, picks = [F.max("total").alias("_total")], []
    for i, (name, q) in enumerate(probabilities.items()):
        place = F.lit(float(q)) * (F.col("total") - 1)
        aggs += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
        share = F.lit(float(q)) * (F.col("_total") - 1)
        picks.append((F.col(f"_lo{i}") + (share - F.floor(share)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name))
    return spots.groupBy(*keys).agg(*aggs).select(*keys, *picks)


def with_quantiles(groups: DataFrame, df: DataFrame, value: str, probabilities: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """``groups`` (a row per key) with quantiles of ``df`` beside it; null for keys without values."""
    found = quantiles(df, value, probabilities, keys)
    if not keys:
        return groups.crossJoin(F.broadcast(found))  # one row
    named = [f"_key{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)))
    return groups.join(found.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), *probabilities), same, "left").drop(*named)


def _places(df: DataFrame, cuts: DataFrame, keys: Sequence[str], levels: int) -> DataFrame:
    """``df`` with its key's ``_group`` and the place ``_at`` of ``_value`` among the key's cuts, by binary search: 2i + 1 on cut i, 2i before it; null without a value or group."""
    named = [f"_key{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)), F.lit(True))
    joined = df.join(cuts.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), "_group", "_cuts"), same, "left").drop(*named)
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(levels)))).cast("array<int>")
    less = lambda at, step: F.when(F.get("_cuts", at + step - 1) < F.col("_value"), at + step).otherwise(at)
    place = F.aggregate(steps, F.lit(0), less, lambda at: 2 * at + F.coalesce(F.get("_cuts", at) == F.col("_value"), F.lit(False)).cast("int"))
    return joined.withColumn("_at", F.when(F.col("_value").isNotNull() & F.col("_cuts").isNotNull(), place)).drop("_cuts")


def score_against(df: DataFrame, value: str, sample: DataFrame, sample_value: str, keys: Sequence[str] = (), share: float = 0.001, every: int = 20) -> DataFrame:
    """``df`` with the percentile of each row's value among the sample (of its key): share of the sample below it (``strict``), up to it (``weak``), and their mean (``score``), times 100.

    A key's values are cut where every ``every``-th lies of a ``share`` of both samples' rows, as a range partitioner would; all rows are counted, so results don't depend on the
    cuts. Rows on a cut, such as those of a common value, are placed by the counts between cuts; the others are sorted between two cuts, for which they are shuffled once, without
    their keys. A null value, or a key that the sample lacks, has no score. Both samples are read several times, so they should be kept.
    """
    own = df.withColumn("_value", F.col(value).cast("double"))
    points = sample.select(*keys, F.col(sample_value).cast("double").alias("_value")).where("_value is not null")
    drawn = own.select(*keys, "_value").where("_value is not null").unionByName(points).sample(share, seed=1)
    named = [f"_key{i}" for i in range(len(keys))]
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)), F.lit(True))
    cuts = drawn.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True))).agg(F.sort_array(F.collect_list("_value")).alias("_drawn"))
    cuts = cuts.withColumn("_cuts", F.array_distinct(F.filter("_drawn", lambda _, i: (i + 1) % every == 0)))
    groups = points.groupBy(*keys).agg(F.count("*").alias("_all")).join(cuts, same, "left")
    groups = kept(groups.select(*keys, "_all", F.coalesce("_cuts", F.array().cast("array<double>")).alias("_cuts"), F.monotonically_increasing_id().alias("_group")))
    levels = (groups.agg(F.max(F.size("_cuts"))).first()[0] or 0).bit_length()
    own, points = _places(own, groups, keys, levels), _places(points, groups, keys, levels).select("_group", "_at", "_value")
    # per place between or on cuts: the sample's rows before it and in it
    each = groups.select("_group", "_all", F.explode(F.sequence(F.lit(0), 2 * F.size("_cuts"))).alias("_at"))
    counts = each.join(points.groupBy("_group", "_at").agg(F.count("*").alias("_in")), ["_group", "_at"], "left").fillna(0, ["_in"])
    before = W.partitionBy("_group").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    places = kept(counts.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0))))

    percent = lambda c: F.try_divide(100 * c, F.col("_all"))
    scored = lambda rows, n, up_to: rows.withColumns({"strict": percent(up_to - n), "weak": percent(up_to), "score": percent(up_to - n / 2)}).select(*df.columns, "strict", "weak", "score")
    still = own.where("_at is null or _at % 2 = 1").join(places, ["_group", "_at"], "left")
    same_value = dict(df.dtypes)[value] == "double"  # the value isn't carried twice
    carried = [c for c in df.columns if c not in keys and not (same_value and c == value)]
    moved = own.where("_at % 2 = 0").select("_group", "_at", "_value", F.lit(0).alias("_n"), *carried)
    moved = moved.unionByName(points.where("_at % 2 = 0").select("_group", "_at", "_value", F.lit(1).alias("_n")), allowMissingColumns=True)
    stretch = W.partitionBy("_group", "_at")  # equal values' rows of the sample come last: what is summed up to a row of df is less; both sums read one sort
    moved = moved.withColumn("_less", F.sum("_n").over(stretch.orderBy("_value", "_n"))).withColumn("_up_to", F.sum("_n").over(stretch.orderBy("_value"))).where("_n = 0").join(places, ["_group", "_at"]).join(groups.select("_group", *keys), "_group")
    if value not in [*keys, *carried]:
        moved = moved.withColumn(value, F.col("_value"))
    return scored(still, F.col("_in"), F.col("_before") + F.col("_in")).unionByName(scored(moved, F.col("_up_to") - F.col("_less"), F.col("_before") + F.col("_up_to")))
