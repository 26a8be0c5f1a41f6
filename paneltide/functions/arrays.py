"""Array columns: aligned unnesting, availability flags, run lengths, closeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def aligned_unnest(df: DataFrame, arrays: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per position at which every array has a non-null element: linear, unlike chained explodes."""
    zipped = F.arrays_zip(*arrays)
    rows = df.withColumn("_e", F.explode(zipped))
    rows = rows.select(*(c for c in df.columns if c not in arrays), *(F.col(f"_e.{a}").alias(n) for a, n in zip(arrays, names, strict=True)))
    return rows.dropna(subset=list(names))


def strip_count(c: Column) -> Column:
    """A type code without the number behind it: ADT1 is ADT."""
    return F.regexp_extract(c, r"^(.*?)[0-9]*$", 1)


def amounts_of_type(df: DataFrame, requested: str, answered: str, amounts: str, kind: str, require_request: bool = True) -> DataFrame:
    """One row per position at which ``kind`` was answered (and, unless ``require_request`` is off, asked for), with columns requested, answered, amount and whether both types differ."""
    rows = aligned_unnest(df, [requested, answered, amounts], ["requested", "answered", "amount"])
    asked = strip_count(F.col("requested"))
    rows = rows.where(F.col("answered") == kind)
    rows = rows.where(F.col("requested").startswith(kind)) if require_request else rows
    return rows.withColumn("differs", asked != F.col("answered"))


def only(arr: Column, value: str) -> Column:
    """Every element is ``value``; true for an empty array, null for a null one."""
    return F.size(F.array_remove(arr, value)) == 0


def any_of(arr: Column, value: str) -> Column:
    return F.array_contains(arr, value)


def share_members(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) > 0


def is_close(a: Column, b: Column, rtol: float = 0.01, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def run_stats(flags: Column, gap: int = 0) -> Column:
    """struct(num_gaps, avg_gap, max_gap) of the runs of ``gap`` in an array of small integers."""
    step = lambda acc, x: F.when(
        x == gap, F.struct((acc["run"] + 1).alias("run"), (acc["n"] + F.when(acc["run"] == 0, 1).otherwise(0)).alias("n"), (acc["total"] + 1).alias("total"), F.greatest(acc["top"], acc["run"] + 1).alias("top"))
    ).otherwise(F.struct(F.lit(0).alias("run"), acc["n"].alias("n"), acc["total"].alias("total"), acc["top"].alias("top")))
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("n"), F.lit(0).alias("total"), F.lit(0).alias("top"))
    done = lambda a: F.struct(a["n"].alias("num_gaps"), F.coalesce(F.try_divide(a["total"], a["n"]), F.lit(0.0)).alias("avg_gap"), a["top"].alias("max_gap"))
    return F.aggregate(flags, start, step, done)
