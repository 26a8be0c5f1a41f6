"""Classifying two-legged offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _missing(c: Column, none: object) -> Column:
    return c.isNull() if none is None else c.isNull() | (c == none)


def trip_type(out_org: str, out_dst: str, in_org: str, in_dst: str, none: object = None) -> Column:
    """'rt' where the return mirrors the way out, 'ow' where there is none, else 'other'. ``none`` also stands for missing."""
    a, b, c, d = (F.col(x) for x in (out_org, out_dst, in_org, in_dst))
    return F.when((a == d) & (b == c), "rt").when(_missing(c, none) & _missing(d, none), "ow").otherwise("other")


def classify_trip(df: DataFrame, out_org: str, out_dst: str, in_org: str, in_dst: str, none: object = None, flag: str = "round_trip") -> DataFrame:
    """Rows that are round trips (1) or one way (0); open jaws and the like are dropped."""
    kind = trip_type(out_org, out_dst, in_org, in_dst, none)
    return df.withColumn("_kind", kind).where("_kind <> 'other'").withColumn(flag, (F.col("_kind") == "rt").cast("int")).drop("_kind")
