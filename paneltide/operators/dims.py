"""Dimension look-ups. Join strategy is left to Spark, which broadcasts a side by its size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def enrich(df: DataFrame, dim: DataFrame, key: str, dim_key: str, attributes: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Adds attributes of ``dim`` (column -> new name) by ``key``; the dimension counts once per key (least attributes)."""
    slim = dim.groupBy(F.col(dim_key).alias("_k")).agg(*(F.min(a).alias(n) for a, n in attributes.items()))
    return df.join(slim, df[key] == F.col("_k"), how).drop("_k")


def geo_enrich(df: DataFrame, dim: DataFrame, dim_key: str, attribute: str, origin: str, destination: str, home: str | None = None, how: str = "inner") -> DataFrame:
    """Attribute of both ends; with ``home``, only rows of which either end lies there."""
    out = enrich(df, dim, origin, dim_key, {attribute: f"{origin}_{attribute}"}, how)
    out = enrich(out, dim, destination, dim_key, {attribute: f"{destination}_{attribute}"}, how)
    return out if home is None else out.where((F.col(f"{origin}_{attribute}") == home) | (F.col(f"{destination}_{attribute}") == home))


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is listed (semi join)."""
    return df.join(keys.select(*on), list(on), "left_semi")
