"""End-to-end compositions that make a latest-value look-up."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import dims, lowest, restrict


@dataclass(frozen=True)
class LookupConfig:
    """Thresholds of a look-up; 0 or None switches a step off."""

    stale_after: int = 0
    ratio_mean: float | None = None
    ratio_median: float | None = None
    least_count: int = 0
    most_rsd: float | None = None
    top_markets: int | None = None
    home: str | None = None


def nightly_lookup(daily: DataFrame, today, config: LookupConfig, keys: Sequence[str] = ("market", "out_date", "stay")) -> DataFrame:
    """Staleness, volume, spread and ratio limits, then the latest row per key. One scan: steps without limits add nothing."""
    rows = restrict.fresh(daily, "shop_date", today, config.stale_after)
    if config.top_markets:
        rows = restrict.top_by_volume(rows, ["market"], "search_counts", config.top_markets)
    if config.most_rsd is not None:
        rows = restrict.low_spread(rows, ["market"], "min_value", config.most_rsd)
    for center in ("mean", "median"):
        if (most := getattr(config, f"ratio_{center}")) is not None:
            rows = restrict.ratio_filter(rows, ["market"], "min_value", most, center, "search_counts", config.least_count).drop("ratio")
    return lowest.latest_per_key(rows, keys, "shop_date", ["pos", "currency", "min_value"]).select("pos", "currency", "origin", "destination", "out_date", "stay", "shop_date", "min_value")


def summary_lookup(rows: DataFrame, dim: DataFrame, dim_key: str, attribute: str, config: LookupConfig, lead_range: tuple[int, int], stay_range: tuple[int, int]) -> DataFrame:
    """Rows that touch the home place on either end (kept if only one end is known), in range, then the latest per key."""
    near = dims.geo_enrich(rows, dim, dim_key, attribute, "origin", "destination", config.home, how="left")
    near = near.where(F.col("lead").between(*lead_range) & F.col("stay").between(*stay_range))
    if config.ratio_mean is not None:
        near = restrict.ratio_filter(near, ["market"], "min_value", config.ratio_mean).drop("ratio")
    return lowest.latest_per_key(near, ["market", "pos", "out_date", "stay"], "shop_date", ["currency", "min_value"]).select("market", "pos", "currency", "out_date", "stay", "shop_date", "min_value")
