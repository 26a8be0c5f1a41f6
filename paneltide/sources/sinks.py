"""Writers: idempotent partitions, capped files, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_days(df: DataFrame, path: str, day_col: str, by_day: bool = True) -> None:
    """Replaces exactly the days present in ``df``; writing a day twice leaves it once. A day's rows meet before the write, hot days split by AQE."""
    rows = df.hint("rebalance", day_col) if by_day else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)


def write_capped_csv(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    """CSV with header, at most ``rows_per_file`` rows a file, without counting first."""
    df.write.mode("overwrite").option("header", "true").option("maxRecordsPerFile", rows_per_file).csv(path)


def write_hours(df: DataFrame, path: str, ts: str) -> None:
    """Year, month, day and hour partitions of a time stamp; writing an hour twice leaves it once."""
    t = F.col(ts)
    parts = {"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)}
    rows = df.withColumns(parts).hint("rebalance", *parts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Adds rows to a table; a batch that may run twice belongs into ``write_days``."""
    df.write.mode("append").parquet(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """A small frame as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", str(header).lower()).csv(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A small aggregated frame as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
