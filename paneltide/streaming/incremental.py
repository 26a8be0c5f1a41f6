"""Structured Streaming: daily lowest values with late data, and an upserted latest-value table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lowest import latest_per_key


def daily_lowest(stream: DataFrame, ts: str, keys: Sequence[str], value: str, late: str = "1 day") -> DataFrame:
    """Rows and least value per key and day; a day is final once the watermark has passed it."""
    day = F.window(ts, "1 day")
    out = stream.withWatermark(ts, late).groupBy(day.alias("w"), *keys).agg(F.count("*").alias("observations"), F.min(value).alias("min_value"))
    return out.select(F.to_date("w.start").alias("day"), *keys, "observations", "min_value")


def trailing_mean(stream: DataFrame, ts: str, keys: Sequence[str], value: str, span: str = "7 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    """Sliding-window mean."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, span, step).alias("w"), *keys).agg(F.avg(value).alias("mean_value")).select(F.to_date("w.end").alias("day"), *keys, "mean_value")


def read_latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table that ``maintain_latest`` keeps: of each bucket its newest version (older than ``before``)."""
    rows = spark.read.parquet(path)
    rows = rows if before is None else rows.where(F.col("version") < before)
    newest = rows.groupBy(F.col("bucket").alias("_b")).agg(F.max("version").alias("_v"))
    return rows.join(newest, (F.col("bucket") == F.col("_b")) & (F.col("version") == F.col("_v"))).drop("_b", "_v", "version")


def maintain_latest(stream: DataFrame, path: str, keys: Sequence[str], order: str, checkpoint: str, buckets: int = 16, keep: int = 2) -> StreamingQuery:
    """Keeps the latest row per key in Parquet buckets of versions (``bucket=../version=epoch``).

    A batch rewrites the buckets that it touches only, from their newest version before it, so a batch that is
    run again changes nothing. Versions beyond the newest ``keep`` of a touched bucket are removed.
    """
    spark = stream.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(bucket: int) -> list[int]:
        own = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={bucket}")
        return sorted(int(s.getPath().getName().removeprefix("version=")) for s in files.listStatus(own) if s.getPath().getName().startswith("version=")) if files.exists(own) else []

    def upsert(batch: DataFrame, epoch: int) -> None:
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
        old = {b: max((v for v in versions(b) if v < epoch), default=None) for b in touched}
        paths = [f"{path}/bucket={b}/version={v}" for b, v in old.items() if v is not None]
        both = new.unionByName(spark.read.option("basePath", path).parquet(*paths).drop("version")) if paths else new
        out = latest_per_key(both, keys, order).withColumn("version", F.lit(epoch))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(path)
        for b in touched:
            for v in versions(b)[:-keep]:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={b}/version={v}"), True)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
