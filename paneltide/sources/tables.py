"""Tables of the session catalogue in buckets by key, and files as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lowest import latest_per_key


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """A catalogue table in ``buckets`` by key, sorted by key in each, one file a bucket; at ``path``, or in the warehouse."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def merged_latest(table: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row of the greatest ``order`` per key of a table (one row a key) and a batch (any number); of equal ones the batch's.

    Keys must not be null. A table in buckets by the keys is read as it lies: only the batch is shuffled.
    """
    new = latest_per_key(batch.select(*table.columns), keys, order, ties)
    mine, theirs = F.struct(*(F.col(f"_old.{c}").alias(c) for c in table.columns)), F.struct(*(F.col(f"_new.{c}").alias(c) for c in table.columns))
    same = [F.col(f"_old.{k}") == F.col(f"_new.{k}") for k in keys]
    newer = F.col(f"_old.{keys[0]}").isNull() | (F.col(f"_new.{keys[0]}").isNotNull() & (F.col(f"_old.{order}").isNull() | (F.col(f"_new.{order}") >= F.col(f"_old.{order}"))))
    return table.alias("_old").join(new.alias("_new"), same, "full_outer").select(F.when(newer, theirs).otherwise(mine).alias("r")).select("r.*")


def file_index(spark: SparkSession, root: str, pattern: str = "*.parquet", day_col: str = "day") -> DataFrame:
    """Files below ``root`` whose names match: path, day (of the partition ``day_col``, null outside one), bytes, modified. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    day = F.regexp_extract("path", rf"/{day_col}=([^/]*)/", 1)
    return files.select("path", F.when(day != "", day).alias("day"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def day_index(files: DataFrame) -> DataFrame:
    """Per day: files, bytes, and when the last was written."""
    return files.where("day is not null").groupBy("day").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))


def days_without_files(files: DataFrame, first: str, last: str, least_bytes: int = 1) -> DataFrame:
    """Calendar days of a span whose files hold fewer than ``least_bytes``."""
    days = files.sparkSession.sql(f"SELECT CAST(day AS STRING) AS day FROM (SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS day)")
    return days.join(day_index(files).where(F.col("bytes") >= least_bytes).select("day"), "day", "left_anti")


def read_files(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """Reads the chosen files (some of ``file_index``), with the partition columns below ``root``."""
    paths = sorted(r["path"] for r in files.select("path").collect())  # file names, as a scan lists them anyway
    return spark.read.option("basePath", root).parquet(*paths)
