"""Readers: dated partitions, drifting versions, lists with comments, dimensions."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_days(spark: SparkSession, root: str, first: str, last: str, day_col: str = "day", merge_schema: bool = False, tolerant: bool = False) -> DataFrame:
    """Days ``first`` to ``last`` of a table partitioned by ``day_col``: a predicate on the partition column, so other days aren't listed or read."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower()).option("ignoreCorruptFiles", str(tolerant).lower()).option("ignoreMissingFiles", str(tolerant).lower())
    return reader.parquet(root).where(F.col(day_col).cast("string").between(first, last))


def read_hours(spark: SparkSession, root: str, day: str, first: int, last: int) -> DataFrame:
    """Hours ``first`` to ``last`` of a day of a table partitioned by year, month, day and hour: one read, pruned by predicates."""
    year, month, number = (int(x) for x in day.split("-"))
    at = (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == number)
    return spark.read.parquet(root).where(at & F.col("hour").between(first, last))


def read_glob(spark: SparkSession, pattern: str, recursive: bool = False) -> DataFrame:
    """Files that a path pattern matches, or all files below it."""
    return spark.read.option("recursiveFileLookup", str(recursive).lower()).parquet(pattern)


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or in local mode a temporary one."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="paneltide-scratch-"))
    return spark.sparkContext.getCheckpointDir()


def read_existing(spark: SparkSession, paths: Iterable[str]) -> DataFrame | None:
    """Union of the paths that exist; None if none does. Only a missing path is forgiven."""
    from pyspark.errors import AnalysisException

    found = []
    for p in paths:
        try:
            found.append(spark.read.parquet(p))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return union_versions(found, {}) if found else None


def union_versions(versions: Sequence[DataFrame], renames: Mapping[str, str], columns: Mapping[str, str] | None = None) -> DataFrame:
    """Layout versions under one schema: columns renamed (old -> new, coalesced where both exist), cast, unioned by name."""
    out = None
    for df in versions:
        for old, new in renames.items():
            if old in df.columns:
                df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old) if new in df.columns else df.withColumnRenamed(old, new)
        if columns:
            df = df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_list(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """One entry a line; blank lines and lines that start with # don't count."""
    lines = spark.read.text(path).select(F.trim("value").alias(name))
    return lines.where((F.col(name) != "") & ~F.col(name).startswith("#"))


def read_dim(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A CSV dimension, with or without header, by an explicit schema (no inference pass)."""
    return spark.read.option("header", str(header).lower()).schema(schema).csv(path)


def source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def bounds(df: DataFrame, column: str | Column) -> tuple:
    """Least and greatest value in one aggregate."""
    return tuple(df.agg(F.min(column), F.max(column)).first())


def point_lookup(df: DataFrame, columns: Sequence[str], **equal: object) -> DataFrame:
    """Drill-down to raw rows; equality predicates reach the scan. None asks for null."""
    for c, v in equal.items():
        df = df.where(F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
    return df.select(*columns)
