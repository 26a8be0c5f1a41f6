"""A daily loop that may be stopped anywhere: which days are done is a table of its own.

A run writes the days that it computed to a folder of its own, and then commits them with one small file in the
ledger, which appears as a whole or not at all. Readers take each day from its last committed run, so days of a run
that died before its commit are not seen, and a day that is run again is there once. Ledger rows carry how much
was read for the day, by which days that grew late, and holes, are found.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .readers import read_existing

LEDGER = "day string, run string, version long, rows long, source_rows long"


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def entries(self) -> DataFrame:
        """All commits: day, run, version, rows written, source rows read."""
        found = read_existing(self.spark, [f"{self.root}/ledger"])
        return self.spark.createDataFrame([], LEDGER) if found is None else found

    def done(self) -> DataFrame:
        """The last commit of each day."""
        last = F.max_by(F.struct("run", "version", "rows", "source_rows"), "version").alias("l")
        return self.entries().groupBy("day").agg(last).select("day", "l.*")

    def write(self, df: DataFrame, day_col: str, run: str) -> None:
        """Rows of any number of days as a run that nobody sees yet."""
        df.withColumn("day", F.col(day_col).cast("string")).hint("rebalance", "day").write.mode("errorifexists").partitionBy("day").parquet(f"{self.root}/runs/{run}")

    def commit(self, run: str, source: DataFrame) -> None:
        """Makes a run's days count. ``source`` (day, source_rows): the days that it covers, those without a row left among them."""
        version = (self.entries().agg(F.max("version")).first()[0] or 0) + 1
        written = self.spark.read.schema("day string").parquet(f"{self.root}/runs/{run}")  # the partition column; there may be no file
        rows = written.groupBy("day").agg(F.count("*").alias("rows"))
        made = source.select(F.col("day").cast("string").alias("day"), F.col("source_rows").cast("long").alias("source_rows")).join(rows, "day", "left")
        made = made.select("day", F.lit(run).alias("run"), F.lit(version).cast("long").alias("version"), F.coalesce("rows", F.lit(0)).alias("rows"), "source_rows")
        made.repartition(1).write.mode("append").parquet(f"{self.root}/ledger")  # a row a day

    def read(self, first: str, last: str, like: DataFrame | None = None) -> DataFrame:
        """Rows of finished days in a span: only the runs that hold them are listed, only those days read."""
        days = self.done().where(F.col("day").between(first, last) & (F.col("rows") > 0)).select("day", "run").collect()  # a row a day
        out = None
        for run in sorted({r["run"] for r in days}):
            part = self.spark.read.option("basePath", f"{self.root}/runs/{run}").parquet(*(f"{self.root}/runs/{run}/day={r['day']}" for r in days if r["run"] == run))
            part = part.withColumn("day", F.col("day").cast("string"))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        if out is None:
            if like is None:
                raise ValueError("no finished day in the span")
            return like.withColumn("day", F.lit("")).where("false")
        return out

    def open_days(self, source: DataFrame) -> DataFrame:
        """Days of ``source`` (day, source_rows) that aren't done, or that have more or fewer rows than when they were: late data."""
        done = self.done().select("day", F.col("source_rows").alias("_then"))
        return source.withColumn("day", F.col("day").cast("string")).join(done, "day", "left").where(~F.col("_then").eqNullSafe(F.col("source_rows"))).drop("_then")

    def holes(self, first: str, last: str) -> DataFrame:
        """Calendar days of a span that no run has covered."""
        days = self.spark.sql(f"SELECT CAST(day AS STRING) AS day FROM (SELECT explode(sequence(DATE'{first}', DATE'{last}')) AS day)")
        return days.join(self.done().select("day"), "day", "left_anti")


def run_open_days(ledger: Ledger, source: DataFrame, day_col: str, work: Callable[[DataFrame], DataFrame], days: Sequence[str] | None = None) -> str | None:
    """Computes and commits all open days of ``source`` in one run (or the listed ones among them); returns the run, None if there was nothing to do.

    ``work`` must keep ``day_col`` and compute each day from its own rows.
    """
    counted = source.groupBy(F.col(day_col).cast("string").alias("day")).agg(F.count("*").alias("source_rows")).where("day is not null")
    todo = ledger.open_days(counted if days is None else counted.where(F.col("day").isin(list(days))))
    todo = ledger.spark.createDataFrame(todo.collect(), "day string, source_rows long")  # a row a day
    if todo.isEmpty():
        return None
    run = uuid.uuid4().hex
    rows = source.join(F.broadcast(todo.select(F.col("day").alias("_day"))), F.col(day_col).cast("string") == F.col("_day"), "left_semi")  # a row a day
    ledger.write(work(rows), day_col, run)
    ledger.commit(run, todo)
    return run
