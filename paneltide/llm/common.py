"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


#: What each operator keeps in a Python worker from task to task, and how to drop it.
kept: dict[str, Callable[[], None]] = {}


def take_turn(owner: str) -> None:
    """Drops what other operators left in this worker, so that a job of several doesn't add up their caches."""
    for name, drop in kept.items():
        if name != owner:
            drop()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset a temporary one is made, in local mode (tests) only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="paneltide-checkpoint-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


SALTS = 64


def salt(*columns: str) -> Column:
    """0 to ``SALTS`` - 1 by the hash of what tells rows of one key apart."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def salts_seen(name: str) -> Column:
    """Aggregate: the salts of a group's rows, as bits."""
    return F.bit_or(F.expr(f"shiftleft(1L, `{name}`)"))


def per_salt(df: DataFrame, seen: str, name: str) -> DataFrame:
    """A row per salt that ``seen`` holds."""
    return df.withColumn(name, F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> (shiftright(`{seen}`, i) & 1L) = 1L)"))).drop(seen)


def spread_join(left: DataFrame, right: DataFrame, on: list[str], apart: list[str], how: str = "left") -> DataFrame:
    """``left`` joined to ``right`` (one row per key), with the rows of a hot key dealt to ``SALTS`` tasks by the columns ``apart``."""
    salted = left.withColumn("_salt", salt(*apart))
    seen = salted.groupBy(*on).agg(salts_seen("_salt").alias("_seen"))
    return salted.join(per_salt(right.join(seen, on), "_seen", "_salt"), [*on, "_salt"], how).drop("_salt")


def crc_mod(column: str, modulus: int) -> str:
    """SQL text for crc32 of a column's decimal text, modulo ``modulus``; a null counts as empty text."""
    return f"crc32(cast(coalesce(cast({column} as string), '') as binary)) % {modulus}"


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of each batch that hold about ``max_bytes`` bytes of ``column`` at most (one row at least)."""
    for batch in batches:
        begin = size = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if i > begin and size + n > max_bytes:
                own = batch.slice(begin, i - begin)
                yield own, own.column(column).to_pylist()
                begin, size = i, 0
            size += n
        if begin < batch.num_rows:
            own = batch.slice(begin)
            yield own, own.column(column).to_pylist()
