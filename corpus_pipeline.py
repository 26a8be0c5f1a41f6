"""A corpus pipeline of four stages, each over what its predecessor kept.

Language ID drops documents without letters and those that no learnt language explains, toxicity drops toxic
ones, the n-gram join keeps one document of each near-duplicate group, and packing lays the rest out in
windows.

Defined results: a null or empty text has no letters and goes with the first stage; a null id counts as the
least one for choosing which document of a group stays; of repeated rows one stays; very long texts are
handled whole; ties go as each operator says; columns beside those of ``documents``, whatever their names,
stay as they are up to packing; empty tables give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paneltide.llm import langid, ngram_join, packing, toxicity
from paneltide.llm.common import shared_folder, table
from paneltide.llm.queries import tokenizer_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("packing", packing_stage),
]

#: SQL can't express the parse, the classifier or the encoding; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder, read again, and removed once the next is written."""
    docs = table(spark, sf_dir, "documents")
    root = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    last = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs
