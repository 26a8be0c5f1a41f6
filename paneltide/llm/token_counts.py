"""Exact histogram of encoded lengths with suffix sums (operator 7).

Documents are aggregated by encoded length; running and suffix sums over the distinct lengths answer
totals, quantiles and truncated totals for every context limit without the documents. Sums run in two
levels (blocks of lengths, then within a block), so no task holds all distinct lengths. Blocks widen with the
length (a step of a logarithm), as long documents differ in length more than short ones do.

Defined results: a null or empty text has length 0; very long texts are encoded whole; rows of equal length are one
row of the histogram; repeated rows count each; other columns, whatever their names, are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .bpe import encoder
from .common import cut, pieces


def encoded_lengths(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """One row per document: length (number of ids)."""
    with open(tokenizer_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value)
        for _, texts in pieces(batches, "text", 1_000_000):
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe.encode(t)) // 4 for t in texts], pa.int64())], ["length"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "length long")


def length_histogram(lengths: DataFrame, steps: int = 64) -> DataFrame:
    """Per distinct length, taken as a context limit:

    n_docs and n_tokens at that length; docs_within and tokens_within it; docs_over and tokens_over it;
    truncated_tokens (every document cut to the limit); cum_share (the quantile that the limit is).
    ``steps``: blocks of lengths per factor of e.
    """
    h = cut(lengths.groupBy("length").agg(F.count("*").alias("n_docs"))).withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.log1p("length") * steps))
    every = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    blocks = (
        h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
        .select("block", *(F.coalesce(F.sum(c).over(every), F.lit(0)).alias(f"{c}_before") for c in "dt"), *(F.sum(c).over(whole).alias(f"{c}_all") for c in "dt"))
    )
    inside = W.partitionBy("block").orderBy("length").rowsBetween(W.unboundedPreceding, 0)
    return (
        h.join(blocks, "block")
        .withColumn("docs_within", F.col("d_before") + F.sum("n_docs").over(inside))
        .withColumn("tokens_within", F.col("t_before") + F.sum("n_tokens").over(inside))
        .select(
            "length", "n_docs", "n_tokens", "docs_within", "tokens_within",
            (F.col("d_all") - F.col("docs_within")).alias("docs_over"),
            (F.col("t_all") - F.col("tokens_within")).alias("tokens_over"),
            (F.col("tokens_within") + F.col("length") * (F.col("d_all") - F.col("docs_within"))).alias("truncated_tokens"),
            (F.col("docs_within") / F.col("d_all")).alias("cum_share"),
        )
    )


def quantile(histogram: DataFrame, q: float) -> int | None:
    """The least length that at least a share ``q`` of documents doesn't exceed."""
    row = histogram.where(F.col("cum_share") >= q).agg(F.min("length")).first()
    return row[0]


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens kept when every document is cut to ``limit``, for any limit: read off the suffix sums of one row."""
    below = histogram.where(F.col("length") <= limit).select("length", "tokens_within", "docs_over")
    row = below.agg(F.max_by(F.struct("tokens_within", "docs_over"), "length").alias("r")).first()["r"]
    if row is not None:
        return row["tokens_within"] + limit * row["docs_over"]
    row = histogram.agg(F.max(F.col("docs_within") + F.col("docs_over"))).first()  # every document is longer
    return limit * (row[0] or 0)
