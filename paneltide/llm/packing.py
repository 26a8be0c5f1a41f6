"""Packing documents into windows by Karmarkar-Karp multiway differencing (operator 6).

Each row's ids (with the end id) are cut at multiples of the window; full pieces are windows of
their own, and the remainders of a group of rows are dealt to windows by differencing: the two partial
partitions with the largest imbalance are merged with opposing order until one is left. If its
fullest window exceeds the capacity, the number of windows rises and the group is dealt again.
Groups are hashed and of bounded expected size (``group_windows`` windows), so no task grows with the input.

Defined results: a null or empty text is the end id alone; very long texts are encoded whole and cut into
windows; a null id stays null; repeated rows are packed each on its own; other columns, whatever their names, are ignored;
ties in length keep the row order within a group; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import encoder
from .common import cut, pieces


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item: Karmarkar-Karp multiway differencing into ``windows`` near-equal sums."""
    n = len(sizes)
    if windows <= 1 or n == 0:
        return np.zeros(n, np.int64)
    left, right = [-1] * n, [-1] * n  # nodes 0..n-1 are items, later ones are unions of two
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    heap: list[tuple[int, int]] = []
    for i, s in enumerate(sizes):
        parts.append((np.array([s], np.int64), np.array([i], np.int64)))  # windows without an item aren't stored: memory follows the items
        heap.append((-int(s), i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sa, na), (sb, nb) = parts[a], parts[b]
        alone = max(0, windows - len(sb))  # a's fullest windows meet b's empty ones
        met = max(0, len(sa) - alone)
        sums = np.concatenate([sa, sb[: len(sb) - met]])
        nodes = np.concatenate([na, nb[: len(nb) - met]])
        if met:
            sums[alone : alone + met] += sb[::-1][:met]
            nodes[alone : alone + met] = np.arange(len(left), len(left) + met)
            left.extend(na[alone:].tolist())
            right.extend(nb[::-1][:met].tolist())
        if len(sums) == windows:
            sums -= sums.min()
        order = np.argsort(-sums, kind="stable")
        parts[a], parts[b] = (sums[order], nodes[order]), None
        heapq.heappush(heap, (-int(sums.max()), a))
    out = np.zeros(n, np.int64)
    for w, top in enumerate(parts[heap[0][1]][1].tolist()):
        stack = [top]
        while stack:
            x = stack.pop()
            if x < n:
                out[x] = w
            else:
                stack += [left[x], right[x]]
    return out


def deal(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item; the window count starts at the least possible and rises while any is over capacity."""
    sizes = np.asarray(sizes, np.int64)
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        out = differencing(sizes, windows)
        if not len(sizes) or np.bincount(out, sizes).max() <= capacity:
            return out
        # as many more as this imbalance calls for, one at least
        excess = np.bincount(out, sizes).max() - sizes.sum() / windows
        windows = max(windows + 1, int(sizes.sum() / max(capacity - excess, capacity / 2)))


def piece_table(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, pos (row number in its task), start, length, ids_crc32, doc_tokens."""
    with open(tokenizer_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary file
    end = int(end_id).to_bytes(4, "little")
    names = ["doc", "pos", "start", "length", "ids_crc32", "doc_tokens"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pos, step = encoder(shared.value, cache=500_000), 0, 4 * capacity
        for batch, texts in pieces(batches, "text", 2_000_000):
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode_all(texts), strict=True):
                ids += end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    out.append((doc, pos, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                pos += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 6, names)

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, group_windows: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    found = cut(piece_table(docs, tokenizer_path, capacity, end_id, id_col, text_col))
    total = found.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (group_windows * capacity)))
    grouped = found.withColumn("part", F.pmod(F.xxhash64("doc", "pos", "start", "ids_crc32"), F.lit(groups)))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "pos", "start"], kind="stable", ignore_index=True)
        full = pdf["length"].to_numpy() == capacity
        window = np.zeros(len(pdf), np.int64)
        window[~full] = deal(pdf.loc[~full, "length"].to_numpy(), capacity)
        used = int(window[~full].max()) + 1 if (~full).any() else 0
        window[full] = used + np.arange(full.sum())
        pdf["sequence_id"] = pdf["part"].to_numpy() * (1 << 32) + window
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf[["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    out = grouped.groupBy("part").applyInPandas(one, "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("doc", id_col)
