"""Prefix trie of conversations (operator 13).

A node is a distinct sequence of first turns. Turns are numbered over range partitions, and each prefix is named by
128 bits: the running xor of hashes of (turn, place), so a long conversation is spread over tasks. Rows of one
prefix are aggregated to its node; what a node sums over its subtree is found in shards.

Nodes of more than ``heavy`` conversations (the square root of their number) are the upper levels. Below them
every subtree is small, and is a shard: numpy lays its nodes out in level order as a LOUDS bit vector (a one per
child and a zero per node) beside arrays of labels, and sums run from the last level to the first by ``add.at`` on
the parents that the bits give. The upper levels take the sums of the shards under each of their nodes, and are
rolled up by themselves in one task: at most the root of the number of conversations on each level.

The ids that end at a node are joined to texts in order by range partitions; one task a node hashes these texts.

Defined results: null roles and texts are empty; rows without a conversation id are left out; a null turn comes
first, equal turns go by the digest of role and text, and repeated rows are turns each; very long texts and
conversations are handled whole; a conversation without turns ends at the root; other columns, whatever their
names, are ignored; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ranks import ranged, row_numbers, running
from .common import crc_mod, cut, spread_join

EMPTY = hashlib.sha256(b"").hexdigest()


class Louds:
    """A forest in level order: after a run for the roots, each node's children as a run of ones ended by a zero."""

    def __init__(self, parent: np.ndarray, level: np.ndarray) -> None:
        """``parent``: index of each node's parent, -1 for roots; ``level``: 0 for roots."""
        place = np.empty(len(parent), np.int64)  # in level order
        order, self.starts = [], [0]
        for nodes in np.split(np.argsort(level, kind="stable"), np.cumsum(np.bincount(level))[:-1]) if len(level) else []:
            if self.starts[-1]:
                nodes = nodes[np.argsort(place[parent[nodes]], kind="stable")]
            place[nodes] = self.starts[-1] + np.arange(len(nodes))
            order.append(nodes)
            self.starts.append(self.starts[-1] + len(nodes))
        self.order = np.concatenate(order) if order else np.empty(0, np.int64)
        degrees = np.bincount(np.where(parent < 0, 0, place[parent] + 1), minlength=len(parent) + 1)
        ones = np.arange(len(parent)) + np.repeat(np.arange(len(parent) + 1), degrees)
        bits = np.zeros(2 * len(parent) + 1, np.uint8)
        bits[ones] = 1
        self.bits, self.size = np.packbits(bits), len(bits)

    def parents(self) -> np.ndarray:
        """By select and rank: the zeros before the one of a node end the runs of the nodes before its parent."""
        ones = np.flatnonzero(np.unpackbits(self.bits, count=self.size))
        return ones - np.arange(len(ones)) - 1

    def degrees(self) -> np.ndarray:
        ends = np.flatnonzero(np.unpackbits(self.bits, count=self.size) == 0)
        return np.diff(ends) - 1

    def rolled_up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees of values in level order."""
        out, parents = values.copy(), self.parents()
        for a, b in reversed([*zip(self.starts[1:], self.starts[2:], strict=False)]):
            np.add.at(out, parents[a:b], out[a:b])
        return out


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all conversation ids, turns of rebuilt conversations: conv_id, pos from 0, label, size).

    A rebuilt conversation begins with the first h turns of that of the next lower hundred (h by its crc32), then
    has its own after its first h.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    label = F.unhex(F.md5(F.concat(F.octet_length(role), F.lit(":"), role, text)))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), label.alias("label"), F.length(text).cast("long").alias("size"))
    numbered = cut(row_numbers(turns, ["turn", "label"], ["conv_id"], "pos").select("conv_id", (F.col("pos") - 1).alias("pos"), "label", "size"))
    taken = F.expr(crc_mod("conv_id", 6)).cast("long")
    convs = cut(numbered.groupBy("conv_id").agg((F.max("pos") + 1).alias("n")).withColumn("h", taken).withColumn("head", F.col("conv_id") - F.col("conv_id") % 100))
    first = numbered.where("conv_id % 100 = 0 and pos < 6").select(F.col("conv_id").alias("head"), "pos", "label", "size")
    front = convs.join(first, "head").where("pos < h").select("conv_id", "pos", "label", "size")
    lengths = convs.where("conv_id % 100 = 0").select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    short = convs.join(lengths, "head", "left").select("conv_id", (F.col("h") - F.least("h", F.coalesce("head_n", F.lit(0)))).alias("shift")).where("shift > 0")
    own = spread_join(numbered.where(F.col("pos") >= taken), short, ["conv_id"], ["pos"])
    own = own.select("conv_id", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("pos"), "label", "size")
    return convs.select("conv_id"), front.unionByName(own)


_ROLLED = "ka long, kb long, pa long, pb long, depth long, n_convs long, conv_id long, parent_conv_id long, n_children long, n_leaves long, saved_tokens long, at_top boolean"


def _roll_up(rows: DataFrame, chunk: int = 50_000) -> DataFrame:
    """Sums over the subtrees of each shard (sa, sb), rows sorted by shard and depth; ``x_children``, ``x_leaves`` and ``x_saved`` are what hangs below a node outside it, ``up`` the conversation of the shard's parent."""

    def trie(pdf: pd.DataFrame) -> pa.RecordBatch:
        key, above = (pd.MultiIndex.from_arrays([pdf[a].to_numpy(), pdf[b].to_numpy()]) for a, b in (("ka", "kb"), ("pa", "pb")))
        parent = key.get_indexer(above)
        parent[pdf["depth"].to_numpy() == 0] = -1
        level = (pdf["depth"] - pdf.groupby(["sa", "sb"])["depth"].transform("min")).to_numpy()
        louds = Louds(parent, level)
        p = pdf.iloc[louds.order]
        degree, top = louds.degrees(), louds.parents()
        children = degree + p["x_children"].to_numpy()
        leaves = louds.rolled_up(np.where(children == 0, 1, p["x_leaves"].to_numpy()))
        saved = louds.rolled_up((p["n_convs"].to_numpy() - 1) * p["size"].to_numpy() + p["x_saved"].to_numpy())
        conv, at_top = p["conv_id"].to_numpy(), top < 0
        of_parent = pa.array(np.where(at_top, p["up"].to_numpy(), conv[np.maximum(top, 0)]), pa.int64(), mask=at_top & ~p["has_up"].to_numpy())
        names = ("ka", "kb", "pa", "pb", "depth", "n_convs", "conv_id")
        return pa.RecordBatch.from_arrays([*(pa.array(p[c].to_numpy(), pa.int64()) for c in names), of_parent, pa.array(children), pa.array(leaves), pa.array(saved), pa.array(at_top)], [c.split()[0] for c in _ROLLED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            held.append(batch.to_pandas())
            rows += batch.num_rows
            if rows >= chunk:  # whole shards so far
                whole = pd.concat(held, ignore_index=True)
                last = (whole["sa"] == whole["sa"].iloc[-1]) & (whole["sb"] == whole["sb"].iloc[-1])
                if not last.all():
                    yield trie(whole[~last].reset_index(drop=True))
                held = [whole[last]]
                rows = int(last.sum())
        if rows:
            yield trie(pd.concat(held, ignore_index=True))

    return rows.withColumn("has_up", F.col("up").isNotNull()).withColumn("up", F.coalesce("up", F.lit(0))).mapInArrow(run, _ROLLED)


def end_digests(ends: DataFrame) -> DataFrame:
    """Per key (ka, kb): SHA-256 of its conversation ids, in order, joined by commas."""
    rows = ranged(ends, ["ka", "kb", "conv_id"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, batch in enumerate(batches):
            ka, kb, part, ids = (batch.column(c).to_numpy() for c in ("ka", "kb", "_part", "conv_id"))
            if not len(ka):
                continue
            starts = np.flatnonzero(np.concatenate([[True], (ka[1:] != ka[:-1]) | (kb[1:] != kb[:-1])]))
            stops = [*starts[1:].tolist(), len(ka)]
            joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts.tolist(), stops, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ka[starts]), pa.array(kb[starts]), pa.array(part[starts]), pa.array([seq] * len(starts), pa.int32()), pa.array(joined)], ["ka", "kb", "part", "seq", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        out = []
        for key, rows in groupby(pieces(), key=lambda r: r[:2]):
            h = hashlib.sha256()
            for i, r in enumerate(rows):
                h.update(("," * (i > 0) + r[2]).encode())
            out.append((*key, h.hexdigest()))
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["ka", "kb", "ends_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["ka", "kb", "ends_sha256"])

    joined = rows.mapInArrow(texts, "ka long, kb long, part int, seq int, ids string")
    return joined.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "part", "seq").select("ka", "kb", "ids").mapInArrow(digest, "ka long, kb long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, heavy: int | None = None) -> DataFrame:
    """Nodes of the conversations ``convs`` (distinct conv_id) with ``turns`` (conv_id, pos, label, size): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    hashed = turns.withColumns({x: F.xxhash64(F.lit(i), "label", "pos") for i, x in enumerate("ab")})
    named = running(hashed.select("conv_id", "pos", "size", "a", "b"), ["conv_id"], ["pos"], {"ka": ("xor", "a"), "kb": ("xor", "b")})
    named = cut(named.select("conv_id", (F.col("pos") + 1).alias("depth"), "size", "ka", "kb", F.col("ka").bitwiseXOR(F.col("a")).alias("pa"), F.col("kb").bitwiseXOR(F.col("b")).alias("pb")))
    nothing = {c: F.lit(0).cast("long") for c in ("ka", "kb", "pa", "pb", "depth", "size")}
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").withColumns(nothing)
    nodes = named.groupBy("ka", "kb").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.min(c).alias(c) for c in ("pa", "pb", "depth", "size")))
    nodes = cut(nodes.unionByName(root).withColumns({c: F.lit(0).cast("long") for c in ("x_children", "x_leaves", "x_saved")}))
    largest = nodes.agg(F.max("n_convs")).first()[0] or 0
    most = heavy or max(64, math.isqrt(largest))

    if largest <= most:  # one shard
        rows = nodes.withColumns({"sa": F.lit(0).cast("long"), "sb": F.lit(0).cast("long"), "up": F.lit(None).cast("long")})
        made = _roll_up(rows.repartition(1).sortWithinPartitions("depth"))
    else:
        upper, lower = nodes.where(F.col("n_convs") > most), nodes.where(F.col("n_convs") <= most)
        parents = upper.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("up"))
        tops = spread_join(lower.select("ka", "kb", "pa", "pb"), parents, ["pa", "pb"], ["ka", "kb"], "inner").select("ka", "kb", "up")
        shard = named.select("conv_id", "ka", "kb").join(tops, ["ka", "kb"]).select("conv_id", F.col("ka").alias("sa"), F.col("kb").alias("sb"), "up")
        rows = spread_join(lower, shard, ["conv_id"], ["ka", "kb"], "inner")
        low = cut(_roll_up(rows.repartition("sa", "sb").sortWithinPartitions("sa", "sb", "depth")))
        below = low.where("at_top").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("x_children"), F.sum("n_leaves").alias("x_leaves"), F.sum("saved_tokens").alias("x_saved"))
        joined = upper.drop("x_children", "x_leaves", "x_saved").join(below, ["ka", "kb"], "left").fillna(0, subset=["x_children", "x_leaves", "x_saved"])
        joined = joined.withColumns({"sa": F.lit(0).cast("long"), "sb": F.lit(0).cast("long"), "up": F.lit(None).cast("long")})
        made = low.unionByName(_roll_up(joined.repartition(1).sortWithinPartitions("depth")))

    last = named.groupBy("conv_id").agg(F.max(F.struct("depth", "ka", "kb")).alias("end"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("end.ka", zero).alias("ka"), F.coalesce("end.kb", zero).alias("kb"))
    out = made.join(end_digests(ends), ["ka", "kb"], "left").fillna({"ends_sha256": EMPTY})
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def shared_starts(conversations: DataFrame, heavy: int | None = None) -> DataFrame:
    """The trie of rebuilt conversations (conv_id, turn, role, text)."""
    return trie(*rebuild(conversations), heavy)
