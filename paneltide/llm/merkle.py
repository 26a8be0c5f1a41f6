"""Merkle manifest of a dataset (operator 11).

Each row is a leaf; per key (source) the leaves, in order, are hashed up in runs of ``arity`` nodes to a
subroot, and the subroots of all keys, in order, likewise to the root. A proof lists the siblings of every
level, so a row is checked against the root without the others.

The hashing is combineByKey driven by arrivals. Leaves are dealt to range partitions by key and order. In a
partition each arriving digest joins its parent's partial (child digests by place); once the parent has as
many children as the size of its tree calls for, it is hashed and arrives at its own parent, up to subtrees of
``height`` levels. What stays unresolved at a partition's ends is its frontier. Frontiers are shuffled by the
ancestor that they share a few levels further up, and combined there in the same way, until only subroots are
left. Proofs go back over reverse links: each group hands every node that came into it the siblings up to its
top, followed by those above. A partition then meets its own frontier again and adds the siblings below it.
No task holds more than a subtree of ``height`` levels; a hot key is spread over many partitions.

Defined results: nulls in any column are part of the leaf; a null id comes first (and counts as
empty text for its crc32), a null key is a key and comes first; ids that repeat are ordered by their leaves' digests, and repeated rows are leaves each; very long
texts are hashed whole; other columns, whatever their names, are ignored; an empty table gives no rows; the
proof of an only row is empty.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.ranks import ranged
from .common import crc_mod, cut

STEPS = "array<struct<left string, right string>>"
_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
#: Levels that a round of the frontier climbs.
ROUND = 3


def leaf_digest(*columns: Column | str) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and itself; ``-`` for null."""
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def nodes_at(n: int, level: int, arity: int) -> int:
    """Nodes of a level over ``n`` leaves."""
    return -(-n // arity**level)


class Partials:
    """Partial parents: (level, index) -> child digests by place. ``done`` gets nodes (level, index, digest, is the tree's top) that nothing here will join."""

    def __init__(self, arity: int, top: int, keep: bool = False) -> None:
        self.arity, self.top, self.open, self.done = arity, top, {}, []
        self.links: dict[tuple[int, int], list[str]] | None = {} if keep else None

    def arrive(self, level: int, at: int, digest: str, n: int | None) -> None:
        """``n``: leaves of the tree; None while unknown, when only full runs are hashed."""
        while True:
            if n is not None and nodes_at(n, level, self.arity) == 1:
                self.done.append((level, at, digest, True))
                return
            if level == self.top:
                self.done.append((level, at, digest, False))
                return
            parent = (level + 1, at // self.arity)
            held = self.open.setdefault(parent, {})
            held[at % self.arity] = digest
            if len(held) < self.wanted(parent, n):
                return
            digest, (level, at) = self.hashed(parent), parent

    def wanted(self, parent: tuple[int, int], n: int | None) -> int:
        level, at = parent
        return self.arity if n is None else min(self.arity, nodes_at(n, level - 1, self.arity) - self.arity * at)

    def hashed(self, parent: tuple[int, int]) -> str:
        held = self.open.pop(parent)
        children = [held[i] for i in sorted(held)]
        if self.links is not None:
            self.links[parent] = children
        return sha("".join(children))

    def settle(self, n: int) -> None:
        """The tree's size is known and nothing else arrives here: short runs are hashed, the rest is the frontier."""
        level = 1
        while self.open:
            for parent in sorted(p for p in self.open if p[0] == level):
                if nodes_at(n, level - 1, self.arity) == 1 or len(self.open[parent]) < self.wanted(parent, n):
                    is_top = nodes_at(n, level - 1, self.arity) == 1
                    self.done += [(level - 1, self.arity * parent[1] + i, d, is_top) for i, d in sorted(self.open.pop(parent).items())]
                else:
                    self.arrive(*parent, self.hashed(parent), n)
            level += 1


def _batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_NODE = pa.schema([("part", pa.int32()), ("k", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("digest", pa.string()), ("top", pa.bool_())])
NODE = "part int, k string, n long, level int, at long, digest string, top boolean"
_PATH = pa.schema([("part", pa.int32()), ("k", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("steps", _STEPS), ("subroot", pa.string()), ("root", pa.string())])
PATH = f"part int, k string, n long, level int, at long, steps {STEPS}, subroot string, root string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _batches(held, schema)
            held = []
    yield _batches(held, schema)


def fold_leaves(leaves: DataFrame, arity: int, height: int) -> tuple[DataFrame, int]:
    """The nodes that each partition of ``ranged`` leaves (k, digest, _part) can't take further, and the level at which their first groups meet, a few partitions each."""
    sizes = leaves.groupBy("_part", "k").agg(F.count("*").alias("own"))
    of_key = W.partitionBy("k")
    sizes = sizes.withColumn("n", F.sum("own").over(of_key)).withColumn("before", F.coalesce(F.sum("own").over(of_key.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    spans: dict[int, dict[str, tuple[int, int]]] = {}
    largest = 1
    for r in sizes.where("n > own").collect():  # keys that lie in several partitions: two a partition at most
        spans.setdefault(r["_part"], {})[r["k"]] = (r["before"], r["n"])
        largest = max(largest, r["own"])
    local = max(1, min(height, math.ceil(math.log(largest, arity))))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (part, k), rows in groupby(_rows(batches), key=lambda r: r[:2]):
                begin, n = spans.get(part, {}).get(k, (0, None))
                p, at = Partials(arity, local), begin
                for _, _, digest in rows:
                    p.arrive(0, at, digest, None)
                    at += 1
                n = n or at
                p.settle(n)
                yield from ((part, k, n, level, i, digest, nodes_at(n, level, arity) == 1) for level, i, digest, _ in p.done)

        return _in_batches(out(), _NODE)

    return leaves.select("_part", "k", "digest").mapInArrow(fold, NODE), local + 2


def _grouped(nodes: DataFrame, arity: int, to: int) -> DataFrame:
    return nodes.withColumn("g", F.expr(f"at div bigint(pow({arity}, {to} - level))"))


def climb(nodes: DataFrame, arity: int, to: int) -> DataFrame:
    """Nodes combined up to level ``to``, or their tree's top below it."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (k, _), rows in groupby(_rows(batches), key=lambda r: r[:2]):
                p = Partials(arity, to)
                for _, _, n, level, at, digest in rows:
                    p.arrive(level, at, digest, n)
                yield from ((None, k, n, *x) for x in p.done)

        return _in_batches(out(), _NODE)

    shared = _grouped(nodes, arity, to).select("k", "g", "n", "level", "at", "digest").repartition("k", "g").sortWithinPartitions("k", "g", "level", "at")
    return shared.mapInArrow(up, NODE)


def descend(nodes: DataFrame, above: DataFrame, arity: int, to: int) -> DataFrame:
    """Steps to the root of each of ``nodes``, from those of the nodes that ``climb`` made of them (``above``, as ``PATH``)."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (k, _), rows in groupby(_rows(batches), key=lambda r: r[:2]):
                _, _, _, _, _, _, _, _, rest, subroot, root = next(rows)
                p, own = Partials(arity, to, keep=True), []
                for _, _, _, part, n, level, at, digest, *_ in rows:
                    own.append((part, n, level, at))
                    p.arrive(level, at, digest, n)
                for part, n, level, at in own:
                    steps, lv, i = [], level, at
                    while (run := p.links.get((lv + 1, i // arity))) is not None:
                        place = i % arity
                        steps.append({"left": "".join(run[:place]), "right": "".join(run[place + 1 :])})
                        lv, i = lv + 1, i // arity
                    yield part, k, n, level, at, steps + rest, subroot, root

        return _in_batches(out(), _PATH, 1000)

    empty = F.lit(None)
    ways = _grouped(above, arity, to).select(
        "k", "g", F.lit(0).alias("kind"), empty.cast("int").alias("part"), "n", F.lit(0).alias("level"), F.lit(0).cast("long").alias("at"), empty.cast("string").alias("digest"), "steps", "subroot", "root"
    )
    rows = _grouped(nodes, arity, to).select("k", "g", F.lit(1).alias("kind"), "part", "n", "level", "at", "digest", empty.cast(STEPS).alias("steps"), empty.cast("string").alias("subroot"), empty.cast("string").alias("root"))
    return ways.unionByName(rows).repartition("k", "g").sortWithinPartitions("k", "g", "kind", "level", "at").mapInArrow(down, PATH)


def local_steps(digests: Sequence[str], level: int, arity: int) -> list[tuple[list[str], list[str]]]:
    """Siblings (left, right) of each leaf of a subtree, level by level up to ``level``."""
    lefts, rights, row = [], [], list(digests)
    for _ in range(level):
        runs = [row[i : i + arity] for i in range(0, len(row), arity)]
        lefts.append(["".join(r[:i]) for r in runs for i in range(len(r))])
        rights.append(["".join(r[i + 1 :]) for r in runs for i in range(len(r))])
        row = [sha("".join(r)) for r in runs]
    scale = [arity**x for x in range(level)]
    return [([s[i // x] for s, x in zip(lefts, scale, strict=True)], [s[i // x] for s, x in zip(rights, scale, strict=True)]) for i in range(len(digests))]


def grow(leaves: DataFrame, carried: Sequence[str], above: Callable[[DataFrame], DataFrame], arity: int, height: int) -> DataFrame:
    """Trees of ``leaves`` (k: never null, o: order in it, digest): the ``carried`` columns, digest, steps, subroot, root.

    ``above`` takes the trees' tops (k, digest) and gives (k, steps, subroot, root): the way on from them.
    """
    rows = ranged(leaves.withColumn("o", F.struct("o", "digest", F.monotonically_increasing_id().alias("row"))), ["k", "o"])
    nodes, to = fold_leaves(rows, arity, height)
    levels, made = [], [cut(nodes)]
    largest = made[0].where("not top").agg(F.max("n")).first()[0]
    while largest and (not levels or nodes_at(largest, levels[-1], arity) > 1):
        levels.append(levels[-1] + ROUND if levels else to)
        made.append(cut(climb(made[-1].where("not top"), arity, levels[-1])))
    tops = made[0].where("top")
    for m in made[1:]:
        tops = tops.unionByName(m.where("top"))
    ways = cut(above(tops.select("k", "digest")))

    def paths(i: int) -> DataFrame:
        """Ways of all nodes that step ``i`` made."""
        at_top = made[i].where("top").join(ways, "k").select("part", "k", "n", "level", "at", "steps", "subroot", "root")
        return at_top if i == len(levels) else at_top.unionByName(descend(made[i].where("not top"), paths(i + 1), arity, levels[i]))

    found = paths(0).withColumn("start", F.col("at") * F.expr(f"bigint(pow({arity}, level))"))
    none = lambda kind: F.lit(None).cast(kind)
    kinds = dict(rows.dtypes)
    heads = found.select(
        F.col("part").alias("_part"), "k", F.lit(0).alias("kind"), "start", none(kinds["o"]).alias("o"), "n", "level", "steps", "subroot", "root", none("string").alias("digest"), *(none(kinds[c]).alias(c) for c in carried)
    )
    own = rows.select("_part", "k", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("start"), "o", none("long").alias("n"), none("int").alias("level"), none(STEPS).alias("steps"), none("string").alias("subroot"), none("string").alias("root"), "digest", *carried)
    met = heads.unionByName(own).repartition("_part").sortWithinPartitions("_part", "k", "kind", "start", "o").drop("_part", "o")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the partition's nodes, by their first leaf
        buffer: list[str] = []
        held: list[pa.RecordBatch] = []  # leaves whose proofs aren't whole yet
        proofs: list[tuple] = []  # of the first leaves held

        def emit() -> Iterator[pa.RecordBatch]:
            while held and len(proofs) >= held[0].num_rows:
                b = held.pop(0)
                own, proofs[: b.num_rows] = proofs[: b.num_rows], []
                ends = [0]
                for left, *_ in own:
                    ends.append(ends[-1] + len(left))
                pairs = pa.StructArray.from_arrays([pa.array([x for p in own for x in p[0]], pa.string()), pa.array([x for p in own for x in p[1]], pa.string())], fields=[*_STEPS.value_type])
                made = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), pa.array([p[2] for p in own], pa.string()), pa.array([p[3] for p in own], pa.string())]
                yield pa.RecordBatch.from_arrays([b.column("digest"), *made, *(b.column(c) for c in carried)], ["digest", "steps", "subroot", "root", *carried])

        for batch in batches:
            kind = batch.column("kind").to_pylist()
            head = [r for r in zip(kind, *(batch.column(c).to_pylist() for c in ("start", "n", "level", "steps", "subroot", "root")), strict=True)]
            leaves_here = batch.filter(pa.array([x == 1 for x in kind]))
            if leaves_here.num_rows:
                held.append(leaves_here)
            digests = batch.column("digest").to_pylist()
            for (is_leaf, *node), digest in zip(head, digests, strict=True):
                if not is_leaf:
                    waiting.append(tuple(node))
                    continue
                buffer.append(digest)
                start, n, level, steps, subroot, root = waiting[0]
                if len(buffer) == min(arity**level, n - start):
                    left, right = [s["left"] for s in steps], [s["right"] for s in steps]
                    proofs += [(a + left, b + right, subroot, root) for a, b in local_steps(buffer, level, arity)]
                    buffer.clear()
                    waiting.pop(0)
                    yield from emit()
        yield from emit()

    return met.mapInArrow(prove, f"digest string, steps {STEPS}, subroot string, root string" + "".join(f", `{c}` {kinds[c]}" for c in carried))


def manifest(leaves: DataFrame, key: str, order: str, digest: str, arity: int = 3, height: int = 8) -> DataFrame:
    """Per row of ``leaves``: its columns, and subroot, root and proof (siblings left and right of it, level by level up to the root)."""
    names = [c for c in leaves.columns if c != digest]
    key_text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))  # orders as the key does, null first
    inner = leaves.select(key_text.alias("k"), F.col(order).alias("o"), F.col(digest).alias("digest"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(names)))

    def over(tops: DataFrame) -> DataFrame:
        whole = lambda t: t.select("k", F.array().cast(STEPS).alias("steps"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
        second = grow(tops.select(F.lit("").alias("k"), F.col("k").alias("o"), "digest", F.col("k").alias("own")), ["own"], whole, arity, height)
        return second.select(F.col("own").alias("k"), "steps", F.col("digest").alias("subroot"), "root")

    out = grow(inner, [f"c{i}" for i in range(len(names))], over, arity, height)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("digest").alias(digest), "subroot", "root", F.col("steps").alias("proof"))


def folded(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, F.col(leaf), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(proof: str = "proof") -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def audit(docs: DataFrame, arity: int = 3, height: int = 8) -> DataFrame:
    """Manifest of documents, and which rows still lead to the root once line ends are deleted from every text whose id's crc32 is even."""
    tampered = F.when(F.expr(f"{crc_mod('doc_id', 2)} = 0"), F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))).otherwise(F.col("text").cast("string"))
    leaves = docs.select("doc_id", "source", leaf_digest("doc_id", "source", "lang", "n_chars", "text").alias("leaf"), leaf_digest("doc_id", "source", "lang", "n_chars", tampered).alias("presented"))
    rows = manifest(leaves, "source", "doc_id", "leaf", arity, height)
    out = rows.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), folded("presented").alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
