"""Approximate nearest neighbours by balanced posting lists (operator 1).

A bounded sample (the rows of least hash) is halved by two means again and again, so clusters are balanced;
their unit centroids head the posting lists. Every vector goes to its nearest centroid's list and, where it
lies near a boundary, is replicated to further lists: centroids within a distance ratio that aren't closer
to a list already chosen than to the vector. Centroids are searched, for vectors and for queries alike, by
a beam over an in-memory neighbour graph with a layer of entry points above it. A query scans the lists
whose centroids lie within a distance ratio of its nearest one; that ratio is fitted on the sample so that
the lists hold a target share of true neighbours. Lists are stored and scanned in blocks, and both sides of
a popular list are split, so that no task grows with the input. Queries that found fewer than ``k`` others scan
eight times more lists at any distance, and so on, in the end all.

Equal rows (id and vector) are indexed once. Of identical vectors only the ``k`` + 1 of least id can be among
the ``k`` nearest of any query, so the rest are left out before indexing; this changes no result.

Defined results: vectors without id, or that are null or zero, hold null or non-finite components, or have another length than
most rows, take no part; vectors of any one length are handled whole; ties go to the smaller id; repeated rows of one id and vector count
once, different vectors of one id count each, and no id is its own neighbour; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut


def usable(vec: str) -> Column:
    """Vectors that have a direction: not null, no null or non-finite component, not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    return F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def balanced_centroids(x: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Unit centroids of clusters of at most ``limit`` points: halves by two means, of equal size, split again while too large."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= limit:
            mean = x[own].mean(axis=0)
            done.append(mean / norm if (norm := np.sqrt(mean @ mean)) > 1e-9 else x[own[0]])
            continue
        a, b = x[rng.choice(own, 2, replace=False)]
        half = len(own) // 2
        for _ in range(5):
            order = own[np.argsort(x[own] @ (a - b), kind="stable")]
            b, a = x[order[:half]].mean(axis=0), x[order[half:]].mean(axis=0)
        todo += [order[:half], order[half:]]
    return np.array(done)


class CentroidGraph:
    """Centroids with a neighbour graph and, above it, a sparse layer of entry points; a beam search runs over many queries at once."""

    def __init__(self, centroids: np.ndarray, degree: int = 12, rng: np.random.Generator | None = None):
        self.centroids = np.ascontiguousarray(centroids, np.float32)
        k = len(centroids)
        rng = rng or np.random.default_rng(7)
        near = min(degree, k - 1)
        sq = (self.centroids**2).sum(axis=1)
        parts = []
        for at in range(0, k, 2048):
            d = sq[None, :] - 2 * self.centroids[at : at + 2048] @ self.centroids.T
            d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
            parts.append(np.argpartition(d, near - 1, axis=1)[:, :near] if near > 0 else np.zeros((len(d), 0), int))
        nearest = np.concatenate(parts)
        # a few random links join what the near links leave apart
        self.links = np.concatenate([nearest, rng.integers(0, k, (k, 4))], axis=1).astype(np.int32)
        self.entries = np.sort(rng.choice(k, min(k, int(4 * np.sqrt(k)) + 1), replace=False)).astype(np.int32)

    def distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its own row of centroids."""
        c = self.centroids[ids]
        return np.maximum((c * c).sum(axis=2) - 2 * np.matmul(c, q[:, :, None])[:, :, 0] + (q * q).sum(axis=1)[:, None], 0)

    def search(self, q: np.ndarray, m: int, beam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances) of about the ``m`` nearest centroids of each query, nearest first; fewer where the graph has fewer."""
        q = np.ascontiguousarray(q, np.float32)
        if len(q) > 256:
            parts = [self.search(q[at : at + 256], m, beam) for at in range(0, len(q), 256)]
            width = min(p[0].shape[1] for p in parts)
            return np.concatenate([p[0][:, :width] for p in parts]), np.concatenate([p[1][:, :width] for p in parts])
        k = len(self.centroids)
        m = min(m, k)
        beam = max(m + m // 4, beam or 0, 16)
        expand = max(4, beam // 12)
        n = np.arange(len(q))[:, None]
        far = self.distances_to_all(q, self.entries)
        first = np.argpartition(far, min(8, far.shape[1]) - 1, axis=1)[:, :8]
        ids, d = self.entries[first], np.take_along_axis(far, first, 1)
        seen = np.zeros((len(q), k), bool)
        seen[n, ids] = True
        open_ = np.ones(ids.shape, bool)
        while True:
            if ids.shape[1] > beam:
                keep = np.argpartition(d, beam - 1, axis=1)[:, :beam]
                ids, d, open_ = ids[n, keep], d[n, keep], open_[n, keep]
            rank = np.where(open_, d, np.inf)
            width = min(expand, rank.shape[1])
            pick = np.argpartition(rank, width - 1, axis=1)[:, :width]  # the nearest that aren't expanded yet
            live = np.isfinite(rank[n, pick])
            if not live.any():
                order = np.argsort(d, axis=1, kind="stable")[:, :m]
                ids, d = ids[n, order], d[n, order]
                width = int(np.isfinite(d).sum(axis=1).min())
                return ids[:, :width], d[:, :width]
            open_[n, pick] = False
            more = np.sort(self.links[ids[n, pick]].reshape(len(q), -1), axis=1)  # sorted, as one row may meet a centroid twice
            fresh = np.ones(more.shape, bool)
            fresh[:, 1:] = more[:, 1:] != more[:, :-1]
            fresh &= ~seen[n, more]
            seen[n, more] = True
            away = np.where(fresh, self.distances(q, more), np.inf).astype(np.float32)
            ids, d = np.concatenate([ids, more], axis=1), np.concatenate([d, away], axis=1)
            open_ = np.concatenate([open_, np.isfinite(away)], axis=1)

    def distances_to_all(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to the same centroids."""
        c = self.centroids[ids]
        return np.maximum((c * c).sum(axis=1)[None, :] - 2 * q @ c.T + (q * q).sum(axis=1)[:, None], 0)


class Index:
    def __init__(self, graph: CentroidGraph, dim: int, replicas: int, spread: float, probes: int, ratio: float):
        self.graph, self.dim, self.replicas, self.spread, self.probes, self.ratio = graph, dim, replicas, spread, probes, ratio

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list of each vector and, where it lies near a boundary, further ones that aren't closer to a list already chosen than to the vector."""
        ids, d2 = self.graph.search(x, 3 * self.replicas)
        d, c = np.sqrt(d2), self.graph.centroids
        taken = np.zeros(ids.shape, bool)
        taken[:, 0] = True
        number = np.ones(len(x), int)
        for j in range(1, ids.shape[1]):
            ok = (d[:, j] <= self.spread * d[:, 0] + 1e-12) & (number < self.replicas)
            for i in range(j):
                between = np.sqrt(((c[ids[:, j]] - c[ids[:, i]]) ** 2).sum(axis=1))
                ok &= ~taken[:, i] | (between > d[:, j])
            taken[:, j] = ok
            number += ok
        row, j = np.nonzero(taken)
        return row, ids[row, j]

    def probed(self, q: np.ndarray, wider: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the lists that each query scans, those within ``ratio`` of its nearest centroid's distance. With ``wider``, so many times more lists, at any distance."""
        most = len(self.graph.centroids)
        if wider * self.probes >= most and wider > 1:
            return np.repeat(np.arange(len(q)), most), np.tile(np.arange(most), len(q))
        ids, d2 = self.graph.search(q, min(most, wider * self.probes))
        row, j = np.nonzero(np.sqrt(d2) <= (self.ratio if wider == 1 else np.inf) * np.sqrt(d2[:, :1]) + 1e-12)
        return row, ids[row, j]


def fit(sample: np.ndarray, rows: int, list_size: int = 128, most_lists: int = 4096, target: float = 0.94, k: int = 5, replicas: int = 3, spread: float = 1.15, seed: int = 11) -> Index:
    """Centroids, graph and probe ratio from unit vectors of a bounded sample of a table of ``rows`` vectors."""
    rng = np.random.default_rng(seed)
    wanted = max(1, min(most_lists, len(sample) // 4, round(rows / list_size)))
    centroids = balanced_centroids(sample, max(1, -(-len(sample) // wanted)), rng)
    index = Index(CentroidGraph(centroids, rng=rng), sample.shape[1], replicas, spread, len(centroids), np.inf)
    # the ratio that true neighbours of sampled queries need, given where replication puts them
    queries = sample[rng.choice(len(sample), min(len(sample), 256), replace=False)]
    near = queries @ sample.T
    best = np.argsort(-near, axis=1, kind="stable")[:, 1 : k + 1]
    row, at = index.lists(sample)
    homes: dict[int, list[int]] = {}
    for r, c in zip(row.tolist(), at.tolist(), strict=True):
        homes.setdefault(r, []).append(c)
    d = np.sqrt(np.maximum(2 - 2 * queries @ centroids.T, 0))
    rank, first = np.argsort(np.argsort(d, axis=1), axis=1), d.min(axis=1)
    need = [min((d[i, c] / max(first[i], 1e-9), rank[i, c]) for c in homes[v]) for i in range(len(queries)) for v in best[i]]
    if need:
        index.ratio = float(np.quantile([r for r, _ in need], target)) + 1e-6
        index.probes = int(min(len(centroids), 1 + np.quantile([p for _, p in need], target + (1 - target) / 2)))
    return index


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of row i of both, in double precision; the result doesn't depend on the rows around it."""
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


class Best:
    """The ``k`` best distinct hits of each query so far."""

    def __init__(self, k: int):
        self.k = k
        self.q, self.x, self.s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    @property
    def size(self) -> int:
        return len(self.q)

    def add(self, hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        q, x, s = (np.concatenate(c) for c in zip((self.q, self.x, self.s), *hits, strict=True))
        order = np.lexsort((x, -s, q))
        q, x, s = q[order], x[order], s[order]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (x[1:] != x[:-1]) | (s[1:] != s[:-1])
        q, x, s = q[once], x[once], s[once]
        first = np.searchsorted(q, q)
        keep = np.arange(len(q)) - first < self.k
        self.q, self.x, self.s = q[keep], x[keep], s[keep]

    def emptied(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(self.q, pa.int64()), pa.array(self.x, pa.int64()), pa.array(self.s, pa.float64())], ["query_id", "vec_id", "score"])
        self.__init__(self.k)
        return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", sample_rows: int = 20_000, list_size: int = 128, block: int = 512) -> DataFrame:
    """Per query row and rank: query_id, rank, vec_id, score (cosine of the original vectors)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"  # floats are moved as such and scored as doubles
    rows = vectors.where(usable(vec_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vec_col), lambda x: x.cast(kind)).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return empty
    dim = lengths["d"]
    rows = rows.where(F.size("v") == dim)
    first = W.partitionBy("v").orderBy("id")
    kept = cut(rows.dropDuplicates(["id", "v"]).withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).drop("n"))
    number = kept.count()
    place = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40))
    share = min(1.0, 1.2 * sample_rows / number)
    sample = kept.where(place < max(int(share * (1 << 40)), 1 + 64 * (1 << 40) // max(number, 64))).select("v", place.alias("h")).orderBy("h").limit(sample_rows).toPandas()["v"]
    index = fit(unit(np.stack([*sample]).astype(np.float64)), number, list_size, k=k)
    shared = spark.sparkContext.broadcast(index)  # bounded: most_lists x (dim + links) numbers

    def assign(find: str, *options: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    row, to = getattr(shared.value, find)(unit(_matrix(batch.column(1), dim)), *options)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(row_ := pa.array(row)), batch.column(1).take(row_), pa.array(to, pa.int32())], ["id", "v", "list"])

        return run

    shape = f"id long, v array<{kind}>, list int"
    posted = kept.mapInArrow(assign("lists"), shape)
    def blocks(pairs: DataFrame, name: str) -> DataFrame:
        """Rows of about ``block`` members of a list: list, number of the block, ids, flat vectors."""
        pairs = cut(pairs)
        sizes = pairs.groupBy("list").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
        placed = pairs.join(sizes, "list").withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))
        return placed.groupBy("list", "part").agg(F.first("parts").alias(f"{name}_parts"), F.collect_list(F.struct("id", "v")).alias(name)).withColumnRenamed("part", f"{name}_part")

    lists = blocks(posted, "post")

    def met(asked: DataFrame) -> DataFrame:
        """Blocks of queries beside the blocks of the lists that they scan."""
        wanted = blocks(asked, "ask")
        copies = wanted.groupBy("list").agg(F.first("ask_parts").alias("ask_parts"))
        spread = lists.join(copies, "list").withColumn("ask_part", F.explode(F.sequence(F.lit(0), F.col("ask_parts") - 1))).drop("ask_parts")
        return spread.join(wanted.drop("ask_parts"), ["list", "ask_part"]).select("ask", "post")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, fresh, waiting = Best(k), [], 0
        for whole in batches:
            for i in range(whole.num_rows):
                ask, post = whole.column(0).slice(i, 1).flatten(), whole.column(1).slice(i, 1).flatten()
                q, x = _matrix(ask.field(1), dim), _matrix(post.field(1), dim)
                qi, xi = (a.field(0).to_numpy(zero_copy_only=False) for a in (ask, post))
                s = unit(q) @ unit(x).T
                s[qi[:, None] == xi[None, :]] = -np.inf
                floor = np.partition(s, -min(k, len(xi)), axis=1)[:, -min(k, len(xi))]
                a, b = np.nonzero((s >= floor[:, None] - 1e-9) & np.isfinite(s))
                fresh.append((qi[a], xi[b], scores(q[a], x[b])))
                waiting += len(a)
                if waiting > 100_000:
                    best.add(fresh)
                    fresh, waiting = [], 0
                    if best.size > 1_000_000:  # keeps a task's memory bounded, whatever it is dealt
                        yield best.emptied()
        best.add(fresh)
        yield best.emptied()

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def nearest(queries: DataFrame, wider: int) -> DataFrame:
        found = met(queries.mapInArrow(assign("probed", wider), shape)).mapInArrow(scan, "query_id long, vec_id long, score double").distinct()
        return cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score"))

    # queries whose lists held too few others scan more lists, in the end all
    queries, wider, whole = rows.where(is_query), 1, False
    others = min(k, kept.select("id").distinct().limit(k + 1).count() - 1)
    out = nearest(queries, wider)
    while others > 0 and not whole:
        full = out.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") >= others).select("id")
        short = queries.join(full, "id", "left_anti")
        if short.isEmpty():
            break
        wider *= 8
        whole = wider * index.probes >= len(index.graph.centroids)
        more = nearest(short, wider)
        out = out.join(more.select("query_id").distinct(), "query_id", "left_anti").select(*more.columns).unionByName(more)
    return out
