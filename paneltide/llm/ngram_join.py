"""N-gram Jaccard self-join by MinHash banding (operator 10).

Word 5-grams of each distinct text are MinHashed; bands and rows are chosen for a target recall at the
threshold, and band hashes are shuffled. Texts that share a band hash with the least text of their bucket
are tied to it, and tied texts form families. Within a family pairs are verified on the full n-gram sets
(of 64-bit hashes of n-grams), in blocks against blocks, so a large family is spread over many tasks; blocks
return link counts and a spanning forest, never pairs. Exact copies (texts equal but for case) are one class
from the start: they are signed once per row, counted, and never paired. Wherever rows of one text, bucket
or family meet what is known of it, they are dealt to 64 tasks.

Result per row: the component it belongs to (``class_id``: the least doc_id of all texts that are linked
directly or through others) and ``n_links``, the number of other rows whose text has a Jaccard similarity of
the threshold or more with it.

Defined results: a text that is null or has no word is a class of its own row id with no link, though
repeated; a text of fewer than five words has one n-gram, all its words; very long texts are compared whole;
a pair at the threshold is linked; repeated rows count each; a null id counts as the
least id for choosing representatives and stays null in the output; an empty table gives an empty result;
columns of any other names are ignored by ``join`` and stay as they are in ``keep_one``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import SALTS, cut, per_salt, pieces, salt, salts_seen, spread_join, take_turn, unused

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
NO_ID = -(1 << 63)


def choose_bands(threshold: float, recall: float = 0.999, most_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false candidates, that reach ``recall`` at ``threshold``."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        miss = math.log1p(-(threshold**rows)) if threshold < 1 else -math.inf  # of one band
        if not miss or (bands := math.ceil(math.log(1 - recall) / miss) or 1) * rows > most_hashes:
            break
        best = (bands, rows)
    return best


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word n-grams of all texts, one after the other, and where each text's begin (one more entry than texts)."""
    words = [_WORD.findall(t.lower()) if t else [] for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.array([x for w in words for x in w], dtype=object)
    if not len(flat):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    codes, unique = pd.factorize(flat)
    hashed = pd.util.hash_array(np.asarray(unique, dtype=object), categorize=False)[codes].astype(np.uint64)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(grams)])
    first = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]) - ends[:-1], grams) + np.arange(ends[-1])
    size = np.repeat(np.minimum(counts, n), grams)
    out = np.zeros(ends[-1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            more = size > k
            at = np.where(more, first + k, 0)
            out = np.where(more, mix(out * np.uint64(0x9E3779B97F4A7C15) + hashed[at] + np.uint64(k + 1)), out)
    return out, ends


def band_hashes(texts: list[str | None], bands: int, rows: int, n: int = 5) -> list[np.ndarray | None]:
    """Band hashes (int64) of each text; None where it has no word."""
    grams, ends = gram_hashes(texts, n)
    full = np.flatnonzero(np.diff(ends))
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(full):
        return out
    rng = np.random.default_rng(20_240_229)
    a, b = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    starts = ends[full]
    with np.errstate(over="ignore"):
        made = np.zeros((len(full), bands), np.uint64)
        for j in range(bands * rows):
            least = np.minimum.reduceat(grams * a[j] + b[j], starts)
            made[:, j // rows] = mix(made[:, j // rows] + least + np.uint64(j))
    for i, row in zip(full, made.astype(np.int64), strict=True):
        out[i] = row
    return out


def text_key(text: str) -> Column:
    """16 bytes that name a text but for case; null for a text without words."""
    return F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(F.lower(F.col(text)))))


def node_name(id0: Column, key: Column) -> Column:
    """24 bytes that order texts by their least id, then key."""
    return F.unhex(F.concat(F.lpad(F.hex(id0.bitwiseXOR(F.lit(NO_ID))), 16, "0"), F.hex(key)))


def node_id(node: Column) -> Column:
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(NO_ID))


def node_key(node: Column) -> Column:
    return F.substring(node, 9, 16)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of an undirected graph of edges (a, b): the least node that each is connected to.

    Each node first hangs from its least smaller neighbour, which takes over its other edges, so a dense
    group shrinks to about an edge per node. Then labels spread to neighbours and jump to their label's
    label, each round cut off in the shared folder.
    """
    down = edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    hung = down.withColumn("top", F.min("lo").over(W.partitionBy("hi")))
    thin = hung.select(F.col("top").alias("a"), F.col("hi").alias("b")).unionByName(hung.where("top <> lo").select(F.col("top").alias("a"), F.col("lo").alias("b"))).distinct()
    thin = cut(thin)
    both = thin.unionByName(thin.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        seen = spread_join(both, labels.select(F.col("node").alias("b"), "root"), ["b"], ["a"], "inner").groupBy("a").agg(F.min("root").alias("near")).select(F.col("a").alias("node"), "near")
        near = labels.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        spread = cut(spread_join(near, jump, ["root"], ["node"]).select("node", "was", F.least("root", "next").alias("root")))
        labels = spread.select("node", "root")
        if spread.where("root <> was").isEmpty():
            return labels


def verified(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of ``left`` x ``right`` (sorted unique gram hashes) have Jaccard similarity >= threshold."""
    a_of, b_of = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])
    grams, codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    ca, cb = codes[: len(a_of)], codes[len(a_of) :]
    shared = np.flatnonzero((np.bincount(ca, minlength=len(grams)) > 0) & (np.bincount(cb, minlength=len(grams)) > 0))
    place = np.full(len(grams), -1)
    place[shared] = np.arange(len(shared))
    common = np.zeros((len(left), len(right)), np.float32)
    pa_, pb = place[ca], place[cb]
    for at in range(0, len(shared), 8192):
        x, y = np.zeros((len(left), 8192), np.float32), np.zeros((len(right), 8192), np.float32)
        ia, ib = (pa_ >= at) & (pa_ < at + 8192), (pb >= at) & (pb < at + 8192)
        x[a_of[ia], pa_[ia] - at] = 1
        y[b_of[ib], pb[ib] - at] = 1
        common += x @ y.T
    common = common.astype(np.float64)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - common
    return common >= threshold * union - 1e-9


def _forest(n: int, links: np.ndarray) -> list[int]:
    """Root (least index) of each of ``n`` nodes under a symmetric boolean matrix."""
    root = [-1] * n
    for i in range(n):
        if root[i] < 0:
            stack, root[i] = [i], i
            while stack:
                for k in np.flatnonzero(links[stack.pop()]):
                    if root[k] < 0:
                        root[k] = i
                        stack.append(int(k))
    return root


def join(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.999, block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, class_id, n_links."""
    rows = links(docs, threshold, n, recall, block, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), "class_id", "n_links")


def links(docs: DataFrame, threshold: float, n: int, recall: float, block: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, id0 (never null), key (of its text), class_id, rep0 and rep_key (which row stands for its class), n_links."""
    bands, rows = choose_bands(threshold, recall)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id0"), text_key(text_col).alias("key"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("ngram_join")
        for batch, texts in pieces(batches, "text", 1_000_000):
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(band_hashes(texts, bands, rows, n), pa.list_(pa.int64()))], ["id", "id0", "key", "salt", "bands"])

    # the salt tells rows of one text apart, repeated rows too
    salted = slim.select("id", "id0", "key", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"), "text")
    signed = cut(salted.mapInArrow(sign, "id long, id0 long, key binary, salt int, bands array<long>"))
    found = signed.where("key is not null").groupBy("key").agg(F.min("id0").alias("id0"), F.count("*").alias("copies"), salts_seen("salt").alias("seen"), F.first("bands").alias("bands"))
    classes = cut(found.withColumn("node", node_name(F.col("id0"), F.col("key"))))

    # one star per bucket: every class is tied to the least of those that share a band hash with it
    banded = classes.select("node", salt("node").alias("salt"), F.posexplode("bands").alias("band", "hash"))
    stars = banded.groupBy("band", "hash").agg(F.min("node").alias("hub"), F.count("*").alias("size"), salts_seen("salt").alias("seen")).where("size > 1").drop("size")
    tied = banded.join(per_salt(stars, "seen", "salt"), ["band", "hash", "salt"]).where("node <> hub")
    families = cut(components(tied.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()))

    # full n-gram sets of the families' texts; a family is dealt to blocks of about ``block`` texts
    sizes = families.groupBy("root").agg(F.count("*").alias("size"))
    members = spread_join(families, sizes, ["root"], ["node"], "inner").join(classes.select("node", "id0", "key", "copies"), "node")
    members = members.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = slim.select("id0", "key", "text").join(members, ["id0", "key"]).dropDuplicates(["id0", "key"]).select("node", "root", "copies", "blocks", "own", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("ngram_join")
        for batch, texts in pieces(batches, "text", 1_000_000):
            grams, ends = gram_hashes(texts, n)
            own = [np.unique(grams[a:b]).view(np.int64) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(own, pa.list_(pa.int64()))], [*batch.schema.names[:5], "grams"])

    full = texts.mapInArrow(sets, "node binary, root binary, copies long, blocks int, own int, grams array<long>")
    dealt = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        left = pdf if lo == hi else pdf[pdf["own"] == lo]
        right = pdf if lo == hi else pdf[pdf["own"] == hi]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "linked": [], "to": []})
        ok = verified([*left["grams"]], [*right["grams"]], threshold)
        if lo == hi:
            np.fill_diagonal(ok, False)
            both, linked = ok, ok @ right["copies"].to_numpy()
        else:
            both = np.block([[np.zeros((len(left), len(left)), bool), ok], [ok.T, np.zeros((len(right), len(right)), bool)]])
            linked = np.concatenate([ok @ right["copies"].to_numpy(), ok.T @ left["copies"].to_numpy()])
        nodes = [*left["node"]] if lo == hi else [*left["node"], *right["node"]]
        return pd.DataFrame({"node": nodes, "linked": linked.astype(np.int64), "to": [nodes[r] for r in _forest(len(nodes), both)]})

    checked = cut(dealt.groupBy("root", "lo", "hi").applyInPandas(verify, "node binary, linked long, to binary"))
    counted = checked.groupBy("node").agg(F.sum("linked").alias("linked"))
    grouped = components(checked.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")).distinct())
    known = classes.select("node", "key", "copies", "seen").join(counted, "node", "left").join(grouped, "node", "left")
    # only texts with copies or links say more than their own row does
    result = known.withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).where("n_links > 0").withColumn("root", F.coalesce("root", "node"))
    result = per_salt(result.select("key", "seen", "n_links", node_id(F.col("root")).alias("rep0"), node_key(F.col("root")).alias("rep_key")), "seen", "salt")
    out = signed.select("id", "id0", "key", "salt").join(result, ["key", "salt"], "left").drop("salt")
    out = out.withColumn("rep0", F.coalesce("rep0", "id0")).withColumn("rep_key", F.coalesce("rep_key", "key")).withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    return out.withColumn("class_id", F.when(F.col("rep0") != NO_ID, F.col("rep0")))


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.999, block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component; texts without words all stay. Columns stay as they are."""
    found = links(docs, threshold, n, recall, block, id_col, text_col)
    id0, key = unused(docs, "id0"), unused(docs, "text_key")
    gone = found.where((F.col("id0") != F.col("rep0")) | ~F.col("key").eqNullSafe(F.col("rep_key"))).select(F.col("id0").alias(id0), F.col("key").alias(key)).distinct()
    again = cut(found.where("key is not null").groupBy("id0", "key").agg(F.count("*").alias("k")).where("k > 1").select(F.col("id0").alias(id0), F.col("key").alias(key)))
    named = docs.withColumn(id0, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn(key, text_key(text_col))
    left = named.join(gone, [id0, key], "left_anti")
    if again.isEmpty():  # ids are unique: nothing else to drop
        return left.select(*docs.columns)
    twice = left.join(again, [id0, key], "left_semi").dropDuplicates([id0, key])
    return left.join(again, [id0, key], "left_anti").select(*docs.columns).unionByName(twice.select(*docs.columns))
