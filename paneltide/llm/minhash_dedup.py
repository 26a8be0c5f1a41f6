"""Near-duplicate groups by SuperMinHash (operator 12).

A text's set is its distinct word shingles. Its signature is a SuperMinHash: every shingle runs through a random
permutation of the slots, and offers slot p(j) the value j plus a random fraction. All shingles of a batch of
texts take step j together; a text stops as soon as each of its slots holds less than j + 1, as later steps can't
lower any (long texts stop after a step or two, a single shingle takes them all). Slots of one shingle never
clash, hence the lower variance. Bands of the signature are shuffled.

Texts of a bucket are verified on their full sets (64-bit hashes of shingles), against the bucket's least text
first. What that links is grouped; only buckets that hold other texts of different groups are looked at again:
texts outside the bucket's largest group are compared with all others, in blocks against blocks, without pairs
that share an earlier band. So a family of copies takes about a comparison a text. Links of a block are joined by
union-find in the task, all links by hooking and jumping over tables. Equal texts are one class from the start;
rows of a hot text or bucket are dealt to 64 tasks.

Result per row: n_shingles, component_id (the least doc_id that is linked, directly or through others; itself, if
none is), kept (it is that one).

Defined results: words are lower-cased from A to Z only; a text that is null or has no word has an empty set, is
linked with nothing and kept; a text of fewer words than a shingle is one shingle; very long texts are compared
whole; a pair at the threshold is linked; repeated rows count each and all rows of a kept id are kept; a null id
counts as the least id, so its rows are kept, and is null as component_id too; columns of other names are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import SALTS, cut, per_salt, pieces, salt, salts_seen, spread_join, take_turn
from .ngram_join import NO_ID, _forest, choose_bands, components, mix, verified

_STEP, _LANE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def shingles(texts: list[bytes | None], n: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct word shingles of all texts, ascending within a text, and where each text's begin (one more entry than texts)."""
    words = [t.lower().split() if t else [] for t in texts]  # of bytes: A to Z, and the six ASCII white spaces
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
            out = np.where(more, mix(out * _STEP + hashed[np.where(more, first + k, 0)] + np.uint64(k + 1)), out)
    owner = np.repeat(np.arange(len(texts)), grams)
    order = np.lexsort((out, owner))
    out = out[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(texts)))])


def signatures(grams: np.ndarray, ends: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash of each set (none is empty): the step in the upper 16 bits, the fraction below."""
    sets = len(ends) - 1
    owner = np.repeat(np.arange(sets), np.diff(ends))
    least = np.full(sets * slots, np.iinfo(np.uint64).max, np.uint64)
    places = None  # of the shingles still under way: their permutations so far
    with np.errstate(over="ignore"):
        for j in range(slots):
            x = mix(grams + _STEP * np.uint64(j + 1))
            swap = j + ((x >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
            value = (np.uint64(j) << np.uint64(48)) | (mix(x + _LANE) >> np.uint64(16))
            if places is None:
                slot = swap
            else:
                rows = np.arange(len(grams))
                slot = places[rows, swap].astype(np.int64)
                places[rows, swap] = places[rows, j]
                places[rows, j] = slot
            np.minimum.at(least, owner * slots + slot, value)
            under_way = (least.reshape(sets, slots).max(axis=1) >> np.uint64(48)) > j
            if not under_way.any():
                break
            keep = under_way[owner]
            if places is None:
                swapped = swap[keep]
                places = np.tile(np.arange(slots, dtype=np.uint16), (len(swapped), 1))
                places[np.arange(len(swapped)), swapped], places[:, 0] = 0, swapped
            elif not keep.all():
                places = places[keep]
            grams, owner = grams[keep], owner[keep]
    return least.reshape(sets, slots)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per band, that tells bands apart too."""
    out = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), 1))
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = mix(out * _STEP + signature[:, r : bands * rows : rows])
    return out.view(np.int64)


def exact_key(text: str) -> Column:
    """16 bytes that name a text; null for a text without words."""
    return F.when(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.md5(F.col(text))))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sets_of(slim: DataFrame, members: DataFrame, signed: DataFrame, n: int) -> DataFrame:
    """``members`` (id0, key and others) with the shingles of their texts, which are moved once; of repeated rows, one a task."""
    own = [c for c in members.columns if c not in ("id0", "key")]
    again = cut(signed.where("key is not null").groupBy("id0", "key").agg(F.count("*").alias("k")).where("k > 1").drop("k").join(members.select("id0", "key"), ["id0", "key"], "left_semi"))
    if again.isEmpty():
        texts = slim.join(members, ["id0", "key"]).select("key", *own, "text")
    else:
        salted = slim.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        repeated = members.join(again, ["id0", "key"], "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        one = salted.join(repeated.select("id0", "key", "salt"), ["id0", "key", "salt"]).groupBy("id0", "key").agg(F.first("text").alias("text"))
        single = slim.join(members.join(again, ["id0", "key"], "left_anti"), ["id0", "key"]).select("key", *own, "text")
        texts = single.unionByName(one.join(members, ["id0", "key"]).select("key", *own, "text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("minhash_dedup")
        for batch, texts in pieces(batches, "text", 1_000_000):
            grams, ends = shingles([t and t.encode() for t in texts], n)
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], [*batch.schema.names[:-1], "grams"])

    kinds = dict(members.dtypes)
    return texts.mapInArrow(sets, "key binary, " + "".join(f"{c} {kinds[c]}, " for c in own) + "grams array<long>")


def _star_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): texts that are linked with a hub of theirs. ``sets``: key, hubs, grams."""
    held = sets.select("key", "grams", salt("key").alias("salt"), F.explode("hubs").alias("hub"))
    seen = held.where("key <> hub").groupBy("hub").agg(salts_seen("salt").alias("seen"))
    hubs = per_salt(sets.select(F.col("key").alias("hub"), "grams").join(seen, "hub"), "seen", "salt")
    rows = hubs.select("hub", "salt", F.lit(0).alias("kind"), F.col("hub").alias("key"), "grams").unionByName(held.where("key <> hub").select("hub", "salt", F.lit(1).alias("kind"), "key", "grams"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("minhash_dedup")
        own = None
        for batch in batches:
            ends, flat = batch.column("grams").offsets.to_numpy(), batch.column("grams").values.to_numpy()
            a, b = [], []
            for i, (hub, kind, key) in enumerate(zip(batch.column("hub").to_pylist(), batch.column("kind").to_pylist(), batch.column("key").to_pylist(), strict=True)):
                grams = flat[ends[i] : ends[i + 1]]
                if kind == 0:
                    own = grams.copy()
                elif 100 * min(len(own), len(grams)) >= percent * max(len(own), len(grams)) and linked(own, grams, percent):
                    a.append(hub)
                    b.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "kind").select("hub", "kind", "key", "grams").mapInArrow(compare, "a binary, b binary")


def _rest_links(tied: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links between texts of one bucket, neither its hub, that no link with a hub has put in one group."""
    entries = tied.join(labels.select(F.col("node").alias("key"), "root"), "key", "left").select("hash", "key", F.coalesce("root", "key").alias("root"))
    groups = entries.groupBy("hash", "root").agg(F.count("*").alias("k"))
    buckets = groups.groupBy("hash").agg(F.max_by("root", "k").alias("main"), F.sum("k").alias("size"), F.max("k").alias("most")).where("most < size")
    buckets = buckets.select("hash", "main", F.ceil((F.col("size") - F.col("most")) / block).cast("int").alias("out_blocks"), F.ceil(F.col("size") / block).cast("int").alias("all_blocks"))
    held = cut(spread_join(entries, buckets, ["hash"], ["key"], "inner"))
    at = F.xxhash64("key")
    outside = held.where("root <> main").select("hash", "key", "root", F.lit(True).alias("out"), F.pmod(at, F.col("out_blocks")).cast("int").alias("x"), F.explode(F.expr("sequence(0, all_blocks - 1)")).alias("y"))
    inside = held.select("hash", "key", "root", F.lit(False).alias("out"), F.explode(F.expr("sequence(0, out_blocks - 1)")).alias("x"), F.pmod(at, F.col("all_blocks")).cast("int").alias("y"))
    dealt = outside.unionByName(inside).join(sets.select("key", "bands", "grams"), "key")

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = (pdf[pdf["out"] == x].sort_values("key", ignore_index=True) for x in (True, False))
        none = pd.DataFrame({"a": [], "b": []})
        if not len(left) or not len(right):
            return none
        code = {k: i for i, k in enumerate(sorted({*left["key"], *right["key"]}))}
        a, b = (np.array([code[k] for k in x["key"]]) for x in (left, right))
        root = {k: i for i, k in enumerate({*left["root"], *right["root"]})}
        ra, rb = (np.array([root[k] for k in x["root"]]) for x in (left, right))
        sizes = [np.array([len(g) for g in x["grams"]]) for x in (left, right)]
        small, large = np.minimum(sizes[0][:, None], sizes[1][None, :]), np.maximum(sizes[0][:, None], sizes[1][None, :])
        wanted = (ra[:, None] != rb[None, :]) & (100 * small >= percent * large)
        is_out = np.isin(b, a)  # pairs of two texts outside the main group come up twice
        wanted &= ~is_out[None, :] | (a[:, None] < b[None, :])
        shared, hashes = np.zeros_like(wanted), pdf["hash"].iloc[0]
        x, y = np.stack(left["bands"]), np.stack(right["bands"])
        for k in range(x.shape[1]):
            if x[0, k] == hashes:
                break
            shared |= x[:, k][:, None] == y[:, k][None, :]
        wanted &= ~shared
        if not wanted.any():
            return none
        rows, cols = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        ok = verified([left["grams"].iloc[i] for i in rows], [right["grams"].iloc[i] for i in cols], percent / 100) & wanted[np.ix_(rows, cols)]
        i, j = np.nonzero(ok)
        both = np.zeros((len(code), len(code)), bool)
        both[a[rows[i]], b[cols[j]]] = both[b[cols[j]], a[rows[i]]] = True
        top, name = _forest(len(code), both), list(code)
        kept = [n for n in range(len(code)) if top[n] != n]
        return pd.DataFrame({"a": [name[top[n]] for n in kept], "b": [name[n] for n in kept]})

    return dealt.groupBy("hash", "x", "y").applyInPandas(verify, "a binary, b binary")


def groups(docs: DataFrame, percent: int = 80, n: int = 4, recall: float = 0.9999, block: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id, kept. Texts are linked at ``percent`` of their union and more."""
    bands, rows = choose_bands(percent / 100, recall, 200)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id0"), exact_key(text_col).alias("key"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("minhash_dedup")
        for batch, texts in pieces(batches, "text", 500_000):
            grams, ends = shingles([t and t.encode() for t in texts], n)
            counts = np.diff(ends)
            full = counts > 0
            made = band_hashes(signatures(grams, np.concatenate([[0], np.cumsum(counts[full])]), bands * rows), bands, rows) if full.any() else np.empty((0, bands), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * bands)]), pa.int32()), pa.array(made.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(counts, pa.int64()), lists], ["id", "id0", "key", "salt", "n_shingles", "bands"])

    salted = slim.select("id", "id0", "key", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"), "text")
    signed = cut(salted.mapInArrow(sign, "id long, id0 long, key binary, salt int, n_shingles long, bands array<long>"))
    classes = cut(signed.where("key is not null").groupBy("key").agg(F.min("id0").alias("id0"), F.count("*").alias("copies"), salts_seen("salt").alias("seen"), F.first("bands").alias("bands")))

    # one star per bucket: each text is tied to the least that shares a band hash with it
    banded = classes.select("key", salt("key").alias("salt"), F.explode("bands").alias("hash"))
    stars = banded.groupBy("hash").agg(F.min("key").alias("hub"), F.count("*").alias("size"), salts_seen("salt").alias("seen")).where("size > 1").drop("size")
    tied = cut(banded.join(per_salt(stars, "seen", "salt"), ["hash", "salt"]).where("key <> hub").select("hash", "hub", "key"))
    pairs = tied.select("hub", "key").distinct()
    ends = pairs.unionByName(pairs.select("hub", F.col("hub").alias("key"))).groupBy("key").agg(F.collect_set("hub").alias("hubs"))  # a hub a band at most
    sets = cut(_sets_of(slim.select("id0", "key", "text"), ends.join(classes.select("key", "id0", "bands"), "key"), signed, n))

    links = cut(_star_links(sets, percent))
    labels = components(links)
    more = cut(_rest_links(tied, labels, sets, percent, block))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    known = classes.select("key", "id0", "copies", "seen").join(labels.withColumnRenamed("node", "key"), "key", "left")
    least = known.where("root is not null").groupBy("root").agg(F.min("id0").alias("rep0"))
    result = spread_join(known.where("copies > 1 or root is not null"), least, ["root"], ["key"])
    result = per_salt(result.select("key", "seen", F.coalesce("rep0", "id0").alias("rep0")), "seen", "salt")
    out = signed.select("id", "id0", "key", "salt", "n_shingles").join(result, ["key", "salt"], "left").withColumn("rep0", F.coalesce("rep0", "id0"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("rep0") != NO_ID, F.col("rep0")).alias("component_id"), (F.col("id0") == F.col("rep0")).alias("kept"))
