"""URL filter: path rules, then exact membership in a block list by a Bloom filter cascade (operator 2, native).

Keys are addresses (host and path). The cascade's key universe is every distinct address of the table.
Level 0 encodes the listed keys, level 1 the unlisted keys that pass level 0, level 2 the listed keys that
pass level 1, and so on until no key passes wrongly, so the parity of the first failing level is exact
membership: pages probe a few bits and join nothing, and neither does the build. The bit tables ride in as
scalar subqueries. A list whose bits would exceed ``max_bits`` is split by key hash into several cascades, each for its own
share of the addresses; their pages are written apart once, so each is read by its own cascade only.

Defined results: a url that is null or has no ``://`` has empty host and path, fits no rule and is
allowed; very long urls are taken whole; null or empty listed keys are ignored; repeated rows are each judged; tied rules can't occur,
as the longest fitting rule wins and two rules of one text are the same rule; other columns, whatever their
names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import cut, shared_folder

#: Fixed values given for the query: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule whose host (or a parent of it) and path prefix fit; null if none."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


class Level:
    """One Bloom filter of the cascade: a table of 64-bit words, probed as a scalar subquery."""

    def __init__(self, keys: DataFrame, number: int, bits: int, hashes: int):
        self.number, self.bits, self.hashes = number, max(64, 64 * math.ceil(bits / 64)), hashes
        spark = keys.sparkSession
        marks = keys.select(F.explode(F.array(*(self._place(F.col("key"), i) for i in range(hashes)))).alias("p"))
        words = marks.select(F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
        blank = spark.range(self.bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
        dense = words.unionByName(blank).groupBy("w").agg(F.bit_or("b").alias("b"))
        self.words = cut(dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words")))

    def _place(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits))

    def has(self, key: Column) -> Column:
        words = self.words.scalar()
        bit = lambda i: F.call_function("shiftright", F.get(words, (self._place(key, i) / 64).cast("int")), (self._place(key, i) % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
        out = bit(0)
        for i in range(1, self.hashes):
            out = out & bit(i)
        return out


class Cascade:
    """Exact membership of any key of the universe in the listed keys."""

    def __init__(self, universe: DataFrame, inside: int, outside: int):
        """``universe``: distinct key (string), listed (boolean), with its numbers of listed and other keys."""
        self.levels: list[Level] = []
        rest, number = universe, 0
        while inside:
            rate, hashes = first_rate(inside, outside) if number == 0 else (1 / 8, 3)
            side = number % 2 == 0
            level = Level(rest.where(F.col("listed") == side).select("key"), number, math.ceil(inside * hashes / math.log(2)), hashes)
            self.levels.append(level)
            # what passes so far is found again from the bits, so only they are stored
            rest = rest.where((F.col("listed") == side) | level.has(F.col("key")))
            inside, number = rest.where(F.col("listed") != side).count(), number + 1

    def contains(self, key: Column) -> Column:
        """The first failing level decides: an odd one means listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(level.has(key), out).otherwise(F.lit(level.number % 2 == 1))
        return out & (key != "")


def first_rate(inside: int, outside: int) -> tuple[float, int]:
    """False positive rate and hashes of level 0: its size against what it leaves to later levels, which pass about an eighth."""
    rate = min(0.5, inside / (math.sqrt(2) * outside)) if outside else 0.5
    return rate, max(2, round(-math.log2(rate)))


def cascades(universe: DataFrame, max_bits: int, most_shards: int = 64) -> list[Cascade]:
    """One cascade per share of the keys (``shard_of``), as many as keep each within about ``max_bits`` bits."""
    universe = cut(universe.where("key <> ''"))
    sizes = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    inside, outside = sizes.get(True, 0), sizes.get(False, 0)
    bits = 1.5 * inside * first_rate(inside, outside)[1] / math.log(2) if inside else 0
    shards = max(1, min(most_shards, math.ceil(bits / max(max_bits, 64))))
    if shards == 1:
        return [Cascade(universe, inside, outside)]
    own = universe.withColumn("shard", shard_of(F.col("key"), shards))
    counts = {(r["shard"], r["listed"]): r["count"] for r in own.groupBy("shard", "listed").count().collect()}
    return [Cascade(own.where(F.col("shard") == i).drop("shard"), counts.get((i, True), 0), counts.get((i, False), 0)) for i in range(shards)]


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", max_bits: int = 1 << 26) -> DataFrame:
    """Per page: id, host, path, rule, verdict. ``listed``: addresses (column key) to block where no rule fits."""
    rows = pages.select(F.col(id_col), url_host(url_col).alias("host"), url_path(url_col).alias("path")).withColumn("key", F.concat("host", "path"))
    marked = rows.select("key", F.lit(True).alias("here"), F.lit(False).alias("listed")).unionByName(listed.select("key", F.lit(False).alias("here"), F.lit(True).alias("listed")))
    universe = marked.groupBy("key").agg(F.bool_or("here").alias("here"), F.bool_or("listed").alias("listed")).where("here").select("key", "listed")
    parts = cascades(universe, max_bits)
    if len(parts) == 1:
        blocked = rows.withColumn("blocked", parts[0].contains(F.col("key")))
    else:
        path = f"{shared_folder(pages.sparkSession)}/url-shards-{uuid.uuid4().hex}"
        rows.withColumn("shard", shard_of(F.col("key"), len(parts))).write.partitionBy("shard").parquet(path)
        apart = pages.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType())])).parquet(path)
        blocked = None
        for i, part in enumerate(parts):
            own = apart.where(F.col("shard") == i).drop("shard").withColumn("blocked", part.contains(F.col("key")))
            blocked = own if blocked is None else blocked.unionByName(own)
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("_rule").isNotNull(), F.col("_rule.verdict")).when(F.col("blocked"), "block").otherwise("allow")
    return blocked.withColumn("_rule", rule).select(F.col(id_col), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))


def plain_addresses(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """The query's block list: addresses that are served by plain http only."""
    seen = pages.select(F.concat(url_host(url_col), url_path(url_col)).alias("key"), F.lower(F.regexp_extract(F.col(url_col), r"(?s)^(.*?)://", 1)).alias("scheme"))
    return seen.where("key <> ''").groupBy("key").agg(F.max((F.col("scheme") != "http").cast("int")).alias("other")).where("other = 0").select("key")
