"""Prefix trie: brute force, shards and upper levels, odd rows, the bit vector."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from paneltide.llm import prefix_trie, queries

CONVS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one a node."""
    label = lambda r: hashlib.md5(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    by = {}
    for r in rows:
        if r[0] is not None:
            by.setdefault(r[0], []).append(r)
    turns = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=lambda r: (r[1] is not None, r[1] or 0, label(r)))] for c, v in by.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        seq = turns.get(head, [])[:h] + own[h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) if below else 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1]) if k else 0) + sum(saved[x] for x in below)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], sha(ends.get(k, []))) for k, m in members.items()), key=str
    )


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_op13_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in queries.table(spark, f"/root/testdata/{sf}", "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(queries.op13_prefix_trie(spark, f"/root/testdata/{sf}")) == brute(rows)


@pytest.mark.parametrize("heavy", [1, 2, 5, 40, 10_000])
def test_shards_and_upper_levels(spark, heavy):
    """Few distinct turns: long shared starts, copies of whole conversations, a long one; gaps in the ids and missing heads."""
    rnd = random.Random(heavy)
    rows = []
    for c in [x for x in range(420) if x % 7 and x != 200]:
        rows += [(c, t, rnd.choice("ua"), rnd.choice(["", "a", "bb", "ccc"][: 1 + c % 4])) for t in range(rnd.choice([1, 2, 3, 6, 9]))]
    rows += [(300, t, "u", f"{t % 3}") for t in range(300)] + [(301, t, "u", f"{t % 3}") for t in range(300)]
    assert as_rows(prefix_trie.shared_starts(spark.createDataFrame(rows, CONVS), heavy)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "u", "x"), (0, None, "u", "first"), (0, 1, None, None), (0, 1, None, None), (0, 1, "a", "tie"), (0, 2, "u", "é" * 500_000), (-1, 5, "u", "neg"), (-107, 1, "u", "neg"),
        (1, 3, "u", "only"), (2, 1, "u", ""), (2, 2, "", "u"), (99, 0, "a", "end"), (150, 0, "u", "no head"), (10**15, 0, "u", "far"),
    ]
    df = spark.createDataFrame(rows, CONVS)
    assert as_rows(prefix_trie.shared_starts(df)) == brute(rows)
    assert as_rows(prefix_trie.shared_starts(df, 1)) == brute(rows)
    assert as_rows(prefix_trie.shared_starts(df.selectExpr("*", "1 AS pos", "'l' AS label", "2 AS size", "3 AS depth", "4 AS ka", "5 AS _part", "6 AS h", "7 AS head"))) == brute(rows)
    assert prefix_trie.shared_starts(df.limit(0)).count() == 0
    assert prefix_trie.shared_starts(df.where("conv_id is null")).count() == 0


def test_only_turnless_conversations(spark):
    """Ids whose only turn is before their first h, without a head: all end at the root."""
    ids = [c for c in range(1, 400) if c % 100 and zlib.crc32(str(c).encode()) % 6 >= 1][:20]
    rows = [(c, 0, "u", "gone") for c in ids]
    got = as_rows(prefix_trie.shared_starts(spark.createDataFrame(rows, CONVS)))
    assert got == brute(rows) and len(got) == 1 and got[0][:7] == (min(ids), 0, None, 20, 0, 1, 0)


def test_bit_vector_gives_the_tree_back():
    rnd = np.random.default_rng(5)
    for n in (0, 1, 2, 30, 500):
        parent = np.array([-1 if i == 0 or rnd.random() < 0.05 else rnd.integers(0, i) for i in range(n)], np.int64)
        level = np.zeros(n, np.int64)
        for i in range(n):
            level[i] = 0 if parent[i] < 0 else level[parent[i]] + 1
        louds = prefix_trie.Louds(parent, level)
        assert louds.size == 2 * n + 1
        back = louds.parents()
        place = np.empty(n, np.int64)
        place[louds.order] = np.arange(n)
        assert all(back[place[i]] == (place[parent[i]] if parent[i] >= 0 else -1) for i in range(n))
        assert louds.degrees().tolist() == [int((parent == i).sum()) for i in louds.order]
        sums = louds.rolled_up(np.ones(n, np.int64))
        assert sums[back < 0].sum() == n
