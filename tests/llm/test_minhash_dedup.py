"""Near-duplicate groups: brute force, signatures, families, odd rows."""

import random
import re

import numpy as np
import pytest

from paneltide.llm import minhash_dedup, queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n=4):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(docs, percent=80):
    """(doc_id, n_shingles, component_id, kept), one a row; links by an inverted index."""
    sets = [shingle_set(t) for _, t in docs]
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                root[find(i)] = find(j)
    order = lambda x: (x is not None, x or 0)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, d), d, key=order)
    return sorted(((d, len(s), least[find(i)], d == least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_op12_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in queries.table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "text").collect()]
    assert as_rows(queries.op12_minhash_dedup(spark, f"/root/testdata/{sf}")) == brute(docs)


def test_signatures_estimate_better_than_independent_hashes():
    """Share of equal slots: right on average, and of lower variance than that of as many independent hashes."""
    rnd = np.random.default_rng(3)
    got = []
    for _ in range(400):
        pool = rnd.integers(0, 1 << 63, 30, dtype=np.uint64)
        a, b = np.sort(pool[:24]), np.sort(pool[6:])  # 18 of 30
        s = minhash_dedup.signatures(np.concatenate([a, b]), np.array([0, 24, 48]), 128)
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - 0.6) < 0.01 and np.var(got) < 0.75 * 0.6 * 0.4 / 128


def test_signatures_stop_early_without_changing():
    """A set's signature is the least of its shingles' own signatures, each of which is a permutation taken to its end."""
    rnd = np.random.default_rng(4)
    for n in (1, 2, 50, 5000):
        g = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        each = minhash_dedup.signatures(g, np.arange(len(g) + 1), 64)
        assert all(sorted((row >> np.uint64(48)).tolist()) == list(range(64)) for row in each[:50])
        assert (minhash_dedup.signatures(g, np.array([0, len(g)]), 64)[0] == each.min(axis=0)).all()


def family(rnd, size, words, changed):
    base = [f"w{rnd.randrange(10**9)}" for _ in range(words)]
    for _ in range(size):
        own = list(base)
        for _ in range(changed):
            own[rnd.randrange(words)] = f"x{rnd.randrange(10**9)}"
        yield " ".join(own)


@pytest.mark.parametrize("block", [8, 256])
def test_families_about_the_threshold(spark, block):
    """Families whose pairs lie on both sides of the threshold, so hubs miss links that blocks must find."""
    rnd = random.Random(9)
    texts = [t for changed in (1, 4, 5, 6, 7, 9) for t in family(rnd, 60, 200, changed)] + [t for _ in range(40) for t in family(rnd, 3, 60, 2)]
    rnd.shuffle(texts)
    docs = [*enumerate(texts)]
    want = brute(docs)
    assert as_rows(minhash_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string"), block=block)) == want
    sizes = {}
    for r in want:
        sizes[r[2]] = sizes.get(r[2], 0) + 1
    assert max(sizes.values()) > 20 and 1 in sizes.values()


def test_links_of_a_bucket_whose_hub_has_none(spark):
    rnd = random.Random(2)
    docs = [*enumerate(t for _ in range(25) for t in family(rnd, 12, 80, 3))]
    assert as_rows(minhash_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string"), block=2)) == brute(docs)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, " "), (8, "É a b c"), (9, "é a b c"), (None, "null id here now please"), (None, "null id here now please"),
        (10, "null ID here now please"), (11, long), (12, long + " end"), (13, "same id"), (13, "same id"), (13, "other text of id"), (14, "SAME ID"), (0, "x y z w v"), (-3, "x y z w v"), (None, None), (15, "a b"), (16, "a b"),
    ]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOCS)
    assert as_rows(minhash_dedup.groups(df)) == [(*r[:3], r[3] if r[0] is not None else True) for r in brute(docs)]
    clashing = df.selectExpr("*", "1 AS id", "2 AS id0", "'k' AS key", "3 AS hash", "4 AS hub", "5 AS root", "6 AS salt")
    assert as_rows(minhash_dedup.groups(clashing)) == as_rows(minhash_dedup.groups(df))
    assert minhash_dedup.groups(df.limit(0)).count() == 0


def test_a_pair_at_the_threshold_is_linked(spark):
    """8 of 10 shingles are shared: linked; 7 of 10 are not."""
    a = [f"a{i}" for i in range(12)]  # 9 shingles
    docs = [(1, " ".join(a)), (2, " ".join([*a[:-1], "z"])), (3, " ".join(["p", "q", "r", "s", *[f"b{i}" for i in range(20)]])), (4, " ".join(["p", "q", "r", "t", *[f"b{i}" for i in range(20)]]))]
    assert as_rows(minhash_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
    assert {r[2] for r in brute(docs)[:2]} == {1}
