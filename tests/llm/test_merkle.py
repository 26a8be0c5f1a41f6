"""Merkle manifest: brute force, small subtrees, odd rows."""

import hashlib
import zlib

import pytest

from paneltide.llm import merkle, queries

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(row, arity):
    out = [row]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def siblings(tree, i, arity):
    steps = []
    for row in tree[:-1]:
        first = i - i % arity
        steps.append(("".join(row[first:i]), "".join(row[i + 1 : first + arity])))
        i //= arity
    return steps


def brute(rows, arity=3):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one a row."""
    leaf = lambda r: sha("".join(map(field, r)))
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(by[k], key=lambda x: x[:3])], arity) for k in keys]
    top = levels([t[-1][0] for t in trees], arity)
    out = []
    for j, k in enumerate(keys):
        for i, x in enumerate(sorted(by[k], key=lambda x: x[:3])):
            r = x[3]
            steps = siblings(trees[j], i, arity) + siblings(top, j, arity)
            even = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0
            acc = leaf((*r[:4], r[4].replace("\n", ""))) if even and r[4] is not None else x[2]
            for a, b in steps:
                acc = sha(a + acc + b)
            out.append((r[0], x[2], trees[j][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op11_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in queries.table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = brute(rows)
    assert as_rows(queries.op11_merkle_manifest(spark, f"/root/testdata/{sf}")) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize(("arity", "height", "parts"), [(3, 1, 7), (3, 2, 5), (2, 1, 9), (5, 3, 3), (3, 8, 4)])
def test_trees_of_any_height_over_many_partitions(spark, arity, height, parts):
    """One source holds two thirds of all rows; several rounds of the frontier are needed."""
    rows = [(i, "hot" if i % 3 else f"s{i % 40}", "en", i, f"text {i}\nend") for i in range(1500)] + [(i, "full and one", "en", i, "t") for i in range(3**6 + 1)] + [(i, "two to the ninth and one", "en", i, "t") for i in range(2**9 + 1)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = as_rows(merkle.audit(spark.createDataFrame(rows, DOCS), arity, height))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows, arity)


def test_sizes_around_full_trees(spark):
    rows = [(i, f"n{n}", None, None, f"{n} {i}") for n in (1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 81, 82) for i in range(n)]
    assert as_rows(merkle.audit(spark.createDataFrame(rows, DOCS), 3, 2)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, "a\nb"), (1, None, "en", 3, ""), (1, "s", "en", 3, "x"), (1, "s", "en", 3, "x"), (1, "s", "en", 3, "a\nb"),
        (-5, "é", "fr", None, "y" * 2_000_000 + "\n"), (2, "", "en", 1, "\n"), (3, "日本", None, 0, "1:a"), (4, "z", "en", 1, "t"),
    ]
    df = spark.createDataFrame(rows, DOCS)
    assert as_rows(merkle.audit(df)) == brute(rows)
    clashing = df.selectExpr("*", "'x' AS k", "1 AS o", "'y' AS digest", "2 AS kind", "3 AS _part", "4 AS leaf", "5 AS root", "6 AS n")
    assert as_rows(merkle.audit(clashing)) == brute(rows)
    assert merkle.audit(df.limit(0)).count() == 0


def test_an_only_row_proves_itself(spark):
    row = merkle.audit(spark.createDataFrame([(7, "s", "en", 1, "t")], DOCS)).first()
    assert row.leaf == row.subroot == row.root and row.verified and row.proof_sha256 == sha("")


def test_any_change_is_found(spark):
    """A proof leads to the root from the untouched leaf only; the manifest keeps the rows' own columns."""
    docs = spark.createDataFrame([(i, f"s{i % 4}", "en", i, f"t{i}") for i in range(50)], DOCS)
    made = merkle.manifest(docs.select("doc_id", "source", merkle.leaf_digest("doc_id", "text").alias("leaf")), "source", "doc_id", "leaf")
    other = docs.select("doc_id", merkle.leaf_digest("doc_id", "source").alias("other"))
    rows = made.join(other, "doc_id").select((merkle.folded("leaf") == made.root).alias("same"), (merkle.folded("other") == made.root).alias("changed")).collect()
    assert len(rows) == 50 and all(r.same and not r.changed for r in rows)
    assert made.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof"]
