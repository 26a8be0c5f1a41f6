"""Bucketed catalogue tables, files as a table, correlations, trailing medians."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneltide.operators import distribution, features
from paneltide.sources import sinks, tables


def same(got, want):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


OLD = [("a", 1, 10, "x"), ("b", 1, 10, "y"), ("c", 1, 12, "z")]


def stored(spark, tmp_path, rows):
    name = f"t_{uuid.uuid4().hex}"
    tables.write_bucketed(spark.createDataFrame(rows, "k string, g int, day int, v string"), name, ["k", "g"], 4, str(tmp_path / name))
    return spark.table(name)


def test_merges_keep_the_latest_row(spark, tmp_path):
    old = stored(spark, tmp_path, OLD)
    batch = spark.createDataFrame([("a", 1, 11, "new"), ("a", 1, 11, "newer"), ("b", 1, 9, "late"), ("c", 1, 12, "again"), ("d", 2, 1, "first"), ("d", 1, None, "undated")], "k string, g int, day int, v string")
    same(tables.merged_latest(old, batch, ["k", "g"], "day", ["v"]), [("a", 1, 11, "new"), ("b", 1, 10, "y"), ("c", 1, 12, "again"), ("d", 2, 1, "first"), ("d", 1, None, "undated")])
    same(tables.merged_latest(old, batch.limit(0), ["k", "g"], "day"), OLD)
    same(tables.merged_latest(stored(spark, tmp_path, []), batch.where("k = 'b'"), ["k", "g"], "day"), [("b", 1, 9, "late")])


def test_the_table_side_of_a_merge_is_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = stored(spark, tmp_path, [(f"k{i}", i % 3, i, "v") for i in range(500)])
        batch = spark.createDataFrame([(f"k{i}", i % 3, i + 1, "w") for i in range(0, 600, 2)], "k string, g int, day int, v string")
        merged = tables.merged_latest(old, batch, ["k", "g"], "day")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 550 and merged.where("v = 'w'").count() == 300
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_files_as_a_table(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-03", 3)], "day string, x int")
    sinks.write_days(rows, path, "day")
    (tmp_path / "files" / "notes.txt").write_text("no table")
    files = tables.file_index(spark, path)
    assert files.where("day is null").count() == 0 and files.where("bytes <= 0 or modified is null").count() == 0
    assert {r.day for r in tables.day_index(files).collect()} == {"2024-01-01", "2024-01-03"}
    same(tables.days_without_files(files, "2024-01-01", "2024-01-04"), [("2024-01-02",), ("2024-01-04",)])
    assert tables.days_without_files(files, "2024-01-01", "2024-01-04", 10**9).count() == 4
    same(tables.read_files(spark, files.where("day = '2024-01-01'"), path).select("x"), [(1,), (2,)])
    assert tables.file_index(spark, path, "*.txt").count() == 1
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_correlations_know_missing_values_pairwise(spark):
    rnd = np.random.default_rng(2)
    pdf = pd.DataFrame(rnd.normal(size=(300, 4)), columns=[*"abcd"])
    pdf["b"] += pdf.a
    pdf["d"] = 5.0
    pdf["k"] = rnd.choice(["x", "y"], 300)
    holes = pdf.mask(pd.DataFrame(rnd.random((300, 5)) < 0.2, columns=pdf.columns).assign(k=False))
    df = spark.createDataFrame(holes.astype(object).where(holes.notna(), None), "a double, b double, c double, d double, k string")
    got = {(r.k, r.a, r.b): (r.corr, r.n) for r in distribution.correlations(df, [*"abcd"], ["k"]).collect()}
    assert len(got) == 12
    for (k, a, b), (c, n) in got.items():
        both = holes[holes.k == k][[a, b]].dropna()
        assert n == len(both) and (c is None if "d" in (a, b) else abs(c - both.corr().iloc[0, 1]) < 1e-9)
    whole = {r.column: r for r in distribution.matrix(distribution.correlations(df, [*"abcd"]), [*"abcd"]).collect()}
    want = holes[[*"abc"]].corr()
    assert all(abs(whole[a][b] - want.loc[a, b]) < 1e-9 for a in "abc" for b in "abc") and whole["d"]["a"] is None
    assert distribution.correlations(df.limit(0), ["a", "b"], ["k"]).count() == 0


@pytest.mark.parametrize(("days", "block"), [(1, 64), (7, 5), (30, 10), (60, 64)])
def test_trailing_medians_equal_brute_force(spark, days, block):
    rnd = np.random.default_rng(days)
    first = dt.date(2023, 12, 20)
    rows = [("ab"[rnd.integers(0, 2)] if i % 10 else None, first + dt.timedelta(int(x)), float(rnd.integers(0, 30)) if i % 13 else None) for i, x in enumerate(rnd.integers(0, 120, 600))] + [("a", None, 1.0), ("gap", first, 2.0), ("gap", first + dt.timedelta(400), 4.0)]
    df = spark.createDataFrame(rows, "k string, day date, x double")
    got = features.trailing_days_median(df, ["k"], "day", "x", days, block_days=block)

    def brute(k, day):
        own = [x for a, d, x in rows if a == k and d and day and x is not None and 1 <= (day - d).days <= days]
        return float(np.median(own)) if own else None

    same(got, [(*r, brute(r[0], r[1])) for r in rows])
    assert features.trailing_days_median(df.limit(0), ["k"], "day", "x", days).count() == 0
