"""Sketches, running gaps, ranks by range partitions, elastic nets and folds."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from oracle import assert_same
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from paneltide.functions import arrays
from paneltide.models import elastic_net, regression
from paneltide.operators import panel, ranks, sketches
from paneltide.plans import catalogue, spans
from paneltide.sources import readers, sinks

SF = "/root/testdata/sf0.001"
OWN = [n for n, f in catalogue.QUERIES.items() if n in vars(spans)]


def same(got, want):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_the_queries_are_registered():
    assert len(OWN) == 21 and sum(n in catalogue.SQL for n in OWN) == 20


@pytest.mark.parametrize("name", [n for n in OWN if n.startswith("sketched")])
def test_sketches_on_more_rows(spark, name):
    """Enough rows that sketches are lossy."""
    assert_same(spark, catalogue.QUERIES[name], catalogue.SQL[name], "/root/testdata/sf0.1")


# --- sketches


@pytest.fixture(scope="module")
def prices(spark):
    rnd = np.random.default_rng(3)
    rows = pd.DataFrame({"k": rnd.choice(["hot", "b", "c"], 60_000, p=[0.8, 0.15, 0.05]), "day": rnd.integers(1, 29, 60_000), "x": np.round(np.exp(rnd.normal(4, 1.5, 60_000)), 2), "id": rnd.integers(0, 20_000, 60_000)})
    rows["day"] = rows.day.map("2024-02-{:02d}".format)
    return rows, spark.createDataFrame(rows)


@pytest.mark.parametrize("k", [50, 200, 1000])
def test_merged_quantiles_keep_their_rank_error(spark, prices, k):
    rows, df = prices
    merged = sketches.merge(sketches.merge(sketches.sketch(df, ["k", "day"], ["x"], k=k), ["k", "day"]), ["k"])
    qs = {f"q{i}": q for i, q in enumerate((0.0, 0.1, 0.5, 0.9, 0.99, 1.0))}
    for r in sketches.statistics(merged, ["k"], "x", qs).collect():
        own = np.sort(rows.x[rows.k == r.k].to_numpy())
        assert r.n == len(own) and r.least == own[0] == r.q0 and r.most == own[-1] == r.q5
        assert abs(r["mean"] - own.mean()) < 1e-8 * own.mean() and abs(r["std"] - own.std(ddof=1)) < 1e-6 * own.std()
        for name, q in qs.items():
            low, high = np.searchsorted(own, r[name], "left") / len(own), np.searchsorted(own, r[name], "right") / len(own)
            assert low - sketches.rank_error(k) <= q <= high + sketches.rank_error(k)


def test_stored_days_merge_and_replace_themselves(spark, prices, tmp_path):
    """A span reads sketches only; a late day is sketched again and counts once."""
    rows, df = prices
    path = str(tmp_path / "sketches")
    sinks.write_days(sketches.sketch(df.where("day <> '2024-02-07' or id % 2 = 0"), ["k", "day"], ["x"], ["id"]), path, "day")
    sinks.write_days(sketches.sketch(df.where("day = '2024-02-07'"), ["k", "day"], ["x"], ["id"]), path, "day")
    span = sketches.merge(readers.read_days(spark, path, "2024-02-05", "2024-02-11"), ["k"])
    got = {r.k: r for r in span.select("k", "rows", sketches.distinct_count("id").alias("ids")).collect()}
    own = rows[rows.day.between("2024-02-05", "2024-02-11")]
    for k, part in own.groupby("k"):
        assert got[k].rows == len(part) and abs(got[k].ids / part.id.nunique() - 1) < 4 * sketches.distinct_error(12)
    assert "x" not in span.columns and "PartitionFilters" in span._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lg_k", [8, 12])
def test_unions_equal_the_one_pass_sketch(spark, prices, lg_k):
    _, df = prices
    merged, once = sketches.merge(sketches.sketch(df, ["k", "day"], distinct=["id"], lg_k=lg_k), ["k"]), sketches.sketch(df, ["k"], distinct={"id": F.col("id")}, lg_k=lg_k)
    estimate = lambda s, name: sketches.merge(s.unionByName(s), ["k"]).select("k", sketches.distinct_count("id").alias(name))
    rows = estimate(merged, "a").join(estimate(once, "b"), "k").collect()
    assert len(rows) == 3 and all(r.a == r.b for r in rows)


def test_sketches_of_odd_rows(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 3.0), (None, 1, 5.0), (None, 2, 7.0)], "k string, day int, x double")
    merged = sketches.merge(sketches.sketch(df, ["k", "day"], ["x"], ["x"]), ["k"])
    same(sketches.statistics(merged, ["k"], "x"), [("a", 0, None, None, None, None, None), ("b", 1, 3.0, None, 3.0, 3.0, 3.0), (None, 2, 6.0, 2**0.5, 5.0, 7.0, 5.0)])
    same(merged.select("k", sketches.distinct_count("x")), [("a", 0), ("b", 1), (None, 2)])
    assert sketches.merge(sketches.sketch(df.limit(0), ["k", "day"], ["x"]), ["k"]).count() == 0


def test_ratio_to_a_sketched_median(spark):
    df = spark.createDataFrame([("a", 1.0, 9), ("a", 2.0, 9), ("a", 6.0, 9), ("a", 7.0, 1), ("b", 5.0, 1), ("b", None, 1)], "k string, x double, n int")
    stored = sketches.sketch(df, ["k"], ["x"])
    same(sketches.ratio_to_median(df, stored, ["k"], "x", 2.0).select("k", "x"), [("a", 1.0), ("a", 2.0), ("b", 5.0)])
    same(sketches.ratio_to_median(df, stored, ["k"], "x", 2.0, "n", 5).select("k", "x"), [("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", 5.0)])


# --- running gaps


def test_running_gaps_equal_recomputing_each_prefix(spark):
    rnd = np.random.default_rng(6)
    rows = [(k, i, int(x)) for k, p in (("a", 0.5), ("b", 0.9), ("c", 0.05), ("d", 0.0), ("e", 1.0)) for i, x in enumerate(rnd.random(60) < p)]
    df = spark.createDataFrame(rows, "k string, day int, seen int")
    got = panel.running_gaps(df, ["k"], "day", "seen")
    before = df.alias("x").join(df.alias("y"), F.expr("x.k = y.k and y.day <= x.day")).groupBy("x.k", "x.day").agg(F.array_sort(F.collect_list(F.struct("y.day", "y.seen"))).alias("h"))
    want = before.select("k", "day", arrays.run_stats(F.transform("h", lambda x: x["seen"])).alias("s"), F.size("h").alias("n")).select("k", "day", "n", "s.*")
    keyed = lambda d: {(r.k, r.day): r for r in d.collect()}
    mine, theirs = keyed(got), keyed(want)
    assert mine.keys() == theirs.keys() and len(mine) == 300
    for key, w in theirs.items():
        g = mine[key]
        assert (g.rows_so_far, g.num_gaps, g.max_gap) == (w.n, w.num_gaps, w.max_gap) and abs(g.avg_gap - w.avg_gap) < 1e-12
        assert g.max_gap_share == w.max_gap / w.n and g.num_gaps_share == w.num_gaps / w.n


def test_running_gaps_of_known_series(spark):
    df = spark.createDataFrame([("s", i, x) for i, x in enumerate([1, 0, 0, 1, 0])], "k string, day int, seen int")
    same(panel.running_gaps(df, ["k"], "day", "seen").select("day", "num_gaps", "avg_gap", "max_gap"), [(0, 0, 0.0, 0), (1, 1, 1.0, 1), (2, 1, 2.0, 2), (3, 1, 2.0, 2), (4, 2, 1.5, 2)])


def test_days_missing_from_the_source_are_adjusted_for(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, x)) for x in (1, 2, 2, 5)] + [("b", dt.date(2024, 1, 10))], "k string, day date")
    same(panel.coverage_of_span(df, ["k"], "day"), [("a", 3, 4, 10, 4, 0.3, 0.75), ("b", 1, 1, 10, 4, 0.1, 0.25)])
    assert panel.coverage_of_span(df.limit(0), ["k"], "day").count() == 0


# --- ranks


def test_ranks_without_a_one_task_window(spark):
    rnd = np.random.default_rng(7)
    rows = [(int(i), "hot" if i % 3 else [None, "a", "b"][i % 2], int(rnd.integers(0, 50)), int(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string, v int, w int").repartition(9)
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    same(ranks.row_numbers(df, ["v", "id"]).select("id", "row_number"), [(r[0], i + 1) for i, r in enumerate(order)])
    seen, want = {}, []
    for r in order:
        n, total, top, low, bits = seen.get(r[1], (0, 0, -1, 99, 0))
        seen[r[1]] = n + 1, total + r[3], max(top, r[3]), min(low, r[3]), bits ^ r[0]
        want.append((r[0], *seen[r[1]]))
    got = ranks.running(df, ["k"], ["v", "id"], {"n": ("count", "id"), "total": ("sum", "w"), "top": ("max", "w"), "low": ("min", "w"), "bits": ("xor", "id")})
    same(got.select("id", "n", "total", "top", "low", "bits"), want)
    plan = ranks.row_numbers(df, ["v", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("parts", [2, 9])
def test_previous_values_cross_partitions(spark, parts):
    rnd = np.random.default_rng(parts)
    rows = [(int(i), "hot" if i % 3 else [None, "a", "b", "c"][i % 4], int(rnd.integers(0, 40)) if i % 17 else None, float(i) if i % 5 else None) for i in range(800)]
    want, last = [], {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0])):
        want.append((r[0], last.get(r[1])))
        last[r[1]] = r[3]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranks.previous(spark.createDataFrame(rows, "id int, k string, v int, x double"), ["k"], ["v", "id"], "x", "before")
        same(got.select("id", "before"), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["id", "k", "v", "x", "before"]


def test_ranks_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 5.0), (4, None), (5, 9.0)], "id int, x double")
    same(ranks.placed(df, "x"), [(5.0, 2, 0, 3), (9.0, 1, 2, 3)])
    same(ranks.row_numbers(df, ["x", "id"]).select("id", "row_number"), [(1, 1), (4, 2), (2, 3), (3, 4), (5, 5)])
    assert ranks.row_numbers(df.limit(0), ["x"]).count() == ranks.placed(df.limit(0), "x").count() == 0
    assert ranks.running(df.limit(0), ["id"], ["x"], {"n": ("count", "x")}).count() == 0
    same(ranks.running(df, [], ["id"], {"s": ("sum", "x")}).select("id", "s"), [(1, None), (2, 5.0), (3, 10.0), (4, 10.0), (5, 19.0)])


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_exact_quantiles_by_selection(spark, keys):
    rnd = np.random.default_rng(8)
    rows = [([None, "a", "hot"][min(2, int(i % 9))], float(rnd.integers(0, 300)) / 4 if i % 11 else None) for i in range(2000)] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(7)
    qs = {"a0": 0.0, "a1": 0.05, "a2": 0.5, "a3": 0.77, "a4": 1.0}
    got = {r.k if keys else None: r for r in ranks.quantiles(df, "x", qs, keys).collect()}
    assert set(got) == ({None, "a", "hot", "one"} if keys else {None})
    for k, r in got.items():
        own = [x for y, x in rows if x is not None and (not keys or y == k)]
        assert np.allclose([r[n] for n in qs], np.quantile(own, [*qs.values()]))
    assert ranks.quantiles(df.limit(0), "x", qs, ["k"]).count() == 0 and ranks.quantiles(df.limit(0), "x", qs).first().a2 is None


def test_scores_against_another_sample(spark):
    own = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", 4.0), ("a", None), ("b", 3.0), (None, 2.0)], "k string, x double")
    sample = spark.createDataFrame([("a", 1), ("a", 4), ("a", 4), ("a", 9), (None, 2), ("a", None)], "k string, y int")
    got = ranks.score_against(own, "x", sample, "y", ["k"])
    same(got, [("a", 1.0, 0.0, 25.0, 12.5), ("a", 4.0, 25.0, 75.0, 50.0), ("a", 4.0, 25.0, 75.0, 50.0), ("a", None, None, None, None), ("b", 3.0, None, None, None), (None, 2.0, 0.0, 100.0, 50.0)])
    same(ranks.score_against(own.where("k = 'b'"), "x", sample, "y").select("weak"), [(40.0,)])


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("kind", ["double", "decimal(9,2)"])
@pytest.mark.parametrize("every", [1, 4, 10**6])
def test_scores_do_not_depend_on_cuts(spark, keys, kind, every):
    """With many, some and no cuts: common values, both zeros, NaN, nulls, keys that only one side has."""
    rnd = random.Random(every)
    draw = lambda n, ks: [(i, rnd.choice(ks), rnd.choice([7.0, 7.0, None, 0.0, *([-0.0, float("nan")] if kind == "double" else []), rnd.randrange(-40, 160) / 4])) for i in range(n)]
    mine, theirs = draw(300, ["a", "b", None, "mine"]), draw(400, ["a", "b", None, "theirs"])
    own, sample = (spark.createDataFrame(r, "id int, k string, x double").withColumn("x", F.col("x").cast(kind)) for r in (mine, theirs))
    out = ranks.score_against(own, "x", sample, "x", keys, share=1.0, every=every)
    assert out.dtypes[:3] == own.dtypes
    order = lambda x: (x != x, 0.0 if x != x else x)  # noqa: E731  NaN is greatest, and equal to itself
    want = {}
    for i, k, x in mine:
        held = [order(y) for _, key, y in theirs if y is not None and (not keys or key == k)]
        less, up_to = (0, 0) if x is None else (sum(y < order(x) for y in held), sum(y <= order(x) for y in held))
        want[i] = (k, None if x is None else order(x), *((None,) * 3 if x is None or not held else (100 * n / len(held) for n in (less, up_to, (less + up_to) / 2))))
    got = {r.id: (r.k, None if r.x is None else order(float(r.x)), r.strict, r.weak, r.score) for r in out.collect()}
    assert got.keys() == want.keys() and len(mine) == out.count()
    for i, row in want.items():
        assert got[i][:2] == row[:2] and got[i][2:] == pytest.approx(row[2:])


# --- elastic nets


def market_rows(spark, n=400, seed=5):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 3)) * [1.0, 20.0, 0.1] + [3.0, -40.0, 0.0]
    k = rnd.choice(["a", "b"], n)
    y = np.exp(0.4 * x[:, 0] - 0.01 * x[:, 1] + np.where(k == "a", 2.0, -1.0) * x[:, 2] + rnd.normal(size=n) * 0.2)
    days = [dt.date(2024, 1, 1) + dt.timedelta(int(i)) for i in rnd.integers(0, 100, n)]
    pdf = pd.DataFrame({"k": k, "x1": x[:, 0], "x2": x[:, 1], "x3": x[:, 2], "flat": 7.0, "y": y, "day": days})
    return pdf, spark.createDataFrame(pdf)


PENALTIES = [(0.0, 0.5), (0.01, 0.0), (0.05, 0.5), (0.2, 1.0), (5.0, 1.0)]


def test_elastic_nets_equal_the_library_per_market(spark):
    pdf, df = market_rows(spark)
    features = ["x1", "x2", "x3", "flat"]
    got = {(r.k, r.alpha, r.l1_ratio): r for r in elastic_net.fit(df, ["k"], features, "y", PENALTIES).collect()}
    assert len(got) == 2 * len(PENALTIES)
    for k in "ab":
        rows = VectorAssembler(inputCols=features, outputCol="features").transform(df.where(F.col("k") == k).withColumn("label", F.log("y")))
        for alpha, l1 in PENALTIES:
            # the library divides the squared part by the label's deviation
            a, b = alpha * l1, alpha * (1 - l1) * rows.agg(F.stddev_pop("label")).first()[0]
            want = LinearRegression(regParam=a + b, elasticNetParam=a / (a + b) if a + b else 0.0, maxIter=2000, tol=1e-12).fit(rows)
            r = got[k, alpha, l1]
            assert np.allclose(r.weights, [want.intercept, *want.coefficients], rtol=1e-4, atol=1e-5), (k, alpha, l1)
            assert r.weights[-1] == 0 and abs(r.mse - want.summary.meanSquaredError) < 1e-6
    assert got["a", 5.0, 1.0].weights[1:] == [0, 0, 0, 0]


def test_predictions_are_exponentials(spark):
    pdf, df = market_rows(spark)
    fitted = elastic_net.fit(df, ["k"], ["x1", "x2", "x3"], "y", [(0.0, 0.5)])
    off = elastic_net.predict(df, fitted, ["k"], ["x1", "x2", "x3"]).select(F.avg(F.abs(F.log(F.col("prediction") / F.col("y"))))).first()[0]
    assert off < 0.2


def refit(pdf, train, columns, alpha, l1):
    m = elastic_net.unpacked(len(pdf[train]), pdf[train][[*columns, "_y"]].mean(), (np.cov(pdf[train][[*columns, "_y"]].T, bias=True) * train.sum())[np.triu_indices(len(columns) + 1)])
    return elastic_net.solved(m, [(alpha, l1)])[0]


def test_folds_equal_refitting(spark):
    """Each fold's fit and error equal those found from its rows; no day is in two folds."""
    pdf, df = market_rows(spark)
    columns = ["x1", "x2", "x3"]
    pdf["_y"] = np.log(pdf.y)
    first, last = min(pdf.day), max(pdf.day)
    pdf["fold"] = [(d - first).days * 4 // ((last - first).days + 1) for d in pdf.day]
    got = elastic_net.cross_validate(df, ["k"], columns, "y", "day", PENALTIES, folds=4).collect()
    assert len(got) == 2 * 4 * len(PENALTIES)
    for r in got:
        own = pdf[pdf.k == r.k]
        train, test = own.fold != r.fold, own[own.fold == r.fold]
        w = refit(own, train, columns, r.alpha, r.l1_ratio)
        assert (r.n_train, r.n_test) == (train.sum(), len(test)) and np.allclose(r.weights, w, rtol=1e-6, atol=1e-9)
        assert abs(r.mse - np.mean((test._y - w[0] - test[columns].to_numpy() @ w[1:]) ** 2)) < 1e-9
    folds = df.select("day", elastic_net.fold_of(F.col("day"), first, last, 4).alias("f"))
    assert folds.groupBy("day").agg(F.count_distinct("f").alias("n")).agg(F.max("n")).first()[0] == 1
    assert sorted(r.f for r in folds.select("f").distinct().collect()) == [0, 1, 2, 3]


def test_masked_rows_leave_training(spark):
    """A row that took a feature from a day of the fold isn't trained on for that fold."""
    pdf, df = market_rows(spark)
    pdf["_y"] = np.log(pdf.y)
    first, last = min(pdf.day), max(pdf.day)
    fold = lambda d: (d - first).days * 5 // ((last - first).days + 1)
    pdf["fold"], pdf["other"] = [fold(d) for d in pdf.day], [fold(max(first, d - dt.timedelta(9))) for d in pdf.day]
    rows = df.withColumn("src", F.greatest(F.lit(first), F.date_sub("day", 9)))
    got = elastic_net.cross_validate(rows, ["k"], ["x1", "x2"], "y", "day", [(0.01, 0.5)], folds=5, sources=["src"]).collect()
    assert len(got) == 10
    for r in got:
        own = pdf[pdf.k == r.k]
        train = (own.fold != r.fold) & (own.other != r.fold)
        assert r.n_train == train.sum() < (own.fold != r.fold).sum() or r.fold == 4
        assert np.allclose(r.weights, refit(own, train, ["x1", "x2"], 0.01, 0.5), rtol=1e-6, atol=1e-9)


def test_the_best_penalty_of_a_group(spark):
    scores = spark.createDataFrame([("a", 0, 0.1, 0.5, 10, 1.0), ("a", 1, 0.1, 0.5, 30, 2.0), ("a", 0, 0.2, 0.5, 10, 5.0), ("a", 1, 0.2, 0.5, 30, 1.0), ("b", 0, 0.1, 0.5, 5, 1.0), ("b", 0, 0.2, 0.5, 5, 1.0)], "k string, fold int, alpha double, l1_ratio double, n_test long, mse double")
    same(elastic_net.best_penalties(scores, ["k"]), [("a", 0.1, 0.5, 1.75, 2), ("b", 0.2, 0.5, 1.0, 1)])


def test_odd_rows_of_fits(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, dt.date(2024, 1, 1)), ("a", None, 2.0, dt.date(2024, 1, 2)), ("a", 2.0, -1.0, dt.date(2024, 1, 3)), ("a", 3.0, 5.0, dt.date(2024, 1, 9)), ("b", 1.0, 1.0, None)], "k string, x double, y double, day date")
    assert [(r.k, r.n) for r in elastic_net.fit(df, ["k"], ["x"], "y", [(0.0, 0.5)]).collect()] == [("a", 2)]
    got = elastic_net.cross_validate(df, ["k"], ["x"], "y", "day", [(0.0, 0.5)], folds=2, least_rows=1).collect()
    assert sorted((r.fold, r.n_train, r.n_test) for r in got) == [(0, 1, 1), (1, 1, 1)]
    assert elastic_net.cross_validate(df.limit(0), ["k"], ["x"], "y", "day", [(0.0, 0.5)]).count() == 0


def test_fits_agree_with_least_squares(spark):
    _, df = market_rows(spark)
    ours = {r.k: r.weights for r in elastic_net.fit(df, ["k"], ["x1", "x2"], "y", [(0.0, 0.0)], log_label=False).collect()}
    theirs = {r.k: r.weights for r in regression.fit_per_group(df, ["k"], ["x1", "x2"], "y", ridge=0.0).collect()}
    assert all(np.allclose(ours[k], theirs[k], rtol=1e-6) for k in "ab")


def test_requested_and_answered_types(spark):
    df = spark.createDataFrame([(1, ["ADT1", "CNN2", "INF"], ["ADT", "CNN", "ADT"], [10.0, 5.0, 0.0]), (2, ["ITX1", "ADT"], ["ADT", None], [7.0, 8.0]), (3, None, ["ADT"], [1.0])], "id int, asked array<string>, got array<string>, prices array<double>")
    same(arrays.amounts_of_type(df, "asked", "got", "prices", "ADT"), [(1, "ADT1", "ADT", 10.0, False)])
    same(arrays.amounts_of_type(df, "asked", "got", "prices", "ADT", require_request=False), [(1, "ADT1", "ADT", 10.0, False), (1, "INF", "ADT", 0.0, True), (2, "ITX1", "ADT", 7.0, True)])
