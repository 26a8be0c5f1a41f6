import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from paneltide.functions import arrays, codec, dates
from paneltide.operators import distribution, features, lowest, panel, restrict, trips


def day(s):
    return dt.date.fromisoformat(s)


def test_int_dates(spark):
    df = spark.createDataFrame([(0,), (None,), (20240229,), (20230229,), (20241301,)], "i int")
    assert [r[0] for r in df.select(dates.int_to_date(F.col("i"))).collect()] == [None, None, day("2024-02-29"), None, None]


def test_calendar(spark):
    df = spark.createDataFrame([(day("2024-07-05"),), (day("2024-07-08"),)], "d date")
    got = df.select(dates.weekday(F.col("d")), *dates.near_weekend_or_holiday(F.col("d"), ["2024-07-04"]).values(), dates.is_weekend(F.col("d"), True)).collect()
    assert [tuple(r) for r in got] == [(4, 1, 0, 1, True), (0, 1, 0, 0, False)]
    assert spark.range(1).select(dates.key_of(F.lit("A"), F.lit(None).cast("string"))).first()[0] is None


def test_codec_round_trip(spark):
    known = {"US": 353566720, "USD": 353567744, "LAX": 201398272, "EWR": 85398016}
    df = spark.createDataFrame([(k, v) for k, v in known.items()] + [("", 0), ("ABCD", None)], "s string, n long")
    for r in df.select("s", "n", codec.encode(F.col("s")).alias("e"), codec.decode(codec.encode(F.col("s"))).alias("d")).collect():
        assert r.d == r.s and (r.n is None or r.e == r.n)


CASES = [(["ADT", "INF"], [1.0, 0.0]), (["INF", "ADT"], [0.0, 9.0]), (["ADT"], [1.0, 2.0]), ([], []), (None, [1.0]), (["ADT", None], [None, 3.0])]


def test_aligned_unnest_equals_posexplode_product(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "id int, c struct<a:array<string>,b:array<double>>").select("id", "c.a", "c.b")
    got = {tuple(r) for r in arrays.aligned_unnest(df, ["a", "b"], ["x", "y"]).collect()}
    chained = df.select("id", "b", F.posexplode("a").alias("i", "x")).select("id", "i", "x", F.posexplode("b").alias("j", "y")).where("i = j and x is not null and y is not null")
    assert got == {(r.id, r.x, r.y) for r in chained.collect()} and len(got) == 5


def test_availability(spark):
    df = spark.createDataFrame([([],), (["009"],), (["009", "1"],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(arrays.only(F.col("a"), "009")).collect()] == [True, True, False, None]


def brute_gaps(v):
    runs = [len(list(g)) for k, g in itertools.groupby(v) if k == 0]
    return (len(runs), sum(runs) / len(runs) if runs else 0.0, max(runs, default=0))


def test_gap_stats_both_ways(spark):
    rnd = random.Random(3)
    series = [[1, 1, 1], [0], [1, 0, 0, 1, 0], [0, 0, 0]] + [[rnd.randint(0, 1) for _ in range(rnd.randint(1, 30))] for _ in range(40)]
    flat = spark.createDataFrame([(k, i, x) for k, v in enumerate(series) for i, x in enumerate(v)], "k int, d int, f int")
    native = {r.k: (r.num_gaps, r.avg_gap, r.max_gap) for r in panel.gap_stats(flat, ["k"], "d", "f").collect()}
    folded = {r.k: tuple(r.g) for r in spark.createDataFrame(list(enumerate(series)), "k int, v array<int>").select("k", arrays.run_stats(F.col("v")).alias("g")).collect()}
    for k, v in enumerate(series):
        assert native[k] == pytest.approx(brute_gaps(v)) and folded[k] == pytest.approx(brute_gaps(v))


def test_trips(spark):
    rows = [("A", "B", "B", "A"), ("A", "B", None, None), ("A", "B", "B", "C"), ("A", "B", None, "A"), ("A", "B", "0", "0")]
    df = spark.createDataFrame(rows, "o string, d string, io string, id string")
    assert [r.round_trip for r in trips.classify_trip(df, "o", "d", "io", "id").collect()] == [1, 0]
    assert trips.classify_trip(df, "o", "d", "io", "id", none="0").where("round_trip = 0").count() == 2


def test_latest_has_one_row_per_key_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("a", 2, 6.0), ("b", None, 1.0)], "k string, d int, v double")
    assert sorted(tuple(r) for r in lowest.latest_per_key(df, ["k"], "d", ["v"]).collect()) == [("a", 2, 6.0), ("b", None, 1.0)]


def test_argmin_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 2), ("a", 2.0, 3), (None, 0.5, 4), ("b", None, 5)], "k string, v double, i int")
    assert sorted(r.i for r in lowest.argmin_rows(df, ["k"], "v").collect()) == [1, 2]


def test_rank_collapse_with_a_single_rank(spark):
    df = spark.createDataFrame([("m", 1, 10.0, "x"), ("m", 2, 12.0, "y"), ("m", 3, 10.0, "z"), ("n", 4, 5.0, "x")], "k string, s int, f double, c string")
    out = {r.k: r for r in lowest.collapse_ranks(lowest.rank_panel(lowest.value_ranks(df, ["k"], "f", "s"), ["k"], "f", "c"), ["k"]).collect()}
    assert out["m"].carriers == ["x", "z"] and out["m"].value_step == 2.0 and out["m"].shared_carriers == 0 and out["m"].group_searches == 3
    assert out["n"].next_value is None


def test_ratio_modes(spark):
    df = spark.createDataFrame([("a", 10.0, 1), ("a", 10.0, 5), ("a", 40.0, 1), ("a", 40.0, 9), ("z", 0.0, 1)], "k string, v double, n int")
    assert restrict.ratio_filter(df, ["k"], "v", 1.2).count() == 2
    assert sorted(r.n for r in restrict.ratio_filter(df, ["k"], "v", 1.2, "mean", "n", 5).collect()) == [1, 5, 9]


def test_single_row_key_has_no_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 1.2)], "k string, v double")
    assert [r.k for r in restrict.spread(df, ["k"], "v").collect()] == ["b"]


def test_combos_and_volume(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("b", 1, 1), ("c", None, 1), ("c", 1, 1)], "k string, x int, v int")
    assert {r.k for r in restrict.full_combos(df, ["k"], ["x"], 2).collect()} == {"a", "c"}
    assert [r.k for r in restrict.volume_ranks(df, ["k"], "v").orderBy("volume_rank").collect()] == ["a", "b", "c"]


def test_bounds_of_days(spark):
    df = spark.createDataFrame([(0, 1), (1, None), (60, 21), (61, 22), (62, 1)], "lead int, stay int")
    assert restrict.within_days(df, "lead", "stay", (1, 60), (1, 21)).count() == 2
    assert restrict.within_days(df, "lead", "stay", (1, 60), (1, 21), slack=1).count() == 3


def test_densify_has_the_grid(spark):
    grid = panel.date_grid(spark, "2024-01-01", "2024-01-03", [3, 7], 5)
    seen = grid.limit(4).withColumn("n", F.lit(2))
    out = panel.densify(grid, seen, ["service_day", "stay", "seen_day"], ["n"])
    assert out.count() == grid.count() == 30 and out.agg(F.sum("n")).first()[0] == 8


def test_cumulative_share_ends_at_one(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "k string, n int")
    out = distribution.cumulative_shares(df, "n", ["k"]).orderBy("rank").collect()
    assert out[-1].cum_share == 1.0 and out[0].share == 0.5
    empty = distribution.volume_threshold(distribution.cumulative_shares(df, "n", ["k"]), [0.5, 0.81]).orderBy("level").collect()
    assert [r["rank"] for r in empty] == [1, 3]


def test_last_bucket_is_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.1,), (None,)], "v double")
    assert {r.bucket: r["rows"] for r in distribution.bucket_histogram(df, "v", [0, 1, 2]).collect()} == {0: 1, 1: 2}


def test_features_leave_their_own_target_out(spark):
    df = spark.createDataFrame([("m", day(f"2024-01-0{i}"), float(i)) for i in (1, 2, 5, 6)], "m string, d date, v double")
    assert [r.encoded for r in features.target_encode(df, ["m"], "d", "v").orderBy("d").collect()] == [None, 1.0, 1.5, pytest.approx(8 / 3)]
    assert [r.trail_days_mean for r in features.trailing_days(df, ["m"], "d", "v", 3).orderBy("d").collect()] == [None, 1.0, 2.0, 5.0]
    got = features.shifted(df, "v", {"s": (["m"], "d")}, [1], [1]).orderBy("d").collect()
    assert [(r.s_prev_1, r.s_next_1, r.s_gap) for r in got] == [(None, 2.0, None), (1.0, 5.0, 1), (2.0, 6.0, 3), (5.0, None, 1)]


def test_row_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(features.row_mean("a", "b")).collect()] == [2.0, 3.0, None]
