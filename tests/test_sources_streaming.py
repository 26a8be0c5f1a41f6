import datetime as dt

import pytest
from pyspark.sql import functions as F

from paneltide.sources import readers, sinks
from paneltide.streaming import incremental


def test_days_are_replaced_not_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)], "day string, v int")
    sinks.write_days(df, path, "day")
    sinks.write_days(df.where("day = '2024-01-02' and v = 3"), path, "day")
    got = readers.read_days(spark, path, "2024-01-01", "2024-01-02")
    assert sorted(r.v for r in got.collect()) == [1, 3]
    one = readers.read_days(spark, path, "2024-01-02", "2024-01-02")
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1


def test_missing_paths_and_versions(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1, 5)], "id int, solution_count int").write.parquet(a)
    spark.createDataFrame([(2, 6, None), (3, None, 7)], "id int, solution_counts int, solution_count int").write.parquet(b)
    assert readers.read_existing(spark, [str(tmp_path / "none")]) is None
    both = readers.union_versions([spark.read.parquet(a), spark.read.parquet(b)], {"solution_count": "solution_counts"}, {"id": "int", "solution_counts": "bigint"})
    assert sorted(map(tuple, both.collect())) == [(1, 5), (2, 6), (3, 7)]
    assert readers.read_existing(spark, [a, str(tmp_path / "none")]).count() == 1


def test_lists_files_and_bounds(spark, tmp_path):
    f = tmp_path / "list.txt"
    f.write_text("# head\nAAA-BBB\n\n CCC-DDD \n#x")
    assert [r.value for r in readers.read_list(spark, str(f)).collect()] == ["AAA-BBB", "CCC-DDD"]
    c = tmp_path / "dim.csv"
    c.write_text("code,place\nA,x\n")
    assert readers.read_dim(spark, str(c), "code string, place string").collect()[0] == ("A", "x")
    assert readers.bounds(spark.range(3, 9), "id") == (3, 8)


def test_capped_csv(spark, tmp_path):
    sinks.write_capped_csv(spark.range(25).coalesce(1), str(tmp_path / "c"), 10)
    assert len(list((tmp_path / "c").glob("*.csv"))) == 3
    sinks.write_capped_csv(spark.range(0), str(tmp_path / "e"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 25
    sinks.write_metrics(spark.range(1), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 1


@pytest.fixture
def stream(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), k, float(v)) for d, h, k, v in [(1, 1, "a", 5), (1, 9, "a", 3), (2, 1, "b", 4), (9, 1, "a", 1)]]
    spark.createDataFrame(rows, "ts timestamp, k string, v double").write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema("ts timestamp, k string, v double").parquet(str(tmp_path / "in"))


def test_daily_lowest_stream(spark, stream, tmp_path):
    q = incremental.daily_lowest(stream, "ts", ["k"], "v").writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(120)
    got = {(str(r.day), r.k): (r.observations, r.min_value) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[("2024-01-01", "a")] == (2, 3.0) and got[("2024-01-02", "b")] == (1, 4.0)


def test_latest_table_stream(spark, stream, tmp_path):
    path = str(tmp_path / "latest")
    incremental.maintain_latest(stream, path, ["k"], "ts", str(tmp_path / "ck2")).awaitTermination(120)
    assert {r.k: r.v for r in incremental.read_latest(spark, path).collect()} == {"a": 1.0, "b": 4.0}
    before = {p.name: sorted(x.name for x in p.glob("version=*")) for p in (tmp_path / "latest").glob("bucket=*")}
    for day, value in ((10, 7.0), (11, 8.0), (12, 9.0)):
        spark.createDataFrame([(dt.datetime(2024, 1, day), "a", value)], "ts timestamp, k string, v double").write.mode("append").parquet(str(tmp_path / "in"))
        incremental.maintain_latest(stream, path, ["k"], "ts", str(tmp_path / "ck2")).awaitTermination(120)
        assert {r.k: r.v for r in incremental.read_latest(spark, path).collect()} == {"a": value, "b": 4.0}
    after = {p.name: sorted(x.name for x in p.glob("version=*")) for p in (tmp_path / "latest").glob("bucket=*")}
    assert sum(before[b] != after[b] for b in after) == 1 and max(map(len, after.values())) == 2  # one bucket touched, old versions gone


def test_trailing_mean_stream(spark, stream, tmp_path):
    q = incremental.trailing_mean(stream, "ts", ["k"], "v").writeStream.outputMode("append").format("parquet").option("checkpointLocation", str(tmp_path / "ck3")).trigger(availableNow=True).start(str(tmp_path / "means"))
    q.awaitTermination(120)
    got = {(str(r.day), r.k): r.mean_value for r in spark.read.parquet(str(tmp_path / "means")).collect()}
    assert got[("2024-01-02", "a")] == 4.0 and got[("2024-01-08", "b")] == 4.0


def test_globs_corrupt_files_and_file_names(spark, tmp_path):
    for k in (1, 2):
        spark.createDataFrame([(k,)], "id int").coalesce(1).write.parquet(str(tmp_path / f"t/x={k}"))
    assert readers.read_glob(spark, str(tmp_path / "t/*")).count() == readers.read_glob(spark, str(tmp_path / "t"), True).count() == 2
    named = readers.source_file(spark.read.parquet(str(tmp_path / "t")))
    assert all(f"x={r.x}" in r.source_file for r in named.collect())
    (tmp_path / "t/x=3").mkdir()
    (tmp_path / "t/x=3/part-0.parquet").write_bytes(b"no parquet at all")
    assert readers.read_days(spark, str(tmp_path / "t"), "1", "3", "x", tolerant=True).count() == 2
    spark.createDataFrame([(4, 5)], "id int, more int").write.parquet(str(tmp_path / "m/x=1"))
    spark.createDataFrame([(4,)], "id int").write.parquet(str(tmp_path / "m/x=2"))
    assert "more" in readers.read_days(spark, str(tmp_path / "m"), "1", "2", "x", merge_schema=True).columns


def test_hours_prune(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, h), h) for d in (1, 2) for h in range(24)], "ts timestamp, n int")
    sinks.write_hours(df, str(tmp_path / "h"), "ts")
    got = readers.read_hours(spark, str(tmp_path / "h"), "2024-01-02", 6, 8)
    assert sorted(r.n for r in got.collect()) == [6, 7, 8] and "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().executedPlan().toString()
