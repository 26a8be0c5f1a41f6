"""The daily loop: stopped runs, late days, holes."""

import pytest
from pyspark.sql import functions as F

from paneltide.sources.ledger import Ledger, run_open_days

ROWS = [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3), ("2024-01-04", 4)]


def work(rows):
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.sum("x").alias("total"))


def content(book, like=None):
    return sorted(tuple(r) for r in book.read("2024-01-01", "2024-12-31", like).select("day", "n", "total").collect())


@pytest.fixture
def book(spark, tmp_path):
    return Ledger(spark, str(tmp_path / "book"))


def test_a_day_is_there_once(spark, book):
    src = spark.createDataFrame(ROWS, "day string, x int")
    assert run_open_days(book, src, "day", work) and run_open_days(book, src, "day", work) is None
    assert content(book) == [("2024-01-01", 2, 3), ("2024-01-02", 1, 3), ("2024-01-04", 1, 4)]
    assert [r.day for r in book.holes("2024-01-01", "2024-01-05").orderBy("day").collect()] == ["2024-01-03", "2024-01-05"]
    assert [r.n for r in book.read("2024-01-02", "2024-01-03").collect()] == [1]


def test_killed_between_write_and_commit(spark, book, monkeypatch):
    src = spark.createDataFrame(ROWS, "day string, x int")
    monkeypatch.setattr(Ledger, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        run_open_days(book, src, "day", work)
    monkeypatch.undo()
    assert book.done().count() == 0 and content(book, work(src)) == []
    with pytest.raises(ValueError):
        book.read("2024-01-01", "2024-01-02")
    run_open_days(book, src, "day", work)
    assert content(book) == [("2024-01-01", 2, 3), ("2024-01-02", 1, 3), ("2024-01-04", 1, 4)]


def test_killed_while_writing(spark, book):
    """Half a run is never seen, and doesn't hinder the next."""
    src = spark.createDataFrame(ROWS, "day string, x int")
    book.write(work(src.where("day < '2024-01-02'")), "day", "half")
    run_open_days(book, src, "day", work)
    assert content(book) == [("2024-01-01", 2, 3), ("2024-01-02", 1, 3), ("2024-01-04", 1, 4)]


def test_late_rows_replay_their_days_only(spark, book):
    first = spark.createDataFrame(ROWS, "day string, x int")
    one = run_open_days(book, first, "day", work)
    late = first.unionByName(spark.createDataFrame([("2024-01-02", 10), ("2024-01-03", 5)], "day string, x int"))
    assert sorted(r.day for r in book.open_days(late.groupBy("day").agg(F.count("*").alias("source_rows"))).collect()) == ["2024-01-02", "2024-01-03"]
    two = run_open_days(book, late, "day", work)
    assert content(book) == [("2024-01-01", 2, 3), ("2024-01-02", 2, 13), ("2024-01-03", 1, 5), ("2024-01-04", 1, 4)]
    assert {r.day: r.run for r in book.done().collect()} == {"2024-01-01": one, "2024-01-02": two, "2024-01-03": two, "2024-01-04": one}


def test_chosen_days_and_days_without_a_result(spark, book):
    src = spark.createDataFrame([*ROWS, (None, 9)], "day string, x int")
    keep = lambda rows: work(rows.where("x <> 3"))
    run_open_days(book, src, "day", keep, ["2024-01-02"])
    assert [(r.day, r.rows, r.source_rows) for r in book.done().collect()] == [("2024-01-02", 0, 1)] and content(book, work(src)) == []
    run_open_days(book, src, "day", keep)
    assert content(book) == [("2024-01-01", 2, 3), ("2024-01-04", 1, 4)] and run_open_days(book, src, "day", keep) is None


def test_an_empty_source(spark, book):
    assert run_open_days(book, spark.createDataFrame([], "day string, x int"), "day", work) is None
    assert book.done().count() == 0 and book.holes("2024-01-01", "2024-01-02").count() == 2
