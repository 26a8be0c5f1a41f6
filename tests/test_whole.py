"""The operators over whole tables: no lead range, no modulo filter."""

import pytest

import __spark_entry__
from paneltide.operators import dims
from paneltide.plans import adapters, catalogue

SF = "/root/testdata/sf0.001"


def test_daily_keeps_every_offer(spark):
    assert adapters.daily(spark, SF).agg({"solution_counts": "sum"}).first()[0] == adapters.offers(spark, SF).count()


def test_latest_value_of_every_key(spark):
    keys = adapters.offers(spark, SF).select("market", "out_date", "stay").distinct().count()
    assert catalogue.QUERIES["latest_per_key"](spark, SF).count() == keys


def test_entry_reaches_beyond_the_lead_range(spark):
    assert __spark_entry__.entry(spark).where("datediff(out_date, shop_date) not between 1 and 120").count() > 0


def test_series_and_features_keep_every_market_day(spark):
    days = adapters.offers(spark, SF).select("market", "shop_date").distinct().count()
    assert catalogue.QUERIES["trailing_rows"](spark, SF).count() == days
    assert catalogue._features(spark, SF).where("lead not between 1 and 400").count() > 0  # what the models learn from


def test_left_join_keeps_ends_without_a_place(spark):
    rows = spark.createDataFrame([(1, "A", "B"), (2, "A", "X"), (3, "X", "A"), (4, "B", "X"), (5, "X", "X")], "id int, origin string, destination string")
    places = spark.createDataFrame([("A", "ASIA"), ("B", "EUROPE")], "place string, region string")
    got = dims.geo_enrich(rows, places, "place", "region", "origin", "destination", "ASIA", "left")
    assert sorted((r.id, r.origin_region, r.destination_region) for r in got.collect()) == [(1, "ASIA", "EUROPE"), (2, "ASIA", None), (3, None, "ASIA")]


def test_left_join_on_the_whole_nation_table(spark):
    whole, inner = (catalogue.QUERIES[n](spark, SF) for n in ("geo_enrich_left", "geo_enrich_filter"))
    assert whole.exceptAll(inner).count() == inner.exceptAll(whole).count() == 0 < inner.count()


#: Queries of which a lead range is the subject.
BY_LEAD = {"coverage_dtd_los", "coverage_oneway", "coverage_expected", "coverage_pos_summary", "coverage_pivot", "dtd_los_filter", "summary_lookup", "subset_summary", "coverage_lead_grid", "coverage_adjusted", "model_rows"}


@pytest.mark.parametrize("name", sorted(set(catalogue.SQL) - BY_LEAD))
def test_no_query_is_cut_by_lead_or_modulo(name):
    sql = catalogue.SQL[name]
    assert "lead BETWEEN" not in sql and "nationkey %" not in sql
