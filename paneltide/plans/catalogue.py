"""Registered queries: each applies a library operator to the driver's tables; ``sql`` gives the same rows in DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import arrays, codec, dates
from ..operators import dims, distribution, errors, features, lowest, panel, ranks, restrict, trips
from ..sources import readers, sinks
from . import lookups
from .adapters import ALL_DAILY_SQL, DAILY_SQL, OFFERS_SQL, USER_DAYS_SQL, daily, offers, table, user_days

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEY = ("market", "out_date", "stay", "shop_date", "pos", "currency", "min_value")
KEYS = ", ".join(KEY)
HOLIDAYS = ("1995-07-04", "1995-11-23", "1995-12-25", "1996-01-01", "1996-07-04", "1996-11-28", "1996-12-25")
HOLIDAY_SQL = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)
FIRST, LAST = "min(day)", "max(day)"


def query(sql: str | None = None, base: str = "", ints: tuple[str, ...] = ()) -> Callable:
    """Registers a query. ``ints``: integer columns that can be null, shown as doubles, which hold nulls alike in both engines."""

    def register(f):
        name = f.__name__
        QUERIES[name] = (lambda spark, d: f(spark, d).withColumns({c: F.col(c).cast("double") for c in ints})) if ints else f
        if sql:
            body = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in ints)}) FROM ({sql})" if ints else sql
            SQL[name] = (f"WITH {base}\n" if base else "") + body
        return QUERIES[name]

    return register


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- lowest values and recency


@query("SELECT * FROM daily", ALL_DAILY_SQL, ints=("stay",))
def daily_lowest_fare(spark, d):
    return daily(spark, d)


@query(f"SELECT {KEYS} FROM daily QUALIFY row_number() OVER (PARTITION BY market, out_date, stay ORDER BY shop_date DESC, pos, currency, min_value) = 1", ALL_DAILY_SQL, ints=("stay",))
def latest_per_key(spark, d):
    return lowest.latest_per_key(daily(spark, d), ["market", "out_date", "stay"], "shop_date", ["pos", "currency", "min_value"]).select(*KEY)


_RANKS = f"""{OFFERS_SQL},
ranked AS (SELECT * FROM (
  SELECT market, out_date, search_id, line, carrier, fare, dense_rank() OVER (PARTITION BY market, out_date ORDER BY fare) AS value_rank,
         count(*) OVER (PARTITION BY market, out_date) AS group_rows FROM offers)
  JOIN (SELECT market, out_date, count(DISTINCT search_id) AS group_searches FROM offers GROUP BY ALL) USING (market, out_date) WHERE value_rank <= 3),
panel AS (SELECT market, out_date, value_rank, min(fare) AS value, list_sort(list_distinct(list(carrier))) AS carriers, min(group_searches) AS group_searches, min(group_rows) AS group_rows FROM ranked GROUP BY ALL)"""


def _ranked(spark, d):
    return lowest.value_ranks(offers(spark, d).select("market", "out_date", "search_id", "line", "carrier", "fare"), ["market", "out_date"], "fare", "search_id")


@query("SELECT market, out_date, search_id, line, carrier, fare, CAST(value_rank AS INTEGER) AS value_rank, group_searches, group_rows FROM ranked", _RANKS)
def fare_ranks(spark, d):
    return _ranked(spark, d).select("market", "out_date", "search_id", "line", "carrier", "fare", "value_rank", "group_searches", "group_rows")


@query("SELECT market, out_date, CAST(value_rank AS INTEGER) AS value_rank, value, array_to_string(carriers, '|') AS carriers, group_searches, group_rows FROM panel", _RANKS)
def fare_rank_agg(spark, d):
    return lowest.rank_panel(_ranked(spark, d), ["market", "out_date"], "fare", "carrier").withColumn("carriers", F.array_join("carriers", "|"))


@query("""
SELECT market, out_date, value, group_rows, next_value, round(next_value - value, 6) AS value_step, array_to_string(carriers, '|') AS carriers,
       CAST(carriers = next_carriers AS INTEGER) AS same_carriers, CASE WHEN next_carriers IS NULL THEN NULL WHEN len(list_intersect(carriers, next_carriers)) > 0 THEN 1 ELSE 0 END AS shared_carriers
FROM (SELECT *, lead(value) OVER w AS next_value, lead(carriers) OVER w AS next_carriers FROM panel WINDOW w AS (PARTITION BY market, out_date ORDER BY value_rank)) WHERE value_rank = 1""", _RANKS, ints=("same_carriers", "shared_carriers",))
def fare_rank_collapse(spark, d):
    out = lowest.collapse_ranks(lowest.rank_panel(_ranked(spark, d), ["market", "out_date"], "fare", "carrier"), ["market", "out_date"])
    return out.select("market", "out_date", "value", "group_rows", "next_value", r6("value_step").alias("value_step"), F.array_join("carriers", "|").alias("carriers"), "same_carriers", "shared_carriers")


@query("SELECT o.market, o.out_date, o.search_id, o.line, o.fare FROM offers o, (SELECT market, out_date, min(fare) AS f FROM offers GROUP BY ALL) m WHERE o.market = m.market AND o.out_date = m.out_date AND o.fare = m.f", OFFERS_SQL)
def argmin_rows(spark, d):
    return lowest.argmin_rows(offers(spark, d), ["market", "out_date"], "fare").select("market", "out_date", "search_id", "line", "fare")


_CARRIERS = """
SELECT market, out_date, carriers, fare FROM (
  SELECT market, out_date, carrier AS carriers, fare FROM offers WHERE round_trip = 1 AND carrier IN ('C1', 'C2')
  UNION SELECT market, out_date, carrier || '+' || l_linestatus AS carriers, fare FROM offers WHERE round_trip = 1 AND carrier = 'C3') x"""


@query(f"SELECT e.* FROM ({_CARRIERS}) e JOIN (SELECT market AS m, out_date AS t, min(fare) AS f FROM ({_CARRIERS}) GROUP BY ALL) ON market = m AND out_date = t AND fare = f", OFFERS_SQL)
def argmin_rows_sql(spark, d):
    """The same shape as SQL text: a distinct union of branches joined to its own minimum, as a window."""
    return spark.sql(
        f"SELECT market, out_date, carriers, fare FROM (SELECT *, rank() OVER (PARTITION BY market, out_date ORDER BY fare) AS r FROM ({_CARRIERS.replace('FROM offers', 'FROM {offers}')})) WHERE r = 1",
        offers=offers(spark, d),
    )


# --- trips, arrays, codes

_TRIP = "CASE WHEN round_trip = 1 AND line % 5 <> 0 THEN {rt} WHEN round_trip = 0 THEN {ow} ELSE {other} END"


def _legs(spark, d):
    """Return legs: mirrored for round trips, shifted for every fifth (open jaw), missing one way."""
    back = lambda c, other: F.when((F.col("round_trip") == 1) & (F.col("line") % 5 != 0), F.col(c)).when(F.col("round_trip") == 1, F.concat(F.col(other), F.lit("*")))
    return offers(spark, d).withColumn("in_org", back("destination", "destination")).withColumn("in_dst", back("origin", "origin")).drop("round_trip")


@query("SELECT search_id, line, origin, destination, fare, round_trip FROM offers WHERE NOT (round_trip = 1 AND line % 5 = 0)", OFFERS_SQL)
def trip_classify(spark, d):
    return trips.classify_trip(_legs(spark, d), "origin", "destination", "in_org", "in_dst").select("search_id", "line", "origin", "destination", "fare", "round_trip")


@query(f"""
SELECT * FROM (
  SELECT market, kind, n, round(n * 1.0 / sum(n) OVER (PARTITION BY market), 6) AS share, dense_rank() OVER (ORDER BY total DESC) AS market_rank FROM (
    SELECT *, sum(n) OVER (PARTITION BY market) AS total FROM (SELECT market, {_TRIP.format(rt="'rt'", ow="'ow'", other="'other'")} AS kind, count(*) AS n FROM offers GROUP BY ALL)))
WHERE market_rank <= 20""", OFFERS_SQL)
def trip_type_share_topn(spark, d):
    kinds = _legs(spark, d).withColumn("kind", trips.trip_type("origin", "destination", "in_org", "in_dst")).groupBy("market", "kind").agg(F.count("*").alias("n"))
    shared = distribution.cumulative_shares(kinds, "n", ["kind"], ["market"]).drop("rank", "cum_share")
    places = kinds.groupBy("market").agg(F.sum("n").alias("total")).withColumn("market_rank", F.dense_rank().over(W.orderBy(F.desc("total")))).where("market_rank <= 20")
    return shared.join(places.drop("total"), "market").select("market", "kind", "n", r6("share").alias("share"), F.col("market_rank").cast("long").alias("market_rank"))


@query("""
SELECT search_id, line, ptc, amount FROM (
  SELECT search_id, line, unnest([l_returnflag || '1', l_linestatus]) AS ptc, unnest([fare, CASE WHEN l_tax > 0.04 THEN l_tax END]) AS amount FROM offers)
WHERE amount IS NOT NULL AND (ptc LIKE 'A%' OR ptc LIKE 'O%')""", OFFERS_SQL)
def aligned_explode_adt(spark, d):
    rows = offers(spark, d).select("search_id", "line", F.array(F.concat("l_returnflag", F.lit("1")), "l_linestatus").alias("ptcs"), F.array("fare", F.when(F.col("l_tax") > 0.04, F.col("l_tax"))).alias("amounts"))
    return arrays.aligned_unnest(rows, ["ptcs", "amounts"], ["ptc", "amount"]).where(F.col("ptc").startswith("A") | F.col("ptc").startswith("O"))


@query("""
SELECT search_id, n, CAST(len(list_filter(seats, x -> x <> '009')) = 0 AS INTEGER) AS all_009, CAST(list_contains(seats, '001') OR list_contains(seats, '002') AS INTEGER) AS few_left
FROM (SELECT search_id, count(*) AS n, list(CASE WHEN l_tax < 0.02 THEN '001' WHEN l_tax < 0.03 THEN '002' ELSE '009' END) AS seats FROM offers GROUP BY ALL)""".replace("x ->", "lambda x:"), OFFERS_SQL)
def avail_flags(spark, d):
    seats = offers(spark, d).groupBy("search_id").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("l_tax") < 0.02, "001").when(F.col("l_tax") < 0.03, "002").otherwise("009")).alias("seats"))
    few = arrays.any_of(F.col("seats"), "001") | arrays.any_of(F.col("seats"), "002")
    return seats.select("search_id", "n", arrays.only(F.col("seats"), "009").cast("int").alias("all_009"), few.cast("int").alias("few_left"))


@query("SELECT n_nationkey, code, upper(substr(replace(n_name, ' ', ''), 1, 2)) AS text FROM (SELECT *, (ascii(upper(substr(n_name, 1, 1))) - 64) * 16777216::BIGINT + (ascii(upper(substr(replace(n_name, ' ', ''), 2, 1))) - 64) * 65536 AS code FROM nation)")
def codec_decode(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", codec.encode(F.upper(F.substring(F.replace("n_name", F.lit(" "), F.lit("")), 1, 2))).alias("code"))
    return n.withColumn("text", codec.decode(F.col("code")))


# --- dimensions

_GEO = "(SELECT n_name AS k, min(r_name) AS region FROM nation JOIN region ON n_regionkey = r_regionkey {w} GROUP BY 1)"


def _places(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name", F.col("r_name").alias("region"), "n_nationkey")


@query(f"SELECT search_id, line, origin, destination, a.region AS origin_region, b.region AS destination_region FROM offers JOIN {_GEO.format(w='')} a ON origin = a.k JOIN {_GEO.format(w='')} b ON destination = b.k WHERE 'ASIA' IN (a.region, b.region)", OFFERS_SQL)
def geo_enrich_filter(spark, d):
    return dims.geo_enrich(offers(spark, d), _places(spark, d), "n_name", "region", "origin", "destination", "ASIA").select("search_id", "line", "origin", "destination", "origin_region", "destination_region")


@query(f"SELECT search_id, line, origin, destination, a.region AS origin_region, b.region AS destination_region FROM offers LEFT JOIN {_GEO.format(w='')} a ON origin = a.k LEFT JOIN {_GEO.format(w='')} b ON destination = b.k WHERE coalesce(a.region = 'ASIA', false) OR coalesce(b.region = 'ASIA', false)", OFFERS_SQL)
def geo_enrich_left(spark, d):
    return dims.geo_enrich(offers(spark, d), _places(spark, d), "n_name", "region", "origin", "destination", "ASIA", "left").select("search_id", "line", "origin", "destination", "origin_region", "destination_region")


@query("SELECT search_id, line, market, pos, fare FROM offers WHERE market IN (SELECT market FROM offers GROUP BY market ORDER BY count(*) DESC, market LIMIT 14)", OFFERS_SQL)
def top_market_semi_join(spark, d):
    """Markets are counted first, on a few columns; then only lines and orders of nations that the listed markets have are shuffled."""
    seen = ranks.kept(offers(spark, d).groupBy("market", "origin", "destination").agg(F.count("*").alias("one")))
    top = dims.keep_keys(seen, restrict.volume_ranks(seen, ["market"], "one").where("volume_rank <= 14"), ["market"])
    return dims.keep_keys(offers(spark, d, top), top, ["market"]).select("search_id", "line", "market", "pos", "fare")


@query("SELECT search_id, line, shop_date, out_date, fare FROM offers WHERE origin = 'NATION_1' AND destination = 'NATION_2' AND stay IS NULL", OFFERS_SQL)
def pull_records(spark, d):
    return readers.point_lookup(offers(spark, d), ["search_id", "line", "shop_date", "out_date", "fare"], origin="NATION_1", destination="NATION_2", stay=None)


@query("SELECT o_orderkey AS k, o_totalprice AS price, o_orderpriority AS priority FROM orders WHERE o_orderkey % 3 <> 2 UNION ALL SELECT o_orderkey, coalesce(o_totalprice, -1), NULL FROM orders WHERE o_orderkey % 3 = 2")
def union_versions(spark, d):
    o = table(spark, d, "orders")
    v1 = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("k"), "o_totalprice", F.col("o_orderpriority").alias("priority"))
    v2 = o.where("o_orderkey % 3 = 1").select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit(None).cast("double").alias("o_totalprice"), F.col("o_orderpriority").alias("priority"))
    v3 = o.where("o_orderkey % 3 = 2").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    return readers.union_versions([v1, v2, v3], {"o_orderkey": "k", "o_totalprice": "price"}, {"k": "bigint", "price": "double", "priority": "string"})


# --- restrictions


@query(f"SELECT {KEYS} FROM daily WHERE lead BETWEEN 1 AND 61 AND (stay BETWEEN 3 AND 22 OR stay IS NULL)", ALL_DAILY_SQL, ints=("stay",))
def dtd_los_filter(spark, d):
    return restrict.within_days(daily(spark, d), "lead", "stay", (1, 60), (3, 21), slack=1).select(*KEY)


@query(f"SELECT {KEYS} FROM daily WHERE shop_date >= DATE '1996-06-30' - 365", ALL_DAILY_SQL, ints=("stay",))
def staleness_filter(spark, d):
    return restrict.fresh(daily(spark, d), "shop_date", F.lit("1996-06-30").cast("date"), 365).select(*KEY)


_RATIO = "SELECT *, min_value / {f} OVER (PARTITION BY market) AS ratio FROM daily"


@query(f"SELECT {KEYS}, round(ratio, 6) AS ratio FROM ({_RATIO.format(f='avg(min_value)')}) WHERE ratio < 1.5", ALL_DAILY_SQL, ints=("stay",))
def ratio_mean_filter(spark, d):
    return restrict.ratio_filter(daily(spark, d).select(*KEY), ["market"], "min_value", 1.5).select(*KEY, r6("ratio").alias("ratio"))


@query(f"SELECT {KEYS} FROM daily WHERE shop_date BETWEEN DATE '1998-01-01' - 700 AND DATE '1998-01-01' - 1", ALL_DAILY_SQL, ints=("stay",))
def staleness_window(spark, d):
    """The look-up's window: from a number of days ago up to yesterday, as today is still changing."""
    return restrict.fresh(daily(spark, d), "shop_date", F.lit("1998-01-01").cast("date"), 700, whole_days=True).select(*KEY)


@query(f"SELECT {KEYS} FROM daily WHERE pos IN ('ASIA', 'EUROPE') AND currency = '1-URGENT'", ALL_DAILY_SQL, ints=("stay",))
def pos_currency_filter(spark, d):
    return restrict.sold_at(daily(spark, d), "pos", ["ASIA", "EUROPE"], "currency", "1-URGENT").select(*KEY)


@query("SELECT search_id, line, fare, refused FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN l_tax > 0.04 WHEN l_returnflag = 'A' THEN false END AS refused FROM offers) WHERE NOT refused", OFFERS_SQL)
def not_flagged(spark, d):
    flag = F.when(F.col("l_returnflag") == "R", F.col("l_tax") > 0.04).when(F.col("l_returnflag") == "A", F.lit(False))
    return restrict.not_flagged(offers(spark, d).withColumn("refused", flag), "refused").select("search_id", "line", "fare", "refused")


@query(f"SELECT {KEYS}, round(ratio, 6) AS ratio FROM ({_RATIO.format(f='avg(min_value)')}) WHERE NOT (ratio >= 1.1 AND solution_counts < 2)", ALL_DAILY_SQL, ints=("stay",))
def ratio_mean_count_filter(spark, d):
    return restrict.ratio_filter(daily(spark, d).select(*KEY, "solution_counts"), ["market"], "min_value", 1.1, "mean", "solution_counts", 2).select(*KEY, r6("ratio").alias("ratio"))


@query(f"SELECT {KEYS}, round(ratio, 6) AS ratio FROM ({_RATIO.format(f='quantile_cont(min_value, 0.5)')}) WHERE ratio < 1.4", ALL_DAILY_SQL, ints=("stay",))
def ratio_median_filter(spark, d):
    return restrict.ratio_filter(daily(spark, d).select(*KEY), ["market"], "min_value", 1.4, "median").select(*KEY, r6("ratio").alias("ratio"))


@query(f"SELECT {KEYS} FROM (SELECT *, lag(min_value) OVER (PARTITION BY market ORDER BY shop_date, out_date, pos, currency, stay NULLS FIRST, min_value) AS p FROM daily) WHERE p IS NULL OR min_value / p <= 1.2", ALL_DAILY_SQL, ints=("stay",))
def prev_val_ratio_filter(spark, d):
    return restrict.previous_ratio_filter(daily(spark, d).select(*KEY), ["market"], ["shop_date", "out_date", "pos", "currency", "stay", "min_value"], "min_value", 1.2).select(*KEY)


@query(f"SELECT {KEYS} FROM daily WHERE market IN (SELECT market FROM daily GROUP BY market HAVING stddev_samp(min_value) / avg(min_value) < 0.6)", ALL_DAILY_SQL, ints=("stay",))
def rsd_filter(spark, d):
    return restrict.low_spread(daily(spark, d).select(*KEY), ["market"], "min_value", 0.6).select(*KEY)


@query(f"SELECT {KEYS} FROM daily WHERE market IN (SELECT market FROM daily GROUP BY market HAVING count(DISTINCT (isodow(shop_date), isodow(out_date))) = 49)", ALL_DAILY_SQL, ints=("stay",))
def dow_combo_filter(spark, d):
    rows = daily(spark, d).select(*KEY).withColumn("shop_dow", dates.weekday(F.col("shop_date"))).withColumn("out_dow", dates.weekday(F.col("out_date")))
    return restrict.full_combos(rows, ["market"], ["shop_dow", "out_dow"], 49).select(*KEY)


_VOLUME = "(SELECT market, sum(search_counts)::BIGINT AS volume, row_number() OVER (ORDER BY sum(search_counts) DESC, market) AS volume_rank FROM daily GROUP BY market)"


@query(f"SELECT {KEYS}, CAST(volume_rank AS INTEGER) AS volume_rank FROM daily JOIN {_VOLUME} USING (market) WHERE volume_rank <= 25", ALL_DAILY_SQL, ints=("stay",))
def rank_filter(spark, d):
    return restrict.top_by_volume(daily(spark, d).select(*KEY, "search_counts"), ["market"], "search_counts", 25).select(*KEY, "volume_rank")


@query(f"SELECT {KEYS} FROM daily JOIN (SELECT market, quantile_cont(min_value, 0.05) AS lo, quantile_cont(min_value, 0.9) AS hi FROM daily GROUP BY market) USING (market) WHERE min_value >= lo AND NOT (min_value > hi AND solution_counts <= 1)", ALL_DAILY_SQL, ints=("stay",))
def percentile_clip(spark, d):
    return restrict.percentile_clip(daily(spark, d).select(*KEY, "solution_counts"), ["market"], "min_value", 0.05, 0.9, "solution_counts", 1).select(*KEY)


@query("""
SELECT pos, currency, origin, destination, out_date, stay, shop_date, min_value FROM (
  SELECT *, min_value / avg(min_value) OVER (PARTITION BY market) AS ratio FROM daily WHERE shop_date >= DATE '1998-01-01' - 1500) WHERE ratio < 3
QUALIFY row_number() OVER (PARTITION BY market, out_date, stay ORDER BY shop_date DESC, pos, currency, min_value) = 1""", ALL_DAILY_SQL, ints=("stay",))
def nightly_lookup(spark, d):
    return lookups.nightly_lookup(daily(spark, d), F.lit("1998-01-01").cast("date"), lookups.LookupConfig(stale_after=1500, ratio_mean=3.0))


@query(f"""
SELECT market, pos, currency, out_date, stay, shop_date, min_value FROM (
  SELECT *, min_value / avg(min_value) OVER (PARTITION BY market) AS ratio FROM daily LEFT JOIN {_GEO.format(w='')} a ON origin = a.k LEFT JOIN {_GEO.format(w='')} b ON destination = b.k
  WHERE 'EUROPE' IN (a.region, b.region) AND lead BETWEEN 1 AND 90 AND stay BETWEEN 1 AND 30) WHERE ratio < 2.5
QUALIFY row_number() OVER (PARTITION BY market, pos, out_date, stay ORDER BY shop_date DESC, currency, min_value) = 1""", ALL_DAILY_SQL)
def summary_lookup(spark, d):
    return lookups.summary_lookup(daily(spark, d), _places(spark, d), "n_name", "region", lookups.LookupConfig(ratio_mean=2.5, home="EUROPE"), (1, 90), (1, 30))


# --- features

_SERIES = f"{OFFERS_SQL},\nseries AS (SELECT market, out_date, shop_date, min(fare) AS fare FROM offers GROUP BY ALL)"


def _series(spark, d):
    """Lowest values of all offers per market, service day and observation day."""
    return offers(spark, d).groupBy("market", "out_date", "shop_date").agg(F.min("fare").alias("fare"))


_AXES = {"shop": (["market"], "shop_date"), "dept": (["market", "shop_date"], "out_date")}
_BOTH = {"shop": (["market", "out_date"], "shop_date"), "dept": (["market", "shop_date"], "out_date")}


@query("""
SELECT market, out_date, shop_date, fare, lag(fare) OVER s AS shop_prev_1, lag(fare, 2) OVER s AS shop_prev_2, lead(fare) OVER s AS shop_next_1,
       CAST(date_diff('day', lag(shop_date) OVER s, shop_date) AS INTEGER) AS shop_gap,
       lag(fare) OVER d AS dept_prev_1, lag(fare, 2) OVER d AS dept_prev_2, lead(fare) OVER d AS dept_next_1,
       CAST(date_diff('day', lag(out_date) OVER d, out_date) AS INTEGER) AS dept_gap
FROM series WINDOW s AS (PARTITION BY market, out_date ORDER BY shop_date), d AS (PARTITION BY market, shop_date ORDER BY out_date)""", _SERIES, ints=("shop_gap", "dept_gap"))
def shifted_features(spark, d):
    return features.shifted(_series(spark, d), "fare", _BOTH, [1, 2], [1])


_ONE = f"{_SERIES},\none AS (SELECT market, shop_date, min(fare) AS fare, min(out_date) AS out_date FROM series GROUP BY ALL)"


def _one(spark, d):
    """The same per market and observation day, with the first service day: least values of least values, so one aggregate of the offers."""
    return offers(spark, d).groupBy("market", "shop_date").agg(F.min("fare").alias("fare"), F.min("out_date").alias("out_date"))


@query("SELECT market, shop_date, fare, CAST(date_diff('day', lag(shop_date) OVER w, shop_date) AS INTEGER) AS shop_gap, lag(fare) OVER w AS shop_prev_1 FROM one WINDOW w AS (PARTITION BY market ORDER BY shop_date)", _ONE, ints=("shop_gap",))
def prev_shop_gap(spark, d):
    return features.shifted(_one(spark, d).drop("out_date"), "fare", {"shop": _AXES["shop"]}, [1])


@query("""
SELECT market, lead, shop_date, cents, avg(cents) OVER (PARTITION BY market, lead ORDER BY shop_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS encoded
FROM (SELECT market, lead, shop_date, CAST(round(100 * min(fare)) AS BIGINT) AS cents FROM offers GROUP BY ALL)""", OFFERS_SQL)
def target_encode(spark, d):
    """Expanding mean per market and lead days, in whole cents so that sums are exact."""
    least = offers(spark, d).groupBy("market", "lead", "shop_date").agg(F.round(100 * F.min("fare")).cast("long").alias("cents"))
    return features.target_encode(least, ["market", "lead"], "shop_date", "cents")


@query("SELECT market, shop_date, fare, round(avg(fare) OVER w, 6) AS trail_mean, round(stddev_samp(fare) OVER w, 4) AS trail_std FROM one WINDOW w AS (PARTITION BY market ORDER BY shop_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)", _ONE)
def trailing_rows(spark, d):
    return features.trailing_rows(_one(spark, d).drop("out_date"), ["market"], "shop_date", "fare").withColumn("trail_mean", r6("trail_mean")).withColumn("trail_std", F.round("trail_std", 4))


@query("SELECT market, shop_date, CAST(isodow(shop_date) - 1 AS INTEGER) AS dow, fare, round(avg(fare) OVER (PARTITION BY market, isodow(shop_date) ORDER BY shop_date RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) AS trail_days_mean FROM one", _ONE)
def trailing_range(spark, d):
    rows = _one(spark, d).select("market", "shop_date", dates.weekday(F.col("shop_date")).alias("dow"), "fare")
    return features.trailing_days(rows, ["market", "dow"], "shop_date", "fare", 60).withColumn("trail_days_mean", r6("trail_days_mean"))


_EST = """
SELECT market, shop_date, fare, round(coalesce(p + change, trail), 6) AS estimate FROM (
  SELECT *, lag(c) OVER (PARTITION BY market ORDER BY shop_date) AS change FROM (
    SELECT *, lag(fare) OVER w AS p, fare - lag(fare) OVER w AS c, avg(fare) OVER (PARTITION BY market ORDER BY shop_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS trail
    FROM one WINDOW w AS (PARTITION BY market ORDER BY shop_date)))"""


def _estimated(spark, d):
    w = W.partitionBy("market").orderBy("shop_date")
    rows = features.trailing_rows(features.shifted(_one(spark, d).drop("out_date"), "fare", {"shop": _AXES["shop"]}, [1]), ["market"], "shop_date", "fare")
    rows = rows.withColumn("change", F.lag(F.col("fare") - F.col("shop_prev_1")).over(w))
    return features.estimate_from_shift(rows, "shop_prev_1", "change", "trail_mean").select("market", "shop_date", "fare", "estimate")


@query(_EST, _ONE)
def est_fare_from_neighbors(spark, d):
    return _estimated(spark, d).withColumn("estimate", r6("estimate"))


@query("""
SELECT market, shop_date, fare, round(coalesce(CASE WHEN p IS NULL AND n IS NULL THEN NULL WHEN p IS NULL THEN n WHEN n IS NULL THEN p ELSE (p + n) / 2 END, trail), 6) AS filled FROM (
  SELECT *, lag(fare) OVER w AS p, lead(fare) OVER w AS n, avg(fare) OVER (PARTITION BY market ORDER BY shop_date ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS trail FROM one WINDOW w AS (PARTITION BY market ORDER BY shop_date))
WHERE p IS NOT NULL OR n IS NOT NULL OR trail IS NOT NULL""", _ONE)
def impute_chain(spark, d):
    rows = features.trailing_rows(features.shifted(_one(spark, d).drop("out_date"), "fare", {"shop": _AXES["shop"]}, [1], [1]), ["market"], "shop_date", "fare")
    return features.impute(rows, "filled", features.row_mean("shop_prev_1", "shop_next_1"), F.col("trail_mean")).select("market", "shop_date", "fare", r6("filled").alias("filled"))


@query(f"SELECT market, out_date, shop_date, CAST(out_date IN ({HOLIDAY_SQL}) AS INTEGER) AS holiday, CAST(isodow(out_date) - 1 AS INTEGER) AS dow, strftime(out_date, '%a') AS dow_name FROM series", _SERIES)
def holiday_flags(spark, d):
    o = F.col("out_date")
    return _series(spark, d).select("market", "out_date", "shop_date", dates.in_dates(o, HOLIDAYS).alias("holiday"), dates.weekday(o).alias("dow"), F.date_format(o, "E").alias("dow_name"))


_OFF = f"CAST(isodow({{x}}) >= 6 OR {{x}} IN ({HOLIDAY_SQL}) AS INTEGER)"


@query(f"SELECT DISTINCT out_date, {_OFF.format(x='(out_date - 1)')} AS prev_off, {_OFF.format(x='out_date')} AS day_off, {_OFF.format(x='(out_date + 1)')} AS next_off, CAST(isodow(out_date) >= 5 AS INTEGER) AS long_weekend FROM offers", OFFERS_SQL)
def wkehol_flags(spark, d):
    days = offers(spark, d).select("out_date").distinct()
    return days.withColumns(dates.near_weekend_or_holiday(F.col("out_date"), HOLIDAYS)).withColumn("long_weekend", dates.is_weekend(F.col("out_date"), True).cast("int"))


@query("SELECT i, CASE WHEN i = 0 THEN NULL ELSE CAST(try_strptime(lpad(CAST(i AS VARCHAR), 8, '0'), '%Y%m%d') AS DATE) END AS day FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 19960231 ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END AS i FROM orders)")
def int_dates(spark, d):
    k = F.col("o_orderkey") % 4
    o = table(spark, d, "orders").select(F.when(k == 0, 0).when(k == 1, 19960231).otherwise(dates.date_to_int(F.col("o_orderdate").cast("date"))).alias("i"))
    return o.withColumn("day", dates.int_to_date(F.col("i")))


# --- panel


@query("""
SELECT service_day, stay, CAST(service_day - lead AS DATE) AS seen_day FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS service_day FROM user_days),
       (SELECT unnest([3, 7, 14]) AS stay), (SELECT unnest(range(1, 31))::INTEGER AS lead)""", USER_DAYS_SQL)
def date_grid(spark, d):
    """The grid over the days that the events span."""
    first, last = readers.bounds(user_days(spark, d), "day")
    return panel.date_grid(spark, str(first), str(last), [3, 7, 14], 30)


_GRID = f"""{USER_DAYS_SQL},
span AS (SELECT min(day) AS a, max(day) AS b FROM user_days),
dense AS (SELECT u.user, g.day, coalesce(hits, 0) AS hits, CAST(hits IS NOT NULL AS INTEGER) AS seen FROM (SELECT DISTINCT user FROM user_days) u
  CROSS JOIN (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span) g LEFT JOIN user_days d ON d.user = u.user AND d.day = g.day)"""


def _dense(spark, d):
    seen = user_days(spark, d)
    first, last = readers.bounds(seen, "day")
    grid = panel.key_grid(seen, ["user"], "day", F.lit(first), F.lit(last))
    return panel.densify(grid, seen.withColumn("seen", F.lit(1)), ["user", "day"], ["hits", "seen"])


@query("SELECT * FROM dense", _GRID)
def densify(spark, d):
    return _dense(spark, d)


@query("SELECT user, count(*) AS num_gaps, round(avg(len), 6) AS avg_gap, max(len) AS max_gap FROM (SELECT user, count(*) AS len FROM (SELECT *, row_number() OVER (PARTITION BY user ORDER BY day) - row_number() OVER (PARTITION BY user, seen ORDER BY day) AS g FROM dense) WHERE seen = 0 GROUP BY user, g) GROUP BY user UNION ALL SELECT user, 0, 0, 0 FROM dense GROUP BY user HAVING min(seen) = 1", _GRID)
def gap_stats(spark, d):
    return panel.gap_stats(_dense(spark, d), ["user"], "day", "seen").withColumn("avg_gap", r6("avg_gap"))


@query("SELECT user, sum(seen)::BIGINT AS days_seen, CAST(sum(gap_start) AS INTEGER) AS num_gaps FROM (SELECT *, CASE WHEN seen = 0 AND coalesce(lag(seen) OVER (PARTITION BY user ORDER BY day), 1) = 1 THEN 1 ELSE 0 END AS gap_start FROM dense) GROUP BY user", _GRID)
def gap_stats_array(spark, d):
    """The same number of gaps from a history array per user, by a fold."""
    hist = _dense(spark, d).groupBy("user").agg(F.sum("seen").alias("days_seen"), F.array_sort(F.collect_list(F.struct("day", "seen"))).alias("h"))
    return hist.select("user", "days_seen", arrays.run_stats(F.transform("h", lambda x: x["seen"]))["num_gaps"].alias("num_gaps"))


@query("SELECT user, day, hits, seen, count(*) OVER w AS rows_so_far, CAST(sum(seen) OVER w AS BIGINT) AS set_so_far FROM dense WINDOW w AS (PARTITION BY user ORDER BY day ROWS UNBOUNDED PRECEDING)", _GRID)
def expanding_counts(spark, d):
    return panel.expanding_counts(_dense(spark, d), ["user"], "day", "seen")


@query("SELECT user, day, hits, rolling_sum, round(rolling_mean, 6) AS rolling_mean FROM (SELECT user, day, hits, sum(hits) OVER w::BIGINT AS rolling_sum, avg(hits) OVER w AS rolling_mean, row_number() OVER (PARTITION BY user ORDER BY day) AS n FROM dense WINDOW w AS (PARTITION BY user ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) WHERE n >= 7".replace("sum(hits) OVER w::BIGINT", "CAST(sum(hits) OVER w AS BIGINT)"), _GRID)
def rolling_coverage(spark, d):
    return panel.rolling(_dense(spark, d), ["user"], "day", "hits", 7).withColumn("rolling_mean", r6("rolling_mean")).drop("seen")


@query("SELECT lead, stay, count(DISTINCT shop_date) AS days_seen, count(*) AS observations, round(count(DISTINCT shop_date) / 365.0, 6) AS coverage FROM daily GROUP BY lead, stay", DAILY_SQL, ints=("stay",))
def coverage_dtd_los(spark, d):
    return panel.coverage(daily(spark, d, 120), ["lead", "stay"], "shop_date", 365).withColumn("coverage", r6("coverage"))


@query("SELECT lead, count(DISTINCT shop_date) AS days_seen, count(*) AS observations, round(count(DISTINCT shop_date) / 365.0, 6) AS coverage FROM daily WHERE round_trip = 0 GROUP BY lead", DAILY_SQL)
def coverage_oneway(spark, d):
    return panel.coverage(daily(spark, d, 120).where("round_trip = 0"), ["lead"], "shop_date", 365).withColumn("coverage", r6("coverage"))


@query("SELECT lead, days_seen, expected, round(days_seen * 1.0 / expected, 6) AS coverage FROM (SELECT lead, count(DISTINCT shop_date) AS days_seen, CASE WHEN lead < 31 THEN lead WHEN lead > 90 THEN 121 - lead ELSE 30 END AS expected FROM daily GROUP BY lead)", DAILY_SQL)
def coverage_expected(spark, d):
    seen = daily(spark, d, 120).groupBy("lead").agg(F.count_distinct("shop_date").alias("days_seen")).withColumn("expected", panel.expected_days(F.col("lead"), 1, 120, 30))
    return seen.withColumn("coverage", r6(F.try_divide("days_seen", "expected")))


@query("SELECT pos, CAST(g.lead AS INTEGER) AS lead, coalesce(n, 0) AS observations FROM (SELECT DISTINCT pos FROM offers) CROSS JOIN (SELECT unnest(range(1, 121)) AS lead) g LEFT JOIN (SELECT pos AS p, lead AS l, count(*) AS n FROM daily GROUP BY ALL) ON p = pos AND l = g.lead", ALL_DAILY_SQL)
def coverage_lead_grid(spark, d):
    """Every lead of 1 to 120 days at every point of sale, 0 where nothing was observed."""
    rows = daily(spark, d)
    return panel.lead_grid(rows, ["pos"], "lead", 1, 120).select("pos", "lead", "observations")


@query("""
SELECT pos, lead, round(mean_coverage, 6) AS mean_coverage, counts, round(avg(mean_coverage) OVER (PARTITION BY pos ORDER BY lead RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS running_coverage FROM (
  SELECT pos, lead, avg(c) AS mean_coverage, CAST(sum(n) AS BIGINT) AS counts FROM (SELECT pos, lead, stay, count(DISTINCT shop_date) / 365.0 AS c, sum(search_counts) AS n FROM daily WHERE stay BETWEEN 1 AND 14 GROUP BY ALL) GROUP BY ALL)""", DAILY_SQL)
def coverage_pos_summary(spark, d):
    cells = daily(spark, d, 120).where("stay between 1 and 14").groupBy("pos", "lead", "stay").agg((F.count_distinct("shop_date") / 365.0).alias("c"), F.sum("search_counts").alias("n"))
    by_pos = cells.groupBy("pos", "lead").agg(F.avg("c").alias("mean_coverage"), F.sum("n").alias("counts"))
    run = F.avg("mean_coverage").over(W.partitionBy("pos").orderBy("lead").rangeBetween(W.unboundedPreceding, 0))
    return by_pos.select("pos", "lead", r6("mean_coverage").alias("mean_coverage"), "counts", r6(run).alias("running_coverage"))


_PIVOT = (3, 7, 14, 21)


@query("SELECT lead, " + ", ".join(f"count(DISTINCT shop_date) FILTER (stay = {s}) AS stay_{s}" for s in _PIVOT) + f" FROM daily WHERE stay IN {_PIVOT} GROUP BY lead", DAILY_SQL)
def coverage_pivot(spark, d):
    wide = daily(spark, d, 120).where(F.col("stay").isin(*_PIVOT)).groupBy("lead").pivot("stay", list(_PIVOT)).agg(F.count_distinct("shop_date"))
    return wide.select("lead", *(F.coalesce(F.col(str(s)), F.lit(0)).alias(f"stay_{s}") for s in _PIVOT))


# --- distributions

_TOTALS = f"{OFFERS_SQL},\ntotals AS (SELECT market, count(DISTINCT search_id) AS searches, count(*) AS solutions FROM offers GROUP BY market)"


def _totals(spark, d):
    return offers(spark, d).groupBy("market").agg(F.count_distinct("search_id").alias("searches"), F.count("*").alias("solutions"))


_CUM = "row_number() OVER (ORDER BY searches DESC, {k}) AS rank, round(searches / sum(searches) OVER (), 6) AS share, round(sum(searches) OVER (ORDER BY searches DESC, {k} ROWS UNBOUNDED PRECEDING) / sum(searches) OVER (), 6) AS cum_share"


@query(f"SELECT market, searches, solutions, CAST(rank AS INTEGER) AS rank, share, cum_share FROM (SELECT *, {_CUM.format(k='market')} FROM totals)", _TOTALS)
def market_stats_cumulative(spark, d):
    return distribution.cumulative_shares(_totals(spark, d), "searches", ["market"]).withColumn("share", r6("share")).withColumn("cum_share", r6("cum_share"))


@query(f"SELECT month, searches, CAST(rank AS INTEGER) AS rank, share, cum_share FROM (SELECT *, {_CUM.format(k='month')} FROM (SELECT CAST(month(out_date) AS INTEGER) AS month, count(DISTINCT search_id) AS searches FROM offers GROUP BY ALL))", OFFERS_SQL)
def time_stats_cumulative(spark, d):
    months = offers(spark, d).groupBy(F.month("out_date").alias("month")).agg(F.count_distinct("search_id").alias("searches"))
    return distribution.cumulative_shares(months, "searches", ["month"]).withColumn("share", r6("share")).withColumn("cum_share", r6("cum_share"))


@query("SELECT market, searches, solutions, round(sum(searches) OVER (ORDER BY searches, market ROWS UNBOUNDED PRECEDING) / sum(searches) OVER (), 6) AS reverse_cum_share FROM totals", _TOTALS)
def reverse_cdf(spark, d):
    return distribution.reverse_cdf(_totals(spark, d), "searches", ["market"]).withColumn("reverse_cum_share", r6("reverse_cum_share"))


@query("SELECT log_bin, keys, round(cdf, 6) AS cdf, round(coalesce(lead(cdf) OVER (ORDER BY log_bin), 1), 6) AS next_cdf, round(pow(10.0, log_bin), 6) AS bin_value FROM (SELECT log_bin, count(*) AS keys, max(pct) AS cdf FROM (SELECT round(log10(searches), 1) AS log_bin, percent_rank() OVER (ORDER BY searches) AS pct FROM totals) GROUP BY log_bin)", _TOTALS)
def log_histogram_cdf(spark, d):
    h = distribution.log_histogram(_totals(spark, d), "searches")
    return h.select("log_bin", "keys", *(r6(c).alias(c) for c in ("cdf", "next_cdf", "bin_value")))


@query("SELECT market, searches, round(cume_dist() OVER (ORDER BY searches), 6) AS cume, round(percent_rank() OVER (ORDER BY searches), 6) AS pct FROM totals", _TOTALS)
def cumulative_distribution(spark, d):
    return distribution.cumulative_distribution(_totals(spark, d), "searches").select("market", "searches", r6("cume").alias("cume"), r6("pct").alias("pct"))


_SPLITS = (0.0, 10_000.0, 20_000.0, 40_000.0, 80_000.0, 200_000.0)


@query("SELECT bucket, count(*) AS rows FROM (SELECT CAST(CASE WHEN fare < 10000 THEN 0 WHEN fare < 20000 THEN 1 WHEN fare < 40000 THEN 2 WHEN fare < 80000 THEN 3 WHEN fare <= 200000 THEN 4 END AS INTEGER) AS bucket FROM offers WHERE fare >= 0) WHERE bucket IS NOT NULL GROUP BY bucket", OFFERS_SQL)
def bucket_histogram(spark, d):
    return distribution.bucket_histogram(offers(spark, d), "fare", _SPLITS)


@query(f"SELECT level, CAST(min(rank) FILTER (c >= level) AS BIGINT) AS rank FROM (SELECT row_number() OVER (ORDER BY searches DESC, market) AS rank, sum(searches) OVER (ORDER BY searches DESC, market ROWS UNBOUNDED PRECEDING) / sum(searches) OVER () AS c FROM totals), (SELECT unnest([0.5, 0.8, 0.9, 0.95])::DOUBLE AS level) GROUP BY level", _TOTALS)
def volume_threshold(spark, d):
    return distribution.volume_threshold(distribution.cumulative_shares(_totals(spark, d), "searches", ["market"]), [0.5, 0.8, 0.9, 0.95])


@query("SELECT pos, solutions, markets, round(solutions / sum(solutions) OVER (), 6) AS share, round(solutions / 30.0, 6) AS per_day FROM (SELECT pos, count(*) AS solutions, count(DISTINCT market) AS markets FROM offers GROUP BY pos)", OFFERS_SQL)
def pos_share(spark, d):
    by_pos = offers(spark, d).groupBy("pos").agg(F.count("*").alias("solutions"), F.count_distinct("market").alias("markets"))
    return distribution.cumulative_shares(by_pos, "solutions", ["pos"]).select("pos", "solutions", "markets", r6("share").alias("share"), r6(F.col("solutions") / 30.0).alias("per_day"))


@query(f"SELECT pos, kind, n, round(n / sum(n) OVER (PARTITION BY pos), 6) AS share FROM (SELECT pos, CASE WHEN a.region = pos AND b.region = pos THEN 'domestic' WHEN a.region = pos OR b.region = pos THEN 'international' ELSE 'out-of-pos' END AS kind, count(*) AS n FROM offers JOIN {_GEO.format(w='')} a ON origin = a.k JOIN {_GEO.format(w='')} b ON destination = b.k GROUP BY ALL)", OFFERS_SQL)
def flight_type_share(spark, d):
    rows = dims.geo_enrich(offers(spark, d), _places(spark, d), "n_name", "region", "origin", "destination")
    kinds = rows.groupBy("pos", distribution.flight_type("origin_region", "destination_region", "pos").alias("kind")).agg(F.count("*").alias("n"))
    return distribution.cumulative_shares(kinds, "n", ["kind"], ["pos"]).select("pos", "kind", "n", r6("share").alias("share"))


@query("SELECT * FROM (SELECT 'all' AS subset, count(*) AS solutions, count(DISTINCT search_id) AS searches FROM offers UNION ALL SELECT 'round_trip', count(*), count(DISTINCT search_id) FROM offers WHERE round_trip = 1 UNION ALL SELECT 'near', count(*), count(DISTINCT search_id) FROM offers WHERE lead BETWEEN 1 AND 30)", OFFERS_SQL)
def subset_summary(spark, d):
    return distribution.subset_summary(offers(spark, d), {"all": F.lit(True), "round_trip": F.col("round_trip") == 1, "near": F.col("lead").between(1, 30)}, "search_id")


@query("SELECT market, out_date, count(DISTINCT currency) AS currencies, count(DISTINCT pos) AS points FROM offers GROUP BY ALL", OFFERS_SQL)
def currency_multiplicity(spark, d):
    return offers(spark, d).groupBy("market", "out_date").agg(F.count_distinct("currency").alias("currencies"), F.count_distinct("pos").alias("points"))


@query("SELECT count(DISTINCT CASE WHEN stay IS NOT NULL THEN (market, stay, out_date) END) AS searches_non_null, count(DISTINCT {'a': market, 'b': stay, 'c': out_date}) AS searches FROM offers", OFFERS_SQL)
def multi_distinct_count(spark, d):
    return distribution.search_counts(offers(spark, d), ["market", "stay", "out_date"])


@query("SELECT market, count(DISTINCT shop_date) AS days, CAST(sum(search_counts) AS BIGINT) AS searches FROM daily GROUP BY market ORDER BY searches DESC, market LIMIT 50", ALL_DAILY_SQL)
def top_markets_by_days(spark, d):
    return daily(spark, d).groupBy("market").agg(F.count_distinct("shop_date").alias("days"), F.sum("search_counts").alias("searches")).orderBy(F.desc("searches"), "market").limit(50)


# --- errors

_ERRORS = f"{_ONE},\nerrors AS (SELECT *, 100 * abs(estimate - fare) / fare AS abs_pct_err FROM ({_EST.replace('round(coalesce(p + change, trail), 6)', 'coalesce(p + change, trail)')}) WHERE estimate IS NOT NULL)"
_STATS = "count(abs_pct_err) AS n, round(avg(abs_pct_err), 6) AS mape, round(stddev_samp(abs_pct_err), 6) AS std, round(min(abs_pct_err), 6) AS least, round(max(abs_pct_err), 6) AS most, round(quantile_cont(abs_pct_err, 0.5), 6) AS median"
_ROUNDED = ("mape", "std", "least", "most", "median")


def _errors(spark, d):
    return errors.with_errors(_estimated(spark, d).where("estimate is not null"), "estimate", "fare")


@query(f"SELECT {_STATS}, count(DISTINCT market) AS markets FROM errors", _ERRORS)
def error_stats(spark, d):
    return errors.error_stats(_errors(spark, d), (), "market").withColumns({c: r6(c) for c in _ROUNDED})


@query(f"SELECT market, {_STATS} FROM errors GROUP BY market", _ERRORS)
def error_by_segment(spark, d):
    return errors.error_stats(_errors(spark, d), ["market"]).withColumns({c: r6(c) for c in _ROUNDED})


@query("SELECT market, round(avg(CASE WHEN abs_pct_err <= 25 THEN 1.0 ELSE 0.0 END), 6) AS share_within, count(abs_pct_err) AS n FROM errors GROUP BY market", _ERRORS)
def pct_within_threshold(spark, d):
    return errors.within(_errors(spark, d), ["market"], 25).withColumn("share_within", r6("share_within"))


@query("SELECT round(1 - sum(power(estimate - fare, 2)) / (var_pop(fare) * count(fare)), 6) AS r2, round(avg(abs(estimate - fare)), 4) AS mae, round(quantile_cont(abs(estimate - fare), 0.5), 4) AS mdae, round(avg(abs_pct_err), 6) AS mape FROM errors", _ERRORS)
def regression_metrics(spark, d):
    return errors.regression_metrics(_errors(spark, d), "estimate", "fare").select(r6("r2").alias("r2"), F.round("mae", 4).alias("mae"), F.round("mdae", 4).alias("mdae"), r6("mape").alias("mape"))


@query("""
SELECT g.ratio, CAST(g.ranks AS INTEGER) AS ranks, count(e.abs_pct_err) AS n, round(avg(e.abs_pct_err), 6) AS mape
FROM (SELECT unnest([1.0, 1.5, 2.0])::DOUBLE AS ratio) a(ratio) CROSS JOIN (SELECT unnest([10, 100, 1000]) AS ranks) b CROSS JOIN LATERAL (SELECT a.ratio, b.ranks) g
LEFT JOIN (SELECT abs_pct_err, fare / avg(fare) OVER (PARTITION BY market) AS r, k FROM errors JOIN (SELECT market, row_number() OVER (ORDER BY count(*) DESC, market) AS k FROM errors GROUP BY market) USING (market)) e ON e.r < g.ratio AND e.k <= g.ranks
GROUP BY ALL""", _ERRORS)
def restriction_grid(spark, d):
    rows = restrict.with_group(_errors(spark, d).withColumn("one", F.lit(1)), ["market"], F.avg("fare").alias("_mean")).withColumn("ratio", F.try_divide("fare", "_mean"))
    places = restrict.volume_ranks(rows, ["market"], "one").drop("volume")
    return errors.restriction_grid(rows.join(places, "market"), [1.0, 1.5, 2.0], [10, 100, 1000]).withColumn("mape", r6("mape"))


@query("SELECT pos, round(corr(fare, lead), 6) AS fare_lead, round(corr(fare, stay), 6) AS fare_stay, round(corr(lead, stay), 6) AS lead_stay FROM offers GROUP BY pos", OFFERS_SQL)
def corr_features(spark, d):
    pairs = (("fare", "lead"), ("fare", "stay"), ("lead", "stay"))
    return offers(spark, d).groupBy("pos").agg(*(F.round(F.corr(a, b), 6).alias(f"{a}_{b}") for a, b in pairs))


@query("SELECT market, shop_date, fare, round((fare - avg(fare) OVER w) / nullif(stddev_samp(fare) OVER w, 0), 6) AS z, round(percent_rank() OVER (PARTITION BY market ORDER BY fare), 6) AS pct FROM one WINDOW w AS (PARTITION BY market)", _ONE)
def zscore(spark, d):
    w = W.partitionBy("market")
    z = F.try_divide(F.col("fare") - F.avg("fare").over(w), F.stddev("fare").over(w))
    return _one(spark, d).select("market", "shop_date", "fare", r6(z).alias("z"), r6(F.percent_rank().over(w.orderBy("fare"))).alias("pct"))


@query("SELECT market, shop_date, fare, prev, CAST(abs(fare - prev) <= 1e-8 + 0.01 * abs(prev) AS INTEGER) AS unchanged FROM (SELECT *, lag(fare) OVER (PARTITION BY market ORDER BY shop_date) AS prev FROM one) WHERE prev IS NOT NULL", _ONE)
def unchanged_values(spark, d):
    rows = features.shifted(_one(spark, d), "fare", {"shop": _AXES["shop"]}, [1]).withColumnRenamed("shop_prev_1", "prev").where("prev is not null")
    return rows.select("market", "shop_date", "fare", "prev", arrays.is_close(F.col("fare"), F.col("prev")).cast("int").alias("unchanged"))


# --- models (rows only: no SQL form)


def _features(spark, d):
    """Model rows, computed once: fits and their passes, predictions and errors read what is kept."""
    rows = _one(spark, d)
    rows = features.trailing_rows(features.target_encode(features.shifted(rows, "fare", {"shop": _AXES["shop"]}, [1, 2]), ["market"], "shop_date", "fare"), ["market"], "shop_date", "fare")
    rows = rows.withColumn("lead", F.datediff("out_date", "shop_date")).withColumn("dow", dates.weekday(F.col("out_date")).cast("string"))
    return ranks.kept(rows.dropna())


_NUMERIC = ("shop_prev_1", "shop_prev_2", "encoded", "trail_mean", "trail_std", "lead")


def _mape(spark, d, kind, **options):
    from ..models import regression

    train, test = regression.split(_features(spark, d), ["market", "shop_date"])
    scored = regression.pipeline(kind, _NUMERIC, ["dow"], "fare", **options).fit(train).transform(test)
    return errors.error_stats(errors.with_errors(scored, "prediction", "fare"), ["market"])


@query()
def model_linear(spark, d):
    return _mape(spark, d, "linear", scale="standard")


@query()
def model_forest(spark, d):
    return _mape(spark, d, "forest")


@query()
def model_boosted(spark, d):
    return _mape(spark, d, "boosted")


@query()
def model_linear_pca(spark, d):
    return _mape(spark, d, "linear", scale="minmax", pca=3)


@query()
def model_per_market(spark, d):
    """A least-squares fit of its own for every market, all in one grouped aggregate."""
    from ..models import regression

    train, test = regression.split(_features(spark, d), ["market", "shop_date"])
    scored = regression.predict_per_group(test, regression.fit_per_group(train, ["market"], _NUMERIC, "fare"), ["market"], _NUMERIC)
    return errors.error_stats(errors.with_errors(scored, "prediction", "fare"), ["market"])


@query(f"SELECT market, round(regr_slope(fare, lead), 6) AS slope, round(regr_intercept(fare, lead), 4) AS intercept, count(*) AS n FROM offers GROUP BY market HAVING count(*) >= 3", OFFERS_SQL)
def market_trend(spark, d):
    """The per-group fit with one feature, which SQL can express."""
    from ..models import regression

    fitted = regression.fit_per_group(offers(spark, d), ["market"], ["lead"], "fare", ridge=0.0, least_rows=3)
    return fitted.select("market", F.round(F.get("weights", F.lit(1)), 6).alias("slope"), F.round(F.get("weights", F.lit(0)), 4).alias("intercept"), "n")


@query("SELECT market, out_date, shop_date, fare FROM series WHERE shop_date >= DATE '1993-01-01' AND out_date - shop_date <= 120 AND out_date NOT IN (" + HOLIDAY_SQL + ")", _SERIES)
def model_rows(spark, d):
    """Rows that a model may learn from: after a clip date, within a lead, no holidays, nothing missing."""
    from ..models import regression

    rows = _series(spark, d).withColumn("lead", F.datediff("out_date", "shop_date"))
    return regression.prepare(rows, "shop_date", "1993-01-01", "lead", 120, "out_date", HOLIDAYS).drop("lead")


# --- sources and sinks: written to the shared folder, read back


def _scratch(spark, name):
    return f"{readers.scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-05-31'")
def source_days(spark, d):
    """Months written as day partitions, one of them twice; days read back by partition."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").cast("string").alias("day")).where(F.col("day").between("1995-02-01", "1995-06-30"))
    path = _scratch(spark, "days")
    sinks.write_days(o, path, "day")
    sinks.write_days(o.where(F.col("day").startswith("1995-04")), path, "day")
    return readers.read_days(spark, path, "1995-03-01", "1995-05-31").select("o_orderkey", "o_totalprice", F.col("day").cast("string").alias("day"))


@query("SELECT event_id, value, CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events) AND hour(ts) BETWEEN 6 AND 19")
def source_hours(spark, d):
    """Year, month, day and hour partitions; hours of the last day read by predicate."""
    e = table(spark, d, "events").select("event_id", "value", "ts")
    path, (_, last) = _scratch(spark, "hours"), readers.bounds(e, F.col("ts").cast("date"))
    sinks.write_hours(e, path, "ts")
    return readers.read_hours(spark, path, str(last), 6, 19).select("event_id", "value", F.col("hour").cast("int").alias("hour"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def sink_append(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = _scratch(spark, "append")
    sinks.append(c, path)
    sinks.append(c.where("c_acctbal < 0"), path)
    return spark.read.parquet(path)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def source_csv_headerless(spark, d):
    path = _scratch(spark, "csv")
    sinks.write_single_csv(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), path, header=False)
    return readers.read_dim(spark, path, "n_nationkey int, n_name string, n_regionkey int", header=False)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_csv_capped(spark, d):
    path = _scratch(spark, "capped")
    sinks.write_capped_csv(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path, 100)
    return readers.read_dim(spark, path, "s_suppkey long, s_name string, s_acctbal double")


@query("SELECT r_name AS value FROM region")
def source_list(spark, d):
    path = _scratch(spark, "list")
    lines = table(spark, d, "region").select("r_name").unionByName(spark.sql("SELECT * FROM VALUES ('# regions'), (''), ('#x') AS t(r_name)"))
    lines.coalesce(1).write.text(path)
    return readers.read_list(spark, path)


@query("SELECT count(*) AS rows, min(l_quantity) AS least FROM lineitem")
def sink_metrics(spark, d):
    path = _scratch(spark, "metrics")
    sinks.write_metrics(table(spark, d, "lineitem").agg(F.count("*").alias("rows"), F.min("l_quantity").alias("least")), path)
    return spark.read.schema("rows long, least double").json(path)
