"""The driver's order tables seen as price observations, in the DataFrame API and, for the oracle, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lowest import lowest_per_group

DAILY_KEYS = ("market", "origin", "destination", "pos", "currency", "round_trip", "out_date", "stay", "shop_date", "lead")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _market():
    return F.concat_ws("-", "origin", "destination").alias("market")


def offers(spark: SparkSession, sf_dir: str, ends: DataFrame | None = None) -> DataFrame:
    """One priced offer per order line: ends of the trip, point of sale, observation and service dates, price.

    Customers meet the orders, not their lines, and suppliers the lines, before both meet by order: lines are shuffled once, in
    narrow columns, and lie by order afterwards. Names are looked up last. ``ends``: origins and destinations; offers of
    others are left out before lines and orders are shuffled (those of unlisted pairs of them stay).
    """
    line, order, supplier, customer, nation, region = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "supplier", "customer", "nation", "region"))
    if ends is not None:
        among = lambda end: nation.join(ends, F.col("n_name") == F.col(end), "left_semi").select("n_nationkey")
        supplier = supplier.join(among("origin"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
        customer = customer.join(among("destination"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    asked = order.select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("shop_date"))
    asked = asked.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    returns = F.col("l_returnflag") != "N"
    priced = line.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("date").alias("out_date"), F.when(returns, F.col("l_quantity").cast("int")).alias("stay"),
        F.when(returns, 1).otherwise(0).alias("round_trip"), "l_extendedprice", F.concat(F.lit("C"), (F.col("l_suppkey") % 7).cast("string")).alias("carrier"), "l_returnflag", "l_linestatus", "l_tax", "l_discount", "l_partkey",
    )
    priced = priced.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")
    away = nation.select(F.col("n_nationkey").alias("_away"), F.col("n_name").alias("origin"))
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("_home"), F.col("n_name").alias("destination"), F.col("r_name").alias("pos"))
    joined = priced.join(asked, F.col("l_orderkey") == F.col("o_orderkey")).join(away, F.col("s_nationkey") == F.col("_away")).join(home, F.col("c_nationkey") == F.col("_home"))
    return joined.select(
        F.col("l_orderkey").alias("search_id"), F.col("l_linenumber").alias("line"), "origin", "destination", _market(), "pos",
        F.col("o_orderpriority").alias("currency"), "shop_date", "out_date", "stay", F.datediff("out_date", "shop_date").alias("lead"),
        "round_trip", F.col("l_extendedprice").alias("fare"), "carrier", "l_returnflag", "l_linestatus", "l_tax", "l_discount", "l_partkey",
    )


def daily(spark: SparkSession, sf_dir: str, most_lead: int | None = None) -> DataFrame:
    """Daily lowest values of all offers, or of those made 1 to ``most_lead`` days ahead. Markets and leads follow from the other keys, so they aren't shuffled."""
    rows = offers(spark, sf_dir)
    own = [k for k in DAILY_KEYS if k not in ("market", "lead")]
    least = lowest_per_group(rows if most_lead is None else rows.where(F.col("lead").between(1, most_lead)), own, "search_id", "fare")
    return least.select("*", _market(), F.datediff("out_date", "shop_date").alias("lead")).select(*DAILY_KEYS, "search_counts", "solution_counts", "min_value")


OFFERS_SQL = """
offers AS (
  SELECT l_orderkey AS search_id, l_linenumber AS line, sn.n_name AS origin, cn.n_name AS destination, sn.n_name || '-' || cn.n_name AS market, r_name AS pos,
         o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS shop_date, CAST(l_shipdate AS DATE) AS out_date,
         CASE WHEN l_returnflag <> 'N' THEN CAST(trunc(l_quantity) AS INTEGER) END AS stay,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lead,
         CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END AS round_trip, l_extendedprice AS fare, 'C' || (l_suppkey % 7) AS carrier,
         l_returnflag, l_linestatus, l_tax, l_discount, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
       JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region ON cn.n_regionkey = r_regionkey)"""
_DAILY = """daily AS (
  SELECT market, origin, destination, pos, currency, round_trip, out_date, stay, shop_date, lead,
         count(DISTINCT search_id) AS search_counts, count(*) AS solution_counts, min(fare) AS min_value
  FROM offers {where} GROUP BY ALL)"""
DAILY_SQL = f"{OFFERS_SQL},\n{_DAILY.format(where='WHERE lead BETWEEN 1 AND 120')}"
ALL_DAILY_SQL = f"{OFFERS_SQL},\n{_DAILY.format(where='')}"


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: user, day, number."""
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("user"), F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("hits"))


USER_DAYS_SQL = "user_days AS (SELECT user_id AS user, CAST(ts AS DATE) AS day, count(*) AS hits FROM events GROUP BY ALL)"
