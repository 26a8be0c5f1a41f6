"""Registered queries over spans of days: stored sketches, running gaps, ranks by range partitions, elastic nets and cross-validation by blocks of days."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates
from ..functions import arrays
from ..models import elastic_net, regression
from ..operators import distribution, errors, features, lowest, panel, ranks, sketches
from ..sources import ledger, readers, sinks, tables
from .adapters import ALL_DAILY_SQL, DAILY_SQL, OFFERS_SQL, daily, offers, table
from .catalogue import _ERRORS, _GRID, _NUMERIC, _ONE, KEY, KEYS, _dense, _errors, _features, _one, _scratch, query, r6

FIRST, LAST = "1995-01", "1996-12"


def _month(c: str):
    return F.date_format(c, "yyyy-MM")


def _stored(spark, rows, day, keys, name, **options):
    """Sketches per key and day, written by month; a month written again replaces itself."""
    path = _scratch(spark, name)
    sinks.write_days(sketches.sketch(rows, [*keys, day], deal=8, **options).withColumn("month", _month(day)), path, "month")
    return path


# --- sketches that merge over days

_SPAN = f"shop_date >= DATE '{FIRST}-01' AND shop_date < DATE '1997-01-01'"


@query(f"""
SELECT pos, count(*) AS n, round(avg(fare), 4) AS mean, round(stddev_samp(fare), 4) AS std, min(fare) AS least, max(fare) AS most, count(DISTINCT search_id) AS searches,
       true AS median_ok, true AS p90_ok, true AS searches_ok
FROM offers WHERE {_SPAN} GROUP BY pos""", OFFERS_SQL)
def sketched_span(spark, d):
    """Statistics of two years' offers per point of sale from stored daily sketches; how exact the quantiles and distinct counts are is held against the offers."""
    size, width = 1000, 12
    every = ranks.kept(offers(spark, d).select("pos", "shop_date", "fare", "search_id"))
    path = _stored(spark, every, "shop_date", ["pos"], "span-sketches", values=["fare"], distinct=["search_id"], k=size, lg_k=width)
    merged = sketches.merge(readers.read_days(spark, path, FIRST, LAST, "month"), ["pos"])
    found = sketches.statistics(merged, ["pos"], "fare", {"median": 0.5, "p90": 0.9}).join(merged.select("pos", sketches.distinct_count("search_id").alias("estimate")), "pos")
    rows = every.where(_SPAN)
    exact = rows.groupBy("pos").agg(F.count_distinct("search_id").alias("searches"))
    out = found.join(exact, "pos")
    for name, q in (("median", 0.5), ("p90", 0.9)):
        place = sketches.rank_bounds(rows, found, ["pos"], "fare", name)
        most = sketches.rank_error(size)
        out = out.join(place.select("pos", ((F.col("strict") <= q + most) & (F.col("weak") >= q - most)).alias(f"{name}_ok")), "pos")
    near = F.abs(F.col("estimate") / F.col("searches") - 1) <= 4 * sketches.distinct_error(width)
    return out.select("pos", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "least", "most", "searches", "median_ok", "p90_ok", near.alias("searches_ok"))


@query("SELECT count(abs_pct_err) AS n, round(avg(abs_pct_err), 6) AS mean, round(stddev_samp(abs_pct_err), 6) AS std, round(min(abs_pct_err), 6) AS least, round(max(abs_pct_err), 6) AS most, true AS median_ok FROM errors", _ERRORS)
def sketched_errors(spark, d):
    """Error statistics over all days from daily sketches: no task gathers the distinct errors."""
    rows = ranks.kept(_errors(spark, d).select("shop_date", "abs_pct_err"))
    path = _stored(spark, rows, "shop_date", [], "error-sketches", values=["abs_pct_err"])
    found = sketches.statistics(sketches.merge(spark.read.parquet(path), []), [], "abs_pct_err")
    place, most = sketches.rank_bounds(rows, found, [], "abs_pct_err", "median"), sketches.rank_error(1000)
    ok = place.select(((F.col("strict") <= 0.5 + most) & (F.col("weak") >= 0.5 - most)).alias("median_ok"))
    return found.select("n", *(r6(c).alias(c) for c in ("mean", "std", "least", "most"))).crossJoin(ok)  # a row each


@query("SELECT pos, count(DISTINCT shop_date) AS days, count(DISTINCT search_id) AS searches, true AS near, true AS same_as_one_pass FROM offers GROUP BY pos", OFFERS_SQL)
def sketched_distinct(spark, d):
    """Distinct searches per point of sale, from unions of stored daily sketches; equal to that of one sketch over all days."""
    rows, width = ranks.kept(offers(spark, d).select("pos", "shop_date", "search_id")), 11
    path = _stored(spark, rows, "shop_date", ["pos"], "distinct-sketches", distinct=["search_id"], lg_k=width)
    stored = spark.read.parquet(path)
    merged, once = sketches.merge(stored, ["pos"]), sketches.sketch(rows, ["pos"], distinct=["search_id"], lg_k=width)
    # united with itself, a sketch is read by the same estimator whatever it was made of
    estimate = lambda s, name: sketches.merge(s.unionByName(s), ["pos"]).select("pos", sketches.distinct_count("search_id").alias(name))
    union, whole = estimate(merged, "estimate"), estimate(once, "one_pass")
    exact = rows.groupBy("pos").agg(F.count_distinct("search_id").alias("searches")).join(rows.groupBy("pos").agg(F.count_distinct("shop_date").alias("days")), "pos")
    near = F.abs(F.col("estimate") / F.col("searches") - 1) <= 4 * sketches.distinct_error(width)
    return exact.join(union, "pos").join(whole, "pos").select("pos", "days", "searches", near.alias("near"), (F.col("estimate") == F.col("one_pass")).alias("same_as_one_pass"))


@query(f"SELECT {KEYS}, round(ratio, 6) AS ratio FROM (SELECT *, min_value / quantile_disc(min_value, 0.5) OVER (PARTITION BY market) AS ratio FROM daily) WHERE ratio < 1.4", ALL_DAILY_SQL, ints=("stay",))
def ratio_median_sketch(spark, d):
    """The ratio filter with medians from stored monthly sketches, merged per market: they bracket the median, which is then picked exactly."""
    rows, size = ranks.kept(daily(spark, d).select(*KEY)), 4096
    path = _scratch(spark, "median-sketches")
    sinks.write_days(sketches.sketch(rows.withColumn("month", _month("shop_date")), ["market", "month"], ["min_value"], k=size, deal=8), path, "month")
    return sketches.ratio_to_median(rows, spark.read.parquet(path), ["market"], "min_value", 1.4, error=2 * sketches.rank_error(size)).select(*KEY, r6("ratio").alias("ratio"))


# --- running gap statistics

_GAPS = """
runs AS (SELECT *, row_number() OVER w AS rows_so_far, CASE WHEN seen = 0 AND coalesce(lag(seen) OVER w, 1) = 1 THEN 1 ELSE 0 END AS begins FROM {t} WINDOW w AS (PARTITION BY {k} ORDER BY day)),
lens AS (SELECT *, rows_so_far - coalesce(max(CASE WHEN seen = 1 THEN rows_so_far END) OVER w, 0) AS run FROM runs WINDOW w AS (PARTITION BY {k} ORDER BY day)),
gaps AS (SELECT *, CAST(sum(begins) OVER w AS BIGINT) AS num_gaps, max(run) OVER w AS max_gap, CAST(sum(1 - seen) OVER w AS BIGINT) AS zeros FROM lens WINDOW w AS (PARTITION BY {k} ORDER BY day))"""
_GAP_COLUMNS = "num_gaps, CAST(max_gap AS INTEGER) AS max_gap, round(coalesce(zeros * 1.0 / nullif(num_gaps, 0), 0), 6) AS avg_gap, round(max_gap * 1.0 / rows_so_far, 6) AS max_gap_share, round(num_gaps * 1.0 / rows_so_far, 6) AS num_gaps_share"
_GAP_ROUNDED = ("avg_gap", "max_gap_share", "num_gaps_share")


@query(f"SELECT user, day, seen, CAST(rows_so_far AS INTEGER) AS rows_so_far, {_GAP_COLUMNS} FROM gaps", f"{_GRID}, {_GAPS.format(t='dense', k='user')}")
def running_gaps(spark, d):
    """At every day of a user's grid the gaps up to it."""
    out = panel.running_gaps(_dense(spark, d), ["user"], "day", "seen").withColumns({c: r6(c) for c in _GAP_ROUNDED})
    return out.select("user", "day", "seen", "rows_so_far", "num_gaps", "max_gap", *_GAP_ROUNDED)


_TRIPS = f"""{OFFERS_SQL},
seen_days AS (SELECT DISTINCT out_date, shop_date FROM offers),
trip_grid AS (SELECT out_date, CAST(out_date - CAST(i AS INTEGER) AS DATE) AS day FROM (SELECT DISTINCT out_date FROM offers), (SELECT unnest(range(0, 122)) AS i)),
trip_days AS (SELECT g.out_date, g.day, CASE WHEN s.shop_date IS NULL THEN 0 ELSE 1 END AS seen FROM trip_grid g LEFT JOIN seen_days s ON g.out_date = s.out_date AND g.day = s.shop_date)"""


@query(f"SELECT out_date, day, seen, {_GAP_COLUMNS} FROM gaps", f"{_TRIPS}, {_GAPS.format(t='trip_days', k='out_date')}")
def running_gaps_by_lead(spark, d):
    """Gaps in the observation of a service day, at each of the days up to 121 ahead."""
    seen = ranks.kept(offers(spark, d).select("out_date", F.col("shop_date").alias("day")).distinct()).withColumn("seen", F.lit(1))  # pairs of days
    grid = seen.select("out_date").distinct().withColumn("day", F.explode(F.sequence(F.date_sub("out_date", 121), "out_date")))
    out = panel.running_gaps(panel.densify(grid, seen, ["out_date", "day"], ["seen"]), ["out_date"], "day", "seen").withColumns({c: r6(c) for c in _GAP_ROUNDED})
    return out.select("out_date", "day", "seen", "num_gaps", "max_gap", *_GAP_ROUNDED)


# --- coverage


@query("""
SELECT lead, stay, count(DISTINCT shop_date) AS days_seen, count(*) AS observations, any_value(span_days) AS span_days, any_value(source_days) AS source_days,
       round(count(DISTINCT shop_date) * 1.0 / any_value(span_days), 6) AS coverage, round(count(DISTINCT shop_date) * 1.0 / any_value(source_days), 6) AS coverage_adjusted
FROM daily, (SELECT CAST(max(shop_date) - min(shop_date) + 1 AS INTEGER) AS span_days, count(DISTINCT shop_date) AS source_days FROM daily) GROUP BY lead, stay""", DAILY_SQL, ints=("stay",))
def coverage_adjusted(spark, d):
    """Coverage by lead and stay, of the calendar and of the days that the source has."""
    return panel.coverage_of_span(daily(spark, d, 120), ["lead", "stay"], "shop_date").withColumns({c: r6(c) for c in ("coverage", "coverage_adjusted")})


# --- ranks by range partitions


@query("SELECT search_id, line, fare, row_number() OVER (ORDER BY fare, search_id, line) AS row_number FROM offers", OFFERS_SQL)
def global_row_number(spark, d):
    return ranks.row_numbers(offers(spark, d).select("search_id", "line", "fare"), ["fare", "search_id", "line"])


@query("""
SELECT search_id, line, market, fare, round(100 * (up_to - n) / total, 6) AS strict, round(100 * up_to / total, 6) AS weak, round(100 * (up_to - n / 2) / total, 6) AS score
FROM (SELECT search_id, line, market, fare FROM offers WHERE round_trip = 1) o
LEFT JOIN (SELECT market, fare, n, sum(n) OVER (PARTITION BY market ORDER BY fare) AS up_to FROM (SELECT market, fare, CAST(sum(1 - round_trip) AS DOUBLE) AS n FROM offers GROUP BY ALL)) p USING (market, fare)
LEFT JOIN (SELECT market, count(*)::DOUBLE AS total FROM offers WHERE round_trip = 0 GROUP BY ALL) t USING (market)""", OFFERS_SQL)
def score_against_sample(spark, d):
    """Where each round trip's fare lies among the one-way fares of its market."""
    rows = ranks.kept(offers(spark, d).select("search_id", "line", "market", "fare", "round_trip"))
    out = ranks.score_against(rows.where("round_trip = 1").select("search_id", "line", "market", "fare"), "fare", rows.where("round_trip = 0"), "fare", ["market"])
    return out.withColumns({c: r6(c) for c in ("strict", "weak", "score")})


@query("""
SELECT market, volume, round(100 * (up_to - n) / total, 6) AS strict, round(100 * up_to / total, 6) AS weak
FROM (SELECT market, count(*) AS volume FROM offers GROUP BY ALL) JOIN (
  SELECT volume, n, sum(n) OVER (ORDER BY volume) AS up_to, sum(n) OVER () AS total FROM (SELECT volume, count(*)::DOUBLE AS n FROM (SELECT market, count(*) AS volume FROM offers GROUP BY ALL) GROUP BY ALL)) USING (volume)""", OFFERS_SQL)
def volume_percentiles(spark, d):
    """Percentiles of markets by their volume, ties sharing theirs, without a one-task window."""
    volumes = offers(spark, d).groupBy("market").agg(F.count("*").alias("volume"))
    place = ranks.placed(volumes, "volume")
    percent = {"strict": 100 * F.col("less") / F.col("total"), "weak": 100 * (F.col("less") + F.col("n")) / F.col("total")}
    return volumes.join(place, "volume").withColumns({k: r6(v) for k, v in percent.items()}).select("market", "volume", "strict", "weak")


# --- elastic nets with a log target

_PENALTIES = ((0.001, 0.5), (0.01, 0.5), (0.05, 0.2), (0.05, 0.9))


@query(f"""
SELECT market, alpha, l1_ratio, n, round(sign(c) * greatest(0, abs(c) - alpha * l1_ratio) / (1 + alpha * (1 - l1_ratio)) / s, 8) AS slope
FROM (SELECT market, count(*) AS n, stddev_pop(lead) AS s, covar_pop(lead, ln(fare)) / stddev_pop(lead) AS c FROM offers WHERE fare > 0 GROUP BY market HAVING count(*) >= 10 AND stddev_pop(lead) > 0),
     (VALUES {', '.join(f'({a}::DOUBLE, {b}::DOUBLE)' for a, b in _PENALTIES)}) p(alpha, l1_ratio)""", OFFERS_SQL)
def elastic_net_slopes(spark, d):
    """Log price on lead days under four penalties per market, from one aggregate; with one feature SQL has the closed form."""
    fitted = elastic_net.fit(offers(spark, d), ["market"], ["lead"], "fare", _PENALTIES, least_rows=10)
    return fitted.select("market", "alpha", "l1_ratio", "n", F.round(F.get("weights", F.lit(1)), 8).alias("slope"))


_FOLDED = f"""{OFFERS_SQL},
folded AS (SELECT *, CAST(floor((shop_date - lo) * 4 / (hi - lo + 1)) AS INTEGER) AS fold FROM (SELECT market, shop_date, lead, ln(fare) AS y FROM offers WHERE fare > 0), (SELECT min(shop_date) AS lo, max(shop_date) AS hi FROM offers WHERE fare > 0))"""


@query("""
SELECT market, f AS fold, count(*) FILTER (WHERE fold <> f) AS n_train, count(*) FILTER (WHERE fold = f) AS n_test, round(regr_slope(y, lead) FILTER (WHERE fold <> f), 8) AS slope
FROM folded, (SELECT CAST(unnest(range(0, 4)) AS INTEGER) AS f) GROUP BY market, f
HAVING count(*) FILTER (WHERE fold <> f) >= 10 AND count(*) FILTER (WHERE fold = f) > 0 AND var_pop(lead) FILTER (WHERE fold <> f) > 0""", _FOLDED)
def cv_block_folds(spark, d):
    """Four folds by blocks of days: each fold's fit comes from the totals less the fold."""
    scores = elastic_net.cross_validate(offers(spark, d), ["market"], ["lead"], "fare", "shop_date", [(0.0, 0.5)], folds=4, least_rows=10)
    return scores.select("market", "fold", "n_train", "n_test", F.round(F.get("weights", F.lit(1)), 8).alias("slope"))


@query("""
WITH prev AS (SELECT market, shop_date, ln(fare) AS y, lag(fare) OVER w AS p, lag(shop_date) OVER w AS src FROM one WINDOW w AS (PARTITION BY market ORDER BY shop_date)),
known AS (SELECT * FROM prev WHERE p IS NOT NULL), ends AS (SELECT min(shop_date) AS lo, max(shop_date) AS hi FROM known),
folds AS (SELECT *, CAST(floor((shop_date - lo) * 5 / (hi - lo + 1)) AS INTEGER) AS own, CAST(floor((src - lo) * 5.0 / (hi - lo + 1)) AS INTEGER) AS other FROM known, ends)
SELECT market, f AS fold, count(*) FILTER (WHERE own <> f AND other <> f) AS n_train, count(*) FILTER (WHERE own = f) AS n_test, round(regr_slope(y, p) FILTER (WHERE own <> f AND other <> f), 10) AS slope
FROM folds, (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS f) GROUP BY market, f
HAVING count(*) FILTER (WHERE own <> f AND other <> f) >= 10 AND count(*) FILTER (WHERE own = f) > 0""".replace("WITH prev", "prev"), f"{_ONE},\n")
def cv_masked_folds(spark, d):
    """Folds in which training rows that took a feature from a masked day are left out."""
    rows = features.shifted(_one(spark, d), "fare", {"shop": (["market"], "shop_date")}, [1]).withColumn("source_day", F.date_sub("shop_date", F.col("shop_gap")))
    scores = elastic_net.cross_validate(rows, ["market"], ["shop_prev_1"], "fare", "shop_date", [(0.0, 0.5)], folds=5, sources=["source_day"], least_rows=10)
    return scores.select("market", "fold", "n_train", "n_test", F.round(F.get("weights", F.lit(1)), 10).alias("slope"))


@query()
def model_elastic_net(spark, d):
    """Elastic nets of log prices per market, with the penalty that block cross-validation prefers; errors on test rows."""
    train, test = regression.split(_features(spark, d), ["market", "shop_date"])
    best = elastic_net.best_penalties(elastic_net.cross_validate(train, ["market"], _NUMERIC, "fare", "shop_date", _PENALTIES), ["market"])
    fitted = elastic_net.fit(train, ["market"], _NUMERIC, "fare", _PENALTIES).join(best.select("market", "alpha", "l1_ratio"), ["market", "alpha", "l1_ratio"], "left_semi")
    return errors.error_stats(errors.with_errors(elastic_net.predict(test, fitted, ["market"], _NUMERIC), "prediction", "fare"), ["market"])


# --- the daily loop


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def ledger_days(spark, d):
    """Daily totals by a loop that is stopped and run again: a first delivery without the evening, a run that dies before its commit, and a run that finds the days that grew."""
    events = table(spark, d, "events").select(F.col("ts").cast("date").cast("string").alias("day"), "ts", "event_type", "value")
    work = lambda rows: rows.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    book = ledger.Ledger(spark, _scratch(spark, "ledger"))
    ledger.run_open_days(book, events.where(F.hour("ts") < 18), "day", work)
    book.write(work(events), "day", "stopped-before-its-commit")
    ledger.run_open_days(book, events, "day", work)
    ledger.run_open_days(book, events, "day", work)  # nothing is open
    first, last = readers.bounds(events, "day")
    return book.read(first or "", last or "", work(events)).select("day", "event_type", "n", F.round("total", 4).alias("total"))


# --- catalogue tables, files as a table


@query(f"SELECT {KEYS} FROM daily QUALIFY row_number() OVER (PARTITION BY market, out_date, stay ORDER BY shop_date DESC, pos, currency, min_value) = 1", ALL_DAILY_SQL, ints=("stay",))
def catalogue_latest(spark, d):
    """The latest value per key in a bucketed catalogue table, kept up by two batches; the table's side of each merge isn't shuffled."""
    rows = ranks.kept(daily(spark, d).select(*KEY).withColumn("stay_key", F.coalesce("stay", F.lit(-1))))
    keys, ties, cuts = ["market", "out_date", "stay_key"], ["pos", "currency", "min_value"], ("1996-01-01", "1998-01-01")
    name = f"latest_{uuid.uuid4().hex}"
    tables.write_bucketed(lowest.latest_per_key(rows.where(F.col("shop_date") < cuts[0]), keys, "shop_date", ties), f"{name}_0", keys, 8, _scratch(spark, "latest"))
    for i, batch in enumerate((rows.where((F.col("shop_date") >= cuts[0]) & (F.col("shop_date") < cuts[1])), rows.where(F.col("shop_date") >= cuts[1]))):
        merged = tables.merged_latest(spark.table(f"{name}_{i}"), batch, keys, "shop_date", ties)
        tables.write_bucketed(merged, f"{name}_{i + 1}", keys, 8, _scratch(spark, "latest"))
    return spark.table(f"{name}_2").select(*KEY)


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS day, count(*) AS rows, true AS has_files FROM orders WHERE o_orderdate >= TIMESTAMP '1994-01-01' GROUP BY ALL""")
def file_index(spark, d):
    """Orders written by month; the months from 1994 on are chosen in the index of files and only their files read."""
    path = _scratch(spark, "indexed")
    sinks.write_days(table(spark, d, "orders").select("o_orderkey", _month("o_orderdate").alias("day")), path, "day")
    files = tables.file_index(spark, path)
    rows = tables.read_files(spark, files.where("day >= '1994-01'"), path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("rows"))
    sizes = tables.day_index(files).select("day", ((F.col("files") > 0) & (F.col("bytes") > 0) & F.col("modified").isNotNull()).alias("has_files"))
    return rows.join(sizes, "day")


# --- correlations, trailing medians

_PAIRED = ("fare", "lead", "stay", "l_tax", "l_discount")


@query(" UNION ALL ".join(f"SELECT pos, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM offers GROUP BY pos" for i, a in enumerate(_PAIRED) for b in _PAIRED[i + 1 :]), OFFERS_SQL)
def correlation_matrix(spark, d):
    return distribution.correlations(offers(spark, d), _PAIRED, ["pos"]).withColumn("corr", r6("corr"))


@query("""
SELECT market, shop_date, fare, round(quantile_cont(fare, 0.5) OVER (PARTITION BY market ORDER BY shop_date RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) AS trail_days_median
FROM (SELECT market, shop_date, fare FROM offers)""", OFFERS_SQL)
def trailing_median(spark, d):
    """Every offer beside the median fare of its market over the 60 days before."""
    out = features.trailing_days_median(offers(spark, d).select("market", "shop_date", "fare"), ["market"], "shop_date", "fare", 60)
    return out.withColumn("trail_days_median", r6("trail_days_median"))


# --- requested and answered types

_TYPED = f"""{OFFERS_SQL},
typed AS (SELECT * FROM (
  SELECT search_id, line, unnest([l_returnflag || '1', l_linestatus || '2']) AS requested,
         unnest([CASE WHEN l_tax > 0.05 THEN 'A' ELSE l_returnflag END, CASE WHEN l_tax > 0.02 THEN l_linestatus END]) AS answered, unnest([fare, fare / 2]) AS amount FROM offers) WHERE answered = 'A')"""
_TYPED_COLUMNS = "search_id, line, requested, amount, left(requested, length(requested) - 1) <> answered AS differs"


def _typed(spark, d, require_request):
    rows = offers(spark, d).select(
        "search_id", "line", F.array(F.concat("l_returnflag", F.lit("1")), F.concat("l_linestatus", F.lit("2"))).alias("asked"),
        F.array(F.when(F.col("l_tax") > 0.05, "A").otherwise(F.col("l_returnflag")), F.when(F.col("l_tax") > 0.02, F.col("l_linestatus"))).alias("got"), F.array("fare", F.col("fare") / 2).alias("prices"),
    )
    return arrays.amounts_of_type(rows, "asked", "got", "prices", "A", require_request).select("search_id", "line", "requested", "amount", "differs")


@query(f"SELECT {_TYPED_COLUMNS} FROM typed WHERE starts_with(requested, 'A')", _TYPED)
def amounts_asked_and_answered(spark, d):
    """The newer rule: the type must have been asked for and answered."""
    return _typed(spark, d, True)


@query(f"SELECT {_TYPED_COLUMNS} FROM typed", _TYPED)
def amounts_answered(spark, d):
    """The older rule: the answer alone counts; rows whose request differs are marked."""
    return _typed(spark, d, False)
