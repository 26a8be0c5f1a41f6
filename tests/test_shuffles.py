"""What queries over all offers shuffle and read: lines once, narrow; and exact medians from sketches."""

import random

import pytest

from paneltide.operators import ranks, sketches
from paneltide.plans import adapters, catalogue, spans  # noqa: F401  spans registers its queries

SF = "/root/testdata/sf0.001"


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def below(plan, mark):
    """Per line that holds ``mark`` the plan's lines below it."""
    lines = plan.split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-*("))
    for i, line in enumerate(lines):
        if mark in line:
            end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
            yield "\n".join(lines[i + 1 : end])


@pytest.mark.parametrize("name", ["daily_lowest_fare", "top_market_semi_join", "multi_distinct_count"])
def test_customers_meet_orders_not_lines(spark, name):
    parts = list(below(plan_of(catalogue.QUERIES[name](spark, SF), "optimizedPlan"), "(o_custkey"))
    assert parts and not any("l_orderkey" in p for p in parts)


@pytest.mark.parametrize(
    "name",
    ["rank_filter", "coverage_lead_grid", "percentile_clip", "catalogue_latest", "running_gaps_by_lead", "cv_block_folds", "dow_combo_filter", "ratio_mean_count_filter", "trailing_median", "score_against_sample", "sketched_distinct", "model_linear"],
)
def test_offers_are_joined_once(spark, name):
    """What is read twice is kept: the last plan has no lines in it."""
    assert "l_orderkey" not in plan_of(catalogue.QUERIES[name](spark, SF), "optimizedPlan")


def test_markets_and_leads_are_not_shuffled(spark):
    grouped = [line for line in plan_of(adapters.daily(spark, SF), "optimizedPlan").split("\n") if "Aggregate [" in line]
    assert grouped and not any("market" in line.split("]")[0] or "lead" in line.split("]")[0] for line in grouped)


def test_counts_that_nobody_reads_are_not_kept(spark):
    assert "count(distinct" not in plan_of(catalogue.QUERIES["prev_val_ratio_filter"](spark, SF), "optimizedPlan")
    kept = catalogue.QUERIES["ratio_median_filter"](spark, SF)
    assert "search_counts" not in plan_of(kept, "optimizedPlan") and "solution_counts" not in plan_of(kept, "optimizedPlan")
    assert "search_counts" not in plan_of(catalogue.QUERIES["percentile_clip"](spark, SF), "optimizedPlan")


def test_distinct_combinations_are_found_once(spark):
    assert "Expand" not in plan_of(catalogue.QUERIES["multi_distinct_count"](spark, SF), "optimizedPlan")


@pytest.mark.parametrize("error", [0.0, 0.01, 0.5])
def test_medians_from_small_sketches_are_exact(spark, error):
    """Also where the bracket misses the median (error 0), on even and odd counts, ties and nulls."""
    rnd = random.Random(3)
    values = {"a": [rnd.gauss(0, 1) for _ in range(5000)], "b": [float(rnd.randrange(20)) for _ in range(3001)], "c": [2.0], "d": [None]}
    df = spark.createDataFrame([(k, i % 7, v) for k, vs in values.items() for i, v in enumerate(vs)], "k string, day int, v double")
    parts = sketches.sketch(df, ["k", "day"], ["v"], k=8, deal=3)
    got = {r.k: r._middle for r in sketches.exact_median(df, parts, ["k"], "v", error).collect()}
    assert got == {k: sorted(vs)[(len(vs) - 1) // 2] for k, vs in values.items() if k != "d"}


def test_dealt_sketches_hold_all_rows(spark):
    df = spark.range(3000).selectExpr("id % 5 AS k", "id % 1000 AS v", "CAST(id AS double) AS x")
    dealt = sketches.sketch(df, ["k"], ["x"], ["v"], deal=4)
    plain = sketches.sketch(df, ["k"], ["x"], ["v"])
    show = lambda s: sorted((r.k, r.rows, r.x_n, r.n) for r in s.select("k", "rows", "x_n", sketches.distinct_count("v").alias("n")).collect())
    assert show(dealt) == show(plain)


def test_top_markets_are_counted_apart(spark):
    """Lines occur once in the last plan, and suppliers of other nations are gone before lines meet orders."""
    plan = plan_of(catalogue.QUERIES["top_market_semi_join"](spark, SF), "optimizedPlan")
    assert sum("Relation" in line and "l_orderkey" in line for line in plan.split("\n")) == 1
    assert any("LeftSemi, (s_nationkey" in line for line in plan.split("\n"))


def test_scored_rows_are_shuffled_once_without_their_keys(spark):
    plan = plan_of(catalogue.QUERIES["score_against_sample"](spark, SF))
    dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    assert len(dealt) == 1 and "market" not in dealt[0]


def test_common_values_are_not_shuffled(spark):
    """Nine tenths of the rows share a value: only the others are dealt."""
    df = spark.range(20000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN CAST(id AS double) ELSE 5.5 END AS x", "'a' AS k")
    out = ranks.score_against(df, "x", df, "x", ["k"], share=0.1)
    assert out.where("x = 5.5").agg({"weak": "max"}).first()[0] == 100 * 18001 / 20000
    write = out._jdf.queryExecution()
    out._jdf.collectToPython()
    exchanges, todo = [], [write.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            exchanges.append(node.metrics().apply("shuffleRecordsWritten").value())
        below_it = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        children = node.children()
        todo += below_it + [children.apply(i) for i in range(children.size())]
    assert max(exchanges) <= 2 * 2000
