import pytest
from oracle import assert_same

import __spark_entry__
from paneltide.plans import catalogue

SF = "/root/testdata/sf0.001"


#: Small systems are solved, and sorted days slid over, by numpy.
WITH_PYTHON = {"market_trend", "elastic_net_slopes", "cv_block_folds", "cv_masked_folds", "trailing_median"}


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_sql(spark, name):
    """The same rows as its SQL, without Python in the plan."""
    df = catalogue.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert name in WITH_PYTHON or ("Python" not in plan and "Pandas" not in plan)
    assert_same(spark, lambda *_: df, catalogue.SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_models_predict(spark, name):
    """Every test row is scored once, and prices that are near random within their market are hit about as well as by their mean."""
    from paneltide.models import regression

    rows = catalogue.QUERIES[name](spark, SF).collect()
    _, test = regression.split(catalogue._features(spark, SF), ["market", "shop_date"])
    assert sum(r.n for r in rows) >= (0.9 if name in ("model_per_market", "model_elastic_net") else 1) * test.count() > 0
    own = sorted(r.median for r in rows)
    assert 0 < own[len(own) // 2] < 150 and all(r.least <= r.median <= r.most for r in rows)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_reach_the_scan(spark):
    plan = catalogue.pull_records(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,NATION_1)]" in plan.replace(", IsNotNull(n_nationkey)", "")
    assert "l_comment" not in plan
