"""Fits against closed forms, cross-validation, importances, preparation."""

import datetime as dt

import numpy as np
import pytest

from paneltide.models import regression


@pytest.fixture(scope="module")
def rows(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(600, 3))
    y = 5 + x @ [2.0, -1.0, 0.0] + 0.1 * rnd.normal(size=600)
    return spark.createDataFrame([("g%d" % (i % 3), *map(float, x[i]), float(y[i] * (1 + i % 3)), "d%d" % (i % 2)) for i in range(600)], "g string, a double, b double, c double, y double, d string")


def test_fits_per_group_equal_least_squares(spark, rows):
    with_small = rows.unionByName(spark.createDataFrame([("small", 1.0, 1.0, 1.0, 1.0, "d0"), ("g0", None, 1.0, 1.0, 1.0, "d0")], rows.schema))
    fitted = regression.fit_per_group(with_small, ["g"], ["a", "b", "c"], "y", ridge=0.0)
    got, p = {r.g: r for r in fitted.collect()}, rows.toPandas()
    assert set(got) == {"g0", "g1", "g2"}
    for g, own in p.groupby("g"):
        want = np.linalg.lstsq(np.column_stack([np.ones(len(own)), own[["a", "b", "c"]]]), own.y, rcond=None)[0]
        assert got[g].weights == pytest.approx(want.tolist()) and got[g].n == len(own)
    scored = regression.predict_per_group(rows, fitted, ["g"], ["a", "b", "c"]).toPandas()
    assert len(scored) == 600 and np.abs(scored.prediction - scored.y).mean() < 0.5


def test_linear_fit_equals_closed_form(rows):
    flow = regression.pipeline("linear", ["a", "b", "c"], [], "y", regParam=0.0, elasticNetParam=0.0, maxIter=100)
    model, p = flow.fit(rows), rows.toPandas()
    want = np.linalg.lstsq(np.column_stack([np.ones(len(p)), p[["a", "b", "c"]]]), p.y, rcond=None)[0]
    assert [model.stages[-1].intercept, *model.stages[-1].coefficients] == pytest.approx(want.tolist(), abs=1e-6)


def test_cross_validation_and_importances(rows):
    flow = regression.pipeline("forest", ["a", "b", "c"], ["d"], "y", numTrees=8)
    model = regression.cross_validate(flow, rows, "y", {"maxDepth": [1, 6]}, folds=2)
    results = regression.cv_results(model)
    assert [r["maxDepth"] for r in results] == [1, 6] and results[1]["metric"] < results[0]["metric"]
    best = model.bestModel
    ranked = regression.importances(best, best.transform(rows))
    assert ranked[0][0] == "a" and sum(w for _, w in ranked) == pytest.approx(1) and len(ranked) >= 4


def test_defaults_are_those_of_the_published_results():
    assert regression.regressor("forest", "y").getNumTrees() == 100 and regression.regressor("boosted", "y").getMaxIter() == 50
    with pytest.raises(ValueError):
        regression.regressor("other", "y")


def test_preparation(spark):
    day = dt.date.fromisoformat
    df = spark.createDataFrame([(day("2024-01-01"), 5, day("2024-01-06"), 1.0), (day("2023-12-31"), 5, day("2024-01-05"), 1.0), (day("2024-01-02"), 200, day("2024-07-20"), 1.0), (day("2024-01-02"), 2, day("2024-01-04"), 1.0), (day("2024-01-02"), 3, day("2024-01-05"), None)], "shop date, lead int, out date, v double")
    got = regression.prepare(df, "shop", "2024-01-01", "lead", 120, "out", ["2024-01-04"]).collect()
    assert [(str(r.shop), r.lead) for r in got] == [("2024-01-01", 5)]


def test_splits_are_stable(rows):
    train, test = regression.split(rows, ["a"])
    again = regression.split(rows.repartition(7), ["a"])[1]
    assert train.count() + test.count() == 600 and 0.1 < test.count() / 600 < 0.3 and again.exceptAll(test).count() == 0 == test.exceptAll(again).count()
