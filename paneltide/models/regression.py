"""Regression pipelines, cross-validation, importances and PCA on panel features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F


def split(df: DataFrame, keys: Sequence[str], test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same on every run and layout."""
    h = F.pmod(F.xxhash64(*keys), F.lit(10_000)) < int(test_share * 10_000)
    return df.where(~h), df.where(h)


def prepare(df: DataFrame, day: str, first_day: str, lead: str, most_lead: int, service_day: str, holidays: Sequence[str] = ()) -> DataFrame:
    """Rows from ``first_day`` on, up to ``most_lead`` days ahead, not for a holiday, without missing values."""
    rows = df.where((F.col(day) >= F.lit(first_day).cast("date")) & (F.col(lead) <= most_lead))
    return (rows.where(~F.col(service_day).isin([F.lit(h).cast("date") for h in holidays])) if holidays else rows).dropna()


def fit_per_group(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, ridge: float = 1e-6, least_rows: int = 2) -> DataFrame:
    """Per group: weights (intercept first) of a least-squares fit, and its number of rows n.

    The sums of products are one partial aggregation over shifted columns, whatever a group's size; only they
    reach the solver, one small system a group. ``ridge`` is relative to each feature's spread. Groups of
    fewer than ``least_rows`` rows, or without a solution, are left out.
    """
    columns = [*features, label]
    known = df.dropna(subset=columns)
    n, y = len(features), len(features)
    aggs = [F.count("*").alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns))]
    aggs += [F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i in range(n) for j in range(i, n + 1)]
    sums = known.groupBy(*keys).agg(*aggs).where(F.col("n") >= least_rows)

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                a = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
                b = np.array([r[f"c{i}_{y}"] for i in range(n)])
                scale = np.sqrt(np.maximum(np.diag(a), 0))
                scale[scale == 0] = 1
                try:
                    w = np.linalg.solve(a / np.outer(scale, scale) + ridge * np.eye(n), b / scale) / scale
                except np.linalg.LinAlgError:
                    w = np.full(n, np.nan)
                out.append([r[f"m{y}"] - float(w @ np.array([r[f"m{i}"] for i in range(n)])), *w.tolist()])
            yield pdf[[*keys, "n"]].assign(weights=out)

    kinds = dict(known.dtypes)
    fitted = sums.mapInPandas(solve, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "n long", "weights array<double>"]))
    return fitted.where(~F.exists("weights", F.isnan))


def predict_per_group(df: DataFrame, fitted: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Rows of groups with a fit, with ``prediction``; null where a feature is missing."""
    value = F.get("weights", F.lit(0))
    for i, c in enumerate(features):
        value = value + F.get("weights", F.lit(i + 1)) * F.col(c)
    return df.join(fitted.select(*keys, "weights"), list(keys)).withColumn("prediction", value).drop("weights")


def regressor(kind: str, label: str, **options: object):
    """'linear', 'forest' or 'boosted' with the defaults that the published results used."""
    if kind == "linear":
        return LinearRegression(labelCol=label, **({"regParam": 1.0, "elasticNetParam": 0.01, "maxIter": 20} | options))
    if kind == "forest":
        return RandomForestRegressor(labelCol=label, **({"numTrees": 100, "maxDepth": 7, "seed": 19} | options))
    if kind == "boosted":
        return GBTRegressor(labelCol=label, **({"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 19} | options))
    raise ValueError(kind)


def pipeline(kind: str, numeric: Sequence[str], categories: Sequence[str], label: str, scale: str | None = None, pca: int | None = None, **options: object) -> Pipeline:
    """Index and encode categories, assemble, optionally scale and project, then regress."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in categories]
    stages += [OneHotEncoder(inputCols=[f"{c}_index" for c in categories], outputCols=[f"{c}_vec" for c in categories])] if categories else []
    last = "assembled"
    stages.append(VectorAssembler(inputCols=[*numeric, *(f"{c}_vec" for c in categories)], outputCol=last, handleInvalid="skip"))
    if scale:
        stages.append((StandardScaler(inputCol=last, outputCol="scaled", withMean=True) if scale == "standard" else MinMaxScaler(inputCol=last, outputCol="scaled")))
        last = "scaled"
    if pca:
        stages.append(PCA(k=pca, inputCol=last, outputCol="projected"))
        last = "projected"
    return Pipeline(stages=[*stages, regressor(kind, label, **options).setFeaturesCol(last)])


def cross_validate(flow: Pipeline, train: DataFrame, label: str, grid: Mapping[str, Sequence], folds: int = 3, parallelism: int = 4, metric: str = "rmse") -> CrossValidatorModel:
    builder, model = ParamGridBuilder(), flow.getStages()[-1]
    for name, values in grid.items():
        builder = builder.addGrid(getattr(model, name), list(values))
    return CrossValidator(estimator=flow, estimatorParamMaps=builder.build(), evaluator=RegressionEvaluator(labelCol=label, metricName=metric), numFolds=folds, parallelism=parallelism, seed=19).fit(train)


def cv_results(model: CrossValidatorModel) -> list[dict]:
    return [{**{p.name: v for p, v in m.items()}, "metric": x} for m, x in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True)]


def importances(model: PipelineModel, scored: DataFrame, features: str = "assembled") -> list[tuple[str, float]]:
    """(feature, importance) by the assembler's own names, greatest first."""
    attrs = scored.schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    last = model.stages[-1]
    weights = (last.featureImportances if hasattr(last, "featureImportances") else last.coefficients).toArray()
    return sorted(((names[i], float(w)) for i, w in enumerate(weights)), key=lambda x: -abs(x[1]))
