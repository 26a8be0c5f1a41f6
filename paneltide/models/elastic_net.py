"""Elastic nets per group from sums of products, and cross-validation over blocks of days without refitting on rows.

One grouped aggregate (partial, so a hot group is not gathered) gives each group's number of rows, means and
products of deviations. Coordinate descent on them fits any number of penalties. For cross-validation the same
sums are kept per group and fold: a fold's training sums are the group's less those of the fold, and its error is
read off its own sums, so that all folds and penalties need one scan.

The loss is half the mean squared error plus ``alpha`` times (``l1_ratio`` times the absolute plus half the rest
times the squared weights), on features scaled to unit (population) deviation. With ``log_label`` the logarithm of
the label is fitted: labels that aren't positive are left out, and predictions are exponentials. Rows with a
missing label or feature are left out; a constant feature has weight 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import ranks
from .regression import predict_per_group

Moments = tuple[float, np.ndarray, np.ndarray]  # rows, means, products of deviations (the label last)


def usable(df: DataFrame, features: Sequence[str], label: str, log_label: bool) -> DataFrame:
    """Rows without missing values, with the label to fit as ``_y``."""
    rows = df.where(F.col(label) > 0).withColumn("_y", F.log(F.col(label))) if log_label else df.withColumn("_y", F.col(label).cast("double"))
    return rows.dropna(subset=[*features, "_y"])


def moments(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: n, means, and products of deviations of every pair of columns (upper triangle, row by row)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    named = rows.groupBy(*keys).agg(F.count("*").alias("n"), *(F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)), *(F.covar_pop(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)))
    products = F.array(*(F.col(f"_c{i}") * F.col("n") for i in range(len(pairs))))
    return named.select(*keys, "n", F.array(*(f"_m{i}" for i in range(len(columns)))).alias("means"), products.alias("products"))


def unpacked(n: float, means: Sequence[float], products: Sequence[float]) -> Moments:
    m = np.asarray(means, float)
    full = np.zeros((len(m), len(m)))
    full[np.triu_indices(len(m))] = products
    return float(n), m, full + np.triu(full, 1).T


def added(a: Moments, b: Moments, sign: int = 1) -> Moments:
    """Moments of the rows of both; with ``sign`` -1 of the rows of ``a`` without those of ``b``."""
    n = a[0] + sign * b[0]
    if n <= 0:
        return 0.0, np.zeros_like(a[1]), np.zeros_like(a[2])
    mean = (a[0] * a[1] + sign * b[0] * b[1]) / n
    if sign > 0:
        gap = a[1] - b[1]
        return n, mean, a[2] + b[2] + a[0] * b[0] / n * np.outer(gap, gap)
    gap = mean - b[1]
    return n, mean, a[2] - b[2] - n * b[0] / a[0] * np.outer(gap, gap)


def coordinate_descent(a: np.ndarray, c: np.ndarray, alpha: float, l1_ratio: float, start: np.ndarray | None = None, tolerance: float = 1e-10, rounds: int = 2_000) -> np.ndarray:
    """Weights of scaled features with correlations ``a`` among them and covariances ``c`` with the label."""
    w = np.zeros(len(c)) if start is None else start.copy()
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    size = max(1e-300, float(np.abs(c).max(initial=0)))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(c)):
            if a[j, j] <= 0:
                continue
            rest = c[j] - a[j] @ w + a[j, j] * w[j]
            new = np.sign(rest) * max(0.0, abs(rest) - l1) / (a[j, j] + l2)
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= tolerance * size:
            break
    return w


def solved(m: Moments, penalties: Sequence[tuple[float, float]]) -> list[list[float]]:
    """Intercept and weights per penalty (alpha, l1_ratio); strong penalties first, each from the weights before it."""
    n, mean, products = m
    cov = products / n
    p = len(mean) - 1
    scale = np.sqrt(np.maximum(np.diag(cov)[:p], 0))
    fixed = scale <= 1e-12 * np.maximum(1.0, np.abs(mean[:p]))
    scale[fixed] = 1.0
    a, c = cov[:p, :p] / np.outer(scale, scale), cov[:p, p] / scale
    a[fixed], a[:, fixed], c[fixed] = 0, 0, 0
    out: dict[int, list[float]] = {}
    w = np.zeros(p)
    for i in sorted(range(len(penalties)), key=lambda i: -penalties[i][0]):
        w = coordinate_descent(a, c, *penalties[i], start=w)
        own = w / scale
        out[i] = [float(mean[p] - own @ mean[:p]), *own.tolist()]
    return [out[i] for i in range(len(penalties))]


def mean_squared_error(m: Moments, weights: Sequence[float]) -> float:
    """Of a fit on the rows that ``m`` sums up."""
    n, mean, products = m
    v = np.append(-np.asarray(weights[1:]), 1.0)  # label less prediction
    return float(max(0.0, v @ products @ v) / n + (v @ mean - weights[0]) ** 2)


def fit(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, penalties: Sequence[tuple[float, float]], log_label: bool = True, least_rows: int = 2) -> DataFrame:
    """Per group and penalty: keys, alpha, l1_ratio, n, weights (intercept first), mse (of the training rows, as fitted)."""
    sums = moments(usable(df, features, label, log_label), keys, [*features, "_y"]).where(F.col("n") >= least_rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                m = unpacked(r["n"], r["means"], r["products"])
                for (alpha, l1), w in zip(penalties, solved(m, penalties), strict=True):
                    out.append([*(r[k] for k in keys), alpha, l1, r["n"], w, mean_squared_error(m, w)])
            yield pd.DataFrame(out, columns=[*keys, "alpha", "l1_ratio", "n", "weights", "mse"])

    kinds = dict(sums.dtypes)
    return sums.mapInPandas(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "alpha double, l1_ratio double, n long, weights array<double>, mse double")


def predict(df: DataFrame, fitted: DataFrame, keys: Sequence[str], features: Sequence[str], log_label: bool = True) -> DataFrame:
    """Rows of groups with a fit (one a group), with ``prediction``; null where a feature is missing."""
    out = predict_per_group(df, fitted, keys, features)
    return out.withColumn("prediction", F.exp("prediction")) if log_label else out


def fold_of(day: Column, first: date, last: date, folds: int) -> Column:
    """Block of days, 0 to ``folds`` - 1: the span is cut into blocks of equal length, so no day is in two."""
    return F.floor(F.datediff(day, F.lit(first)) * folds / ((last - first).days + 1)).cast("int")


def touched_folds(day: str, sources: Sequence[str], first: date, last: date, folds: int) -> Column:
    """A row's own fold and those that its features were taken from (``sources``: days, null for none)."""
    return F.array_distinct(F.array_compact(F.array(*(fold_of(F.col(c), first, last, folds) for c in (day, *sources)))))


def cross_validate(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, day: str, penalties: Sequence[tuple[float, float]], folds: int = 5, sources: Sequence[str] = (), log_label: bool = True, least_rows: int = 2
) -> DataFrame:
    """Per group, fold and penalty: keys, fold, alpha, l1_ratio, n_train, n_test, weights, mse (of the fold's rows, by the fit on the others).

    Masking: a training row whose features were taken from a day of the fold (``sources``) is left out of that
    fold's training. Groups and folds without test rows, or with fewer than ``least_rows`` training rows, are left out.
    """
    known = usable(df, features, label, log_label).where(F.col(day).isNotNull())
    known = ranks.kept(known.select(*dict.fromkeys([*keys, *features, "_y", day, *sources])))
    first, last = known.agg(F.min(day), F.max(day)).first()
    if first is None:
        first = last = date(1970, 1, 1)
    rows = known.withColumn("_own", fold_of(F.col(day), first, last, folds)).withColumn("_fold", F.explode(touched_folds(day, sources, first, last, folds)))
    sums = moments(rows.withColumn("_held", F.col("_own") == F.col("_fold")), [*keys, "_fold", "_held"], [*features, "_y"])
    per_key = sums.groupBy(*keys).agg(F.collect_list(F.struct("_fold", "_held", "n", "means", "products")).alias("parts"))  # two a fold at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                held, masked = {}, {}
                for part in r["parts"]:
                    (held if part["_held"] else masked)[part["_fold"]] = unpacked(part["n"], part["means"], part["products"])
                total = None
                for m in held.values():
                    total = m if total is None else added(total, m)
                for f, test in sorted(held.items()):
                    train = added(total, added(test, masked[f]) if f in masked else test, -1)
                    if train[0] < max(1, least_rows):
                        continue
                    for (alpha, l1), w in zip(penalties, solved(train, penalties), strict=True):
                        out.append([*(r[k] for k in keys), f, alpha, l1, int(train[0]), int(test[0]), w, mean_squared_error(test, w)])
            yield pd.DataFrame(out, columns=[*keys, "fold", "alpha", "l1_ratio", "n_train", "n_test", "weights", "mse"])

    kinds = dict(sums.dtypes)
    return per_key.mapInPandas(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "fold int, alpha double, l1_ratio double, n_train long, n_test long, weights array<double>, mse double")


def best_penalties(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group the penalty of the least error over all folds' rows; ties go to the stronger one."""
    each = scores.groupBy(*keys, "alpha", "l1_ratio").agg(F.try_divide(F.sum(F.col("mse") * F.col("n_test")), F.sum("n_test")).alias("mse"), F.count("*").alias("folds"))
    best = each.groupBy(*keys).agg(F.min(F.struct("mse", (-F.col("alpha")).alias("a"), (-F.col("l1_ratio")).alias("l"), "folds")).alias("b"))
    return best.select(*keys, (-F.col("b.a")).alias("alpha"), (-F.col("b.l")).alias("l1_ratio"), "b.mse", "b.folds")
