"""Linear models from second moments.

All that a least-squares fit needs of the rows are means and covariances of
the columns: one aggregate, partial on every task, whose result has as many
numbers as pairs of columns. Any number of penalties, column subsets and
folds is then solved from it without reading the rows again, and all fitted
candidates are scored together in one more pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["Moments", "Fit", "moments", "ols", "ridge", "lasso", "alpha_grid", "alpha_grid_scores"]


@dataclass(frozen=True)
class Moments:
    """Of the rows without a null: their number, the means of the columns and of the
    target, covariances of the columns, and of the columns with the target."""

    n: int
    means: np.ndarray
    target: float
    cov: np.ndarray
    cross: np.ndarray

    def only(self, keep: Sequence[int]) -> Moments:
        keep = list(keep)
        return Moments(self.n, self.means[keep], self.target, self.cov[np.ix_(keep, keep)], self.cross[keep])


@dataclass(frozen=True)
class Fit:
    model: str
    alpha: float
    weights: np.ndarray
    intercept: float

    def prediction(self, features: Sequence[str]) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(features, self.weights):
            out = out + F.lit(float(w)) * F.col(c).cast("double")
        return out


def moments(df: DataFrame, features: Sequence[str], label: str, by: str | None = None) -> dict:
    """``Moments`` for each value of ``by`` (or for None), all from one aggregate."""
    cols = [F.col(c).cast("double") for c in (*features, label)]
    known = df.dropna(subset=[*features, label])
    d = len(cols)
    pairs = [(i, j) for i in range(d) for j in range(i, d) if i < d - 1]
    out = {}
    # covar_pop merges running moments of its parts: no difference of large sums.
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
            *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]]
    for r in known.groupBy(*([by] if by else [])).agg(*aggs).collect():  # a row a fold
        if not r.n:
            continue
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"c{i}_{j}"]
        m = np.array([r[f"m{i}"] for i in range(d)])
        out[r[by] if by else None] = Moments(r.n, m[:-1], float(m[-1]), cov[:-1, :-1], cov[:-1, -1])
    return out


def _fit(model: str, alpha: float, m: Moments, w: np.ndarray) -> Fit:
    return Fit(model, alpha, w, float(m.target - w @ m.means))


def ols(m: Moments) -> Fit:
    """Least squares; of columns that depend on each other, the smallest weights."""
    return _fit("ols", 0.0, m, np.linalg.pinv(m.cov, rcond=1e-12, hermitian=True) @ m.cross)


def ridge(m: Moments, alpha: float) -> Fit:
    """Least |y - Xw|^2 + alpha |w|^2, the intercept free."""
    return _fit("ridge", alpha, m, np.linalg.solve(m.n * m.cov + alpha * np.eye(len(m.cross)), m.n * m.cross))


def lasso(m: Moments, alpha: float, rounds: int = 10_000, close: float = 1e-12) -> Fit:
    """Least |y - Xw|^2 / 2n + alpha |w|_1, the intercept free, by coordinate descent on the covariances."""
    w, own = np.zeros(len(m.cross)), np.diag(m.cov)
    for _ in range(rounds):
        step = 0.0
        for j in np.flatnonzero(own > 0):
            rest = m.cross[j] - m.cov[j] @ w + own[j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / own[j]
            step, w[j] = max(step, abs(new - w[j]) * own[j] ** 0.5), new
        if step <= close * max(1.0, float(np.abs(w * own ** 0.5).max(initial=0))):
            break
    return _fit("lasso", alpha, m, w)


def alpha_grid(train: DataFrame, features: Sequence[str], label: str, alphas: Sequence[float] = (0.001, 0.01, 0.1, 1.0, 10.0)) -> list[Fit]:
    """G6 OLS, and Lasso and Ridge for each alpha, from one pass over ``train``."""
    m = moments(train, features, label).get(None)
    return [] if m is None else [ols(m), *[lasso(m, a) for a in alphas], *[ridge(m, a) for a in alphas]]


def alpha_grid_scores(fits: Sequence[Fit], test: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(model, alpha, intercept, weights, mae, mse, r2, best): all fits scored in one pass
    over ``test``; ``best`` marks the smallest MAE of each model."""
    y = F.col(label).cast("double")
    known = test.dropna(subset=[*features, label])
    aggs = [(F.var_pop(y) * F.count(y)).alias("sst"), F.count(y).alias("n")]
    for i, f in enumerate(fits):
        e = f.prediction(features) - y
        aggs += [F.avg(F.abs(e)).alias(f"a{i}"), F.avg(e * e).alias(f"s{i}")]
    r = known.agg(*aggs).first()
    rows = [(f.model, float(f.alpha), f.intercept, [float(w) for w in f.weights], r[f"a{i}"], r[f"s{i}"],
             1 - r[f"s{i}"] * r.n / r.sst if r.sst else None) for i, f in enumerate(fits)]
    least = {m: min((x[4] for x in rows if x[0] == m and x[4] is not None), default=None) for m, *_ in rows}
    rows = [(*x, x[4] is not None and x[4] == least[x[0]]) for x in rows]
    return test.sparkSession.createDataFrame(rows, "model string, alpha double, intercept double, weights array<double>, mae double, mse double, r2 double, best boolean")
