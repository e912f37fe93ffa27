"""Bounded training samples and small linear models, fitted with numpy from those samples alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def some(keys: DataFrame, n: int, seed: int = 5) -> DataFrame:
    """At most ``n`` rows of ``keys`` (id, ...), the same ones in every run: those of the smallest hash."""
    return keys.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(n)


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents of the bounded sample ``keys``, which is small enough to be broadcast by its bound."""
    return docs.join(F.broadcast(keys.withColumnRenamed("id", "key")), F.col("id") == F.col("key")).drop("key")


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine with squared hinge loss; y is -1 or 1.

    Accelerated gradient descent; the step follows from the norms of the rows.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    step = 1.0 / (2.0 * float((weight * (x * x).sum(1)).sum()) + l2)
    w = look = np.zeros(x.shape[1], x.dtype)
    for i in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ look))
        new = look - step * (-2.0 * x.T @ (weight * y * slack) + l2 * look)
        look, w = new + (i / (i + 3.0)) * (new - w), new
    return w


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Rows:
    """Rows of sets of feature numbers: where each begins in ``index``, and the numbers one after another.

    Sums go over PART numbers at a time, so that what is held besides the numbers stays small.
    """

    PART = 1 << 20

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.row = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
        self.index = np.concatenate([*sets, np.zeros(0, np.int32)]).astype(np.int32, copy=False)
        self.n = len(sets)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self._sums(self.row, w, self.index, self.n)

    def only(self, keep: np.ndarray) -> Rows:
        """The same rows with the features marked in ``keep``, numbered anew in their order. These are few, so they are held in
        the width that sums need, which saves a copy for each sum."""
        out = object.__new__(Rows)
        at = np.flatnonzero(keep[self.index])
        number = np.cumsum(keep) - 1
        out.row, out.index, out.n = self.row[at].astype(np.intp), number[self.index[at]], self.n
        return out

    def back(self, r: np.ndarray, dim: int) -> np.ndarray:
        return self._sums(self.index, r, self.row, dim)

    def _sums(self, to: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(n)
        for k in range(0, len(to), self.PART):
            part = slice(k, k + self.PART)
            out += np.bincount(to[part], weights=values[at[part]], minlength=n)
        return out


def chosen_by_lasso(rows: Rows, more: np.ndarray, y: np.ndarray, weight: np.ndarray, dim: int, sure: float, prior: float, passes: int = 5, rounds: int = 30):
    """Marks of the features whose weights are not zero in a logistic model with an absolute penalty (lasso).

    The penalty of a feature is ``sure`` deviations of its slope if the feature said nothing, as if it were in ``prior``
    rows more, so a rare feature takes part if what the others leave unexplained in its rows agrees well enough.
    ``more`` and the bias are not penalised. Each pass goes over the features that have a weight or whose slope exceeds
    their penalty, so most are never touched.
    """
    weight = weight * (weight > 0).sum() / max(weight.sum(), 1e-9)
    base = float((weight * y).sum() / max(weight.sum(), 1e-9))
    if not 0 < base < 1:
        return np.zeros(dim, bool)
    penalty = sure * np.sqrt(base * (1 - base) * (rows.back(weight * weight, dim) + prior))
    dense = np.column_stack([more, np.ones(rows.n)])
    w, u = np.zeros(dim), np.zeros(dense.shape[1])
    u[-1] = np.log(base / (1 - base))
    said = np.zeros(rows.n)  # by the weights so far
    for _ in range(passes):
        slope = rows.back(weight * (sigmoid(said + dense @ u) - y), dim)
        active = (w != 0) | (np.abs(slope) > penalty)
        part, size = rows.only(active), int(active.sum())
        # a bound of the curvature along each weight, so that every step goes down
        many = np.bincount(part.row, minlength=rows.n) + dense.sum(1)
        curve, flat = 0.25 * part.back(weight * many, size) + 1e-9, 0.25 * dense.T @ (weight * many) + 1e-9
        own, least = w[active], penalty[active] / curve
        look, level = own, u
        for i in range(rounds):
            r = weight * (sigmoid(part.dot(look) + dense @ level) - y)
            step = look - part.back(r, size) / curve
            step = np.sign(step) * np.maximum(0.0, np.abs(step) - least)
            down = level - dense.T @ r / flat
            speed = i / (i + 3.0)
            look, own = step + speed * (step - own), step
            level, u = down + speed * (down - u), down
        w[active], said = own, part.dot(own)
    return w != 0


def fit_logistic(rows: Rows, more: np.ndarray, y: np.ndarray, use: np.ndarray, dim: int, l2: float, rounds: int):
    """Weights of the sets, of the dense columns ``more``, and the bias, from the rows that ``use`` marks or weighs.

    Logistic loss, gradient steps scaled per weight (Adam); all of it is deterministic.
    """
    w = np.zeros(dim + more.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n = max(1.0, float(use.sum()))
    rate = 0.1
    w[-1] = np.log(((use * y).sum() + 1.0) / (n - (use * y).sum() + 1.0))
    for i in range(1, rounds + 1):
        p = sigmoid(rows.dot(w[:dim]) + more @ w[dim:-1] + w[-1])
        r = use * (p - y) / n
        g = np.concatenate([rows.back(r, dim), more.T @ r, [r.sum()]])
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return w
