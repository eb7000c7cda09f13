"""Gaussian mixtures with full covariances.

All starts share their scans: a task adds up responsibilities and moments of its rows
for every start still running, and only those sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.operators.centers import _chunks, add_up, distances, n_parts, plus_plus, seed_points, spread, train_runs

RIDGE = 1e-6


@dataclass(frozen=True)
class Mixture:
    """Weights, means and covariances of k components over named columns."""

    cols: tuple[str, ...]
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray

    def whitening(self) -> tuple[np.ndarray, np.ndarray]:
        """Inverse lower Cholesky factors, and the log weight plus normalising constant."""
        inv = np.array([np.linalg.inv(np.linalg.cholesky(c)) for c in self.covs])
        log_det = np.array([np.log(np.diag(m)).sum() for m in inv])
        with np.errstate(divide="ignore"):
            const = np.log(self.weights) + log_det - 0.5 * len(self.cols) * np.log(2 * np.pi)
        return inv, const


def _whitened(runs: Sequence[tuple]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of all runs side by side, columns by component, then run: the factors and offsets of each
    whitened coordinate, which takes the columns up to its own only, and the constants."""
    means, inv, const = (np.stack([r[i] for r in runs], axis=1) for i in (1, 2, 3))
    d = means.shape[-1]
    factors = [np.ascontiguousarray(inv[:, :, j, : j + 1].reshape(-1, j + 1).T) for j in range(d)]
    offsets = [(inv[:, :, j, : j + 1] * means[:, :, : j + 1]).sum(axis=-1).ravel() for j in range(d)]
    return factors, offsets, const.ravel()


def _log_joint(x: np.ndarray, factors: list[np.ndarray], offsets: list[np.ndarray], const: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(const)))
    for j, (factor, offset) in enumerate(zip(factors, offsets)):
        z = x[:, : j + 1] @ factor
        z -= offset
        z *= z
        out += z
    out *= -0.5
    out += const
    return out


def _moments(df: DataFrame, cols: Sequence[str], runs: dict, k: int, tasks: int) -> dict:
    """Per run: component mass, first and second moments, and total log likelihood.

    A run is ``("hard", centers)`` for the start, or ``("soft", means, inv, const)``; all runs of
    a call are of one kind. Their responsibilities are formed side by side, 2 MB at a time, and
    each second moment once.
    """
    d, names = len(cols), list(runs)
    i_of, j_of = np.triu_indices(d)
    width = 1 + d + len(i_of)
    hard = bool(runs) and runs[names[0]][0] == "hard"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc, ll = np.zeros((k * len(names), width)), np.zeros(len(names))
        held = None if hard else _whitened([runs[r] for r in names])
        for pdf in batches:
            x_all = pdf.to_numpy(dtype=float)
            for part in _chunks(len(x_all), k * len(names)):
                x = x_all[part]
                terms = np.hstack([np.ones((len(x), 1)), x, x[:, i_of] * x[:, j_of]])
                if hard:
                    resp = np.zeros((len(x), k, len(names)))
                    for i, r in enumerate(names):
                        resp[np.arange(len(x)), distances(x, runs[r][1]).argmin(axis=1), i] = 1.0
                else:
                    resp = _log_joint(x, *held).reshape(len(x), k, len(names))
                    top = resp.max(axis=1)
                    resp -= top[:, None]
                    np.exp(resp, out=resp)
                    total = resp.sum(axis=1)
                    ll += (top + np.log(total)).sum(axis=0)
                    resp /= total[:, None]
                acc += resp.reshape(len(x), -1).T @ terms
        comp, pos = np.divmod(np.arange(k * width), width)
        for i, r in enumerate(names):
            yield pd.DataFrame({"run": r, "comp": comp, "pos": pos, "v": acc.reshape(k, len(names), width)[:, i].ravel()})
        yield pd.DataFrame({"run": names, "comp": -1, "pos": 0, "v": ll})

    parts = df.select(*cols).mapInPandas(partial, "run int, comp int, pos int, v double")
    total = add_up(parts, ["run", "comp", "pos"], ["v"], tasks * len(runs) * (k * width + 1))
    out = {}
    for r in runs:
        part = total[total["run"] == r]
        m = np.zeros((k, width))
        sums = part[part["comp"] >= 0]
        m[sums["comp"].to_numpy(), sums["pos"].to_numpy()] = sums["v"].to_numpy()
        second = np.zeros((k, d, d))
        second[:, i_of, j_of] = second[:, j_of, i_of] = m[:, 1 + d :]
        out[r] = (np.hstack([m[:, : 1 + d], second.reshape(k, d * d)]), float(part.loc[part["comp"] == -1, "v"].sum()))
    return out


def _maximise(m: np.ndarray, n: int, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mass = m[:, 0] + 10 * np.finfo(float).eps
    means = m[:, 1 : 1 + d] / mass[:, None]
    covs = m[:, 1 + d :].reshape(-1, d, d) / mass[:, None, None] - means[:, :, None] * means[:, None, :]
    return mass / n, means, covs + RIDGE * np.eye(d)


def gmm(
    df: DataFrame, key: str, cols: Sequence[str], k: int, n_init: int = 30, seed: int = 0, max_iter: int = 1000, tol: float = 1e-3,
    starts: Sequence[np.ndarray] | None = None,
) -> tuple[Mixture, float]:
    """Best of ``n_init`` starts by mean log likelihood. Every start begins from its own
    k-means solution and stops when the likelihood gains less than ``tol``. All sums are
    formed around the columns' means, so that large offsets cost no digits. ``starts`` are
    centers whose nearest rows make up the first components, instead of k-means."""
    d = len(cols)
    middle = [m or 0.0 for m in df.agg(*[F.avg(c) for c in cols]).first()]
    data = spread(df.select(key, *[(F.col(c) - F.lit(float(m))).alias(c) for c, m in zip(cols, middle)]), key).persist()
    try:
        n, tasks = data.count(), n_parts(data)
        if starts is None:
            rng = np.random.default_rng(seed)
            sample, weight = seed_points(data, cols, key, k, seed)
            begun = train_runs(data, cols, [plus_plus(sample, k, rng, weight) for _ in range(n_init)])
        else:
            begun = [(np.asarray(s, dtype=float) - np.array(middle), 0.0) for s in starts]
        first = _moments(data, cols, {i: ("hard", c) for i, (c, _) in enumerate(begun)}, k, tasks)
        params = {i: _maximise(first[i][0], n, d) for i in first}
        last = dict.fromkeys(params, -np.inf)
        live = set(params)
        for _ in range(max_iter):
            if not live:
                break
            specs = {}
            for i in live:
                inv, const = Mixture(tuple(cols), *params[i]).whitening()
                specs[i] = ("soft", params[i][1], inv, const)
            sums = _moments(data, cols, specs, k, tasks)
            for i in list(live):
                m, ll = sums[i]
                params[i] = _maximise(m, n, d)
                if abs(ll / n - last[i]) < tol:
                    live.discard(i)
                last[i] = ll / n
    finally:
        data.unpersist()
    best = max(last, key=last.get)
    w, means, covs = params[best][0], params[best][1] + np.array(middle), params[best][2]
    order = np.lexsort(means.T[::-1])
    return Mixture(tuple(cols), w[order], means[order], covs[order]), last[best]


def _log_component(mix: Mixture, j: int, inv: np.ndarray, const: np.ndarray) -> Column:
    centred = [F.col(c) - F.lit(float(m)) for c, m in zip(mix.cols, mix.means[j])]
    squares = []
    for i in range(len(mix.cols)):
        z = reduce(add, (F.lit(float(inv[j][i, t])) * centred[t] for t in range(i + 1)))
        squares.append(z * z)
    return F.lit(float(const[j])) - F.lit(0.5) * reduce(add, squares)


def gmm_score(df: DataFrame, mix: Mixture, key: str) -> DataFrame:
    """``(key, log_density, p0 .. pk-1, label)`` as generated expressions, no Python in the rows."""
    inv, const = mix.whitening()
    k = len(mix.weights)
    parts = df.select(key, *[_log_component(mix, j, inv, const).alias(f"l{j}") for j in range(k)])
    names = [f"l{j}" for j in range(k)]
    top = F.greatest(*names) if k > 1 else F.col("l0")
    with_norm = parts.withColumn("top", top).withColumn(
        "log_density", F.col("top") + F.log(reduce(add, (F.exp(F.col(x) - F.col("top")) for x in names)))
    )
    best = reduce(lambda acc, j: acc.when(F.col(f"l{j}") == F.col("top"), j), range(1, k), F.when(F.col("l0") == F.col("top"), 0))
    return with_norm.select(
        key, "log_density", *[F.exp(F.col(x) - F.col("log_density")).alias(f"p{j}") for j, x in enumerate(names)], best.alias("label")
    )
