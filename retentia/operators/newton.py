"""Penalised logistic regression for many groups of rows at once, by (proximal) Newton steps.

Every step is one job for all groups: tasks add up loss, gradient and Hessian of their rows per group, a shuffle adds
the tasks' cells, and only those cells, of the number of features squared, come to the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sums(rows: DataFrame, betas: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """{group: (loss, gradient, Hessian)} of the unpenalised loss at `betas`."""
    p = len(next(iter(betas.values())))
    upper = np.triu_indices(p)

    def partial(batches):
        sums: dict = {}
        for pdf in batches:
            for t, part in pdf.groupby("t"):
                if t in betas:
                    x = np.hstack([np.ones((len(part), 1)), np.stack(part["x"].to_numpy())])
                    y, w = part["y"].to_numpy(float), part["w"].to_numpy(float)
                    z = x @ betas[t]
                    mu = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                    cells = [[np.sum(w * (np.logaddexp(0, z) - y * z))], x.T @ (w * (mu - y)), ((x * (w * mu * (1 - mu))[:, None]).T @ x)[upper]]
                    sums[t] = sums.get(t, 0) + np.concatenate(cells)
        for t, s in sums.items():
            yield pd.DataFrame({"t": np.full(len(s), t, "int32"), "i": np.arange(len(s), dtype="int32"), "s": s})

    cells = rows.select("t", "x", "y", "w").mapInPandas(partial, "t int, i int, s double").groupBy("t", "i").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for t, part in cells.groupby("t"):
        s = part.sort_values("i")["s"].to_numpy()
        hessian = np.zeros((p, p))
        hessian[upper] = s[1 + p :]
        out[int(t)] = (s[0], s[1 : 1 + p], hessian + np.triu(hessian, 1).T)
    return out


def _direction(beta: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, strength: float, penalty: str) -> np.ndarray:
    """Step to the minimum of the quadratic model plus the penalty; the intercept (first) is free."""
    p = len(beta)
    h = hessian + np.eye(p) * 1e-10 * max(1.0, np.trace(hessian) / p)
    if penalty == "l2":
        own = np.full(p, strength)
        own[0] = 0
        return np.linalg.solve(h + np.diag(own), -(gradient + own * beta))
    d = np.zeros(p)
    for _ in range(500):
        before = d.copy()
        for j in range(p):
            slope = gradient[j] + h[j] @ d - h[j, j] * d[j]
            if j == 0:
                d[j] = -slope / h[j, j]
            else:
                at = beta[j] - slope / h[j, j]
                d[j] = np.sign(at) * max(abs(at) - strength / h[j, j], 0) - beta[j]
        if np.abs(d - before).max() <= 1e-10 * max(1.0, np.abs(d).max()):
            break
    return d


def fit_logistic_groups(
    rows: DataFrame, groups, width: int, C: float = 1.0, penalty: str = "l2", max_iter: int = 1000, tol: float = 1e-6
) -> dict[int, np.ndarray]:
    """{group: (intercept, weights)} of the weighted loss plus the l1 or l2 penalty over C, for rows (t, x, y, w).

    A step that raises a group's objective is halved; a group rests once its step is below `tol`.
    """
    if penalty not in ("l1", "l2"):
        raise ValueError(f"penalty must be l1 or l2, not {penalty!r}")
    strength = 1.0 / C

    def objective(loss, beta):
        return loss + strength * (np.abs(beta[1:]).sum() if penalty == "l1" else 0.5 * beta[1:] @ beta[1:])

    found = {t: np.zeros(width + 1) for t in groups}
    value = dict.fromkeys(groups, np.inf)
    step, way, tried = {}, {}, dict(found)
    for _ in range(max_iter):
        if not tried:
            break
        sums, after = _sums(rows, tried), {}
        for t, beta in tried.items():
            if t not in sums:
                continue  # a group without rows keeps zeros
            loss, gradient, hessian = sums[t]
            now = objective(loss, beta)
            if now <= value[t] + 1e-12 * abs(value[t] if np.isfinite(value[t]) else 0):
                gain = value[t] - now
                found[t], value[t], step[t] = beta, now, 1.0
                way[t] = _direction(beta, gradient, hessian, strength, penalty)
                small = np.abs(way[t]).max() <= tol * max(1.0, np.abs(beta).max()) or gain <= 1e-12 * abs(now)
                if small:
                    continue
            else:
                step[t] /= 2
                if step[t] < 1e-8:
                    continue
            after[t] = found[t] + step[t] * way[t]
        tried = after
    return found


def logistic_scores(rows: DataFrame, betas: dict[int, np.ndarray], keep: list[str]) -> DataFrame:
    """(kept columns, p) of rows (t, x, kept) under the coefficients of their group."""
    types = dict(rows.dtypes)

    def scored(batches):
        for pdf in batches:
            p = np.zeros(len(pdf))
            for t in pdf["t"].unique():
                at = (pdf["t"] == t).to_numpy()
                z = np.stack(pdf["x"].to_numpy()[at]) @ betas[t][1:] + betas[t][0]
                p[at] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pdf[keep].assign(p=p)

    return rows.select(*dict.fromkeys(["t", "x", *keep])).mapInPandas(scored, ", ".join(f"{c} {types[c]}" for c in keep) + ", p double")
