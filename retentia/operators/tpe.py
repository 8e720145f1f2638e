"""Tree-structured Parzen sampler: draws the next trial's parameters from what earlier trials scored.

Per parameter, the trials that have it are split into the best few and the others; each half is a mixture of
truncated normals around its values (of counts, for categories) and one wide component. The value drawn from the
good mixture that is likeliest there compared with the other mixture is taken. A parameter that only some trials have
(a reducer's, say) is learned from those alone.
"""

from __future__ import annotations

from math import ceil, erf, exp, log, pi, sqrt

import numpy as np

# Space entries: ("float" | "log_float" | "int", low, high) or ("categorical", values).
KINDS = ("float", "log_float", "int", "categorical")


def uniform(space: tuple, rng: np.random.Generator):
    """A value drawn without regard to earlier trials."""
    kind, *bounds = space
    if kind == "log_float":
        return float(np.exp(rng.uniform(log(bounds[0]), log(bounds[1]))))
    if kind == "float":
        return float(rng.uniform(*bounds))
    if kind == "int":
        return int(rng.integers(bounds[0], bounds[1] + 1))
    if kind == "categorical":
        return bounds[0][int(rng.integers(len(bounds[0])))]
    raise ValueError(f"unknown space type {kind!r}")


def _cdf(x: float) -> float:
    return 0.5 * (1 + erf(x / sqrt(2)))


class Mixture:
    """Truncated normals around values in [low, high], one wide one in the middle; `step` for whole numbers."""

    def __init__(self, values: list[float], low: float, high: float, step: float = 0.0):
        self.low, self.high, self.step = low, high, step
        centres = np.append(np.asarray(values, float), (low + high) / 2)
        order = np.argsort(centres, kind="stable")
        edged = np.concatenate([[low], centres[order], [high]])
        gap = np.maximum(np.diff(edged)[:-1], np.diff(edged)[1:])
        widths = np.empty(len(centres))
        widths[order] = gap
        widths[-1] = high - low
        self.widths = np.clip(widths, (high - low) / min(100, len(centres) + 1), high - low)
        self.centres = centres
        self.mass = np.array([_cdf((high - c) / w) - _cdf((low - c) / w) for c, w in zip(self.centres, self.widths)])

    def draw(self, n: int, rng: np.random.Generator) -> np.ndarray:
        which = rng.integers(len(self.centres), size=n)
        out = np.full(n, np.nan)
        while np.isnan(out).any():
            at = np.flatnonzero(np.isnan(out))
            some = rng.normal(self.centres[which[at]], self.widths[which[at]])
            out[at] = np.where((some >= self.low) & (some <= self.high), some, np.nan)
        return np.clip(np.round(out / self.step) * self.step, self.low + self.step / 2, self.high - self.step / 2) if self.step else out

    def log_density(self, x: float) -> float:
        if self.step:
            half = self.step / 2
            parts = [(_cdf((x + half - c) / w) - _cdf((x - half - c) / w)) / m for c, w, m in zip(self.centres, self.widths, self.mass)]
        else:
            parts = [exp(-0.5 * ((x - c) / w) ** 2) / (w * m * sqrt(2 * pi)) for c, w, m in zip(self.centres, self.widths, self.mass)]
        return log(sum(parts) / len(parts) + 1e-300)


class TpeSampler:
    """`suggest` a trial's parameters one by one, then `tell` its score (larger is better)."""

    def __init__(self, seed: int = 42, startup: int = 10, candidates: int = 24, best_share: float = 0.1, best_most: int = 25):
        self.rng = np.random.default_rng(seed)
        self.startup, self.candidates, self.best_share, self.best_most = startup, candidates, best_share, best_most
        self.trials: list[tuple[dict, float]] = []

    def tell(self, params: dict, score: float) -> None:
        """Failed trials are not told."""
        if not np.isnan(score):
            self.trials.append((params, score))

    def suggest(self, name: str, space: tuple):
        if space[0] not in KINDS:
            raise ValueError(f"unknown space type {space[0]!r}")
        seen = [(params[name], score) for params, score in self.trials if name in params]
        if len(self.trials) < self.startup or not seen:
            return uniform(space, self.rng)
        seen.sort(key=lambda v: -v[1])
        n = min(ceil(self.best_share * len(seen)), self.best_most)
        good, other = [v for v, _ in seen[:n]], [v for v, _ in seen[n:]]
        return self._category(space[1], good, other) if space[0] == "categorical" else self._number(space, good, other)

    def suggest_all(self, space: dict, prefix: str = "") -> dict:
        return {f"{prefix}{name}": self.suggest(f"{prefix}{name}", one) for name, one in space.items()}

    def _category(self, values: list, good: list, other: list):
        def chances(found):
            counts = np.array([sum(v == f for f in found) for v in values], float) + 1 / len(values)
            return counts / counts.sum()

        p, q = chances(good), chances(other)
        drawn = self.rng.choice(len(values), size=self.candidates, p=p)
        return values[int(drawn[np.argmax(np.log(p[drawn]) - np.log(q[drawn]))])]

    def _number(self, space: tuple, good: list, other: list):
        kind, low, high = space
        to = log if kind == "log_float" else float
        edge = 0.5 if kind == "int" else 0.0
        a, b, step = to(low) - edge, to(high) + edge, 1.0 if kind == "int" else 0.0
        if a == b:
            return low
        near, far = (Mixture([to(v) for v in part], a, b, step) for part in (good, other))
        drawn = near.draw(self.candidates, self.rng)
        best = float(drawn[int(np.argmax([near.log_density(x) - far.log_density(x) for x in drawn]))])
        return int(round(best)) if kind == "int" else min(max(exp(best) if kind == "log_float" else best, low), high)
