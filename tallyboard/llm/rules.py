"""A sparse ensemble of rules: paths of boosted trees, weighted by a lasso logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 32


@dataclass(frozen=True)
class Condition:
    feature: int
    limit: float
    above: bool


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleEnsemble:
    """score = sigmoid(base + sum of the weights of the rules that hold)."""

    features: tuple[str, ...]
    base: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def column(self) -> Column:
        """The score as one Spark expression over columns named as the features."""
        total = F.lit(self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for c in rule:
                value = F.col(self.features[c.feature])
                holds &= (value > c.limit) if c.above else (value <= c.limit)
            total += F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= (x[:, c.feature] > c.limit) if c.above else (x[:, c.feature] <= c.limit)
    return out


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Candidate limits of each feature: midpoints between neighbouring quantiles."""
    out = []
    for column in x.T:
        q = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1), method="nearest"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def tree_paths(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, least: int) -> list[Rule]:
    """Boosted trees on histograms of the features; every path to a node is a rule."""
    edges = _edges(x)
    bins = [np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)]
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = y - p, np.maximum(p * (1 - p), 1e-6)
        nodes: list[tuple[Rule, np.ndarray]] = [((), np.arange(len(y)))]
        leaves: list[np.ndarray] = []
        for _level in range(depth):
            below: list[tuple[Rule, np.ndarray]] = []
            for rule, rows in nodes:
                g, c = gradient[rows], curve[rows]
                parent, best = g.sum() ** 2 / (c.sum() + 1), (1e-6, -1, -1)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    here = bins[f][rows]
                    gs = np.cumsum(np.bincount(here, g, len(e) + 1))[:-1]
                    cs = np.cumsum(np.bincount(here, c, len(e) + 1))[:-1]
                    ns = np.cumsum(np.bincount(here, minlength=len(e) + 1))[:-1]
                    gain = gs**2 / (cs + 1) + (g.sum() - gs) ** 2 / (c.sum() - cs + 1) - parent
                    gain[(ns < least) | (len(rows) - ns < least)] = -1
                    at = int(np.argmax(gain))
                    if gain[at] > best[0]:
                        best = (float(gain[at]), f, at)
                _, f, at = best
                if f < 0:
                    leaves.append(rows)
                    continue
                low = bins[f][rows] <= at
                for above, side in ((False, rows[low]), (True, rows[~low])):
                    path = _tidy((*rule, Condition(f, float(edges[f][at]), above)))
                    rules[path] = None
                    below.append((path, side))
            nodes = below
        for rows in [*leaves, *(rows for _, rows in nodes)]:
            margin[rows] += rate * gradient[rows].sum() / (curve[rows].sum() + 1)
    return list(rules)


def _tidy(rule: Rule) -> Rule:
    """One condition per feature and direction: the strictest."""
    kept: dict[tuple[int, bool], float] = {}
    for c in rule:
        key = (c.feature, c.above)
        kept[key] = c.limit if key not in kept else (max if c.above else min)(kept[key], c.limit)
    return tuple(Condition(f, limit, above) for (f, above), limit in sorted(kept.items()))


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradient."""
    n, m = z.shape
    rate = 4.0 / (np.linalg.norm(np.column_stack([np.ones(n), z]), 2) ** 2 / n)
    w = v = np.zeros(m)
    b = c = float(np.log(y.mean() / (1 - y.mean())))
    t = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(z @ v + c))) - y
        w_new = v - rate * (z.T @ error) / n
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - rate * penalty, 0)
        b_new = c - rate * float(error.mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = w_new + (t - 1) / t_new * (w_new - w)
        c = b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return b, w


def fit_rules(
    x: np.ndarray,
    y: np.ndarray,
    features: tuple[str, ...],
    trees: int = 24,
    depth: int = 3,
    rate: float = 0.3,
    penalty: float = 0.001,
    steps: int = 300,
) -> RuleEnsemble:
    """Rules from boosted trees, kept and weighted by the lasso. One class only: a constant score."""
    if not len(y):
        return RuleEnsemble(features, 0.0)
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleEnsemble(features, float(np.log(share / (1 - share))))
    found = tree_paths(x, y, trees, depth, rate, least=max(5, len(y) // 1000))
    if not found:
        return RuleEnsemble(features, float(np.log(y.mean() / (1 - y.mean()))))
    z = np.column_stack([holds(rule, x) for rule in found])
    _, first = np.unique(z, axis=1, return_index=True)  # rules that hold for the same rows are one
    keep = np.sort(first)
    b, w = lasso(z[:, keep].astype(np.float64), y, penalty, steps)
    chosen = np.flatnonzero(np.abs(w) > 1e-6)
    return RuleEnsemble(
        features, b, tuple(found[keep[i]] for i in chosen), tuple(float(w[i]) for i in chosen)
    )
