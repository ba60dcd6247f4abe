"""Linear models from sums of products; the matrices have one row per feature."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np

LINEAR = ("linear_regression", "ridge", "lasso")


def solve(
    total: np.ndarray,
    kept: list[int],
    name: str,
    params: Mapping[str, float],
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a model on the kept features.

    ``total`` holds the sums of products of [1, features, label].
    """
    at = [0, *[i + 1 for i in kept], total.shape[0] - 1]
    return Prepared(total[np.ix_(at, at)]).solve_all(name, [params])[0]


class Prepared:
    """Covariances from the sums of products of [1, features, label], for any number of models."""

    def __init__(self, total: np.ndarray):
        self.n = total[0, 0]
        if self.n == 0:
            raise ValueError("A fold has no training rows.")
        self.mean, self.mean_y = total[0, 1:-1] / self.n, total[0, -1] / self.n
        self.xx = total[1:-1, 1:-1] / self.n - np.outer(self.mean, self.mean)
        self.xy = total[1:-1, -1] / self.n - self.mean * self.mean_y

    def solve_all(
        self, name: str, params: Sequence[Mapping[str, float]]
    ) -> list[tuple[np.ndarray, float]]:
        """Weights and intercept for each set of parameters."""
        if name == "lasso":
            found = self._lasso_path(params)
        else:
            found = [self._least_squares(name, p) for p in params]
        return [(w, float(self.mean_y - w @ self.mean)) for w in found]

    def _least_squares(self, name: str, params: Mapping[str, float]) -> np.ndarray:
        if name == "linear_regression":
            return np.linalg.lstsq(self.xx, self.xy, rcond=None)[0]
        penalty = params.get("alpha", 1.0) / self.n
        return np.linalg.solve(self.xx + penalty * np.eye(len(self.xy)), self.xy)

    def _lasso_path(self, params: Sequence[Mapping[str, float]]) -> list[np.ndarray]:
        """From the largest penalty to the smallest, each from the weights before it."""
        found: list[np.ndarray] = [self.xy] * len(params)
        weights = np.zeros(len(self.xy))
        for k in sorted(range(len(params)), key=lambda k: -params[k].get("alpha", 1.0)):
            alpha, turns = params[k].get("alpha", 1.0), int(params[k].get("max_iter", 1000))
            settled = None if len(params) == 1 else descend(self.xx, self.xy, alpha, weights, turns)
            weights = lasso(self.xx, self.xy, alpha, turns) if settled is None else settled
            found[k] = weights
        return found


def descend(
    xx: np.ndarray, xy: np.ndarray, alpha: float, start: np.ndarray, max_iter: int = 1000
) -> np.ndarray | None:
    """The minimum that ``lasso`` finds, by coordinate descent from given weights.

    None if it does not settle within ``max_iter`` rounds, as with features that depend on each other.
    """
    weights, curve = start.copy(), np.diag(xx)
    moving = np.flatnonzero(curve > 0)
    weights[curve <= 0] = 0.0
    slope = xx @ weights - xy
    close = 1e-10 * np.abs(xy).max(initial=0.0)
    for _ in range(max_iter):
        most = 0.0
        for j in moving:
            pull = curve[j] * weights[j] - slope[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / curve[j]
            if new != weights[j]:
                most = max(most, curve[j] * abs(new - weights[j]))
                slope += xx[:, j] * (new - weights[j])
                weights[j] = new
        if most <= close:
            return weights
    return None


def lasso(xx: np.ndarray, xy: np.ndarray, alpha: float, max_iter: int = 1000) -> np.ndarray:
    """Minimises w'xx w / 2 - xy'w + alpha |w|_1 by feature-sign search.

    With the signs of the nonzero weights given, the minimum is a linear system. A move
    to it stops at the best point where a weight changes its sign, and that weight
    leaves; once the nonzero weights are right, the feature with the steepest slope
    joins. A trace of ridge lets the move leave through a weight when features are
    linearly dependent.
    """
    weights, signs = np.zeros(len(xy)), np.zeros(len(xy))
    trace = 1e-12 * max(np.diag(xx).mean(), 1e-300)
    close = 1e-10 * np.abs(xy).max(initial=0.0) + 1e-3 * alpha

    def value(w):
        return w @ xx @ w / 2 - xy @ w + alpha * np.abs(w).sum()

    best = value(weights)
    for _ in range(max_iter):
        slope = xx @ weights - xy
        settled = np.abs(slope + alpha * signs)[weights != 0].max(initial=0.0) <= close
        if settled:
            outside = np.where(weights == 0, np.abs(slope), 0.0)
            joining = int(np.argmax(outside))
            if outside[joining] <= alpha + close:
                break
            signs[joining] = -np.sign(slope[joining])
        active = np.flatnonzero(signs)
        system = xx[np.ix_(active, active)] + trace * np.eye(len(active))
        target = np.zeros_like(weights)
        target[active] = np.linalg.solve(system, xy[active] - alpha * signs[active])
        crossing = np.flatnonzero(weights * target < 0)
        shares = weights[crossing] / (weights[crossing] - target[crossing])
        moves = [(1.0, None), *zip(shares, crossing)]
        points = []
        for share, gone in moves:
            point = weights + share * (target - weights)
            if gone is not None:
                point[gone] = 0.0
            points.append(point)
        values = [value(point) for point in points]
        if min(values) >= best:
            break
        best, weights = min(values), points[int(np.argmin(values))]
        signs = np.sign(weights)
    return weights
