"""Posterior modes of many small models at once.

A model has cross products of its terms, normal priors on most coefficients,
Laplace priors on some, and a half-normal prior on the residual deviation. Given
the residual variance, the most probable coefficients are the minimum of a convex
function. The solver guesses which Laplace terms are zero and the signs of the
others, solves the remaining linear system, and corrects the guess by the
derivatives, until a guess confirms itself: then every optimality condition
holds, and that is the certificate. Models whose guesses go round in circles
fall back on a search that lowers the function in every step. The residual
variance then follows from the coefficients, and both alternate.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: scale of the half-normal prior on the residual deviation.
SIGMA_SCALE = 0.5
#: Least residual deviation, as a part of a series' largest value. Below it the
#: density of an exact fit grows without bound and the priors would not count.
LEAST_SIGMA = 1e-4
GUESSES = 40
ROUNDS = 400
SETTLED = 1e-11


def variance_of(rss, observed):
    """Most probable residual variance, of numbers or of Spark columns.

    It minimises observed*log(s) + rss/(2 s^2) + s^2/(2 SIGMA_SCALE^2)."""
    scale, least = SIGMA_SCALE**2, LEAST_SIGMA**2
    if isinstance(rss, Column):
        return F.greatest((F.sqrt(observed * observed + 4 * rss / F.lit(scale)) - observed) * F.lit(scale / 2), F.lit(least))
    return np.maximum((np.sqrt(observed**2 + 4 * rss / scale) - observed) * scale / 2, least)


def _rss(products: np.ndarray, coef: np.ndarray) -> np.ndarray:
    normal, right, total = products[:, :-1, :-1], products[:, :-1, -1], products[:, -1, -1]
    fit = (normal @ coef[:, :, None])[:, :, 0]
    return np.maximum(total - 2 * (coef * right).sum(1) + (coef * fit).sum(1), 0.0)


def _stacked(ridge: np.ndarray, right: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Solutions of many systems, each over its free terms; the others are zero."""
    keep = free[:, :, None] & free[:, None, :]
    system = np.where(keep, ridge, 0.0)
    at = np.arange(ridge.shape[1])
    system[:, at, at] += ~free
    return np.linalg.solve(system, np.where(free, right, 0.0)[:, :, None])[:, :, 0]


def _search(ridge: np.ndarray, right: np.ndarray, pull: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """One model, from ``coef``, by steps that each lower the function; ``pull`` is
    zero for terms without a Laplace prior."""
    smooth = pull == 0
    sign = np.where(smooth, 0.0, np.sign(coef))

    def cost(c):
        return c @ ridge @ c / 2 - c @ right + pull @ np.abs(c)

    for _ in range(50 * len(coef)):
        free = smooth | (sign != 0)
        new = _stacked(ridge[None], (right - pull * sign)[None], free[None])[0]
        flips = ~smooth & (sign != 0) & (np.sign(new) != sign)
        if flips.any():  # go as far as the best zero crossing
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = np.append((coef / (coef - new))[flips & (coef != 0)], 1.0)
            tried = [coef + t * (new - coef) for t in steps[(steps > 0) & (steps <= 1)]]
            crossed = [np.where(~smooth & (np.abs(c) < 1e-14 * (1 + np.abs(coef))), 0.0, c) for c in tried]
            best = min(crossed, key=cost)
            if cost(best) < cost(coef):
                coef = best
                sign = np.where(smooth, 0.0, np.sign(coef))
                continue
            sign = np.where(flips, 0.0, sign)
            coef = np.where(flips, 0.0, coef)
            continue
        coef = new
        slope = ridge @ coef - right
        over = np.where(smooth | (sign != 0), 0.0, np.abs(slope) - pull)
        worst = int(np.argmax(over))
        if over[worst] <= 1e-12 * (1 + np.abs(right).max()):
            break
        sign[worst] = -np.sign(slope[worst])
    return coef


def _given_variance(ridge: np.ndarray, right: np.ndarray, pull: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most probable coefficients of many models, and the signs of the pulled ones,
    from a first guess of the signs."""
    smooth = pull == 0
    weight = np.maximum(np.diagonal(ridge, axis1=1, axis2=2), 1e-300)
    coef = np.zeros_like(right)
    open_ = np.arange(len(right))
    for _ in range(GUESSES):
        own, s = ridge[open_], sign[open_]
        c = _stacked(own, right[open_] - pull[open_] * s, smooth[open_] | (s != 0))
        slope = right[open_] - (own @ c[:, :, None])[:, :, 0]  # of the pull where a term is zero
        moved = c + np.where(s != 0, pull[open_] * s, slope) / weight[open_]
        new = np.where(smooth[open_] | (np.abs(moved) <= pull[open_] / weight[open_] * (1 + 1e-12)), 0.0, np.sign(moved))
        coef[open_], sign[open_] = c, new
        open_ = open_[(new != s).any(axis=1)]
        if not len(open_):
            return coef, sign
    for k in open_:
        coef[k] = _search(ridge[k], right[k], pull[k], np.zeros_like(right[k]))
        sign[k] = np.where(smooth[k], 0.0, np.sign(coef[k]))
    return coef, sign


def posterior_modes(products: np.ndarray, observed: np.ndarray, scales: np.ndarray, laplace: np.ndarray) -> np.ndarray:
    """Most probable coefficients of every model.

    ``products`` (models, terms + 1, terms + 1) are the summed cross products of
    the terms and, last, the value. Priors are normal, or Laplace where
    ``laplace``, with the given scales. The first term is the intercept; a series
    of equal values needs no other.
    """
    n, k = len(products), products.shape[1] - 1
    normal, right, total = products[:, :-1, :-1], products[:, :-1, -1], products[:, -1, -1]
    observed = np.asarray(observed, float)
    coef = np.zeros((n, k))
    flat = right[:, 0] ** 2 == observed * total
    coef[flat, 0] = right[flat, 0] / observed[flat]
    variance, sign = np.full(n, SIGMA_SCALE**2), np.zeros((n, k))
    at, open_ = np.arange(k), np.flatnonzero(~flat)
    for _ in range(ROUNDS):
        if not len(open_):
            break
        ridge = normal[open_].copy()
        ridge[:, at, at] += np.where(laplace, 0.0, variance[open_, None] / scales**2) + 1e-14 * np.diagonal(ridge, axis1=1, axis2=2)
        pull = np.where(laplace, variance[open_, None] / scales, 0.0)
        coef[open_], sign[open_] = _given_variance(ridge, right[open_], pull, sign[open_])
        new = variance_of(_rss(products[open_], coef[open_]), observed[open_])
        moved = np.abs(np.log(new / variance[open_]))
        variance[open_] = new
        open_ = open_[moved > SETTLED]
    return coef
