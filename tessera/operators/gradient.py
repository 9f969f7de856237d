"""Distributed gradient trainers for linear models.

A gradient evaluation is ONE pass over the packed rows (``operators.blocks``):
each task multiplies its matrices with numpy (vectorised margins and ``X^T g``)
and emits its D + 2 sums as one row; a tree of bounded fan-in adds them.  Only
D + 2 numbers come back to the driver, which applies the update rule.  The
weights travel in the task closure (model-sized).

Update rules (full batch):
  * ``none``: ``w -= step_i * g``
  * ``l1``:   gradient step, then soft-threshold by ``reg * step_i``
  * ``l2``:   ``w = w * (1 - step_i * reg) - step_i * g``
with ``step_i = step / sqrt(i)`` (i = 1, 2, ...) and ``g`` the mean gradient.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .blocks import Blocks, blocks_of


def _margin(w: Sequence[float], x: str) -> Column:
    return V.dot(x, V.lit_vector(w))


def _row_terms(kind: str, m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(multiplier, loss)`` per row so that the row gradient is
    ``multiplier * x``.

    * ``logistic``: labels 0/1, loss log(1 + e^m) - y m
    * ``hinge``: labels 0/1 (mapped to -1/+1), loss max(0, 1 - s m)
    * ``squared``: least squares, loss (m - y)^2 / 2
    * ``logistic_pm``: labels -1/+1, multiplier (sigma(y m) - 1) y (the raw
      sum-gradient job), loss log(1 + e^(-y m))
    """
    if kind == "logistic":
        return 1.0 / (1.0 + np.exp(-m)) - y, np.logaddexp(0.0, m) - y * m
    if kind == "hinge":
        s = 2.0 * y - 1.0
        active = s * m < 1.0
        return np.where(active, -s, 0.0), np.maximum(0.0, 1.0 - s * m)
    if kind == "squared":
        return m - y, (m - y) ** 2 / 2
    if kind == "logistic_pm":
        return (1.0 / (1.0 + np.exp(-y * m)) - 1.0) * y, np.logaddexp(0.0, -y * m)
    raise ValueError(kind)


def gradient_sum(data: DataFrame | Blocks, w: Sequence[float], kind: str, x: str = "x", y: str = "y") -> tuple[np.ndarray, float, int]:
    """Sum of row gradients, sum of losses and row count at weights ``w``: one
    pass over the packed rows (``X w`` and ``X^T g`` are BLAS calls)."""
    wv = np.asarray(w, dtype=float)
    d = len(wv)
    blocks, own = blocks_of(data, {x: d, y: 0})

    def task(ms):
        out = np.zeros(d + 2)
        for X, yy in ms:
            mult, lo = _row_terms(kind, X @ wv, yy[:, 0])
            out += np.concatenate([X.T @ mult, [lo.sum(), len(X)]])
        return out
    try:
        tot = blocks.sums(task)
    finally:
        if own:
            blocks.unpersist()
    return tot[:d], float(tot[d]), int(tot[d + 1])


def normal_statistics(data: DataFrame | Blocks, d: int, x: str = "x", y: str = "y") -> tuple[np.ndarray, np.ndarray, float, int]:
    """``X^T X``, ``X^T y``, ``y^T y`` and n of ``d`` features in one pass:
    everything least squares needs."""
    blocks, own = blocks_of(data, {x: d, y: 0})

    def task(ms):
        out = np.zeros(d * d + d + 2)
        for X, yy in ms:
            out += np.concatenate([(X.T @ X).ravel(), X.T @ yy[:, 0], [(yy * yy).sum(), len(X)]])
        return out
    try:
        tot = blocks.sums(task)
    finally:
        if own:
            blocks.unpersist()
    return tot[:d * d].reshape(d, d), tot[d * d:d * d + d], float(tot[-2]), int(tot[-1])


def update(w: np.ndarray, g: np.ndarray, step_i: float, reg: float, updater: str) -> np.ndarray:
    if updater == "none":
        return w - step_i * g
    if updater == "l2":
        return w * (1.0 - step_i * reg) - step_i * g
    if updater == "l1":
        v = w - step_i * g
        shrink = reg * step_i
        return np.sign(v) * np.maximum(0.0, np.abs(v) - shrink)
    raise ValueError(updater)


def descend(stats: tuple[np.ndarray, np.ndarray, float, int], w: np.ndarray, iterations: int, step: float,
            reg: float = 0.0, updater: str = "none") -> tuple[np.ndarray, list[float]]:
    """Least-squares descent from the normal statistics of the data."""
    xtx, xty, yty, n = stats
    losses = []
    for i in range(1, iterations + 1 if n else 0):
        losses.append(float((w @ xtx @ w - 2 * w @ xty + yty) / (2 * n)))
        w = update(w, (xtx @ w - xty) / n, step / math.sqrt(i), reg, updater)
    return w, losses


def train_sgd(df: DataFrame, kind: str, dims: int, iterations: int = 100, step: float = 1.0,
              reg: float = 0.0, updater: str = "none", w0: Sequence[float] | None = None,
              x: str = "x", y: str = "y", one_pass: bool = False) -> tuple[np.ndarray, list[float]]:
    """Full-batch gradient descent with a decaying step; mean gradient.
    Returns the weights and the mean loss before each step.

    Every iteration is one pass over the packed, cached rows.  With
    ``one_pass`` (least squares only; the caller's choice, d * d numbers a task)
    the mean gradient ``(X^T X w - X^T y) / n`` comes from the normal statistics,
    so ONE pass serves all iterations with the same update sequence."""
    w = np.zeros(dims) if w0 is None else np.asarray(w0, dtype=float)
    losses: list[float] = []
    if one_pass and kind != "squared":
        raise ValueError("one_pass is for least squares")
    blocks = Blocks(df.select(F.col(x).alias("x"), F.col(y).alias("y")), {"x": dims, "y": 0})
    try:
        if one_pass:
            return descend(normal_statistics(blocks, dims), w, iterations, step, reg, updater)
        for i in range(1, iterations + 1):
            g, loss, n = gradient_sum(blocks, w, kind)
            if n == 0:
                break
            losses.append(loss / n)
            w = update(w, g / n, step / math.sqrt(i), reg, updater)
    finally:
        blocks.unpersist()
    return w, losses


def logistic_sum_gd(df: DataFrame, w0: Sequence[float], iterations: int = 5, step: float = 1.0,
                    x: str = "x", y: str = "y") -> np.ndarray:
    """Raw logistic-regression gradient descent with labels -1/+1, no
    intercept, no regularisation: ``w -= step * sum_i x_i (sigma(y_i w.x_i) - 1) y_i``
    (the SUM over rows, a constant step)."""
    w = np.asarray(w0, dtype=float)
    blocks = Blocks(df.select(F.col(x).alias("x"), F.col(y).alias("y")), {"x": len(w), "y": 0})
    try:
        for _ in range(iterations):
            g, _, _ = gradient_sum(blocks, w, "logistic_pm")
            w = w - step * g
    finally:
        blocks.unpersist()
    return w


def predict_linear(df: DataFrame, w: Sequence[float], x: str = "x", out: str = "prediction") -> DataFrame:
    """Row-local ``w . x`` (raw margin / regression output)."""
    return df.withColumn(out, _margin(list(map(float, w)), x))


# ------------------------------------------------------------------ L-BFGS
def wolfe_step(fun, w: np.ndarray, f: float, g: np.ndarray, direction: np.ndarray, slope: float,
               c1: float = 1e-4, c2: float = 0.9, max_evals: int = 25):
    """``(w, f, g)`` at a step that satisfies the strong Wolfe conditions
    (bracketing, then bisection with quadratic interpolation), or the best
    sufficient decrease within ``max_evals`` passes; None if there is none."""
    lo, f_lo, s_lo, hi, t, best = 0.0, f, slope, None, 1.0, None
    for _ in range(max_evals):
        x = w + t * direction
        ft, gt = fun(x)
        st = float(gt @ direction)
        down = np.isfinite(ft) and ft <= f + c1 * t * slope
        if down and (best is None or ft < best[1]):
            best = (x, ft, gt)
        if not down or ft >= f_lo and lo > 0:
            hi = t
        elif abs(st) <= -c2 * slope:
            return x, ft, gt
        elif st >= 0:
            hi = t
        else:
            lo, f_lo, s_lo = t, ft, st
        if hi is None:
            t = 2 * t
            continue
        width = hi - lo
        if width < 1e-12:
            break
        t = lo + 0.5 * width
        if hi > lo and np.isfinite(ft) and not down:
            curve = ft - f_lo - s_lo * (hi - lo)
            if curve > 0:                    # minimum of the parabola, kept inside the bracket
                t = min(max(lo - s_lo * (hi - lo) ** 2 / (2 * curve), lo + 0.1 * width), hi - 0.1 * width)
    return best


def lbfgs(fun, w0: np.ndarray, max_iter: int = 100, tol: float = 1e-4, m: int = 10,
          callback=None) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS (two-loop recursion, ``m`` corrections) with a
    strong Wolfe line search.  ``fun(w) -> (loss, grad)``; each call
    is one distributed job.  Stops after ``max_iter`` iterations or when the
    relative loss improvement falls below ``tol``."""
    w = np.asarray(w0, dtype=float).copy()
    f, g = fun(w)
    hist = [f]
    s_list: list[np.ndarray] = []
    y_list: list[np.ndarray] = []
    for _ in range(max_iter):
        q = g.copy()
        alphas = []
        for s, yv in reversed(list(zip(s_list, y_list))):
            rho = 1.0 / float(yv @ s)
            a = rho * float(s @ q)
            alphas.append((a, rho, s, yv))
            q -= a * yv
        if y_list:
            gamma = float(s_list[-1] @ y_list[-1]) / float(y_list[-1] @ y_list[-1])
        else:
            gamma = 1.0 / max(1.0, float(np.linalg.norm(g)))
        r = gamma * q
        for a, rho, s, yv in reversed(alphas):
            b = rho * float(yv @ r)
            r += s * (a - b)
        direction = -r
        slope = float(g @ direction)
        if slope >= 0:                       # not a descent direction: reset memory
            s_list.clear()
            y_list.clear()
            direction = -g / max(1.0, float(np.linalg.norm(g)))
            slope = float(g @ direction)
        step = wolfe_step(fun, w, f, g, direction, slope)
        if step is None:                     # no acceptable step: the loss can't be lowered further
            break
        w_new, f_new, g_new = step
        s_vec, y_vec = w_new - w, g_new - g
        if float(s_vec @ y_vec) > 1e-12:
            s_list.append(s_vec)
            y_list.append(y_vec)
            if len(s_list) > m:
                s_list.pop(0)
                y_list.pop(0)
        improvement = (f - f_new) / max(abs(f), 1e-12)
        w, f, g = w_new, f_new, g_new
        hist.append(f)
        if callback:
            callback(w, f)
        if 0 <= improvement < tol or float(np.linalg.norm(g)) < 1e-12:
            break
    return w, hist
