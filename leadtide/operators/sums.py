"""Linear models from sums of products.

All a linear fit and its errors depend on are the sums of products of inputs and labels. One pass
collects them for every label at once: each task adds up its Arrow batches into one small matrix
per group, and a shuffle of those matrices adds up the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_sums(
    df: DataFrame, columns: Sequence[str], labels: Sequence[str], by: Sequence[str] = ()
) -> tuple[DataFrame, list[float]]:
    """Per group the matrix of sums of products of (1, columns, labels - centre), row by row in
    ``sums``, and the centre of each label (its mean, which keeps the sums precise).

    Rows where any label is missing are left out. ``by`` names few groups (fold parts).
    """
    by = list(by)
    known = df.dropna("any", subset=list(labels))
    means = known.agg(*[F.avg(y).alias(y) for y in labels]).first()  # one row
    centre = [float(means[y] or 0.0) for y in labels]
    source = known.select(
        *[F.col(b).cast("string").alias(b) for b in by],
        *columns,
        *[(F.col(y) - F.lit(c)).alias(y) for y, c in zip(labels, centre)],
    )

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            groups = pdf.groupby(by, sort=False) if by else [((), pdf)]
            for key, part in groups:
                x = part.drop(columns=by).to_numpy(dtype=float)
                x = np.hstack([np.ones((len(x), 1)), x])
                m = x.T @ x
                total[key] = total[key] + m if key in total else m
        yield pd.DataFrame([(*key, m.ravel()) for key, m in total.items()], columns=[*by, "sums"])

    partial = source.mapInPandas(add_up, ", ".join([*[f"`{b}` string" for b in by], "sums array<double>"]))
    added = (
        partial.select(*by, F.posexplode("sums").alias("i", "s"))
        .groupBy(*by, "i")
        .agg(F.sum("s").alias("s"))
        .groupBy(*by)
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda e: e["s"]).alias("sums"))
    )
    return added, centre


def one_label(sums: Sequence[float], n_labels: int, label: int) -> np.ndarray:
    """The matrix of (1, columns, one label)."""
    k = int(round(len(sums) ** 0.5))
    keep = [*range(k - n_labels), k - n_labels + label]
    return np.asarray(sums, dtype=float).reshape(k, k)[np.ix_(keep, keep)]


def solve_many(
    m: np.ndarray, kinds: Sequence[str], alphas: Sequence[float], ratios: Sequence[float]
) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts and weights (one column per parameter set) for one label."""
    n, p = m[0, 0], m.shape[0] - 2
    mean = m[0, 1:] / n
    c = m[1:, 1:] - n * np.outer(mean, mean)
    a, b = c[:p, :p], c[:p, p]
    kinds, alphas, ratios = np.asarray(kinds), np.asarray(alphas, float), np.asarray(ratios, float)
    w = np.zeros((p, len(kinds)))
    plain, ridge = kinds == "LinearRegression", kinds == "Ridge"
    if plain.any():
        w[:, plain] = np.linalg.lstsq(a, b, rcond=1e-12)[0][:, None]
    if ridge.any():
        # one decomposition serves every penalty
        values, vectors = np.linalg.eigh(a)
        values = np.maximum(values, 0.0)
        w[:, ridge] = vectors @ ((vectors.T @ b)[:, None] / (values[:, None] + alphas[ridge][None, :]))
    sparse = ~(plain | ridge)
    if sparse.any():
        mix = np.where(kinds[sparse] == "Lasso", 1.0, ratios[sparse])
        w[:, sparse] = _shrink(a / n, b / n, alphas[sparse] * mix, alphas[sparse] * (1 - mix))
    return mean[p] - mean[:p] @ w, w


def _shrink(
    a: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray, rounds: int = 20, sweeps: int = 20, tol: float = 1e-9
) -> np.ndarray:
    """Minimize w'aw/2 - b'w + l1 |w| + l2 w'w/2, for all penalties side by side.

    Sweeps of coordinate descent find which weights are zero; given those, the rest is a linear
    system, whose solution is taken once it meets the optimality conditions. What descent has not
    settled is finished by a search over signs, which is exact; a set that neither settles is an error.
    """
    p, t = len(b), len(l1)
    spread = np.maximum(np.diag(a), 0.0)  # a column without variance may come out just below zero
    w, grad = np.zeros((p, t)), np.repeat(b[:, None], t, axis=1)
    todo = np.arange(t)
    for _ in range(rounds):
        g, u, lo, ridge = grad[:, todo], w[:, todo], l1[todo], l2[todo]
        for _ in range(sweeps):
            moved = np.zeros(len(todo))
            for j in range(p):
                scale = spread[j] + ridge
                r = g[j] + spread[j] * u[j]
                new = np.sign(r) * np.maximum(np.abs(r) - lo, 0.0) / np.where(scale > 0, scale, np.inf)
                step = new - u[j]
                g -= a[:, j][:, None] * step
                u[j] = new
                np.maximum(moved, np.abs(step) * np.sqrt(spread[j]), out=moved)
        grad[:, todo], w[:, todo] = g, u
        still = []
        for k, i in enumerate(todo):
            exact = None if moved[k] <= tol else _given_signs(a, b, l1[i], l2[i], w[:, i])
            if exact is not None:
                w[:, i] = exact
            elif not moved[k] <= tol:
                still.append(i)
        todo = np.asarray(still, dtype=int)
        if not len(todo):
            break
    for i in todo:
        w[:, i] = _by_signs(a, b, l1[i], l2[i], w[:, i])
    return w


def _by_signs(a: np.ndarray, b: np.ndarray, l1: float, l2: float, w: np.ndarray, tol: float = 1e-9) -> np.ndarray:
    """The optimum by a search over the signs of the weights, from ``w`` on.

    Weights that are not zero move towards the optimum for their signs, as far as the objective
    falls, and stop at zero; then the zero weight that violates its condition most joins them.
    Columns are brought to one size first, as a wide column would hide what narrow ones still lack;
    a square root in place of the matrix keeps the objective convex whatever the rounding.
    """
    values, vectors = np.linalg.eigh(a + l2 * np.eye(len(b)))
    root = np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T
    size = np.sqrt((root * root).sum(axis=0))
    use = size > 0
    out, size = np.zeros_like(w), size[use]
    root, b, w, l1 = root[:, use] / size, b[use] / size, w[use] * size, l1 / size
    limit = tol * (1.0 + np.abs(b).max(initial=0.0))
    settled = False
    for _ in range(100 * (len(b) + 1)):
        sign = np.sign(w)
        on = w != 0
        slope = root.T @ (root @ w) - b
        held = np.where(on, np.abs(slope + l1 * sign), np.abs(slope) - l1)
        if held.max(initial=0.0) <= limit:
            break
        settled = settled or (held[on] <= limit).all()
        if settled:
            j = int(np.argmax(np.where(on, 0.0, held)))
            if not on[j]:
                sign[j], on[j] = -np.sign(slope[j]), True
        # 1e-13 keeps systems without one solution solvable; it shortens the step, so a fixed point is an optimum
        spread, axes = np.linalg.svd(root[:, on])[1:]
        spread = np.pad(spread, (0, len(axes) - len(spread)))
        step = np.zeros_like(w)
        step[on] = axes.T @ ((axes @ (-slope - l1 * sign)[on]) / (spread * spread + 1e-13))
        turns, stops = w * (w + step) < 0, np.ones_like(w)
        stops[turns] = -w[turns] / step[turns]
        best, change = None, 0.0
        for t in np.unique([*stops, 1.0]):
            v = w + step if t == 1 else np.where(stops == t, 0.0, w + t * step)
            moved, seen = v - w, root @ (v - w)
            gain = moved @ slope + seen @ seen / 2 + l1 @ (np.abs(v) - np.abs(w))
            if gain < change:
                best, change = v, gain
        if best is None and settled:  # as near as rounding allows
            break
        w, settled = (w, True) if best is None else (best, False)
    if held.max(initial=0.0) > 1e4 * limit:
        raise ArithmeticError("the penalized fit has not converged")
    out[use] = w / size
    return out


def _given_signs(a: np.ndarray, b: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray | None:
    """The optimum if the signs of ``w`` are those of the optimum, else None."""
    on = w != 0
    sign = np.sign(w[on])
    out = np.zeros_like(w)
    try:
        out[on] = np.linalg.solve(a[np.ix_(on, on)] + l2 * np.eye(on.sum()), b[on] - l1 * sign)
    except np.linalg.LinAlgError:
        return None
    slope = np.abs(b - a @ out)
    right = (np.sign(out[on]) == sign).all() and (slope[~on] <= l1 * (1 + 1e-9) + 1e-12).all()
    return out if right else None


def squared_errors(m: np.ndarray, intercepts: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sum of squared errors of each parameter set on the rows behind ``m``."""
    v = np.vstack([-intercepts[None, :], -w, np.ones((1, w.shape[1]))])
    return np.maximum(np.einsum("it,ij,jt->t", v, m, v), 0.0)
