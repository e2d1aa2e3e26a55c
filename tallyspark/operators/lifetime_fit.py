"""Maximum likelihood fits of the lifetime models as Spark jobs.

The data stay on the cluster: each job evaluates likelihoods and their analytic gradients for a batch of candidate parameters
on every partition and returns a handful of sums per candidate. The driver holds only parameters. All trials of a search share
their jobs. A fit ends when its gradient vanishes, never at a number of rounds, and says so.
"""

from __future__ import annotations

import json
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass, field, replace
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lifetime import hyp2f1
from ..session import materialize

PARAMETERS = {"bgnbd": ("r", "alpha", "a", "b"), "pareto": ("r", "alpha", "s", "beta"), "gammagamma": ("p", "q", "v")}
INPUTS = {"bgnbd": ("x", "tx", "t"), "pareto": ("x", "tx", "t"), "gammagamma": ("x", "m")}


def lgamma(z: np.ndarray) -> np.ndarray:
    """ln Γ for positive z: shift up by eight, then the Stirling series."""
    z = np.asarray(z, dtype=float)
    shift = np.zeros_like(z)
    for k in range(8):
        shift += np.log(z + k)
    y = z + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * log(2 * np.pi) + series - shift


def digamma(z: np.ndarray) -> np.ndarray:
    """Derivative of ln Γ for positive z, by the same shift and series."""
    z = np.asarray(z, dtype=float)
    shift = np.zeros_like(z)
    for k in range(8):
        shift += 1 / (z + k)
    y = z + 8
    return np.log(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6) + 1 / (240 * y**8) - 1 / (132 * y**10) - shift


def bgnbd_loglik(theta: Sequence[float], d: dict[str, np.ndarray]) -> np.ndarray:
    r, alpha, a, b = theta
    x, tx, t = d["x"], d["tx"], d["t"]
    lnb = lgamma(b + x) - lgamma(np.array(b)) + lgamma(np.array(a + b)) - lgamma(a + b + x)
    head = lgamma(r + x) - lgamma(np.array(r)) + r * np.log(alpha)
    alive = -(r + x) * np.log(alpha + t)
    left = np.where(x > 0, np.log(a / np.maximum(b + x - 1, 1e-12)) - (r + x) * np.log(alpha + tx), -np.inf)
    return lnb + head + np.logaddexp(alive, left)


NODES, WEIGHTS = np.polynomial.legendre.leggauss(40)
PLACES = (NODES + 1) / 2


def _pareto_terms(theta: Sequence[float], d: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """ln of the alive part and of the dropped-out part of the likelihood, without the common factor."""
    return _pareto_integral(theta, d)[:2]


ROWS_AT_ONCE = 256  # rows whose nodes stay in a core's cache


def _pareto_integral(theta: Sequence[float], d: dict[str, np.ndarray], slopes: bool = False) -> list[np.ndarray]:
    """Both parts and, with ``slopes``, the means over the integral of ln(alpha+y), 1/(alpha+y), ln(beta+y) and 1/(beta+y).

    The second is s times the integral of (alpha+y)^-(r+x) (beta+y)^-(s+1) over y from tx to T (Schmittlein et al.
    1987, before it is written with a hypergeometric function). Integrating over ln((alpha+y)/(alpha+tx)), cut where
    the integrand has decayed, keeps a fixed Gauss rule accurate.
    """
    r, alpha, s, beta = theta
    x, tx, t = d["x"], d["tx"], d["t"]
    alive = -(r + x) * np.log(alpha + t) - s * np.log(beta + t)
    base, far = min(alpha, beta), max(alpha, beta)
    start, span = np.log(base + tx), np.log((base + t) / (base + tx))
    # the integrand falls at least like exp(-rate·u) with the rate at the start; 40 e-foldings are enough
    rate = (r + x) * (base + tx) / (alpha + tx) + (s + 1) * (base + tx) / (beta + tx) - 1
    width = np.where(rate > 0, np.minimum(span, 40.0 / np.maximum(rate, 1e-9)), span)
    powers = (r + x, np.full(len(x), s + 1.0))
    by_u, by_other = powers if alpha <= beta else powers[::-1]
    out = np.empty((6 if slopes else 2, len(x)))
    for first in range(0, len(x), ROWS_AT_ONCE):
        part = slice(first, first + ROWS_AT_ONCE)
        u = width[part, None] * PLACES
        u += start[part, None]
        near = np.exp(u)  # base + y
        distant = near + (far - base)  # the greater of both + y
        other = np.log(distant)
        logs = u * (1 - by_u[part, None])
        logs -= by_other[part, None] * other
        top = logs.max(axis=1)
        logs -= top[:, None]
        shares = np.exp(logs, out=logs)
        shares *= WEIGHTS
        whole = np.maximum(shares.sum(axis=1), 1e-300)
        out[1, part] = top + np.log(whole * np.maximum(width[part], 1e-300) / 2)
        if slopes:
            means = [np.einsum("ij,ij->i", shares, u), (shares / near).sum(axis=1), np.einsum("ij,ij->i", shares, other), (shares / distant).sum(axis=1)]
            out[2:, part] = np.array(means if alpha <= beta else means[2:] + means[:2]) / whole
    out[0] = alive
    out[1] += np.log(s)
    return list(out)


def pareto_loglik(theta: Sequence[float], d: dict[str, np.ndarray]) -> np.ndarray:
    r, alpha, s, beta = theta
    alive, left = _pareto_terms(theta, d)
    return lgamma(r + d["x"]) - lgamma(np.array(r)) + r * np.log(alpha) + s * np.log(beta) + np.logaddexp(alive, left)


def gammagamma_loglik(theta: Sequence[float], d: dict[str, np.ndarray]) -> np.ndarray:
    p, q, v = theta
    x, m = d["x"], d["m"]
    px = p * x
    return lgamma(px + q) - lgamma(px) - lgamma(np.array(q)) + q * np.log(v) + (px - 1) * np.log(m) + px * np.log(x) - (px + q) * np.log(x * m + v)


def _either(alive: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ln of the sum of two likelihoods, and the share of each, small ones to full accuracy."""
    gap = left - alive
    less = np.exp(-np.abs(gap))
    more = 1 / (1 + less)
    less *= more
    ahead = gap > 0
    return np.maximum(alive, left) - np.log(more), np.where(ahead, less, more), np.where(ahead, more, less)


def bgnbd_slopes(theta: Sequence[float], d: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log-likelihood of each row and its derivatives by r, alpha, a and b. What depends on the count alone is taken once for each count."""
    r, alpha, a, b = theta
    x, tx, t = d["x"], d["tx"], d["t"]
    counts, at = np.unique(x, return_inverse=True)
    often = np.maximum(b + counts - 1, 1e-12)
    log_t, log_tx = np.log(alpha + t), np.log(alpha + tx)
    both, stay, gone = _either(-(r + x) * log_t, np.where(counts > 0, np.log(a / often), -np.inf)[at] - (r + x) * log_tx)
    value = (lgamma(b + counts) - lgamma(np.array(b)) + lgamma(np.array(a + b)) - lgamma(a + b + counts) + lgamma(r + counts) - lgamma(np.array(r)) + r * np.log(alpha))[at] + both
    total = digamma(np.array(a + b)) - digamma(a + b + counts)
    return value, [
        (digamma(r + counts) - digamma(np.array(r)) + np.log(alpha))[at] - stay * log_t - gone * log_tx,
        r / alpha - (r + x) * (stay / (alpha + t) + gone / (alpha + tx)),
        total[at] + gone / a,
        (total + digamma(b + counts) - digamma(np.array(b)))[at] - gone * np.where(counts > 0, 1 / often, 0.0)[at],
    ]


def pareto_slopes(theta: Sequence[float], d: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log-likelihood of each row and its derivatives by r, alpha, s and beta; the limits of the integral depend on none."""
    r, alpha, s, beta = theta
    x, t = d["x"], d["t"]
    alive, left, log_alpha, over_alpha, log_beta, over_beta = _pareto_integral(theta, d, True)
    both, stay, gone = _either(alive, left)
    counts, at = np.unique(x, return_inverse=True)
    value = (lgamma(r + counts) - lgamma(np.array(r)) + r * np.log(alpha) + s * np.log(beta))[at] + both
    return value, [
        (digamma(r + counts) - digamma(np.array(r)) + np.log(alpha))[at] - stay * np.log(alpha + t) - gone * log_alpha,
        r / alpha - (r + x) * (stay / (alpha + t) + gone * over_alpha),
        np.log(beta) - stay * np.log(beta + t) + gone * (1 / s - log_beta),
        s / beta - stay * s / (beta + t) - gone * (s + 1) * over_beta,
    ]


def gammagamma_slopes(theta: Sequence[float], d: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log-likelihood of each row and its derivatives by p, q and v."""
    p, q, v = theta
    x, m = d["x"], d["m"]
    px, scale = p * x, x * m + v
    top = digamma(px + q)
    return gammagamma_loglik(theta, d), [
        x * (top - digamma(px) + np.log(m) + np.log(x) - np.log(scale)),
        top - digamma(np.array(q)) + np.log(v) - np.log(scale),
        q / v - (px + q) / scale,
    ]


LOGLIK = {"bgnbd": bgnbd_loglik, "pareto": pareto_loglik, "gammagamma": gammagamma_loglik}
SLOPES = {"bgnbd": bgnbd_slopes, "pareto": pareto_slopes, "gammagamma": gammagamma_slopes}


def bgnbd_expected(theta: Sequence[float], d: dict[str, np.ndarray], days: float) -> np.ndarray:
    r, alpha, a, b = theta
    x, tx, t = d["x"], d["tx"], d["t"]
    odds = np.where(x > 0, a / np.maximum(b + x - 1, 1e-12) * np.exp((r + x) * np.log((alpha + t) / (alpha + tx))), 0.0)
    shrink = np.exp((r + x) * np.log((alpha + t) / (alpha + t + days)))
    a1 = a - 1 if abs(a - 1) > 1e-9 else 1e-9
    return (a + b + x - 1) / a1 * (1 - shrink * hyp2f1(r + x, b + x, a + b + x - 1, days / (alpha + t + days))) / (1 + odds)


def pareto_alive(theta: Sequence[float], d: dict[str, np.ndarray]) -> np.ndarray:
    alive, left = _pareto_terms(theta, d)
    return 1 / (1 + np.exp(left - alive))


def pareto_expected(theta: Sequence[float], d: dict[str, np.ndarray], days: float) -> np.ndarray:
    r, alpha, s, beta = theta
    x, t = d["x"], d["t"]
    s1 = s - 1 if abs(s - 1) > 1e-9 else 1e-9
    window = -np.expm1(s1 * np.log((beta + t) / (beta + t + days)))
    return (r + x) * (beta + t) / ((alpha + t) * s1) * window * pareto_alive(theta, d)


def gammagamma_expected(theta: Sequence[float], d: dict[str, np.ndarray]) -> np.ndarray:
    p, q, v = theta
    return p * (v + d["x"] * d["m"]) / (p * d["x"] + q - 1)


def lifetime_cells(metrics: DataFrame, x: str = "frequency", tx: str = "recency", t: str = "T") -> DataFrame:
    """Distinct (x, tx, t) with their number of customers: the likelihood needs no more than that."""
    return metrics.groupBy(F.col(x).cast("double").alias("x"), F.col(tx).cast("double").alias("tx"), F.col(t).cast("double").alias("t")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def spend_cells(metrics: DataFrame, x: str = "frequency", m: str = "monetary_value") -> DataFrame:
    kept = metrics.where((F.col(x) > 0) & (F.col(m) > 0))
    return kept.groupBy(F.col(x).cast("double").alias("x"), F.col(m).cast("double").alias("m")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def likelihood_sums(cells: DataFrame, candidates: Sequence[tuple[str, Sequence[float]]], slopes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Mean log-likelihood of each (model, parameters) over the whole of ``cells``, and its gradient, in one job.

    Cells may come in copies, numbered by ``lane`` of ``lanes``: each copy then serves its share of the candidates.
    """
    task = json.dumps([(m, [float(v) for v in p]) for m, p in candidates])
    columns = sorted({c for m, _ in candidates for c in INPUTS[m]})
    kept = cells if "lane" in cells.columns else cells.withColumns({"lane": F.lit(0), "lanes": F.lit(1)})

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        todo = json.loads(task)
        found: dict[int, np.ndarray] = {}
        with np.errstate(all="ignore"):
            for whole in batches:
                for (lane, lanes), pdf in whole.groupby(["lane", "lanes"]):
                    d = {c: pdf[c].to_numpy() for c in columns}
                    n = pdf["n"].to_numpy()
                    for i in range(int(lane), len(todo), int(lanes)):
                        model, theta = todo[i]
                        value, by = SLOPES[model](theta, d) if slopes else (LOGLIK[model](theta, d), [])
                        found[i] = found.get(i, 0.0) + np.array([n.sum(), *(np.dot(n, v) for v in (value, *by))])
        yield pd.DataFrame([(i, k, v) for i, sums in found.items() for k, v in enumerate(sums)], columns=["candidate", "item", "total"])

    rows = (
        kept.select(*columns, "n", "lane", "lanes").mapInPandas(partial_sums, "candidate INT, item INT, total DOUBLE")
        .groupBy("candidate", "item").agg(F.sum("total").alias("total")).collect()  # a few rows per candidate
    )
    sums = np.full((len(candidates), 2 + max(len(p) for _, p in candidates)), np.nan)
    for row in rows:
        sums[row["candidate"], row["item"]] = row["total"]
    return sums[:, 1] / sums[:, 0], sums[:, 2:] / sums[:, :1]


def log_likelihoods(cells: DataFrame, candidates: Sequence[tuple[str, Sequence[float]]]) -> np.ndarray:
    """Mean log-likelihood of each (model, parameters) over the whole of ``cells``."""
    values = likelihood_sums(cells, candidates, slopes=False)[0]
    return np.where(np.isfinite(values), values, -np.inf)


@dataclass(frozen=True)
class Fit:
    """Parameters, and what certifies them: the largest slope of the penalised mean log-likelihood by a log parameter.

    The log-likelihood is the plain mean in the units the fit runs in.
    """

    parameters: list[float]
    rounds: int
    gradient: float
    log_likelihood: float
    converged: bool
    curvature: np.ndarray | None = field(default=None, compare=False, repr=False)  # of the plain mean, by log parameters


TOLERANCE = 1e-8
MAX_ROUNDS = 300


QUICK_ROUNDS = 40
ROUGH = 1e-3  # slope up to which a fit without a known curvature takes second derivatives each round


def _quick(model: str, start: Sequence[float], l2: float, curvature: np.ndarray, tolerance: float) -> Generator[list[tuple[str, list[float]]], tuple[np.ndarray, np.ndarray], Fit | None]:
    """Newton ascent with one candidate a round, from a curvature known nearby that the gradients keep up to date.

    The penalty's own curvature is exact. A round that is no better than the last is cut to a quarter. Where a parameter runs to
    zero, slope and curvature vanish together: steps there are bounded by the tolerance, and longer where the last one went the same way. Ends within ``tolerance`` when a further step would move the plain
    log-likelihood by less than a hundredth of it; gives up when cutting does not help either.
    """
    at, curve, last, found, cuts = np.log(np.asarray(start, dtype=float)), curvature.copy(), None, None, 0
    move, wanted = np.zeros(len(at)), np.zeros(len(at))
    for rounds in range(1, QUICK_ROUNDS + 1):
        theta = np.exp(at)
        values, slopes = yield [(model, theta.tolist())]
        plain, value = slopes[0, : len(at)] * theta, values[0] - l2 * np.sum(theta**2)
        gradient = plain - 2 * l2 * theta**2
        norm = float(np.abs(gradient).max())
        sound = bool(np.isfinite(norm) and np.isfinite(value))
        if last is not None and sound:
            step, change = at - last[0], plain - last[1]
            rest = change - curve @ step
            if abs(rest @ step) > 1e-8 * np.linalg.norm(rest) * np.linalg.norm(step):
                curve = curve + np.outer(rest, rest) / (rest @ step)
        if not sound or last is not None and (value < last[3] - 1e-11 * max(1.0, abs(value)) or norm > 10 * last[2]):
            if last is None or found or cuts == 3:
                return found
            cuts, move = cuts + 1, move / 4
            at = last[0] + move
            continue
        curves, vectors = np.linalg.eigh(np.diag(4 * l2 * theta**2) - curve)
        slope = vectors.T @ gradient
        move = vectors @ (slope / np.maximum(np.abs(curves), tolerance))
        if norm <= tolerance:
            found = Fit(theta.tolist(), rounds, norm, float(values[0]), True, curve)
            if np.abs(plain) @ np.abs(move) <= tolerance / 100:
                return found
        last, cuts = (at, plain, norm, value), 0
        again = wanted @ move > 0.9 * np.linalg.norm(wanted) * np.linalg.norm(move) and np.linalg.norm(move) > 0.1
        wanted, move = move, move * (4.0 if again else 1.0)
        move = move * min(1.0, 3.0 / max(np.max(np.abs(move)), 1e-12))
        at = at + move
    return found


def _near(model: str, start: Sequence[float], l2: float, curvature: np.ndarray | None, tolerance: float) -> Generator[list[tuple[str, list[float]]], tuple[np.ndarray, np.ndarray], Fit]:
    """One candidate a round from where a curvature is known, be it only roughly at the maximum; the whole method where that does not lead there."""
    rounds = 0
    if curvature is None and tolerance < ROUGH:
        rough = yield from _newton(model, start, l2, ROUGH)
        start, curvature, rounds = rough.parameters, rough.curvature, rough.rounds
    found = None if curvature is None else (yield from _quick(model, start, l2, curvature, tolerance))
    found = found or (yield from _newton(model, start, l2, tolerance))
    return replace(found, rounds=found.rounds + rounds)


def _newton(model: str, start: Sequence[float], l2: float, tolerance: float = TOLERANCE) -> Generator[list[tuple[str, list[float]]], tuple[np.ndarray, np.ndarray], Fit]:
    """Damped Newton ascent on log parameters until the gradient vanishes. Yields candidates, receives values and gradients.

    Each batch holds a damped step, and around it a small move along every axis, whose gradients give the second
    derivatives: a step costs one job. Raises if no step gains although the gradient is not zero.
    """
    at, k, h = np.log(np.asarray(start, dtype=float)), len(start), 1e-4
    offsets = np.concatenate([np.zeros((1, k)), h * np.eye(k)])
    center, best, norm, damping = at, -np.inf, np.inf, 1e-3
    gradient, hessian = np.zeros(k), -np.eye(k)
    for rounds in range(1, MAX_ROUNDS + 1):
        theta = np.exp(center + offsets)
        values, slopes = yield [(model, p) for p in theta.tolist()]
        f = values - l2 * np.sum(theta**2, axis=1)
        g = slopes[:, :k] * theta - 2 * l2 * theta**2
        sound = np.isfinite(f).all() and np.isfinite(g).all()
        top, now = float(f[0]), float(np.abs(g[0]).max())
        # values equal to rounding are told apart by their gradients
        noise = 1e-11 * max(1.0, abs(best)) if np.isfinite(best) else 0.0
        if sound and (top > best + noise or top >= best - noise and now < norm):
            if np.isfinite(best):
                damping = max(damping * 1e-2, 1e-12)
            at, best, norm = center, top, now
            gradient, hessian = g[0], (g[1:] - g[:1]) / h
            hessian = (hessian + hessian.T) / 2
            if norm <= tolerance:
                return Fit(np.exp(at).tolist(), rounds, norm, float(values[0]), True, hessian + np.diag(4 * l2 * np.exp(2 * at)))
        elif damping > 1e9:
            break
        else:
            damping *= 1e2
        curves, vectors = np.linalg.eigh(-hessian)
        move = vectors @ ((vectors.T @ gradient) / (np.abs(curves) + damping))
        center = at + move * min(1.0, 3.0 / max(np.max(np.abs(move)), 1e-12))
    raise RuntimeError(f"{model} with l2 {l2}: gradient {norm} after {rounds} rounds at {np.exp(at).tolist()}")


def fit_all(cells: DataFrame, starts: Sequence[tuple], tolerance: float = TOLERANCE) -> list[Fit]:
    """Fit several (model, start, l2, perhaps the curvature at the start) side by side; every round of all of them is one job."""
    runs = [_near(m, s, l2, known[0] if known else None, tolerance) for m, s, l2, *known in starts]
    results: list[Fit | None] = [None] * len(runs)
    pending = {i: next(run) for i, run in enumerate(runs)}
    while pending:
        order = list(pending)
        values, slopes = likelihood_sums(cells, [c for i in order for c in pending[i]])
        following, offset = {}, 0
        for i in order:
            mine = slice(offset, offset + len(pending[i]))
            offset = mine.stop
            try:
                following[i] = runs[i].send((values[mine], slopes[mine]))
            except StopIteration as done:
                results[i] = done.value
        pending = following
    return results


def _along(fitted: Fit, l2: float, to: float) -> list[float]:
    """Where the maximum is at a weight near that of a fit, to first order in the logarithm of the weight."""
    theta = np.asarray(fitted.parameters)
    if fitted.curvature is None or min(l2, to) <= 0 or not 0.5 < to / l2 < 2:
        return fitted.parameters
    curves, vectors = np.linalg.eigh(np.diag(4 * l2 * theta**2) - fitted.curvature)
    move = -2 * l2 * np.log(to / l2) * (vectors @ ((vectors.T @ theta**2) / np.maximum(np.abs(curves), TOLERANCE)))
    return (theta * np.exp(np.clip(move, -1.0, 1.0))).tolist()


def fit_path(cells: DataFrame, plan: Sequence[tuple[str, float]], starts: dict[str, Sequence[float]], tolerance: float = TOLERANCE) -> list[Fit]:
    """Fit each (model, l2) of a plan, starting at the nearest weight of its model that is already fitted.

    The middle weight of every model comes first, then every eighth, then the rest: three waves, each side by side, the
    last ones a few Newton steps from their start. A fit also takes the curvature over from where it starts.
    """
    found: dict[int, Fit] = {}
    lines = {m: sorted((i for i, (name, _) in enumerate(plan) if name == m), key=lambda i: plan[i][1]) for m, _ in plan}
    for stride in (len(plan) + 1, 8, 1):
        wave = []
        for model, line in lines.items():
            done = [i for i in line if i in found]
            chosen = [i for place, i in enumerate(line) if i not in found and place % stride == min(stride, len(line)) // 2]
            for i in chosen:
                nearest = min(done, key=lambda j: abs(plan[j][1] - plan[i][1]), default=None)
                begin = (starts[model], None) if nearest is None else (_along(found[nearest], plan[nearest][1], plan[i][1]), found[nearest].curvature)
                wave.append((i, (model, begin[0], plan[i][1], begin[1])))
        for (i, _), fitted in zip(wave, fit_all(cells, [w for _, w in wave], tolerance) if wave else []):
            found[i] = fitted
    return [found[i] for i in range(len(plan))]


# Starting points, and the parameters that carry the unit of time. Fits run with the longest age scaled to ten and the mean
# spend to one, so that one L2 weight means the same on any data.
STARTS = {"bgnbd": (1.0, 1.0, 0.5, 2.0), "pareto": (1.0, 1.0, 0.5, 2.0), "gammagamma": (2.0, 3.0, 1.0)}
TIME_UNITS = {"bgnbd": (False, True, False, False), "pareto": (False, True, False, True)}


CELLS_PER_TASK = 4000


def _kept(cells: DataFrame, top: str) -> tuple[DataFrame, float]:
    """Keep the cells in as many partitions as their number is worth; few cells in copies, so that all cores share the candidates.

    Also gives the maximum (mean spend) of a column.
    """
    spark = cells.sparkSession
    plain = materialize(cells, "cells")
    value = F.max("t") if top == "t" else F.sum(F.col("m") * F.col("n")) / F.sum("n")
    size, found = plain.agg(F.count(F.lit(1)), value).first()
    parts = max(1, -(-size // CELLS_PER_TASK))
    lanes = max(1, spark.sparkContext.defaultParallelism // parts)
    copies = plain.withColumns({"lane": F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))), "lanes": F.lit(lanes)})
    return copies.repartitionByRange(parts * lanes, "lane", "x", "n").persist(), float(found or 1.0)


def fit_lifetimes(cells: DataFrame, plan: Sequence[tuple[str, float]]) -> list[Fit]:
    """A fit in days for each (model, l2) in ``plan``."""
    kept, top = _kept(cells, "t")
    scale = 10.0 / top
    try:
        fitted = fit_path(kept.withColumns({"tx": F.col("tx") * scale, "t": F.col("t") * scale}), plan, STARTS)
    finally:
        kept.unpersist()
    return [replace(f, parameters=[v / scale if timed else v for v, timed in zip(f.parameters, TIME_UNITS[m])]) for (m, _), f in zip(plan, fitted)]


def fit_spends(cells: DataFrame, weights: Sequence[float]) -> list[Fit]:
    """A fit of the spend model for each L2 weight, with money scaled to a mean spend of one while it runs."""
    kept, mean = _kept(cells, "m")
    try:
        fitted = fit_path(kept.withColumn("m", F.col("m") / mean), [("gammagamma", l2) for l2 in weights], STARTS)
    finally:
        kept.unpersist()
    return [replace(f, parameters=[*f.parameters[:2], f.parameters[2] * mean]) for f in fitted]


def fit_bgnbd(cells: DataFrame, l2: float = 0.0) -> dict[str, float]:
    return dict(zip(PARAMETERS["bgnbd"], fit_lifetimes(cells, [("bgnbd", l2)])[0].parameters))


def fit_pareto(cells: DataFrame, l2: float = 0.0) -> dict[str, float]:
    return dict(zip(PARAMETERS["pareto"], fit_lifetimes(cells, [("pareto", l2)])[0].parameters))


def fit_gammagamma(cells: DataFrame, l2: float = 0.0) -> dict[str, float]:
    return dict(zip(PARAMETERS["gammagamma"], fit_spends(cells, [l2])[0].parameters))


def holdout_losses(holdout: DataFrame, fitted: Sequence[tuple[str, Sequence[float]]], days: float) -> DataFrame:
    """(trial, mse) of predicted against actual holdout purchases for every fitted model, in one job.

    ``holdout`` has frequency_cal, recency_cal, T_cal, frequency_holdout; equal customers are counted first.
    """
    task = json.dumps([(m, list(map(float, p))) for m, p in fitted])
    cells = holdout.groupBy(*[F.col(c).cast("double").alias(a) for c, a in (("frequency_cal", "x"), ("recency_cal", "tx"), ("T_cal", "t"), ("frequency_holdout", "y"))]).agg(F.count(F.lit(1)).cast("double").alias("n"))

    def squared_errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        todo = json.loads(task)
        sums, weight = np.zeros(len(todo)), 0.0
        with np.errstate(all="ignore"):
            for pdf in batches:
                d = {c: pdf[c].to_numpy() for c in ("x", "tx", "t", "y")}
                n = pdf["n"].to_numpy()
                weight += n.sum()
                for i, (model, theta) in enumerate(todo):
                    predict = bgnbd_expected if model == "bgnbd" else pareto_expected
                    sums[i] += float(np.dot(n, (predict(theta, d, days) - d["y"]) ** 2))
        yield pd.DataFrame({"trial": np.arange(len(todo)), "se": sums, "n": weight})

    return cells.mapInPandas(squared_errors, "trial INT, se DOUBLE, n DOUBLE").groupBy("trial").agg((F.sum("se") / F.sum("n")).alias("mse"))


def spend_losses(holdout: DataFrame, fitted: Sequence[Sequence[float]]) -> DataFrame:
    """(trial, mse) of the spend that calibration rows predict against the holdout's, for every fitted spend model, in one pass."""
    rows = holdout.where("frequency_cal > 0 AND monetary_value_cal > 0").select(*[F.col(c).cast("double").alias(a) for c, a in (("frequency_cal", "x"), ("monetary_value_cal", "m"), ("monetary_value_holdout", "y"))])
    trials = F.array(*[F.struct(F.lit(i).alias("trial"), *[F.lit(float(v)).alias(n) for n, v in zip("pqv", p)]) for i, p in enumerate(fitted)])
    each = rows.withColumn("f", F.explode(trials)).select("x", "m", "y", "f.*")
    predicted = F.col("p") * (F.col("v") + F.col("x") * F.col("m")) / (F.col("p") * F.col("x") + F.col("q") - 1)
    return each.groupBy("trial").agg(F.avg(F.pow(predicted - F.col("y"), 2)).alias("mse"))


def _trial_table(losses: DataFrame, plan: Sequence[tuple[str, float]], fitted: Sequence[Fit]) -> DataFrame:
    rows = [(i, m, l2, f.parameters, f.log_likelihood, f.rounds, f.gradient, f.converged) for i, ((m, l2), f) in enumerate(zip(plan, fitted))]
    schema = "trial INT, model STRING, l2 DOUBLE, parameters ARRAY<DOUBLE>, log_likelihood DOUBLE, rounds INT, gradient DOUBLE, converged BOOLEAN"
    return losses.sparkSession.createDataFrame(rows, schema).join(losses, "trial")


def search_lifetime_model(holdout: DataFrame, days: float, trials: int = 100, seed: int = 42) -> DataFrame:
    """Random search over model type and L2 weight; one row per trial with its parameters, certificate and holdout MSE."""
    rng = np.random.default_rng(seed)
    plan = [(("bgnbd", "pareto")[int(rng.integers(2))], float(rng.uniform(0.0, 1.0))) for _ in range(trials)]
    fitted = fit_lifetimes(lifetime_cells(holdout, "frequency_cal", "recency_cal", "T_cal"), plan)
    return _trial_table(holdout_losses(holdout, [(m, f.parameters) for (m, _), f in zip(plan, fitted)], days), plan, fitted)


def search_spend_model(holdout: DataFrame, trials: int = 100, seed: int = 42) -> DataFrame:
    """Random search over the L2 weight of the spend model; one row per trial, as for the lifetime models."""
    rng = np.random.default_rng(seed)
    plan = [("gammagamma", float(rng.uniform(0.0, 1.0))) for _ in range(trials)]
    fitted = fit_spends(spend_cells(holdout, "frequency_cal", "monetary_value_cal"), [l2 for _, l2 in plan])
    return _trial_table(spend_losses(holdout, [f.parameters for f in fitted]), plan, fitted)


def best_trial(search: DataFrame) -> DataFrame:
    """The trial with the least loss; of equal ones the first."""
    return search.where(~F.isnan("mse")).agg(F.min_by(F.struct(*search.columns), F.struct("mse", "trial")).alias("b")).select("b.*")
