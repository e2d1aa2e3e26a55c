"""Closed forms of the customer lifetime models, as columns.

BG/NBD (Fader, Hardie, Lee 2005) and Gamma-Gamma (Fader, Hardie 2013). x is the number of repeat purchase
days, tx the age at the last one, T the age at the end of observation, all in days.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import as_col


@dataclass(frozen=True)
class BgNbd:
    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGamma:
    p: float
    q: float
    v: float


def p_alive(x: Column | str, tx: Column | str, T: Column | str, m: BgNbd) -> Column:
    """Probability that a customer is still active; 1 without repeat purchases."""
    x, tx, T = (as_col(c).cast("double") for c in (x, tx, T))
    odds = m.a / (m.b + x - 1) * F.pow((m.alpha + T) / (m.alpha + tx), m.r + x)
    return F.when(x > 0, 1 / (1 + odds)).otherwise(F.lit(1.0))


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series for 0 <= z < 1, summed until the terms no longer matter."""
    term = np.ones(np.broadcast_shapes(np.shape(a), np.shape(b), np.shape(c), np.shape(z)))
    total, k = term.copy(), 0
    while np.any(np.abs(term) > 1e-13 * np.abs(total)):
        term = term * ((a + k) * (b + k) / ((c + k) * (k + 1.0)) * z)
        total = total + term
        k += 1
    return total


def purchase_curve(x: Column | str, T: Column | str, m: BgNbd, horizons: Sequence[float]) -> Column:
    """Array with one value per horizon t: 1 − ((α+T)/(α+T+t))^(r+x) · ₂F₁(r+x, b+x; a+b+x−1; t/(α+T+t)).

    The series has no built-in; on Arrow batches it costs a few array operations per term, where a higher-order
    function would be interpreted term by term. NULL inputs give NULL.
    """
    steps = np.array([float(t) for t in horizons])

    def curve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ages in batches:
            n, age = xs.to_numpy("float64")[:, None], ages.to_numpy("float64")[:, None]
            with np.errstate(invalid="ignore"):
                end = m.alpha + age + steps
                values = 1 - np.exp((m.r + n) * np.log((m.alpha + age) / end)) * hyp2f1(m.r + n, m.b + n, m.a + m.b + n - 1, steps / end)
            yield pd.Series(list(values))

    result = F.pandas_udf(curve, "array<double>")(as_col(x).cast("double"), as_col(T).cast("double"))
    return F.when(as_col(x).isNotNull() & as_col(T).isNotNull(), result)


def _future_rate(x: Column | str, tx: Column | str, T: Column | str, m: BgNbd) -> Column:
    return (m.a + m.b + as_col(x).cast("double") - 1) / (m.a - 1) * p_alive(x, tx, T, m)


def expected_purchases(t: float, x: Column | str, tx: Column | str, T: Column | str, m: BgNbd) -> Column:
    """Expected purchases in the next t days."""
    return _future_rate(x, tx, T, m) * purchase_curve(x, T, m, [t])[0]


def expected_purchases_at(horizons: Sequence[float], x: Column | str, tx: Column | str, T: Column | str, m: BgNbd) -> Column:
    """Expected purchases for several horizons as one array."""
    rate = _future_rate(x, tx, T, m)
    return F.transform(purchase_curve(x, T, m, horizons), lambda c: c * rate)


def expected_spend(x: Column | str, mean_spend: Column | str, g: GammaGamma) -> Column:
    """Expected average spend per purchase day."""
    x, mean = as_col(x).cast("double"), as_col(mean_spend).cast("double")
    return g.p * (g.v + x * mean) / (g.p * x + g.q - 1)


def lifetime_value(x: Column | str, tx: Column | str, T: Column | str, mean_spend: Column | str, m: BgNbd, g: GammaGamma, months: int = 12, discount: float = 0.01) -> Column:
    """Discounted spend of the next months, in steps of 30 days.

    Σ (E(30i) − E(30(i−1))) / (1+d)^i, summed by parts: every horizon is needed once, with a constant weight.
    """
    v = 1 / (1 + discount)
    weights = [v**i - v ** (i + 1) for i in range(1, months)] + [v**months]
    curve = purchase_curve(x, T, m, [30.0 * i for i in range(1, months + 1)])
    total = F.aggregate(F.zip_with(curve, F.array(*[F.lit(w) for w in weights]), lambda c, w: c * w), F.lit(0.0), lambda s, c: s + c)
    return expected_spend(x, mean_spend, g) * _future_rate(x, tx, T, m) * total
