"""Per-series daily forecasts.

Rows are summed to (keys, day) first, so a group never holds more than one row per calendar day, and Spark
spreads the groups by a hash of their keys. The fit is a decomposition after Taylor and Letham (2018): a linear trend whose
slope may change at some of many candidate dates, times (1 + weekly + yearly Fourier terms). Changes of slope carry an L1
penalty, so most candidates change nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import regression_metrics
from .mutate import by_key

WEEKLY_TERMS, YEARLY_TERMS = 3, 10
# candidate dates for a change of slope lie in the first part of the history; prior scale of a change, as a share of the largest value
CANDIDATES, CANDIDATE_SHARE, CHANGE_SCALE, DAYS_PER_CANDIDATE = 25, 0.8, 0.05, 20


def sales_history(df: DataFrame, keys: Sequence[str], at: str, amount: str) -> DataFrame:
    """(keys…, ds, y) with one row per day, days without a value left out."""
    daily = df.groupBy(*keys, F.to_date(at).alias("ds")).agg(F.sum(amount).cast("double").alias("y"))
    return daily.where("y IS NOT NULL AND ds IS NOT NULL")


def _fourier(days: np.ndarray, period: float, terms: int) -> np.ndarray:
    angle = 2 * np.pi * np.outer(days / period, np.arange(1, terms + 1))
    return np.hstack([np.sin(angle), np.cos(angle)])


def _ridge(a: np.ndarray, b: np.ndarray, weight: float = 0.1) -> np.ndarray:
    """Slightly shrunk least squares, so that short histories stay stable."""
    return np.linalg.solve(a.T @ a + weight * np.eye(a.shape[1]), a.T @ b)


def lasso(gram: np.ndarray, target: np.ndarray, penalty: float, tolerance: float = 1e-10, sweeps: int = 5000) -> np.ndarray:
    """Minimum of x'Gx / 2 - x'c + penalty * |x|, by coordinate descent from zero; columns without weight stay zero."""
    x, left = np.zeros(len(target)), target.astype(float).copy()  # left = c - Gx
    weights = np.diag(gram)
    scale = max(np.abs(target).max(initial=0.0), 1e-300)
    for _ in range(sweeps):
        largest = 0.0
        for j in np.flatnonzero(weights > 1e-12 * max(weights.max(initial=0.0), 1e-300)):
            wish = left[j] + weights[j] * x[j]
            value = np.sign(wish) * max(abs(wish) - penalty, 0.0) / weights[j]
            if value != x[j]:
                left -= gram[:, j] * (value - x[j])
                largest = max(largest, abs(value - x[j]) * weights[j])
                x[j] = value
        if largest <= tolerance * scale:
            break
    return x


def fit_trend(t: np.ndarray, y: np.ndarray, season: np.ndarray, change_scale: float = CHANGE_SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level and slope at t = 0, candidate times, and the change of slope at each of them.

    Level, slope and the seasonal columns are free; what they cannot explain is left to the hinges max(t - candidate, 0). The
    penalty is the noise variance over the prior scale of a change, the noise being what free hinges leave.
    """
    plain = np.column_stack([np.ones_like(t), t]) if len(t) > 1 else np.ones((1, 1))
    base = np.hstack([plain, season]) if len(t) >= 2 * (season.shape[1] + 2) else plain
    number = min(CANDIDATES, len(t) // DAYS_PER_CANDIDATE)
    at = t[np.linspace(0, CANDIDATE_SHARE * (len(t) - 1), number + 1).astype(int)[1:]]
    changes = np.zeros(number)
    if number:
        hinges = np.maximum(t[:, None] - at, 0.0)
        q = np.linalg.qr(base)[0]
        free, rest = hinges - q @ (q.T @ hinges), y - q @ (q.T @ y)
        exact = free @ np.linalg.lstsq(free, rest, rcond=None)[0]
        noise = float(((rest - exact) ** 2).sum()) / max(len(t) - base.shape[1] - number, 1)
        changes = lasso(free.T @ free, free.T @ rest, noise / (change_scale * max(np.abs(y).max(), 1e-300)))
        y = y - hinges @ changes
    line = np.linalg.lstsq(base, y, rcond=None)[0][: plain.shape[1]]
    return (line if len(line) == 2 else np.array([line[0], 0.0])), at, changes


def trend_at(t: np.ndarray, line: np.ndarray, at: np.ndarray, changes: np.ndarray) -> np.ndarray:
    return line[0] + line[1] * t + np.maximum(t[:, None] - at, 0.0) @ changes


def fit_series(days: np.ndarray, y: np.ndarray, future: np.ndarray, yearly: bool = True) -> dict[str, np.ndarray]:
    """Decompose one series and extend it. ``days`` and ``future`` count days since the epoch.

    Seasonal parts are shares of the trend; where the trend crosses zero the share is taken of a small level of its sign. The
    last slope holds for the future.
    """
    origin, length = days[0], max(days[-1] - days[0], 1)
    t, tf = (days - origin) / length, (future - origin) / length
    parts, widths = [_fourier(days, 7.0, WEEKLY_TERMS)], [2 * WEEKLY_TERMS]
    if yearly:
        parts.append(_fourier(days, 365.25, YEARLY_TERMS))
        widths.append(2 * YEARLY_TERMS)
    season = np.hstack(parts)
    # under two years a yearly wave and a trend cannot be told apart, so only the weekly one takes part in finding the trend
    waves = season if days[-1] - days[0] >= 730 else parts[0]
    level = max(abs(y).mean() * 0.05, 1e-9)
    plain = y
    for _ in range(3):  # shares of a growing trend grow with it: the trend is found again without them
        fitted = fit_trend(t, plain, waves)
        trend, trend_f = trend_at(t, *fitted), trend_at(tf, *fitted)
        scale, scale_f = (np.where(x < 0, -1, 1) * np.maximum(np.abs(x), level) for x in (trend, trend_f))
        beta = _ridge(season, (y - trend) / scale)
        plain = y - scale * (season @ beta)
    weekly = _fourier(future, 7.0, WEEKLY_TERMS) @ beta[: widths[0]]
    annual = _fourier(future, 365.25, YEARLY_TERMS) @ beta[widths[0] :] if len(widths) > 1 else np.zeros(len(future))
    spread = float(np.std((y - trend) / scale - season @ beta))
    yhat = trend_f + scale_f * (weekly + annual)
    return {"yhat": yhat, "yhat_upper": yhat + 1.96 * spread * np.abs(scale_f), "yhat_lower": yhat - 1.96 * spread * np.abs(scale_f), "trend": trend_f, "weekly": weekly, "yearly": annual}


def _forecaster(keys: Sequence[str], horizon: int) -> Callable[[pa.Table], pa.Table]:
    def run(history: pa.Table) -> pa.Table:
        days, y = history["day"].to_numpy().astype(float), history["y"].to_numpy()
        order = np.argsort(days)
        days, y = days[order], y[order]
        future = np.concatenate([days, days[-1] + np.arange(1, horizon + 1)])
        fitted = fit_series(days, y, future)
        actual = pa.array(np.concatenate([y, np.zeros(horizon)]), mask=np.arange(len(future)) >= len(days))
        names = pa.table({k: pa.repeat(history[k][0], len(future)) for k in keys})
        out = {"day": pa.array(future.astype(np.int32)), **{k: names[k] for k in keys}, "y": actual}
        return pa.table({**out, **{c: pa.array(v) for c, v in fitted.items()}})

    return run


def forecast_groups(history: DataFrame, keys: Sequence[str], horizon: int = 90) -> DataFrame:
    """Forecast every series: its history days and ``horizon`` days after; y is NULL in the future.

    Groups travel as Arrow tables; with many short series building a pandas frame per group would cost more than the fit.
    """
    outputs = ("y", "yhat", "yhat_upper", "yhat_lower", "trend", "weekly", "yearly")
    fields = [T.StructField("day", T.IntegerType()), *[history.schema[k] for k in keys], *[T.StructField(c, T.DoubleType()) for c in outputs]]
    series = by_key(history.select(*keys, F.unix_date("ds").alias("day"), "y"), *keys)
    out = series.groupBy(*keys).applyInArrow(_forecaster(keys, horizon), T.StructType(fields))
    return out.select(F.date_from_unix_date("day").alias("ds"), *keys, *outputs)


def components(forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    return forecast.select("ds", *keys, "trend", "weekly", "yearly")


def join_history(forecast: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forecast rows with the actual value where there is one."""
    return forecast.drop("y").join(history, [*keys, "ds"], "left")


def forecast_metrics(forecast: DataFrame, keys: Sequence[str], before: Column) -> DataFrame:
    """MAE, MSE, RMSE per series on days before a cut-off."""
    return regression_metrics(forecast.where(F.col("ds") < before), "y", "yhat", keys)


def save_run(forecast: DataFrame, path: str, training_date: Column | None = None) -> None:
    """Add a run to the forecast table, one partition per training date; a rerun replaces its own."""
    dated = forecast.withColumn("training_date", F.current_date() if training_date is None else training_date)
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("training_date").parquet(path)


def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of the newest training date; the subquery prunes the other partitions."""
    return runs.where(F.col("training_date") == runs.agg(F.max("training_date")).scalar())
