"""Daily series operators.

A series frame has one row per (key, day). Windows here run per key over such rows, so a partition holds at
most one row per calendar day or year; aggregate raw rows to days first, which also removes the skew of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _by(keys: Sequence[str] | str, order: str):
    keys = [keys] if isinstance(keys, str) else list(keys)
    return W.partitionBy(*keys).orderBy(order)


def previous_or_self(df: DataFrame, keys: Sequence[str] | str, order: str, column: str, out: str) -> DataFrame:
    """Value of the row before, or of the row itself at the start of a series."""
    return df.withColumn(out, F.first(column).over(_by(keys, order).rowsBetween(-1, 0)))


def log_returns(df: DataFrame, keys: Sequence[str] | str, order: str, price: str, out: str = "return") -> DataFrame:
    """ln(price / previous price); 0 on the first row. Rows without a price are left out."""
    known = previous_or_self(df.where(F.col(price).isNotNull()), keys, order, price, "_prev")
    return known.withColumn(out, F.ln(F.col(price) / F.col("_prev"))).drop("_prev")


def rolling_mean(df: DataFrame, keys: Sequence[str] | str, order: str, column: str, rows: int, out: str) -> DataFrame:
    """Mean of the last ``rows`` rows; NULL until that many known values are there."""
    w = _by(keys, order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.when(F.count(column).over(w) == rows, F.avg(column).over(w)))


def densify_pad(df: DataFrame, keys: Sequence[str], day: str, business_days: bool = False) -> DataFrame:
    """Every calendar day (or weekday) between a key's first and last day; a missing day repeats the last *row*.

    A NULL inside the repeated row stays NULL. Each row spreads over the days up to the next row of its key,
    so there is no calendar table, no range join, and the work is as even as the rows are.
    """
    keys = list(keys)
    w = W.partitionBy(*keys).orderBy(day)
    until = F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.col(day))
    spread = df.withColumn("_until", until).withColumn("_d", F.explode(F.sequence(F.col(day), F.col("_until")))).drop("_until")
    if not business_days:
        return spread.withColumn(day, F.col("_d")).drop("_d")
    # a weekday calendar starts at the first weekday on or after the first row; weekend rows carry into Monday
    kept = spread.where(F.weekday("_d") < 5)
    return kept.withColumn(day, F.col("_d")).drop("_d")


def fill_forward_back(df: DataFrame, keys: Sequence[str] | str, order: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Carry known values forward, then back, within a key; columns in ``exclude`` are left as they are."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = _by(keys, order)
    past, future = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    filled = {
        c: F.coalesce(F.last(f"`{c}`", ignorenulls=True).over(past), F.first(f"`{c}`", ignorenulls=True).over(future))
        for c in df.columns if c not in keys and c != order and c not in exclude
    }
    return df.select(*[filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])


def rebase(df: DataFrame, keys: Sequence[str] | str, order: str, column: str, base: float = 100.0) -> DataFrame:
    """Scale a series so that its first value is ``base``."""
    first = F.first(column).over(_by(keys, order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn(column, F.lit(base) * F.col(column) / first)


def next_event(df: DataFrame, keys: Sequence[str] | str, day: str, out: str) -> DataFrame:
    """Pair each distinct day of a key with the next one; the last day has no pair. Days must be distinct."""
    return df.withColumn(out, F.lead(day).over(_by(keys, day))).where(F.col(out).isNotNull())


def average_gap(df: DataFrame, key: str, day: Column) -> DataFrame:
    """Average days between consecutive distinct days of a key, for keys with at least two.

    The gaps add up to last − first, so one aggregate gives what a search for the next day would.
    """
    per = df.groupBy(key).agg(F.min(day).alias("lo"), F.max(day).alias("hi"), F.count_distinct(day).alias("days")).where("days > 1")
    return per.select(key, (F.datediff("hi", "lo") / (F.col("days") - 1)).alias("avg_gap"))


def reindex(series: DataFrame, index: DataFrame, day: str) -> DataFrame:
    """The series on the days of ``index``; NULL where it has none."""
    return index.join(series, day, "left")


def to_benchmark(series: DataFrame, benchmark: DataFrame, on: Sequence[str], column: str, out: str = "diff") -> DataFrame:
    """Difference of a series to a benchmark on common days."""
    b = benchmark.select(*on, F.col(column).alias("_b"))
    return series.join(b, list(on)).withColumn(out, F.col(column) - F.col("_b")).drop("_b")


def split_at(df: DataFrame, day: str, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut and rows from the cut on."""
    return df.where(F.col(day) < cut), df.where(F.col(day) >= cut)
