"""Aggregations that the analytics jobs share."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def histogram_of_counts(df: DataFrame, key: Sequence[str], item: Column | str | None = None) -> DataFrame:
    """How many keys have 1, 2, … rows (or distinct items): an aggregate over an aggregate."""
    size = F.count(F.lit(1)) if item is None else F.count_distinct(item)
    return df.groupBy(*key).agg(size.alias("per_key")).groupBy("per_key").agg(F.count(F.lit(1)).alias("keys"))


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    """Σ(w·x) / Σw over rows where both are known."""
    value, weight = (F.col(x) if isinstance(x, str) else x for x in (value, weight))
    return F.sum(value * weight) / F.sum(F.when(value.isNotNull(), weight))


def group_multiset(df: DataFrame, key: str, value: str) -> DataFrame:
    """The list of values per key with duplicates, as (key, value, copies).

    Holds what collect_list holds, without building one array per key in one task. NULL keys form one group,
    NULL values are left out.
    """
    return df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("copies"))


def rollup_store(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Additive rollup: SUM and COUNT, so that an average is right on any later slice."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(measure), F.count(F.lit(1)).alias("total"))


def rollup_average(store: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Average of the raw rows on a coarser slice of a rollup store."""
    return (
        store.groupBy(*keys).agg(F.sum(measure).alias(measure), F.sum("total").alias("total"))
        .withColumn(measure, F.col(measure) / F.col("total"))
    )


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts of row × column, 0 where a pair is absent."""
    return df.groupBy(row).pivot(column, list(values)).count().fillna(0)


def pairwise_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation for each pair of columns over rows where all are known, in one pass."""
    complete = df.dropna(subset=list(columns))
    pairs = list(combinations(columns, 2))
    wide = complete.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, quartiles, max; one row per column. Quartiles are exact."""
    parts = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    moments = df.agg(F.array(*parts).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    quartiles = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return moments.join(F.broadcast(quartiles), "column", "left")  # one row per column


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE and RMSE over rows where both sides are known."""
    error = F.col(actual) - F.col(predicted)
    metrics = df.groupBy(*keys).agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"))
    return metrics.withColumn("rmse", F.sqrt("mse"))


def extremes(df: DataFrame, score: str, tie: str) -> DataFrame:
    """The rows with the lowest and the highest score, without sorting; ties go to the least ``tie``."""
    row = F.struct(*df.columns)
    low = F.min_by(row, F.struct(score, tie))
    high = F.min_by(row, F.struct((-F.col(score)).alias("s"), F.col(tie)))
    both = df.where(F.col(score).isNotNull()).agg(F.array(F.struct(F.lit("lowest").alias("which"), low.alias("r")), F.struct(F.lit("highest").alias("which"), high.alias("r"))).alias("b"))
    return both.select(F.explode("b").alias("b")).select("b.which", "b.r.*")


def table_counts(**frames: DataFrame) -> DataFrame:
    """(table_name, rows) for each frame."""
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
