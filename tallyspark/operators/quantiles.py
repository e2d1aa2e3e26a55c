"""Exact quantiles, quantile labels, histograms, scaling.

Spark's ``percentile`` keeps every distinct value of a group in one task's memory. Here the values are counted
first and cut into ranges just below and above each wanted quantile, as an approximate sketch places it. Range
sizes are counted exactly, and only the ranges that hold a wanted rank, a few in ten thousand of all values, are
ranked. The answer is exact whatever the quality of the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Linearly interpolated quantiles. One row (keys…, column, prob, value) per key, column and probability."""
    group = [*keys, "column"]
    tall = df.select(
        *keys,
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])).alias("_kv"),
    ).select(*keys, "_kv.*").where("value IS NOT NULL")
    counts = tall.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    cuts = sorted({min(max(p + e, 0.0), 1.0) for p in probs for e in (-2 / accuracy, 2 / accuracy)})
    halvings = len(cuts).bit_length()
    edges = tall.groupBy(*group).agg(F.percentile_approx("value", cuts, accuracy).alias("edges"), F.count(F.lit(1)).alias("total"))
    edges = edges.withColumn("edges", F.array_distinct("edges"))
    placed = _join_group(counts, edges, group, small=not keys)
    placed = placed.withColumn("bucket", _edges_below("edges", "value", halvings))

    totals = placed.groupBy(*group, "bucket").agg(F.sum("n").alias("rows"), F.first("total").alias("total"))
    by_bucket = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    offsets = totals.withColumn("offset", F.coalesce(F.sum("rows").over(by_bucket), F.lit(0)))
    wanted = F.array(*[F.lit(float(p)) for p in probs])

    def covers(first: Column, past: Column) -> Column:
        def test(p: Column) -> Column:
            rank = p * (F.col("total") - 1)
            return ((F.floor(rank) >= first) & (F.floor(rank) < past)) | ((F.ceil(rank) >= first) & (F.ceil(rank) < past))
        return F.filter(wanted, test)

    needed = (
        offsets.withColumn("probs", covers(F.col("offset"), F.col("offset") + F.col("rows")))
        .where(F.size("probs") > 0)
        .select(*group, "bucket", "offset", "probs")
    )
    inside = placed.drop("edges").join(needed, [*group, "bucket"]) if not keys else _null_safe_join(placed.drop("edges"), needed, [*group, "bucket"])
    running = W.partitionBy(*group, "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = inside.withColumn("past", F.col("offset") + F.sum("n").over(running)).withColumn("first", F.col("past") - F.col("n"))
    rank = F.col("prob") * (F.col("total") - 1)
    hit = ranked.select(*group, "value", "first", "past", "total", F.explode("probs").alias("prob"))
    low = F.max(F.when((F.floor(rank) >= F.col("first")) & (F.floor(rank) < F.col("past")), F.col("value")))
    high = F.max(F.when((F.ceil(rank) >= F.col("first")) & (F.ceil(rank) < F.col("past")), F.col("value")))
    return (
        hit.groupBy(*group, "prob").agg(low.alias("low"), high.alias("high"), F.max(rank - F.floor(rank)).alias("part"))
        .select(*group, "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("value"))
    )


def _edges_below(edges: str, value: str, halvings: int) -> Column:
    """Number of sorted edges below the value, by halving steps; at most 2**halvings - 1 edges."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(halvings))])
    below = lambda i: F.coalesce(F.get(F.col(edges), i) < F.col(value), F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at + step - 1), at + step).otherwise(at))


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = None
    for c in on:
        test = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = test if condition is None else condition & test
    return left.join(renamed, condition).drop(*[f"_r_{c}" for c in on])


def _join_group(counts: DataFrame, edges: DataFrame, group: Sequence[str], small: bool) -> DataFrame:
    """Without keys there is one row per column, so the broadcast has a fixed bound; else Spark decides by size."""
    return counts.join(F.broadcast(edges), list(group)) if small else _null_safe_join(counts, edges, group)


def quantile_row(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """One row, one array column: the quantiles of ``column`` in the order of ``probs``."""
    q = exact_quantiles(df, [column], probs)
    pairs = F.array_sort(F.collect_list(F.struct("prob", "value")))  # len(probs) entries
    return q.agg(F.transform(pairs, lambda p: p["value"]).alias("q"))


def quantile_labels(df: DataFrame, column: str, labels: Sequence[str], out: str) -> DataFrame:
    """Label rows by quantile classes with right-closed edges at linear quantiles; the minimum joins class one.

    Equal edges would make a class empty and ambiguous, so they raise, like NULLs stay NULL.
    """
    k = len(labels)
    edges = quantile_row(df, column, [i / k for i in range(k + 1)])
    checked = edges.select(
        F.when(F.size(F.array_distinct("q")) < k + 1, F.raise_error(F.lit("quantile edges are not unique"))).otherwise(F.col("q")).alias("q")
    )
    tagged = df.withColumn("_q", checked.scalar())
    label = F.when(F.col(column).isNull(), F.lit(None).cast("string"))
    for i, name in enumerate(labels):
        label = label.when(F.col(column) <= F.col("_q")[i + 1], F.lit(name))
    return tagged.withColumn(out, label.otherwise(F.lit(labels[-1]))).drop("_q") if k else df


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins from min to max; the top edge belongs to the last bin. Empty bins are absent."""
    value = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("s"))
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    index = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((value - F.col("_s.lo")) / width), F.lit(bins - 1)))
    return (
        df.withColumn("_s", span.scalar()).where(value.isNotNull())
        .groupBy(*keys, index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns into [0, 1] over the whole frame; a constant column becomes 0."""
    span = df.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]).alias("s"))
    scaled = {
        c: F.when(F.col(c).isNull(), F.lit(None).cast("double"))
        .when(F.col(f"_s.{c}.hi") == F.col(f"_s.{c}.lo"), F.lit(0.0))
        .otherwise((F.col(c) - F.col(f"_s.{c}.lo")) / (F.col(f"_s.{c}.hi") - F.col(f"_s.{c}.lo")))
        for c in columns
    }
    return df.withColumn("_s", span.scalar()).withColumns(scaled).drop("_s")
