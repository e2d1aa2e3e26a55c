"""Indicator tables and tree regression."""

from __future__ import annotations

import json
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import value_or_display, year_range
from ..session import materialize
from .relational import sweep
from .shared_trees import SharedTrees

# Fixed values of the indicator rules
EXCLUDED_INDICATOR = "WHOSIS_000015"
PUBLISHED, BOTH_SEXES = "PUBLISHED", "BTSX"
FIRST_YEAR, LAST_YEAR = 2000, 2018
DROPPED_PREFIXES = ["SP.DYN.LE", "SP.DYN.AMRT", "SP.DYN.TO", "PA.", "PX."]
DROPPED_SUFFIXES = [".FE", ".MA", ".CN", ".KN"]
DROPPED_PARTS = [".FE.", ".MA."]


def normalise_health(raw: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Published, both-sex indicator values as (GHO, Year, Country, Value), one row per year of a range."""
    kept = raw.where(
        (F.col("`GHO (CODE)`") != EXCLUDED_INDICATOR) & (F.col("`PUBLISHSTATE (CODE)`") == PUBLISHED)
        & (F.col("`SEX (CODE)`").isNull() | (F.col("`SEX (CODE)`") == BOTH_SEXES))
    )
    tall = kept.select(
        F.col("`GHO (CODE)`").alias("GHO"), F.explode(year_range("`YEAR (CODE)`")).alias("Year"), F.col("`COUNTRY (CODE)`").alias("Country"),
        value_or_display("Numeric", "`Display Value`").alias("Value"),
    )
    return tall.where(F.col("Year").between(first_year, last_year))


def keep_indicator(code: str = "Indicator Code") -> Column:
    """True for codes that are neither too close to the target nor split by sex nor in local currency."""
    c, keep = F.col(f"`{code}`"), F.lit(True)
    for prefix in DROPPED_PREFIXES:
        keep = keep & ~c.startswith(prefix)
    for suffix in DROPPED_SUFFIXES:
        keep = keep & ~c.endswith(suffix)
    for part in DROPPED_PARTS:
        keep = keep & ~c.contains(part)
    return keep


def normalise_supplementary(raw: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    return raw.where(F.col("Year").between(first_year, last_year) & keep_indicator()).select(
        F.col("`Country ISO3`").alias("Country"), "Year", F.col("`Indicator Code`").alias("Indicator"), "Value"
    )


def widen(tall: DataFrame, indicator: str, values: Sequence[str], keys: Sequence[str] = ("Country", "Year"), value: str = "Value") -> DataFrame:
    """One column per indicator, the average where a value occurs more than once. The indicator list is given, which saves a pass."""
    return tall.groupBy(*keys).pivot(indicator, list(values)).agg(F.avg(value))


def code_dictionary(*sources: DataFrame) -> DataFrame:
    """Distinct (Code, Description) of several sources."""
    out = sources[0].toDF("Code", "Description").distinct()
    for s in sources[1:]:
        out = out.union(s.toDF("Code", "Description").distinct())
    return out.distinct()


def join_wide(first: DataFrame, *others: DataFrame, keys: Sequence[str] = ("Country", "Year")) -> DataFrame:
    for o in others:
        first = first.join(o, on=list(keys), how="left")
    return first


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)


def _learning_rows(df: DataFrame, features: Sequence[str], label: str, validation: Column) -> DataFrame:
    return assemble(df, features).withColumn("_held_out", validation).select("features", F.col(label).cast("double").alias("label"), "_held_out")


MAX_TREES = 1000


def fit_trees(df: DataFrame, features: Sequence[str], label: str, validation: Column, seed: int = 42, **params) -> GBTRegressionModel:
    """Boosted trees; rows with ``validation`` true are held out and stop the boosting.

    As many trees as still lower the held-out error by ``validationTol`` of it. A fit that is still gaining at ``MAX_TREES`` is an
    error, so the number of trees is the data's choice unless the caller gives ``maxIter``.
    """
    options = {"maxIter": MAX_TREES, "maxDepth": 4, "stepSize": 0.2, "subsamplingRate": 1.0, "validationTol": 0.002, "cacheNodeIds": False, **params}
    data = _learning_rows(df, features, label, validation).persist()
    try:
        model = GBTRegressor(featuresCol="features", labelCol="label", validationIndicatorCol="_held_out", seed=seed, **options).fit(data)
    finally:
        data.unpersist()
    if "maxIter" not in params and model.getNumTrees >= MAX_TREES:
        raise RuntimeError(f"the held-out error still falls after {MAX_TREES} trees")
    return model


SEARCHED = ["maxDepth", "maxBins", "stepSize", "subsamplingRate", "minInstancesPerNode", "minInfoGain"]


def tree_trials(trials: int = 96, seed: int = 42) -> list[dict[str, float]]:
    """Random settings of the six searched parameters."""
    rng = np.random.default_rng(seed)
    return [
        {
            "maxDepth": int(rng.integers(2, 7)), "maxBins": int(rng.choice([16, 32, 64])), "stepSize": float(np.exp(rng.uniform(-3, -0.7))),
            "subsamplingRate": float(rng.uniform(0.5, 1.0)), "minInstancesPerNode": int(rng.integers(1, 20)), "minInfoGain": float(rng.uniform(0, 0.01)),
        }
        for _ in range(trials)
    ]


def search_trees(
    df: DataFrame, features: Sequence[str], label: str, validation: Column, trials: int = 96, first: int = 2, keep: int = 4, last: int = 3, parallelism: int = 12, seed: int = 42
) -> tuple[GBTRegressionModel, DataFrame]:
    """Successive halving over random settings: the model of the best one, and one row per trial and rung.

    All trials grow ``first`` trees; the best of every ``keep`` go on with ``keep`` times as many, until ``last`` or fewer are
    left. These grow until the held-out rows stop them, and the least held-out error wins. ``validation`` marks the held-out
    rows; they are the same for all trials. The trees of a rung grow side by side in shared passes and go on in the next;
    ``parallelism`` of the last fits run side by side over the same cached rows.
    """
    data = materialize(_learning_rows(df, features, label, validation), "learning")
    settings, spark = tree_trials(trials, seed), df.sparkSession
    rows, alive, rung, rounds = [], list(range(trials)), 0, first

    def told(errors: dict[int, float], trees: dict[int, int], final: bool) -> list[int]:
        """Notes a rung; its trials, best first."""
        rows.extend((t, rung, trees[t], errors[t], final, json.dumps(settings[t], sort_keys=True)) for t in alive)
        return sorted(alive, key=lambda t: (errors[t], t))

    if len(alive) > last:
        shared = SharedTrees(data, settings, seed, len(features))
        try:
            while len(alive) > last:
                shared.grow(alive, rounds)
                best = told(shared.errors(alive), dict.fromkeys(alive, rounds), False)
                alive, rung, rounds = sorted(best[: max(1, len(alive) // keep)]), rung + 1, rounds * keep
        finally:
            shared.close()

    data = data.persist()
    held = data.where("_held_out").persist()
    evaluator = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")

    def finish(trial: int) -> tuple[GBTRegressionModel, float]:
        gbt = GBTRegressor(featuresCol="features", labelCol="label", seed=seed + trial, maxIter=MAX_TREES, validationIndicatorCol="_held_out", validationTol=0.002, **settings[trial])
        model = gbt.fit(data)
        return model, float(evaluator.evaluate(model.transform(held)))

    pool = ThreadPool(parallelism)
    try:
        done = dict(zip(alive, pool.map(inheritable_thread_target(spark)(finish), alive)))
    finally:
        pool.close()
        held.unpersist()
        data.unpersist()
    best = told({t: error for t, (_, error) in done.items()}, {t: model.getNumTrees for t, (model, _) in done.items()}, True)
    return done[best[0]][0], spark.createDataFrame(rows, "trial INT, rung INT, trees INT, rmse DOUBLE, finished BOOLEAN, parameters STRING")


def best_tree_trial(search: DataFrame) -> DataFrame:
    """The finished trial with the least held-out error."""
    return search.where("finished").agg(F.min_by(F.struct(*search.columns), F.struct("rmse", "trial")).alias("b")).select("b.*")


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str, seed: int = 7) -> DataFrame:
    """(feature, rise): growth of the squared error when a feature takes the value of some other row.

    Rows get positions 0 to n - 1 in an arbitrary order: their place within a written part plus the number of rows in
    the parts before. Position p takes its values from position p + s of the ring, with s between 1 and n - 1, so no row
    keeps its own; equal rows hold different positions. ``seed`` chooses the order and s. With one row the rise is 0.
    """
    base = df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y"))
    # parts by a hash of the whole row and a number within its input part, which spreads equal rows
    spread = base.withColumn("_k", F.xxhash64(F.lit(seed), *features, "_y", F.monotonically_increasing_id()))
    spread = materialize(spread.repartition("_k").sortWithinPartitions("_k").drop("_k").withColumn("_id", F.monotonically_increasing_id()), "permuted")
    # the part number is the upper 31 bits of the id, the place within the part the lower 33
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = [(r["part"], r["n"]) for r in spread.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()]  # one row per task
    total, before = 0, {}
    for number, n in sizes:
        before[number], total = total, total + n
    offsets = df.sparkSession.createDataFrame(list(before.items()), "_part LONG, _before LONG")
    shift = int(np.random.default_rng(seed).integers(1, total)) if total > 1 else 0
    placed = spread.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_p", F.col("_before") + place)
    values = placed.select(F.pmod(F.col("_p") - shift, F.lit(max(total, 1))).alias("_p"), *[F.col(f).alias(f"_o_{f}") for f in features])
    other = placed.join(values, "_p")
    variants = [F.struct(F.lit("").alias("feature"), *[F.col(f) for f in features])]
    variants += [F.struct(F.lit(v).alias("feature"), *[F.col(f"_o_{f}" if f == v else f).alias(f) for f in features]) for v in features]
    rows = other.select("_y", F.explode(F.array(*variants)).alias("v")).select("_y", "v.*")
    scored = model.transform(assemble(rows, features))
    loss = scored.groupBy("feature").agg(F.avg(F.pow(F.col("prediction") - F.col("_y"), 2)).alias("loss"))
    plain = loss.where("feature = ''").agg(F.max("loss"))
    return loss.where("feature <> ''").select("feature", (F.col("loss") - plain.scalar()).alias("rise"))


def group_contrast(df: DataFrame, columns: Sequence[str], member: Column) -> DataFrame:
    """(feature, contrast): mean inside a group minus mean outside, one pass for all columns."""
    means = df.agg(*[(F.avg(F.when(member, F.col(c))) - F.avg(F.when(~member, F.col(c)))).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("contrast")) for c in columns])
    return means.select(F.explode(rows).alias("r")).select("r.*")


def score_unseen(model, actual: DataFrame, unseen: DataFrame, features: Sequence[str], label: str, keys: Sequence[str]) -> DataFrame:
    """Predictions for unseen rows together with the actual values of the others."""
    predicted = model.transform(assemble(unseen, features)).select(*keys, F.col("prediction").alias(label), F.lit(True).alias("predicted"))
    return actual.select(*keys, F.col(label).cast("double").alias(label), F.lit(False).alias("predicted")).unionByName(predicted)


def what_if(model, df: DataFrame, features: Sequence[str], feature: str, grid: Sequence[float], by: str, values: Sequence) -> DataFrame:
    """Mean prediction with one feature set to each grid value, one column per value of ``by``."""
    swept = sweep(df.drop(feature), feature, [float(g) for g in grid])
    return model.transform(assemble(swept, features)).groupBy(feature).pivot(by, list(values)).agg(F.avg("prediction"))
