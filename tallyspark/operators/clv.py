"""Customer metrics for lifetime models.

Raw rows are first summed to (customer, day) with map-side partial sums, then one more aggregate per customer
gives every metric. No join back to first purchases, no COUNT(DISTINCT), and a customer with a third of all
rows is reduced to one row per calendar day before anything gathers by customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lifetime as L
from .relational import with_scalars


def daily_purchases(df: DataFrame, customer: str, at: str, amount: str | None = None) -> DataFrame:
    """(customer, day, amount, lines): spend and number of amounts per customer and day."""
    value = F.lit(0.0) if amount is None else F.col(amount)
    return df.groupBy(F.col(customer), F.to_date(at).alias("day")).agg(F.sum(value).alias("amount"), F.count(value).alias("lines"))


def _dataset_end(df: DataFrame, at: str) -> DataFrame:
    return df.agg(F.to_date(F.max(at)))


def rft_summary(df: DataFrame, customer: str, at: str, amount: str | None = None) -> DataFrame:
    """frequency, recency, T and, with an amount, monetary_value per customer.

    frequency: purchase days after the first; recency: days from first to last; T: days from first to the end
    of the data set; monetary_value: mean daily spend over repeat days, 0 without any.
    """
    daily = daily_purchases(df, customer, at, amount).where(F.col(customer).isNotNull())
    per = daily.groupBy(customer).agg(
        (F.count(F.lit(1)) - 1).alias("n"), F.min("day").alias("first"), F.max("day").alias("last"),
        F.sum("amount").alias("total"), F.min_by("amount", "day").alias("first_amount"),
    )
    out = [
        F.col(customer), F.col("n").cast("float").alias("frequency"), F.datediff("last", "first").cast("float").alias("recency"),
        F.datediff("end", "first").cast("float").alias("T"),
    ]
    if amount is not None:
        spend = F.when(F.col("n") == 0, 0.0).otherwise((F.col("total") - F.col("first_amount")) / F.nullif(F.col("n"), F.lit(0)))
        out.append(spend.alias("monetary_value"))
    return with_scalars(per, end=_dataset_end(df, at)).select(*out)


def rft_holdout(df: DataFrame, customer: str, at: str, days: int, amount: str | None = None, raw_lines: bool = False) -> DataFrame:
    """Metrics up to the cut-off (end − days, exclusive) and what followed from the cut-off on.

    Customers without a calibration purchase vanish. The holdout frequency counts all its days. The holdout value
    is the mean of daily totals, or of the raw amounts with ``raw_lines``.
    """
    daily = with_scalars(daily_purchases(df, customer, at, amount).where(F.col(customer).isNotNull()), end=_dataset_end(df, at))
    cut = F.date_sub("end", days)
    cal, hold = F.col("day") < cut, F.col("day") >= cut
    per = daily.groupBy(customer).agg(
        F.count_if(cal).alias("n"), F.min("day").alias("first"), F.max(F.when(cal, F.col("day"))).alias("last"), F.max("end").alias("end"),
        F.sum(F.when(cal, F.col("amount"))).alias("total"), F.min_by("amount", "day").alias("first_amount"),
        F.count_if(hold).alias("hold_days"), F.sum(F.when(hold, F.col("amount"))).alias("hold_total"), F.sum(F.when(hold, F.col("lines"))).alias("hold_lines"),
    ).where("n > 0")
    out = [
        F.col(customer), (F.col("n") - 1).cast("float").alias("frequency_cal"), F.datediff("last", "first").cast("float").alias("recency_cal"),
        F.datediff(cut, "first").cast("float").alias("T_cal"),
    ]
    if amount is not None:
        value = F.when(F.col("n") == 1, 0.0).otherwise((F.col("total") - F.col("first_amount")) / F.nullif(F.col("n") - 1, F.lit(0)))
        out.append(F.coalesce(value, F.lit(0.0)).alias("monetary_value_cal"))
    out.append(F.col("hold_days").cast("float").alias("frequency_holdout"))
    if amount is not None:
        per_what = F.nullif(F.col("hold_lines" if raw_lines else "hold_days"), F.lit(0))
        out.append(F.coalesce(F.col("hold_total") / per_what, F.lit(0.0)).alias("monetary_value_holdout"))
    return per.select(*out, F.lit(float(days)).cast("float").alias("duration_holdout"))


def repeat_buyers(metrics: DataFrame, frequency: str = "frequency", monetary: str | None = None) -> DataFrame:
    kept = metrics.where(F.col(frequency) > 0)
    return kept if monetary is None else kept.where(F.col(monetary) > 0)


def score(metrics: DataFrame, m: L.BgNbd, g: L.GammaGamma, months: int = 12, discount: float = 0.01) -> DataFrame:
    """Add prob_alive, expected_spend and clv."""
    x, tx, T, mv = "frequency", "recency", "T", "monetary_value"
    return metrics.withColumns({
        "prob_alive": L.p_alive(x, tx, T, m),
        "expected_spend": L.expected_spend(x, mv, g),
        "clv": L.lifetime_value(x, tx, T, mv, m, g, months, discount),
    })


def engagement_scores(x: Column | str, tx: Column | str, T: Column | str, m: L.BgNbd, horizons: Sequence[int] = (15, 30, 45)) -> Column:
    """[P(alive), expected purchases in each horizon] as one array."""
    return F.concat(F.array(L.p_alive(x, tx, T, m)), L.expected_purchases_at(horizons, x, tx, T, m))


def holdout_evaluation(metrics: DataFrame, m: L.BgNbd, by: str, days: int) -> DataFrame:
    """Mean actual and predicted holdout purchases by frequency_cal, recency_cal or time_since_last_purchase."""
    predicted = metrics.withColumn("predicted", L.expected_purchases(days, "frequency_cal", "recency_cal", "T_cal", m))
    predicted = predicted.withColumn("time_since_last_purchase", F.col("T_cal") - F.col("recency_cal"))
    return predicted.groupBy(by).agg(F.avg("frequency_holdout").alias("actual"), F.avg("predicted").alias("predicted"), F.count(F.lit(1)).alias("customers"))


def score_matrices(metrics: DataFrame, m: L.BgNbd, horizon: int = 30) -> DataFrame:
    """P(alive) and expected purchases over the grid 0…max frequency × 0…max age, at the greatest age."""
    top = metrics.agg(F.max("frequency").cast("int").alias("fx"), F.max("T").cast("int").alias("tx"))
    grid = top.select("tx", F.explode(F.sequence(F.lit(0), F.col("fx"))).alias("frequency")).repartition("frequency")
    grid = grid.select("frequency", F.col("tx").alias("T"), F.explode(F.sequence(F.lit(0), F.col("tx"))).alias("recency"))
    return grid.select(
        "frequency", "recency", L.p_alive("frequency", "recency", "T", m).alias("prob_alive"),
        L.expected_purchases(horizon, "frequency", "recency", "T", m).alias("expected"),
    )


def alive_history(df: DataFrame, customer: str, at: str, m: L.BgNbd, only: Column | None = None) -> DataFrame:
    """P(alive) per customer and day, from the first purchase to the end of the data set.

    ``only`` selects customers; it reaches the scan of their rows, while the end still comes from all rows.
    """
    from pyspark.sql import Window as W

    chosen = df.where(F.col(customer).isNotNull()) if only is None else df.where(only)
    days = chosen.select(customer, F.to_date(at).alias("day")).distinct()
    w = W.partitionBy(customer).orderBy("day")
    seen = days.select(
        customer, "day", (F.row_number().over(w) - 1).alias("x"), F.min("day").over(w).alias("first"), F.lead("day").over(w).alias("next")
    )
    # each purchase day rules the days up to the next one; the last one rules to the end of the data set
    ruled = with_scalars(seen, end=_dataset_end(df, at)).withColumn("until", F.coalesce(F.date_sub("next", 1), "end"))
    daily = ruled.withColumn("on", F.explode(F.sequence("day", "until")))
    return daily.select(
        customer, F.col("on").alias("day"), F.col("x").alias("frequency"),
        L.p_alive("x", F.datediff("day", "first"), F.datediff("on", "first"), m).alias("prob_alive"),
    )
