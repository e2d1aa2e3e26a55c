"""Portfolio scores, returns and value at risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import timeseries as TS
from .aggregates import extremes, rollup_average
from .quantiles import quantile_labels

# rating classes from worst to best (fixed values)
RATINGS = ["BBB", "BB", "A", "AA", "AAA"]


def portfolio_scores(portfolio: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores of the organisations held; several symbols may share one."""
    return portfolio.join(scores, "organisation").select("symbol", "organisation", "theme", "esg")


def rate(portfolio: DataFrame, scores: DataFrame) -> DataFrame:
    """Mean score per organisation on each symbol, and its quintile class."""
    mean = scores.groupBy("organisation").agg(F.avg("esg").alias("esg"))
    return quantile_labels(mean.join(portfolio, "organisation"), "esg", RATINGS, "rating")


def price_history(prices: DataFrame) -> DataFrame:
    """Prices on every weekday between first and last, gaps repeating the last row."""
    return TS.densify_pad(prices, ["symbol"], "date", business_days=True)


def rated_returns(prices: DataFrame, rated: DataFrame) -> DataFrame:
    """(symbol, rating, date, close, return). Returns come first, so the window runs on prices alone."""
    returns = TS.log_returns(prices, "symbol", "date", "close")
    return returns.join(rated.select("symbol", "rating"), "symbol").select("symbol", "rating", "date", "close", "return")


def class_returns(returns: DataFrame) -> DataFrame:
    """Daily return of each class: the sum over its members."""
    return returns.groupBy("rating", "date").agg(F.sum("return").alias("return"))


def value_at_risk(by_class: DataFrame, level: float = 0.05) -> DataFrame:
    """Historical value at risk per class: a linear quantile of daily returns.

    A class has one row per calendar day, so the built-in exact percentile stays small.
    """
    return by_class.groupBy("rating").agg(F.percentile("return", F.lit(level)).alias("var"))


def sentiment_against_price(rated: DataFrame, gold: DataFrame, prices: DataFrame, smooth_tone: int = 30, smooth_price: int = 7) -> DataFrame:
    """For the worst and the best scored symbol: smoothed tone and rebased, smoothed price on the tone's days."""
    two = extremes(rated.select("symbol", "organisation", "esg"), "esg", "symbol").select("which", "symbol", "organisation")
    chosen = F.broadcast(two)  # two rows
    tone = rollup_average(gold.join(chosen.select("organisation").distinct(), "organisation", "left_semi"), ["organisation", "date"], "tone").select("organisation", "date", "tone")
    tone = TS.rolling_mean(TS.densify_pad(tone, ["organisation"], "date"), "organisation", "date", "tone", smooth_tone, "tone_smooth")
    held = prices.join(chosen.select("symbol"), "symbol", "left_semi").where(F.col("close").isNotNull())
    held = TS.rebase(TS.densify_pad(held, ["symbol"], "date"), "symbol", "date", "close")
    # the price is put on the tone's days before it is smoothed, so missing days leave the mean undefined
    days = tone.join(chosen, "organisation").select("which", "symbol", "organisation", "date", "tone_smooth")
    aligned = days.join(held, ["symbol", "date"], "left")
    return TS.rolling_mean(aligned, "which", "date", "close", smooth_price, "close_smooth").select("which", "symbol", "organisation", "date", "tone_smooth", "close_smooth")
