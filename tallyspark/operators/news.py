"""News sentiment: enrichment, rollups, benchmark-relative scores, propagated scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import prefix_classes
from .aggregates import rollup_average, rollup_store
from .timeseries import densify_pad

# First word of a theme tag and the class it counts for; an article needs class G to be kept
THEME_CLASSES = {"ENV": "E", "ECON": "G", "UNGP": "S"}
REQUIRED_CLASS = "G"

# Names that are no companies although news mention them as such
BLOCKED = ["united states", "european union", "reuters"]
BLOCKED_MEDIA = ["united states", "european union", "reuters", "twitter", "facebook", "thomson reuters", "associated press", "new york times", "bloomberg"]


def canonical(name: Column, aliases: Mapping[str, Sequence[str]]) -> Column:
    """Canonical name if the name starts with one of its aliases, else the name; works on streams.

    For alias tables instead of a short fixed list see ``relational.canonical_names``.
    """
    out = name
    for company in sorted(aliases, reverse=True):
        hit = F.lit(False)
        for alias in aliases[company]:
            hit = hit | name.startswith(alias)
        out = F.when(hit, F.lit(company)).otherwise(out)
    return out


def enrich(news: DataFrame, aliases: Mapping[str, Sequence[str]], codes: Mapping[str, str], themes: Mapping[str, str] = THEME_CLASSES, required: str = REQUIRED_CLASS) -> DataFrame:
    """Bronze news (publishDate, organisations, documentIdentifier, themes, locations, tone) to one row per mention.

    Only row-local expressions, so it serves batch and streams alike. ``codes`` maps two-letter to three-letter
    country codes; unknown ones are dropped.
    """
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]) if codes else F.create_map()
    iso = F.transform("locations", lambda l: F.element_at(lookup, l["countryCode"]))
    classes = prefix_classes("themes", dict(themes), required)
    return (
        news.withColumn("themes", classes).where(F.size("themes") > 0)
        .withColumn("organisation", F.explode("organisations"))
        .select(
            "publishDate", canonical(F.lower("organisation"), aliases).alias("organisation"), F.col("documentIdentifier").alias("url"),
            F.array_distinct(F.filter(iso, lambda c: c.isNotNull())).alias("countries"), "themes", F.col("tone.tone").alias("tone"),
        )
    )


def gold_rollup(mentions: DataFrame) -> DataFrame:
    """(date, organisation, theme, Σ tone, mentions) from rows with one theme each."""
    return rollup_store(mentions.withColumnRenamed("publishDate", "date"), ["date", "organisation", "theme"], "tone")


def daily_average(gold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Average tone per day (and keys), on every calendar day, a missing day repeating the last."""
    daily = rollup_average(gold, [*keys, "date"], "tone").select(*keys, "date", "tone")
    if keys:
        return densify_pad(daily, keys, "date")
    return densify_pad(daily.withColumn("_all", F.lit(1)), ["_all"], "date").drop("_all")  # one row per day


def internal_scores(gold: DataFrame, min_days: int = 300, min_total: int = 1000) -> DataFrame:
    """Mean daily distance of an organisation to the industry per theme, where there is enough news."""
    organisation = rollup_average(gold, ["organisation", "theme", "date"], "tone")
    industry = rollup_average(gold, ["date", "theme"], "tone").select("date", "theme", F.col("tone").alias("_industry"))
    per = organisation.join(industry, ["date", "theme"]).groupBy("organisation", "theme").agg(
        F.sum("total").alias("total"), F.count(F.lit(1)).alias("days"), F.avg(F.col("tone") - F.col("_industry")).alias("esg")
    )
    return per.where((F.col("days") > min_days) & (F.col("total") > min_total))


def contributions(scores: DataFrame, importance: DataFrame) -> DataFrame:
    """Each landmark's connections with the connection's own score per theme."""
    connection = scores.select(F.col("organisation").alias("connection"), "theme", "esg")
    return connection.join(importance, "connection").select("organisation", "connection", "theme", "esg", "importance")


def propagated_scores(contrib: DataFrame) -> DataFrame:
    """Importance-weighted mean score of a landmark's connections per theme."""
    known = contrib.where(F.col("esg").isNotNull() & F.col("importance").isNotNull())
    return known.groupBy("organisation", "theme").agg((F.sum(F.col("esg") * F.col("importance")) / F.sum("importance")).alias("esg"))


def detractors(contrib: DataFrame, organisation, theme) -> DataFrame:
    """Connections of one organisation that score below it on a theme."""
    mine = contrib.where((F.col("organisation") == organisation) & (F.col("theme") == theme)).select("connection", "importance", "esg")
    own = mine.where(F.col("connection") == organisation).agg(F.max("esg").alias("esg"))
    return mine.withColumn("_own", own.scalar()).where(F.col("esg") < F.col("_own")).drop("_own")
