"""Column expressions. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def weekday_sunday_zero(date: Column | str) -> Column:
    """Sunday 0 … Saturday 6."""
    return F.dayofweek(as_col(date)) - 1


def year_month(date: Column | str) -> Column:
    """Zero-padded label, so that text order is time order."""
    return F.date_format(as_col(date), "yyyy-MM")


def value_or_display(numeric: Column | str, display: Column | str) -> Column:
    """The numeric value, or the display text read as a number; text that is no number gives NULL."""
    return F.coalesce(as_col(numeric).cast("float"), as_col(display).try_cast("float"))


def year_range(text: Column | str) -> Column:
    """'2012-2017' to the array 2012…2017, '2012' to one year. Explode it for one row per year."""
    parts = F.transform(F.split(as_col(text), "-"), lambda p: F.trim(p).try_cast("int"))
    return F.sequence(F.element_at(parts, 1), F.element_at(parts, -1))


def printable_ascii(text: Column | str) -> Column:
    return F.regexp_replace(as_col(text), r"[^\x20-\x7E\t\n\r\x0B\x0C]", "")


def abbreviate(text: Column | str, width: int = 32) -> Column:
    text = as_col(text)
    return F.when(F.length(text) < width, text).otherwise(F.concat(F.substring(text, 1, width), F.lit("...")))


def random_choice(options: Sequence[str], seed: int | None = None) -> Column:
    draw = F.rand(seed) if seed is not None else F.rand()
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.floor(draw * len(options)) + 1).cast("int"))


def prefix_classes(tags: Column | str, classes: dict[str, str], required: str, sep: str = "_") -> Column:
    """Map each tag by its first word, drop unknown ones; an array lacking ``required`` becomes empty."""
    head = F.transform(as_col(tags), lambda t: F.element_at(F.split(t, sep), 1))
    mapping = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    mapped = F.filter(F.transform(head, lambda h: F.element_at(mapping, h)), lambda c: c.isNotNull())
    return F.when(F.array_contains(mapped, required), F.array_distinct(mapped)).otherwise(F.array().cast("array<string>"))


def ordered_pairs(items: Column | str) -> Column:
    """All ordered pairs of unlike elements of one short array. Rows of a group use ``graph.co_mentions``."""
    items = as_col(items)
    pairs = F.flatten(F.transform(items, lambda a: F.transform(items, lambda b: F.struct(a.alias("src"), b.alias("dst")))))
    return F.filter(pairs, lambda p: p["src"] != p["dst"])


def any_value_below(distances: Column | str, limit: int) -> Column:
    return F.exists(F.map_values(as_col(distances)), lambda d: d < limit)


def log_return(first: Column | str, close: Column | str) -> Column:
    return F.ln(as_col(close) / as_col(first))
