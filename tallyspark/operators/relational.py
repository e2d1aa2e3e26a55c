"""Relational operators: flags, trims, lookups, prefix matches, one-row scalars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CATEGORIES = 10_000


def distinct_values(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Distinct values for use as column names; refuses columns with too many to be columns."""
    rows = df.select(F.col(f"`{column}`").alias("v")).where("v IS NOT NULL").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values")
    return sorted(r["v"] for r in rows)


def one_hot_flags(df: DataFrame, column: str, values: Sequence | None = None, drop: bool = True) -> DataFrame:
    """One boolean column ``<column>_<value>`` per distinct value; a NULL gives false everywhere."""
    values = distinct_values(df, column) if values is None else values
    flags = [F.coalesce(F.col(f"`{column}`") == F.lit(v), F.lit(False)).alias(f"{column}_{v}") for v in values]
    keep = [F.col(f"`{c}`") for c in df.columns if not (drop and c == column)]
    return df.select(*keep, *flags)


def flag_to_label(flags: Sequence[str], tail: int = 3) -> Column:
    """Name of the first true flag, cut to its last characters; NULL when none is set."""
    return F.coalesce(*[F.when(F.col(f"`{f}`"), F.right(F.lit(f), F.lit(tail))) for f in flags])


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[(F.trim(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`")) for c, t in df.dtypes])


def with_scalars(df: DataFrame, **one_row: DataFrame) -> DataFrame:
    """Add columns from one-row aggregates as scalar subqueries: no join, no shuffle of ``df``.

    Each argument is a frame with one row and one column.
    """
    return df.withColumns({name: frame.scalar() for name, frame in one_row.items()})


def lookup(df: DataFrame, key: str, dictionary: DataFrame, dict_key: str, dict_value: str, out: str, default: Column | None = None) -> DataFrame:
    """Replace codes by a dictionary; unknown codes take ``default`` (the code itself if not given).

    ``dictionary`` must have unique keys. No broadcast hint: Spark broadcasts it when its measured size is
    small, else it sort-merges and splits hot codes at run time.
    """
    d = dictionary.select(F.col(dict_key).alias("_dk"), F.col(dict_value).alias("_dv"))
    joined = df.join(d, df[key] == d["_dk"], "left")
    fallback = F.col(key) if default is None else default
    return joined.withColumn(out, F.coalesce("_dv", fallback)).drop("_dk", "_dv")


def canonical_names(names: DataFrame, column: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """Map each distinct name to the canonical name of an alias it starts with, else to itself.

    ``aliases`` has columns alias, canonical. Instead of comparing every name with every alias, a name is
    expanded to its prefixes of the lengths that occur among aliases and joined on equality. Several matches:
    the least canonical name wins. Returns one row (column, out) per distinct name.
    """
    lengths = aliases.select(F.collect_set(F.length("alias")).alias("l"))
    distinct = names.select(column).where(F.col(column).isNotNull()).distinct()
    prefixes = (
        with_scalars(distinct, _lengths=lengths)
        .select(column, F.explode(F.filter("_lengths", lambda n: n <= F.length(column))).alias("_n"))
        .select(column, F.expr(f"substring(`{column}`, 1, _n)").alias("alias"))
    )
    matched = prefixes.join(aliases, "alias").groupBy(column).agg(F.min("canonical").alias("_c"))
    return distinct.join(matched, column, "left").select(column, F.coalesce("_c", F.col(column)).alias(out))


def sweep(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Every row once per grid value, as a fan-out inside the row."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def append_by_name(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def union_checked(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL by position, after making sure that the positions mean the same."""
    if left.columns != right.columns:
        raise ValueError(f"column order differs: {left.columns} and {right.columns}")
    return left.union(right)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last by ``order``; NULL keys form a group.

    An aggregate instead of a ranking window: hot keys shrink on the map side before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order)).alias("_row")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
