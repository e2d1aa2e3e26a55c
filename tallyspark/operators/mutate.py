"""Table mutation, versions and file layout as DataFrame operators over Parquet.

Parquet tables have no transaction log here. A mutation returns the new content; versions live in a change log
with the columns (version, op, row columns), op 'U' for an upserted row and 'D' for a deleted key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import _edges_below


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (left[k] == right[prefix + k])
    return condition


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take the source, unmatched source rows are added, the rest of the target stays.

    Two source rows for one target row are an error (dedupe first, see ``relational.keep_one``). NULL keys never
    match. Columns only the target has keep their value in matched rows.
    """
    counts = source.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    counts = counts.where("_copies > 1").select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_copies")
    tagged = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias("_in_source"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"_s_{k}") == F.col(f"_c_{k}"))
    tagged = tagged.join(counts, condition, "left")
    # rows with a NULL key have no match and stay out of the full join, where they would all meet in one task
    whole, source_whole = F.lit(True), F.lit(True)
    for k in keys:
        whole, source_whole = whole & F.col(k).isNotNull(), source_whole & F.col(f"_s_{k}").isNotNull()
    marked, keyed = target.withColumn("_in_target", F.lit(True)), tagged.where(source_whole)
    matched = marked.where(whole)
    joined = matched.join(keyed, _on(matched, keyed, keys, "_s_"), "full")
    joined = joined.unionByName(marked.where(~whole), allowMissingColumns=True).unionByName(tagged.where(~source_whole), allowMissingColumns=True)
    twice = F.col("_in_target") & F.coalesce(F.col("_copies") > 1, F.lit(False))
    from_source = F.when(twice, F.raise_error(F.lit("merge: several source rows match one target row"))).otherwise(F.coalesce("_in_source", F.lit(False)))
    out = [F.when(F.col("_use"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in source.columns else F.col(c) for c in target.columns]
    return joined.withColumn("_use", from_source).select(*out)


def merge_update(target: DataFrame, source: DataFrame, on: Sequence[str], assign: Mapping[str, str]) -> DataFrame:
    """Update ``assign`` (target column: source column) in rows with a match; the others stay.

    Several source rows for one target row are an error.
    """
    per_key = source.dropna(subset=list(on)).groupBy(*[F.col(k).alias(f"_s_{k}") for k in on]).agg(
        F.count(F.lit(1)).alias("_copies"), F.first(F.struct(*[F.col(s).alias(f"_v_{t}") for t, s in assign.items()])).alias("_row")
    )
    joined = target.join(per_key, _on(target, per_key, on, "_s_"), "left")
    matched = F.when(F.col("_copies") > 1, F.raise_error(F.lit("merge: several source rows match one target row"))).otherwise(F.col("_copies") == 1)
    out = [F.when(F.col("_hit"), F.col(f"_row._v_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in target.columns]
    return joined.withColumn("_hit", F.coalesce(matched, F.lit(False))).select(*out)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows where the predicate is not true; a NULL predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, assign: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(*[F.when(hit, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in df.columns])


def changes(rows: DataFrame, version: int, op: str = "U") -> DataFrame:
    return rows.select(F.lit(version).alias("version"), F.lit(op).alias("op"), *rows.columns)


def as_of(log: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """The table as of a version: the last change per key, without deleted keys.

    An aggregate with map-side combine: a key with very many changes is thinned out before the shuffle.
    """
    seen = log if version is None else log.where(F.col("version") <= version)
    rest = [c for c in log.columns if c not in (*keys, "version")]
    last = seen.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_r")).where("_r.op <> 'D'")
    return last.select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in log.columns if c not in ("version", "op")])


def restore(log: DataFrame, keys: Sequence[str], version: int, new_version: int) -> DataFrame:
    """Log with a new head equal to ``version``: re-upsert its rows, delete keys born later."""
    old = as_of(log, keys, version)
    later = as_of(log, keys).select(*keys).join(old.select(*keys), list(keys), "left_anti")
    gone = changes(later, new_version, "D")
    return log.unionByName(changes(old, new_version)).unionByName(gone, allowMissingColumns=True)


def reinsert(current: DataFrame, log: DataFrame, keys: Sequence[str], version: int, predicate: Column) -> DataFrame:
    """Add the rows an older version had for a predicate."""
    return current.unionByName(as_of(log, keys, version).where(predicate))


def history(log: DataFrame) -> DataFrame:
    """(version, op, rows) of a change log."""
    return log.groupBy("version", "op").agg(F.count(F.lit(1)).alias("rows"))


def drop_superseded(log: DataFrame, keys: Sequence[str], keep_from: int) -> DataFrame:
    """Fold all versions up to ``keep_from`` into one; later versions can still be read as before."""
    base = changes(as_of(log, keys, keep_from), keep_from)
    return base.unionByName(log.where(F.col("version") > keep_from))


class SchemaMismatch(ValueError):
    """Rows do not fit the table they are to be appended to."""

    def __init__(self, differences: list[str]):
        super().__init__("; ".join(differences))
        self.differences = differences


def schema_differences(table: T.StructType, incoming: T.StructType) -> list[str]:
    have, got = {f.name: f.dataType for f in table}, {f.name: f.dataType for f in incoming}
    out = [f"missing column {c}" for c in have if c not in got]
    out += [f"extra column {c}" for c in got if c not in have]
    out += [f"column {c} is {got[c].simpleString()}, not {have[c].simpleString()}" for c in have if c in got and got[c] != have[c]]
    return out


def append_enforced(table: DataFrame, incoming: DataFrame, path: str) -> None:
    """Append only rows with exactly the table's schema."""
    differences = schema_differences(table.schema, incoming.schema)
    if differences:
        raise SchemaMismatch(differences)
    incoming.select(*table.columns).write.mode("append").parquet(path)


def append_evolving(df: DataFrame, path: str) -> DataFrame:
    """Append with new columns; rows from before read NULL there. The table's columns come first, in their order, then the new ones.

    An existing column may not change its type.
    """
    table = df.sparkSession.read.option("mergeSchema", True).parquet(path).schema
    have = {f.name: f.dataType for f in table}
    changed = [x for x in schema_differences(table, df.schema) if x.startswith("column ")]
    if changed:
        raise SchemaMismatch(changed)
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(T.StructType([*table, *(f for f in df.schema if f.name not in have)])).parquet(path)


def bins_by_size(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Positions of the sizes in bins of a capacity, first fit decreasing; what is larger has a bin of its own."""
    bins: list[list[int]] = []
    room: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, left in enumerate(room) if left >= sizes[i]), None)
        if at is None:
            bins.append([])
            room.append(capacity)
            at = len(bins) - 1
        bins[at].append(i)
        room[at] -= sizes[i]
    return bins


def compact(spark: SparkSession, path: str, out: str, target_bytes: int = 256 * 1024 * 1024) -> DataFrame:
    """The rows of a table with its small files rewritten as few of about the target size."""
    return read_files(compacted_files(spark, path, out, target_bytes))


def compacted_files(spark: SparkSession, path: str, out: str, target_bytes: int = 256 * 1024 * 1024, full: float = 0.75) -> DataFrame:
    """The same table in few files of about the target size: (file_path) of all files that now make it up.

    Files of at least ``full`` of the target stay as they are, under their names. The small ones are packed into bins by first
    fit decreasing; bins of several files are read and written to ``out``, one file per bin, in one job. Sizes come from the
    file listing, which Spark holds on the driver anyway. Read the result with ``read_files``; no old file is deleted.
    """
    from ..sources.files import manifest

    files = [(r["file_path"], r["file_size"]) for r in manifest(spark, path).select("file_path", "file_size").collect()]
    small = sorted(f for f in files if f[1] < full * target_bytes)
    several = [b for b in bins_by_size([size for _, size in small], target_bytes) if len(b) > 1]
    moved = [(small[i][0], number) for number, members in enumerate(several) for i in members]
    kept = sorted({f for f, _ in files} - {f for f, _ in moved})
    if moved:
        dealt = spark.createDataFrame(moved, "file_path STRING, _bin INT")
        rows = spark.read.parquet(*[f for f, _ in moved]).withColumn("file_path", F.col("_metadata.file_path"))
        columns = [c for c in rows.columns if c != "file_path"]
        rows = rows.join(F.broadcast(dealt), "file_path")  # one row per small file of the listing
        # a partition per bin: ranges of the bin number are cut between bins
        rows.repartitionByRange(len(several), "_bin").select(*columns).write.parquet(out)
        kept += [r["file_path"] for r in manifest(spark, out).select("file_path").collect()]
    return spark.createDataFrame([(f,) for f in kept], "file_path STRING")


def read_files(files: DataFrame) -> DataFrame:
    """The rows of a list of Parquet files, as ``compacted_files`` returns it."""
    return files.sparkSession.read.parquet(*[r["file_path"] for r in files.collect()])


CLUSTER_SAMPLE = 20_000


def cluster_key(df: DataFrame, columns: Sequence[str], bits: int = 8, sample: int = CLUSTER_SAMPLE) -> DataFrame:
    """Add _z: the interleaved bits of each column's place among 2**bits ranges of its own order.

    Columns may have any type that can be ordered. The range boundaries come from ``sample`` rows drawn over the whole table;
    they decide which rows share a file, never which rows there are. NULL comes first.
    """
    drawn = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).orderBy(F.rand(7)).limit(sample)
    step = F.sequence(F.lit(1), F.lit(2**bits - 1))
    arrays = []
    for i in range(len(columns)):
        values = F.array_sort(F.collect_list(f"c{i}"))  # at most ``sample`` values
        arrays.append(F.struct(values.alias("v")).alias(f"s{i}"))
    spread = drawn.agg(*arrays).select(F.struct(*[
        F.array_distinct(F.filter(F.transform(step, lambda k: F.get(F.col(f"s{i}.v"), (k * F.size(f"s{i}.v") / 2**bits).cast("int"))), lambda x: x.isNotNull())).alias(f"e{i}") for i in range(len(columns))
    ]).alias("e"))
    z = F.lit(0).cast("long")
    ranked = df.withColumn("_e", spread.scalar())
    for i, c in enumerate(columns):
        ranked = ranked.withColumns({f"_x{i}": F.col(c), f"_e{i}": F.col(f"_e.e{i}")})
        ranked = ranked.withColumn(f"_r{i}", F.when(F.col(c).isNull(), 0).otherwise(_edges_below(f"_e{i}", f"_x{i}", bits)).cast("long"))
        for b in range(bits):
            z = z + F.shiftleft(F.shiftright(F.col(f"_r{i}"), b).bitwiseAND(F.lit(1)), b * len(columns) + i)
    helpers = ["_e", *[f"_{p}{i}" for i in range(len(columns)) for p in ("x", "e", "r")]]
    return ranked.withColumn("_z", z).drop(*helpers)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int) -> DataFrame:
    """Write so that each file covers narrow ranges of all ``columns``; readers then skip files by min/max."""
    keyed = cluster_key(df, columns) if len(columns) > 1 else df.withColumn("_z", F.col(columns[0]))
    keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def by_key(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash repartition ahead of grouped work, so that the groups need no further shuffle.

    The number of partitions is given explicitly, because the adaptive planner would merge partitions by their
    bytes while grouped Python work is bound by CPU.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
