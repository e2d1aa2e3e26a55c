"""Helpers the operators share: byte views of Arrow text, row identity, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

BATCH_BYTES = 1 << 20


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: fewer rows in an Arrow batch keep tasks small. Stays set in the session, which changes no result."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so no further column of the input can clash."""
    short_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the input has a column of that name."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_digest(text: Column) -> Column:
    """With the id it names a row: rows that repeat both are one document given twice."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the n + 1 offsets into them; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def cut(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `limit` bytes of one column; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = byte_view(batch.column(batch.schema.get_field_index(column)))[1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The integers of all [start, stop) one after another."""
    counts = stops - starts
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(first - starts, counts)


def components(edges: DataFrame, label: str = "components", max_rounds: int = 200) -> DataFrame:
    """(node, component) for each node of the links (a, b): the smallest node it can reach.

    Each round takes the least label of all neighbours and then the label of that label, is written to the shared folder
    and reports one number to the driver. Neighbour minima combine before the shuffle, hubs are left to skew handling.
    """
    plain = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    both = materialize(plain.unionByName(plain.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-links")
    state = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), f"{label}-0")
    for step in range(1, max_rounds + 1):
        near = both.join(state.select(F.col("node").alias("b"), F.col("component").alias("near")), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        hooked = state.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        upper = hooked.select(F.col("node").alias("mid"), F.col("mid").alias("top"))
        moved = materialize(hooked.join(upper, "mid").select("node", F.least("mid", "top").alias("component"), (F.least("mid", "top") < F.col("old")).alias("moved")), f"{label}-{step}")
        state = moved.select("node", "component")
        if not moved.where("moved").limit(1).count():
            return state
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
