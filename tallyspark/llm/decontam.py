"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by their number of shingles: class U holds items with U/2 < n <= U. A long document is searched per
class in windows of three blocks of U/2 shingles, so every stretch as long as an item lies in one window and the share of an
item in a window is never tiny, however long the document. Each of `hashes` MinHash values is a band of its own: an item of
which 0.8 stands in a window shares a value with a chance of 0.25 or more each, so 32 miss it once in 10,000 cases. Items of one
or two shingles would be a small share of their windows: their shingles themselves are looked up among all of a document.

Window values first pass a Bloom filter of fixed size over the items' values; documents with a value that passes send those
values and their distinct shingles on, all others nothing, so texts are read once and never shuffled. The values meet the
items' in a join and every candidate pair is verified on the whole document: the share of the item's distinct shingles in it.

Defined cases: null texts count as empty and hold nothing; items without a word are found nowhere; an item under five words
is one shingle and found only in equal documents; null ids are carried along; rows that repeat id and text count once; rows
that repeat only the id are separate documents or items; empty tables return no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import byte_view, cut, free_names, short_batches, table, text_digest
from .registry import query
from .words import mix, shingle_hashes, word_hashes

SHINGLE, THRESHOLD, HASHES = 5, 0.8, 32
SMALLEST_CLASS, EXACT_SHINGLES, EXACT_CLASS = 8, 2, 1
FILTER_BITS, PROBES = 1 << 25, 2
SLICE_BYTES = 1 << 20


def size_class(counts: np.ndarray) -> np.ndarray:
    """The class of items with so many shingles: the power of two that is not less, SMALLEST_CLASS at least, or the exact one."""
    return np.where(counts <= EXACT_SHINGLES, EXACT_CLASS, np.maximum(SMALLEST_CLASS, 1 << np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64)))


def _factors(number: int) -> np.ndarray:
    return np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(number)], np.uint64)


def band_key(value: np.ndarray, band: int, size: int) -> np.ndarray:
    return mix(value + np.uint64(((band + 1) * 0xA24BAED4963EE407 + size * 0x9FB21C651E98DF25) % (1 << 64))).view(np.int64)


def rows_of(table_: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    short_batches(table_.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return table_.select(F.col(id_col).cast("long").alias("id"), text_digest(F.col(text_col)).alias("digest"), F.lower(text).alias("text"))


def _item_rows(batches: Iterator[pa.RecordBatch], shingle: int, hashes: int) -> Iterator[pa.RecordBatch]:
    factors = _factors(hashes)
    for batch in cut(batches, "text", SLICE_BYTES):
        shingles, ends = shingle_hashes(*word_hashes(*byte_view(batch.column(2))), shingle)
        ids, digests, own, sizes, keys = [], [], [], [], []
        for row, (id_, digest) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            mine = np.unique(shingles[ends[row] : ends[row + 1]])
            if len(mine):
                size = int(size_class(np.array([len(mine)]))[0])
                ids.append(id_)
                digests.append(digest)
                own.append(mine.view(np.int64))
                sizes.append(size)
                exact = size == EXACT_CLASS
                keys.append(band_key(mine, 0, size) if exact else np.concatenate([band_key(np.array([(mine * f).min()]), k, size) for k, f in enumerate(factors)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), pa.array(own, pa.list_(pa.int64())), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            ["item_id", "item_digest", "shingles", "size", "keys"],
        )


def _window_keys(batches: Iterator[pa.RecordBatch], shingle: int, hashes: int, classes: list[int], bits: Broadcast) -> Iterator[pa.RecordBatch]:
    """Documents with window values that pass the filter: id, digest, keys, all distinct shingles."""
    factors, words = _factors(hashes), bits.value
    for batch in cut(batches, "text", SLICE_BYTES):
        values, ends = shingle_hashes(*word_hashes(*byte_view(batch.column(2))), shingle)
        if not len(values):
            continue
        counts = np.diff(ends)
        out_row, out_key = [], []

        def probe_filter(key: np.ndarray, owner: np.ndarray) -> None:
            hit = np.arange(len(key))
            for probe in range(PROBES):
                spot = key[hit] >> (25 * probe) & (FILTER_BITS - 1)
                hit = hit[np.flatnonzero(words[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)]
            out_row.append(owner[hit])
            out_key.append(key[hit])

        if EXACT_CLASS in classes:
            probe_filter(band_key(values, 0, EXACT_CLASS), np.repeat(np.arange(batch.num_rows), counts))
        windowed = [c for c in classes if c != EXACT_CLASS]
        block = (windowed or [SMALLEST_CLASS])[0] // 2
        # texts are laid out in whole blocks of the smallest class; the fill never is a least value of a real block
        doc_of, layout = [], []
        blocks = -(-counts // block)
        starts = np.concatenate(([0], np.cumsum(blocks)))
        edges = np.repeat(ends[:-1], blocks) + (np.arange(starts[-1]) - np.repeat(starts[:-1], blocks)) * block
        for band, factor in enumerate(factors if windowed else ()):
            least = np.minimum.reduceat(values * factor, edges)
            at, size, first = least, windowed[0], starts
            while True:
                if size in windowed:
                    number = np.diff(first)
                    owner = np.repeat(np.arange(len(number)), number)
                    left = np.repeat(first[1:], number) - np.arange(first[-1])
                    window = at.copy()
                    for step in (1, 2):
                        has = np.flatnonzero(left > step)
                        window[has] = np.minimum(window[has], at[has + step])
                    probe_filter(band_key(window, band, size), owner)
                if size >= windowed[-1]:
                    break
                size *= 2  # two neighbouring blocks of a text make one of the next class
                number = np.diff(first)
                above = np.concatenate(([0], np.cumsum(-(-number // 2))))
                heads = np.repeat(first[:-1], np.diff(above)) + 2 * (np.arange(above[-1]) - np.repeat(above[:-1], np.diff(above)))
                at, first = np.minimum.reduceat(at, heads), above
        row, key = np.concatenate(out_row), np.concatenate(out_key)
        if len(row):
            row, key = np.unique(np.stack((row, key)), axis=1)
            head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            own = pa.array(row[head])
            sets = [np.unique(values[ends[r] : ends[r + 1]]).view(np.int64) for r in row[head]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(np.split(key, head[1:]), pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))], ["id", "digest", "keys", "own"])


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, hashes: int = HASHES) -> DataFrame:
    """doc_id, digest (of the document's text), item_id, n_item_shingles, n_shared, containment of every hit."""
    spark = docs.sparkSession
    schema = "doc_id long, digest long, item_id long, n_item_shingles long, n_shared long, containment double"
    made = rows_of(items, "item_id").dropDuplicates(["id", "digest"]).mapInArrow(partial(_item_rows, shingle=shingle, hashes=hashes), "item_id long, item_digest long, shingles array<bigint>, size long, keys array<bigint>")
    made = materialize(made, "decontam-items")
    classes = sorted(r["size"] for r in made.select("size").distinct().collect())  # one per power of two
    if not classes:
        return spark.createDataFrame([], schema)
    keys = made.select("item_id", "item_digest", F.explode("keys").alias("key")).distinct()
    spots = keys.select(F.explode(F.array(*(F.shiftright("key", 25 * k).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in range(PROBES)))).alias("spot"))
    set_bits = spots.groupBy(F.shiftright("spot", 3).alias("octet")).agg(F.bit_or(F.pow(F.lit(2), F.col("spot").bitwiseAND(F.lit(7))).cast("int")).alias("bits"))
    words = np.zeros(FILTER_BITS // 8, np.uint8)  # at most so many rows come to the driver, whatever the number of items
    filled = set_bits.toArrow()
    words[filled.column("octet").to_numpy()] = filled.column("bits").to_numpy().astype(np.uint8)
    bits = spark.sparkContext.broadcast(words)
    rows = rows_of(docs, "doc_id")
    hits = rows.mapInArrow(partial(_window_keys, shingle=shingle, hashes=hashes, classes=classes, bits=bits), "id long, digest long, keys array<bigint>, own array<bigint>")
    hits = materialize(hits, "decontam-hits")
    pairs = hits.select("id", "digest", F.explode("keys").alias("key")).join(keys, "key").select("id", "digest", "item_id", "item_digest").distinct()
    # null ids are values too
    items_of = made.select(F.col("item_id").alias("i"), F.col("item_digest").alias("d"), "shingles")
    full = pairs.join(items_of, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_digest") == F.col("d"))).select(F.col("id").alias("doc"), F.col("digest").alias("of"), "item_id", "shingles")
    own = hits.dropDuplicates(["id", "digest"]).select("id", "digest", "own")
    n, shared = F.size("shingles").cast("long"), F.size(F.array_intersect("own", "shingles")).cast("long")
    joined = own.join(full, own["id"].eqNullSafe(full["doc"]) & (own["digest"] == full["of"]))
    counted = joined.select(F.col("id").alias("doc_id"), "digest", "item_id", n.alias("n_item_shingles"), shared.alias("n_shared"))
    return counted.where(F.col("n_shared") >= threshold * F.col("n_item_shingles")).withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no item is found, all columns kept."""
    id_, digest = free_names(docs, "__id", "__digest")
    hits = materialize(contaminated(docs, items, threshold).select(F.col("doc_id").alias(id_), F.col("digest").alias(digest)).distinct(), "decontam-hits")
    return docs.join(hits, docs["doc_id"].cast("long").eqNullSafe(F.col(id_)) & (text_digest(docs["text"]) == F.col(digest)), "left_anti")


CONTAINED_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] WHEN len(w) > 0 THEN ['whole: ' || array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_item_shingles, count(*) AS n_shared, count(*)::DOUBLE / any_value(n) AS containment
FROM shingles d JOIN shingles i ON d.kind = 'd' AND i.kind = 'i' AND d.s = i.s JOIN sizes z ON z.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n)
"""


@query("op6_benchmark_containment", CONTAINED_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")
