"""Importance resampling of documents towards a target collection by hashed n-gram counts.

A table of 256 bytes lower-cases A-Z and blanks every separator in the UTF-8 bytes of a text, so `bytes.split` yields its
words. The CRC-32 of a word is the seed for the next one, so n-grams are hashed without being joined. Counters of buckets
reduce inside a task, then over tasks. Documents that hold what the target holds more often get a higher weight; a Gumbel
number from the document's id is added, and the highest scores are drawn without replacement.

The driver sees one number per bucket and one per task. The draw sorts (score, id) over all tasks; ranks are places in a task
plus the rows of the tasks before it.

Defined cases: null text has no words and weight 0; a null id is hashed as an empty one and ranks after equal scores with an
id; rows that repeat an id are scored and ranked one by one; an empty target gives every bucket its smoothed gain; empty
tables return no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import byte_view, cut, documents, table
from .registry import query

BUCKETS, ORDERS, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42

#: Letters and digits of ASCII and all bytes of other characters stay, capitals become small, the rest is blank.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def feature_buckets(raw: bytes, buckets: int = BUCKETS, orders: int = ORDERS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to `orders` words joined by a space."""
    words = raw.translate(WORD_TABLE).split()
    seeds = list(map(crc32, words))
    hashes = seeds
    spaced = [b" " + w for w in words[1:]]
    for k in range(1, orders):
        seeds = list(map(crc32, spaced[k - 1 :], seeds))
        hashes = hashes + seeds
    return len(words), np.array(hashes, np.int64) % buckets


def _count(batches: Iterator[pa.RecordBatch], buckets: int, orders: int) -> Iterator[pa.RecordBatch]:
    counts: Counter[int] = Counter()
    for batch in cut(batches, "text"):
        raw, ends = byte_view(batch.column(batch.schema.get_field_index("text")))
        raw, ends = raw.tobytes(), ends.tolist()
        for a, b in zip(ends, ends[1:]):
            counts.update(feature_buckets(raw[a:b], buckets, orders)[1].tolist())
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """bucket, n: how many features of all texts fall into a bucket."""
    return texts.select("text").mapInArrow(partial(_count, buckets=buckets, orders=orders), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> list[int]:
    """Gain of every bucket in thousandths of a natural logarithm, from smoothed shares of both collections."""
    counts = bucket_counts(docs, buckets, orders).withColumn("t", F.lit(0).cast("long")).unionByName(
        bucket_counts(target, buckets, orders).select("bucket", F.lit(0).cast("long").alias("n"), F.col("n").alias("t"))
    )
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("s"), F.sum("t").alias("t")).collect():  # at most `buckets` rows
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    whole_s, whole_t = float(s.sum()) + buckets, float(t.sum()) + buckets
    return [math.floor(1000 * math.log((a + 1.0) * whole_s / ((b + 1.0) * whole_t))) for a, b in zip(t.tolist(), s.tolist())]


def _weigh(batches: Iterator[pa.RecordBatch], gains: np.ndarray, orders: int) -> Iterator[pa.RecordBatch]:
    for batch in cut(batches, "text"):
        raw, ends = byte_view(batch.column(1))
        raw, ends = raw.tobytes(), ends.tolist()
        rows = []
        for a, b in zip(ends, ends[1:]):
            words, found = feature_buckets(raw[a:b], len(gains), orders)
            rows.append((words, len(found), int(gains[found].sum())))
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])


def importance_weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    rows, wished = documents(docs), documents(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    gains = np.array(bucket_gains(rows, wished, buckets, orders), np.int64)
    return rows.mapInArrow(partial(_weigh, gains=gains, orders=orders), "doc_id long, n_words long, n_features long, weight long")


def with_gumbel(weighted: DataFrame, seed: int = SEED) -> DataFrame:
    """score: the weight plus a Gumbel number, in thousandths, that only the seed and the document's id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return weighted.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """rank: 1, 2, 3 ... of the drawn share of the documents with at least `min_words` words; null for all others."""
    scored = materialize(scored, "scored")
    able = scored.where(F.col("n_words") >= min_words)
    placed = able.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "n_features").withColumn("_id", F.monotonically_increasing_id())
    placed = materialize(placed, "drawn")
    # the part number is the upper 31 bits of the id, the place within the part the lower 33
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before, total = [], 0
    for row in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():  # one row per task
        before.append((row["part"], total))
        total += row["n"]
    offsets = scored.sparkSession.createDataFrame(before, "_part long, _before long")
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_before") + place + 1)
    drawn = numbered.withColumn("rank", F.when(F.col("rank") <= total * percent // 100, F.col("rank"))).drop("_id", "_part", "_before")
    return drawn.unionByName(scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (null: not drawn) of every document."""
    return draw(with_gumbel(importance_weights(docs, target, buckets, orders), seed), percent, min_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")


@query("op12_importance_resampling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")
