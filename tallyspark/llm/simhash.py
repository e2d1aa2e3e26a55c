"""SimHash near-dedup: meet-in-the-middle ball hashing.

Two fingerprints within radius r share a variant within half of r of both. Every distinct fingerprint therefore emits all its
variants within that half, variants are shuffled, and the fingerprints that meet on one are checked by their true distance.
Copies share a fingerprint and travel as one row; a variant is met by at most as many fingerprints as the ball holds.

Defined cases: null text counts as empty, a text without words has fingerprint zero and links like any other; null ids keep
their row and take part with their fingerprint, but never name a component unless no other id is there (then null); repeated
rows each return a row; no rows in, no rows out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import byte_view, components, documents, free_names, table, text_digest
from .registry import query

SHINGLE, RADIUS, SEED = 3, 2, 42
TASK_VARIANTS = 1 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    hash_of = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    hashes = np.fromiter((hash_of(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), stops[size - 1 :].tolist())), np.uint64, n)
    octets = hashes.view(np.uint8).reshape(n, 8)  # little-endian: octet 0 holds bits 0 to 7
    if n < 4096:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Signed 64-bit fingerprint of a text column."""

    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        raw, ends = byte_view(column)
        raw = raw.tobytes()
        return pa.array(np.array([fingerprint(raw[a:b], shingle) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], np.uint64).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def ball_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join all within `radius`.

    With an even radius all that meet on a variant are within it of each other, so each is linked with the least of them and
    no pairs within the meeting are made; with an odd one all pairs of the (ball-bounded) meeting are checked.
    """
    half = (radius + 1) // 2
    masks = [sum(1 << bit for bit in bits) for k in range(half + 1) for bits in combinations(range(64), k)]
    signed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in masks))
    # a small table blows up to a row per variant, so it is dealt to as many tasks as those rows are worth
    tasks = max(1, -(-prints.count() * len(masks) // TASK_VARIANTS))
    variants = prints.repartition(tasks, "fp").select("fp", F.explode(F.transform(signed, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    met = variants.groupBy("variant").agg(F.collect_list("fp").alias("met")).where(F.size("met") > 1)
    if radius % 2 == 0:
        found = met.select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
    else:
        found = met.select(F.explode("met").alias("a"), "met").select("a", F.explode("met").alias("b"))
    return found.where(F.col("a") < F.col("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_groups(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, digest (of the text), fp, component_id (smallest doc_id of its group)."""
    rows = documents(docs).select("doc_id", text_digest(F.col("text")).alias("digest"), fingerprint_column(F.col("text"), shingle).alias("fp"))
    rows = materialize(rows, "simhash-prints")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(ball_links(prints.select("fp"), radius), "simhash")
    roots = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = materialize(roots.join(names, "component").select("fp", "component_id"), "simhash-groups")
    return rows.join(groups, "fp")


def keep_representatives(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each group, all columns kept.

    Of rows that repeat this id one stays (the least text digest, then any of equal rows). Groups without any id keep one row.
    """
    rows = simhash_groups(docs, radius)
    first = rows.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone"))
    chosen = first.agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("row"), F.count(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), 1)).alias("copies"))
    id_, digest = free_names(docs, "__id", "__digest")
    chosen = materialize(chosen.select(F.col("row.doc_id").alias("id"), F.col("row.digest").alias("of"), (F.col("copies") > 1).alias("repeated")), "simhash-chosen")
    keyed = docs.withColumns({id_: F.col("doc_id").cast("long"), digest: text_digest(F.col("text"))})
    on = keyed[id_].eqNullSafe(chosen["id"]) & (keyed[digest] == chosen["of"])
    once = keyed.join(chosen.where("NOT repeated"), on, "left_semi").drop(id_, digest)
    if chosen.where("repeated").limit(1).count():
        again = keyed.join(chosen.where("repeated"), on, "left_semi").dropDuplicates([id_, digest]).drop(id_, digest)
        return once.unionByName(again)
    return once


@query("op10_simhash_ball_groups")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
