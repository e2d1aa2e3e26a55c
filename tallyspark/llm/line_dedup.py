"""Substring dedup by hashing short runs of lines, sentences or clauses.

A text is cut into clauses at line ends and at the given marks. From every clause on, the shortest run of clauses with at
least `min_words` words is one unit: its words are normalised (case, white space, marks at clause ends) and hashed, digests are
grouped over all documents, and only the earliest occurrence by (doc_id, text digest, position) stays. Runs start at every
clause, so a passage is found inside a line too, whatever stands before and after it. With no marks and one word the units are
whole lines.

Removed clauses, and what lies between two of them, are reported as byte spans of the original text. An occurrence that
overlaps the one that stays (text that repeats itself) is not removed on that account.

A task settles copies among its own rows first and sends the earliest place of a digest only, so a unit that stands in a third
of all documents makes one row per task. Everything is dealt by digest once; texts are joined with their removed runs by row.

Defined cases: null text counts as empty; blank clauses are never removed, and the last clauses of a text that are too short
for a unit only with a unit that reaches them; a null id ranks first; rows that repeat id and text are one document given twice
and return equal rows; empty tables return no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, documents, table, text_digest
from .registry import query

#: Marks that end a clause beside the line feed, and the words a unit needs.
MARKS, MIN_WORDS = ".!?,;:|", 20
HELD = 200_000  # units of one task that are settled together
UNITS = "k0 long, k1 int, doc_id long, digest long, position int, last int, later boolean"


def clause_pattern(marks: str = MARKS) -> re.Pattern:
    """Clauses one after another; what they leave out are line feeds and marks without words before them."""
    some = re.escape(marks)
    return re.compile(rf"([^{some}\n]+)[{some}]*" if marks else r"([^\n]+)")


def clauses(text: str, pattern: re.Pattern) -> tuple[list[str], list[int]]:
    """Normalised clauses that have words, and the number of their words."""
    split = [c.lower().split() for c in pattern.findall(text)]
    split = [words for words in split if words]
    return [" ".join(words) for words in split], [len(words) for words in split]


def runs(counts: list[int], min_words: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the shortest run with `min_words` words from each clause that has one."""
    last, held = -1, 0
    for first, own in enumerate(counts):
        while held < min_words:
            last += 1
            if last == len(counts):
                return
            held += counts[last]
        yield first, last
        held -= own


def _units(batches: Iterator[pa.RecordBatch], marks: str, min_words: int) -> Iterator[pa.RecordBatch]:
    """Units of a task: the earliest place of each digest, and later places that are certain to be copies.

    A later place that overlaps the earliest one of its document is left open: only the earliest of all tasks decides.
    """
    pattern = clause_pattern(marks)
    names = [c.split()[0] for c in UNITS.split(", ")]
    best: dict[bytes, tuple] = {}
    sure: list[tuple] = []
    opened: list[tuple] = []

    def flush() -> pa.RecordBatch:
        rows = [(key, *place, False) for key, place in best.items()] + [(*row, False) for row in opened] + [(*row, True) for row in sure]
        raw = np.frombuffer(b"".join([r[0] for r in rows]), np.uint8).reshape(-1, 16)
        k0, k1 = raw[:, :8].copy().view("<i8").ravel(), raw[:, 8:12].copy().view("<i4").ravel()
        later = np.array([r[6] for r in rows], bool)
        if later.any():  # their digest decides nothing any more, so they are dealt by place
            k0[later] ^= np.array([r[4] for r in rows], np.int64)[later] * 0x9E3779B1 + np.array([r[3] for r in rows], np.int64)[later]
        rest = [pa.array([r[i] for r in rows], t) for i, t in ((2, pa.int64()), (3, pa.int64()), (4, pa.int32()), (5, pa.int32()))]
        best.clear()
        sure.clear()
        opened.clear()
        return pa.RecordBatch.from_arrays([pa.array(k0), pa.array(k1), *rest, pa.array(later)], names)

    for batch in cut(batches, "text"):
        for doc_id, digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words, counts = clauses(text, pattern)
            rank = (doc_id is not None, doc_id or 0, digest)
            for first, last in runs(counts, min_words):
                key = xxhash.xxh3_128_digest(" ".join(words[first : last + 1]))
                place = (rank, doc_id, digest, first, last)
                known = best.get(key)
                if known is None:
                    best[key] = place
                elif (rank, first) < (known[0], known[3]):
                    best[key] = place
                    (opened if known[0] == rank and known[3] <= last else sure).append((key, *known))
                elif (rank, first) != (known[0], known[3]):
                    (opened if known[0] == rank and first <= known[4] else sure).append((key, *place))
        if len(best) + len(sure) + len(opened) > HELD:
            yield flush()
    if best:
        yield flush()


def repeated_units(docs: DataFrame, marks: str = MARKS, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, digest, removed: array of (first, last) clauses) of the documents that hold a later copy of a unit."""
    found = docs.select("doc_id", "digest", "text").mapInArrow(partial(_units, marks=marks, min_words=min_words), UNITS)
    place = F.struct("doc_id", "digest", "position", "last")
    found = found.withColumn("first", F.min(F.when(~F.col("later"), place)).over(Window.partitionBy("k0", "k1")))
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    copy = F.struct("doc_id", "digest", "position") > F.struct("first.doc_id", "first.digest", "first.position")
    later = found.where(F.col("later") | copy & ~(own & (F.col("position") <= F.col("first.last"))))
    return later.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("position", "last"))).alias("removed"))


def dedup_lines(docs: DataFrame, marks: str = MARKS, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, kept text, n_units (clauses), n_removed (clauses), removed_spans ((start, stop) byte offsets in the input text)."""
    rows = documents(docs).withColumn("digest", text_digest(F.col("text")))
    removed = repeated_units(rows, marks, min_words).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "removed")
    joined = rows.join(removed, rows["doc_id"].eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left")
    parts = joined.select("doc_id", "text", "removed")
    schema = "doc_id long, text string, n_units long, n_removed long, removed_spans array<struct<start:bigint,stop:bigint>>"
    return parts.mapInArrow(partial(_without, marks=marks), schema)


def _without(batches: Iterator[pa.RecordBatch], marks: str) -> Iterator[pa.RecordBatch]:
    pattern = clause_pattern(marks)
    for batch in cut(batches, "text"):
        kept, counts, removed, spans = [], [], [], []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            at = [m.span() for m in pattern.finditer(text) if m[1].split()]
            counts.append(len(at))
            if not gone:
                kept.append(text)
                removed.append(0)
                spans.append([])
                continue
            taken = np.zeros(len(at) + 1, np.int64)
            for run in gone:
                taken[run["position"]] += 1
                taken[run["last"] + 1] -= 1
            taken = np.concatenate(([0], np.cumsum(taken[:-1]) > 0, [0])).astype(np.int8)
            edges = np.flatnonzero(np.diff(taken)).reshape(-1, 2).tolist()
            cuts = [(at[a][0], at[b - 1][1]) for a, b in edges]
            kept.append("".join(text[a:b] for a, b in zip([0, *(stop for _, stop in cuts)], [*(start for start, _ in cuts), len(text)])))
            removed.append(int(taken.sum()))
            done = size = 0
            own = []
            for start, stop in cuts:
                size += len(text[done:start].encode())
                wide = len(text[start:stop].encode())
                own.append({"start": size, "stop": size + wide})
                done, size = stop, size + wide
            spans.append(own)
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)], ["doc_id", "text", "n_units", "n_removed", "removed_spans"])


# the text digest does not matter where ids are unique
LINES_SQL = r"""
WITH tokens AS (
  SELECT doc_id, unnest(t) AS t, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?,;:|\n]+[.!?,;:|]*|[.!?,;:|]+|\n') AS t FROM documents)
), split AS (
  SELECT doc_id, i, t, list_filter(regexp_split_to_array(lower(rtrim(t, '.!?,;:|')), '[\s\p{Z}]+'), lambda w: w <> '') AS w FROM tokens
), numbered AS (
  SELECT doc_id, i, t, array_to_string(w, ' ') AS norm, len(w) AS n, sum(CAST(len(w) > 0 AS INTEGER)) OVER o AS q, sum(len(w)) OVER o AS c FROM split WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), clause AS (
  SELECT doc_id, q, c, c - n + 20 AS need, norm FROM numbered WHERE n > 0
), ends AS (
  SELECT a.doc_id, a.q AS first, b.q AS last FROM clause a ASOF JOIN clause b ON a.doc_id = b.doc_id AND a.need <= b.c
), whole AS (
  SELECT doc_id, list(norm ORDER BY q) AS norms FROM clause GROUP BY 1
), unit AS (
  SELECT e.doc_id, e.first, e.last, array_to_string(norms[CAST(e.first AS BIGINT) : CAST(e.last AS BIGINT)], ' ') AS key FROM ends e JOIN whole USING (doc_id)
), ranked AS (
  SELECT *, first_value(doc_id) OVER k AS d0, first_value(first) OVER k AS f0, first_value(last) OVER k AS l0 FROM unit WINDOW k AS (PARTITION BY key ORDER BY doc_id, first)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(CAST(first AS BIGINT), CAST(last AS BIGINT) + 1)) AS q FROM ranked WHERE (doc_id <> d0 OR first > f0) AND NOT (doc_id = d0 AND first <= l0)
), marked AS (
  SELECT m.*, a.q IS NOT NULL AS own, b.q IS NOT NULL AS following FROM numbered m LEFT JOIN gone a ON a.doc_id = m.doc_id AND a.q = m.q LEFT JOIN gone b ON b.doc_id = m.doc_id AND b.q = m.q + 1
)
SELECT d.doc_id, coalesce(string_agg(t, '' ORDER BY i) FILTER (NOT (own AND (n > 0 OR following))), '') AS text, count(*) FILTER (n > 0) AS n_units, count(*) FILTER (n > 0 AND own) AS n_removed
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op7_line_dedup", LINES_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).drop("removed_spans")
