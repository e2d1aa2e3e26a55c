"""Language ID: language-bitmask n-gram filters.

Byte n-grams of the letters of a text are looked up in one Bloom filter whose cells hold a bit per language (bit-sliced: cell
by cell instead of filter by filter), so the AND over the hash functions returns all languages that hold the n-gram. Bits
are counted per language over the text, corrected by each language's own rate of false positives, and the highest
corrected share decides.

A language holds an n-gram if it is at least `share` times as frequent there as in the language where it is most frequent.
All n-grams of all training rows are counted; the filter has a fixed number of cells, so what reaches the driver and the
executors is bounded whatever the corpus.

Defined cases: null texts and texts without a letter are `und` with score 0; rows with a null language train nothing; rows
with a null id count as held out from nothing and train; texts whose n-grams are in no filter get the most frequent
language with score 0; without any training row every text is `und`; empty tables return no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import byte_view, cut, short_batches, table
from .registry import query

GRAM, SHARE = 4, 0.4
CELL_BITS, HASHES = 22, 3
FOLDS, HELD_OUT = 4, 2
TASK_GRAMS = 1 << 23
#: ASCII letters and bytes outside ASCII stay, all else is a space.
_LETTER = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def grams(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of GRAM bytes, and the offsets of the texts into them. Texts are framed by spaces, runs of spaces are one."""
    n = len(ends) - 1
    framed = np.full(len(raw) + n * GRAM, 32, np.uint8)
    shift = np.repeat(np.arange(n) * GRAM + 1, np.diff(ends))
    framed[np.arange(len(raw)) + shift] = _LETTER[raw]
    heads = ends[:-1] + np.arange(n) * GRAM
    space = framed == 32
    drop = space.copy()
    drop[1:] &= space[:-1]
    drop[:1] = False
    tails = (heads[:, None] + np.diff(ends)[:, None] + np.arange(1, GRAM)).ravel()  # the frame itself stays
    drop[tails] = False
    drop[heads] = False
    kept = np.flatnonzero(~drop)
    text = framed[kept].astype(np.uint32)
    starts = np.searchsorted(kept, heads)
    stops = np.append(starts[1:], len(kept))
    code = np.zeros(max(0, len(text) - GRAM + 1), np.uint32)
    for k in range(GRAM):
        code = code << np.uint32(8) | text[k : len(text) - GRAM + 1 + k]
    counts = np.maximum(0, stops - starts - GRAM + 1)
    inside = np.ones(len(code) + GRAM, bool)
    for k in range(1, GRAM):  # n-grams that reach into the next text
        inside[stops - k] = False
    code = code[inside[: len(code)]]
    return code, np.concatenate(([0], np.cumsum(counts)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: language, n-gram, count."""
    held: dict[str, list[np.ndarray]] = {}
    done: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    size = 0

    def fold_in() -> None:
        for lang, parts in held.items():
            codes, numbers = np.unique(np.concatenate(parts), return_counts=True)
            if lang in done:
                both, where = np.unique(np.concatenate((done[lang][0], codes)), return_inverse=True)
                codes, numbers = both, np.bincount(where, np.concatenate((done[lang][1], numbers))).astype(np.int64)
            done[lang] = codes, numbers
        held.clear()

    for batch in cut(batches, "text"):
        code, at = grams(*byte_view(batch.column(0)))
        langs = np.array(batch.column(1).to_pylist(), object)
        of = np.repeat(np.arange(len(langs)), np.diff(at))
        for lang in set(langs.tolist()):
            held.setdefault(lang, []).append(code[(langs == lang)[of]])
        size += len(code)
        if size > TASK_GRAMS:
            fold_in()
            size = 0
    fold_in()
    for lang, (codes, numbers) in done.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(numbers.astype(np.int64))], ["lang", "gram", "number"])


def cells_of(code: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    value = code.astype(np.uint64)
    return [((value * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1)) >> np.uint64(64 - bits)).astype(np.int64) for k in range(hashes)]


@dataclass
class Filters:
    languages: list[str]
    cells: np.ndarray  # (cell, 64 languages a word)
    hashes: int
    wrong: np.ndarray  # false positives per language
    usual: int  # the most frequent language

    def masks(self, code: np.ndarray) -> np.ndarray:
        bits = len(self.cells).bit_length() - 1
        first, *more = cells_of(code, bits, self.hashes)
        out = self.cells[first]
        for at in more:
            out &= self.cells[at]
        return out


def learn(docs: DataFrame, train_rows: Column, bits: int = CELL_BITS, hashes: int = HASHES, share: float = SHARE) -> Filters | None:
    """Filters from all training rows of `docs` (text, lang)."""
    short_batches(docs.sparkSession)
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(train_rows).select(F.lower("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = materialize(rows.mapInArrow(_count, "lang string, gram long, number long").groupBy("gram", "lang").agg(F.sum("number").alias("number")), "langid-counts")
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("number").alias("total")).collect()}
    languages = sorted(totals)
    if not languages:
        return None
    place = F.create_map(*(F.lit(x) for k, lang in enumerate(languages) for x in (lang, k)))
    total = F.create_map(*(F.lit(x) for lang in languages for x in (lang, float(totals[lang]))))
    rated = counts.select("gram", place[F.col("lang")].alias("k"), (F.col("number") / total[F.col("lang")]).alias("rate"))
    words = -(-len(languages) // 64)
    tops = rated.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("k", "rate")).alias("all"))  # one entry per language
    held = tops.select("gram", F.transform(F.filter("all", lambda x: x["rate"] >= share * F.col("top")), lambda x: x["k"]).alias("ks"))
    placed = held.mapInArrow(partial(_place, bits=bits, hashes=hashes, words=words), ", ".join(["cell long", *(f"m{w} long" for w in range(words))]))
    filled = placed.groupBy("cell").agg(*(F.bit_or(f"m{w}").alias(f"m{w}") for w in range(words))).toArrow()  # at most 2 ** bits rows
    cells = np.zeros((1 << bits, words), np.uint64)
    cells[filled.column("cell").to_numpy()] = np.stack([filled.column(f"m{w}").to_numpy().view(np.uint64) for w in range(words)], 1)
    full = np.array([(cells[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)).mean() for k in range(len(languages))])
    return Filters(languages, cells, hashes, np.minimum(full**hashes, 0.99), int(np.argmax([totals[x] for x in languages])))


def _place(batches: Iterator[pa.RecordBatch], bits: int, hashes: int, words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column(1)
        k, of = held.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(batch.num_rows), np.diff(held.offsets.to_numpy()))
        masks = np.zeros((batch.num_rows, words), np.uint64)
        np.bitwise_or.at(masks, (of, k // 64), np.uint64(1) << (k % 64).astype(np.uint64))
        for at in cells_of(batch.column(0).to_numpy(), bits, hashes):
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(masks[:, w].view(np.int64)) for w in range(words))], ["cell", *(f"m{w}" for w in range(words))])


def language_column(text: Column, shared: Broadcast) -> Column:
    """struct(lang, score) of a text that has letters."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def of(column: pa.Array) -> pa.Array:
        filters: Filters = shared.value
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        lang, score = [], []
        for part in cut([batch], "text"):
            code, at = grams(*byte_view(part.column(0)))
            masks, number = filters.masks(code), np.maximum(np.diff(at), 1)
            shares = np.zeros((len(filters.languages), part.num_rows))
            for k in range(len(filters.languages)):
                hit = np.concatenate(([0], np.cumsum(masks[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)))).astype(np.float64)
                shares[k] = np.maximum(0, ((hit[at[1:]] - hit[at[:-1]]) / number - filters.wrong[k]) / (1 - filters.wrong[k]))
            total, best = shares.sum(0), shares.argmax(0)
            best[total == 0] = filters.usual
            lang += [filters.languages[k] for k in best]
            score += np.minimum(1.0, shares.max(0) / np.where(total > 0, total, 1)).tolist()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    return of(F.lower(F.coalesce(text, F.lit(""))))


def predict(docs: DataFrame, filters: Filters | None) -> tuple[Column, Column]:
    """Columns lang_pred and score for the `text` of `docs`."""
    if filters is None:
        return F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")
    found = language_column(docs["text"], docs.sparkSession.sparkContext.broadcast(filters))
    letters = F.coalesce(docs["text"], F.lit("")).rlike(r"\p{L}")
    return F.when(letters, found["lang"]).otherwise("und").alias("lang_pred"), F.when(letters, found["score"]).otherwise(0.0).alias("score")


@query("op3_language_masks")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    lang, score = predict(docs, learn(docs, ~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), lang, score)
