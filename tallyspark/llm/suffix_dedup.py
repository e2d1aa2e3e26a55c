"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte is removed if a `window`-byte string over it also starts earlier. To deal the work out, every window is named by its
anchor, the least hashed gram inside it; equal windows have equal anchors at equal offsets. Neighbouring windows with one
anchor form a fragment. Equal fragments are one string: all but the earliest occurrence go, first inside each task, so a hot
passage is thinned before the shuffle, then over all. The earliest fragments of each anchor that has several different ones
are joined to one text per chunk, whose Burrows-Wheeler transform is expanded breadth first: intervals of strings of length
0, 1, 2, ... are extended backwards, which sets common prefixes by increasing value and stops at `window`. Boundaries still
unset then hold windows that agree in full.

An anchor with more than `hot_fragments` different fragments is not gathered. Its fragments are cut by the place of the anchor
in the window, into stretches of 16 places, and each part is named by the bytes that all windows at these places share; parts
are thinned like fragments, and names that are still hot are cut again, to 4 places and to one, where the name is the window.

Defined cases: null text counts as empty; a null id ranks before all others; rows that repeat id and text are one document
given twice and return equal rows; rows that repeat only the id rank by the digest of their text; texts under `window` bytes
keep every byte; empty tables return no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialize

from .common import byte_view, cut, free_names, ranges, short_batches, table, text_digest
from .registry import query

WINDOW, GRAM = 100, 32
SEGMENT = 1 << 19
TASK_FRAGMENTS = 300_000
HOT_FRAGMENTS = 1024
SPLITS = (16, 4, 1)
CHUNK_BYTES = 1 << 20
EXPAND_BYTES = 2 << 20  # bytes one task of the expansion takes, about
NULL_ID = -(1 << 63)

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTE_HASH = (np.arange(1, 257, dtype=np.uint64) * _MIX) ^ ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(23))
PLACE = np.dtype([("doc", "<i8"), ("digest", "<i8"), ("start", "<i8")])


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc (rank of the document), digest and text. The digest is 0 unless some id is repeated, which only ids are read for."""
    short_batches(docs.sparkSession)
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc")
    repeated = docs.groupBy(doc).count().where("count > 1").limit(1).count()
    digest = text_digest(F.col(text_col)) if repeated else F.lit(0).cast("long")
    return docs.select(doc, digest.alias("digest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of each run of `gram` bytes (a power of two)."""
    value, factor, size = _BYTE_HASH[raw], 0x9E3779B97F4A7C15, 1
    while size < gram:
        value = value[:-size] * np.uint64(factor) + value[size:]
        factor, size = (factor * factor * 5 + 2) % (1 << 64) | 1, size * 2
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    return value


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segment_fragments(raw: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: anchor hash, first window, number of windows and anchor position of every fragment."""
    if len(raw) < window:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    hashes = gram_hashes(raw, gram)
    low = np.uint64((1 << 24) - 1)
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)  # ties: the leftmost
    anchor = (sliding_min(ranked, window - gram + 1) & low).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, np.int8)  # windows that end inside their text
    counts = np.maximum(0, np.diff(ends) - window + 1)
    starts = ends[:-1]
    some = counts > 0
    np.add.at(valid, starts[some], 1)
    np.add.at(valid, starts[some] + counts[some], -1)
    inside = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(inside):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    at = anchor[inside]
    opens = np.zeros(len(valid), bool)  # first windows of texts
    opens[starts[some]] = True
    first = np.concatenate(([True], (at[1:] != at[:-1]) | opens[inside[1:]]))
    begin = np.flatnonzero(first)
    number = np.diff(np.concatenate((begin, [len(inside)])))
    return hashes[at[begin]], inside[begin], number, at[begin]


def _fragments(batches: Iterator[pa.RecordBatch], window: int, gram: int, most: int) -> Iterator[pa.RecordBatch]:
    """Per stretch of a task: the earliest occurrence of each fragment (later false) and runs of windows of later ones."""
    held: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        anchor, digest_of, doc, digest, start, number = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((start, digest, doc, digest_of, anchor))
        anchor, digest_of, doc, digest, start, number = (c[order] for c in (anchor, digest_of, doc, digest, start, number))
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (digest_of[1:] != digest_of[:-1])))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = (doc != doc[head]) | (digest != digest[head]) | (start != start[head])
        # runs of removed windows of one document travel as one row, dealt out by the document
        gone = merged(doc[later], digest[later], start[later], number[later])
        keep = new
        zero = np.zeros(len(gone[0]), np.int64)
        deal = np.concatenate((anchor[keep].view(np.int64), gone[0] * np.int64(0x9E3779B1) ^ gone[2]))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (deal, np.concatenate((digest_of[keep].view(np.int64), zero)), *(np.concatenate((a[keep], b)) for a, b in zip((doc, digest, start, number), gone)))]
            + [pa.array(np.concatenate((np.zeros(keep.sum(), bool), np.ones(len(zero), bool))))],
            ["anchor", "fragment", "doc", "digest", "start", "number", "later"],
        )

    for batch in cut(batches, "text", SEGMENT):
        raw, ends = byte_view(batch.column(2))
        docs, digests = (batch.column(i).to_numpy() for i in (0, 1))
        # a text longer than a segment goes in pieces that share window - 1 bytes
        pieces = [(0, len(raw), ends)] if len(raw) <= 2 * SEGMENT else [(a, min(a + SEGMENT + window - 1, len(raw)), None) for a in range(0, max(1, len(raw) - window + 1), SEGMENT)]
        for a, b, own in pieces:
            part = raw[a:b]
            own = np.array([0, b - a]) if own is None else own
            anchor, first, number, _ = segment_fragments(part, own, window, gram)
            if not len(first):
                continue
            joined, hash_of = part.tobytes(), xxhash.xxh3_64_intdigest
            digest_of = np.fromiter((hash_of(joined[x:y]) for x, y in zip(first.tolist(), (first + number + window - 1).tolist())), np.uint64, len(first))
            row = np.searchsorted(own, first, "right") - 1
            held.append((anchor, digest_of, docs[row], digests[row], first - own[row] + a, number))
            size += len(first)
            if size >= most:
                yield flush()
                held.clear()
                size = 0
    if size:
        yield flush()


def merged(doc: np.ndarray, digest: np.ndarray, start: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts that touch or overlap, as (doc, digest, start, number)."""
    if not len(doc):
        return doc, digest, start, number
    order = np.lexsort((start, digest, doc))
    doc, digest, start, stop = doc[order], digest[order], start[order], (start + number)[order]
    other = np.concatenate(([True], (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])))
    group = np.cumsum(other)
    reach = np.maximum.accumulate(stop + group * (1 << 42)) - group * (1 << 42)
    begin = np.flatnonzero(np.concatenate(([True], other[1:] | (start[1:] > reach[:-1]))))
    return doc[begin], digest[begin], start[begin], reach[np.concatenate((begin[1:], [len(doc)])) - 1] - start[begin]


_FOUND = "kind int, anchor long, doc long, digest long, start long, number long"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, fragment, place -> removed runs (kind 0) and earliest fragments of anchors with several (kind 1)."""
    names = [c.split()[0] for c in _FOUND.split(", ")]
    carry: list[np.ndarray] | None = None  # the earliest place of the last fragment
    sent = False  # whether that anchor is known to have several fragments

    def emit(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int32)), *map(pa.array, columns)], names)

    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(6)]
        gone = batch.column(6).to_numpy(zero_copy_only=False)
        if gone.any():
            yield emit(0, [columns[2][gone] * 0, *(c[gone] for c in columns[2:])])
            columns = [c[~gone] for c in columns]
        if not len(columns[0]):
            continue
        if carry is not None:
            columns = [np.concatenate(pair) for pair in zip(carry, columns)]
        anchor, fragment, doc, digest, start, number = columns
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate(([True], fragment[1:] != fragment[:-1]))
        heads = np.flatnonzero(new)
        head = heads[np.cumsum(new) - 1]
        later = (doc != doc[head]) | (digest != digest[head]) | (start != start[head])
        found = merged(doc[later], digest[later], start[later], number[later])
        yield emit(0, [found[0] * 0, *found])
        group = np.cumsum(new_anchor) - 1
        several = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_anchor)) > 1
        if sent:
            several[0] = True
        fresh = new & several[group]
        if sent:
            fresh[0] = False
        yield emit(1, [c[fresh] for c in (anchor, doc, digest, start, number)])
        carry, sent = [c[heads[-1] : heads[-1] + 1] for c in columns], bool(several[-1])


def common_prefixes(text: np.ndarray, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rotations of `text` by their first `stop` symbols, and the common prefix of each with the one before it.

    Values of `stop` and more are left at -1. Symbols are small integers.
    """
    n = len(text)
    width = int(text.max()) + 1
    rank, size = text.astype(np.int64), 1
    power = max(1, int(62 / max(1.0, np.log2(width + 1))))
    for k in range(1, min(power, stop)):
        rank = rank * width + np.roll(text, -k)
        size += 1
    rank = np.unique(rank, return_inverse=True)[1]
    while size < stop:
        step = min(size, stop - size)
        rank = np.unique(rank * np.int64(n) + np.roll(rank, -step), return_inverse=True)[1]
        size += step
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    back = place[order - 1]  # where the rotation that starts one symbol earlier stands
    transform = text[order - 1].astype(np.int64)
    prefix = np.full(n + 1, -1, np.int64)
    prefix[0] = prefix[n] = 0
    low, high = np.array([0]), np.array([n])
    for length in range(stop):
        at = ranges(low, high)
        owner = np.repeat(np.arange(len(low)), high - low)
        to = back[at]
        by = np.argsort(to)
        to, name = to[by], (owner * width + transform[at])[by]
        edge = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
        low, high = to[edge], to[np.concatenate((edge[1:], [len(to)])) - 1] + 1
        fresh = prefix[high] < 0
        prefix[high[fresh]] = length
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
    return order, prefix[:n]


def repeated_windows(fragments: list[bytes], rank: np.ndarray, window: int) -> list[np.ndarray]:
    """Per fragment the offsets of windows that also occur in a fragment of a lower rank."""
    text = np.frombuffer(b"".join(b"\0" + f for f in fragments), np.uint8).astype(np.int64) + 1
    lengths = np.fromiter(map(len, fragments), np.int64, len(fragments))
    starts = np.cumsum(lengths + 1) - lengths
    text[starts - 1] = 0
    symbols, text = np.unique(text, return_inverse=True)
    order, prefix = common_prefixes(text, window)
    run = np.cumsum(prefix >= 0) - 1
    owner = np.full(len(text), -1, np.int64)
    for_window = ranges(starts, np.maximum(starts, starts + lengths - window + 1))
    owner[for_window] = np.searchsorted(starts, for_window, "right") - 1
    of = owner[order]
    real = of >= 0
    run, of, at = run[real], of[real], order[real]
    if not len(run):
        return [np.zeros(0, np.int64)] * len(fragments)
    edge = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    least = np.minimum.reduceat(rank[of], edge)
    later = rank[of] > np.repeat(least, np.diff(np.concatenate((edge, [len(run)]))))
    of, at = of[later], at[later]
    by = np.lexsort((at, of))
    of, at = of[by], at[by] - starts[of[by]]
    return np.split(at, np.searchsorted(of, np.arange(1, len(fragments))))


def _expand(batches: Iterator[pa.RecordBatch], window: int, most: int) -> Iterator[pa.RecordBatch]:
    """Fragments sorted by anchor -> runs of windows that occur earlier; whole anchors go through one transform together."""
    names = ["doc", "digest", "start", "number"]
    rows: list[tuple] = []

    def work(part):
        place = np.array([(r[1], r[2], r[3]) for r in part], PLACE)
        # a window's rank within its class is that of its fragment: offsets to the anchor are equal
        rank = np.empty(len(part), np.int64)
        rank[np.argsort(place, order=("doc", "digest", "start"), kind="stable")] = np.arange(len(part))
        out = [[], [], [], []]
        for row, offsets in zip(part, repeated_windows([r[4] for r in part], rank, window)):
            if len(offsets):
                start, number = runs(offsets)
                for column, value in zip(out, (np.full(len(start), row[1]), np.full(len(start), row[2]), start + row[3], number)):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], names)

    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if size >= most and row[0] != rows[-1][0]:
                yield work(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield work(rows)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1] + 1)))
    return sorted_values[edge], np.diff(np.concatenate((edge, [len(sorted_values)])))


def _slices(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted fragments of each text."""
    for batch in cut(batches, "text"):
        raw, ends = byte_view(batch.column(2))
        raw = raw.tobytes()
        out = [[], [], [], [], []]
        for row, (doc, digest, wanted) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)))):
            for piece in wanted:
                a = int(ends[row]) + piece["start"]
                for column, value in zip(out, (piece["anchor"], doc, digest, piece["start"], raw[a : a + piece["number"] + window - 1])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], ["anchor", "doc", "digest", "start", "bytes"])


_PARTS = "anchor long, fragment long, doc long, digest long, start long, number long, bytes binary"


def _split(batches: Iterator[pa.RecordBatch], window: int, gram: int, block: int) -> Iterator[pa.RecordBatch]:
    """Parts of fragments with the anchor at `block` neighbouring places of the window, named by the bytes these windows share.

    The shared bytes lie in each window at these places, so equal windows go to equal names.
    """
    names, top = [c.split()[0] for c in _PARTS.split(", ")], (1 << 64) - 1
    for batch in batches:
        keys, fragments, *rest = out = [[] for _ in names]
        for anchor, doc, digest, start, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
            number = len(data) - window + 1
            at = int((gram_hashes(np.frombuffer(data[:window], np.uint8), gram) >> np.uint64(24)).argmin())  # as in segment_fragments
            for k in range((at - number + 1) // block, at // block + 1):
                near, far = at - k * block, at - (k + 1) * block + 1  # latest and earliest window
                first, last = max(0, far), min(number - 1, near)
                part = data[first : last + window]
                keys.append(xxhash.xxh3_64_intdigest(data[near : far + window], (anchor * 131 + k * block) & top))
                fragments.append(xxhash.xxh3_64_intdigest(part))
                for column, value in zip(rest, (doc, digest, start + first, last - first + 1, part)):
                    column.append(value)
        hashes = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[:2]]
        yield pa.RecordBatch.from_arrays([*hashes, *(pa.array(c, pa.int64()) for c in out[2:6]), pa.array(out[6], pa.binary())], names)


def removed_windows(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, hot_fragments: int = HOT_FRAGMENTS) -> DataFrame:
    """(doc, digest, start, number): runs of windows that also start earlier. `rows` as `keyed` makes them."""
    schema = "anchor long, fragment long, doc long, digest long, start long, number long, later boolean"
    found = rows.mapInArrow(partial(_fragments, window=window, gram=gram, most=TASK_FRAGMENTS), schema)
    sorted_rows = found.repartition("anchor").sortWithinPartitions("anchor", "fragment", "doc", "digest", "start")
    compared = materialize(sorted_rows.mapInArrow(_compare, _FOUND), "suffix-compared")
    runs_schema = "doc long, digest long, start long, number long"
    removed = compared.where("kind = 0").select("doc", "digest", "start", "number")
    wanted = compared.where("kind = 1").groupBy("doc", "digest").agg(F.collect_list(F.struct("anchor", "start", "number")).alias("wanted"))
    texts = rows.join(wanted, ["doc", "digest"]).select("doc", "digest", "text", "wanted")
    # rows that repeat id and text bring the same fragment twice
    pieces = texts.mapInArrow(partial(_slices, window=window), "anchor long, doc long, digest long, start long, bytes binary")
    pieces = materialize(pieces, "suffix-pieces")
    hot = compared.where("kind = 1").groupBy("anchor").count().where(F.col("count") > hot_fragments).select("anchor")
    calm = pieces
    if some_hot := hot.limit(1).count():
        calm = pieces.join(hot, "anchor", "left_anti")
    for block in SPLITS:
        if not some_hot:
            break
        cut_up = partial(_split, window=window, gram=gram, block=block)
        parts = materialize(pieces.join(hot, "anchor", "left_semi").select("anchor", "doc", "digest", "start", "bytes").mapInArrow(cut_up, _PARTS), "suffix-parts")
        first = parts.groupBy("anchor", "fragment").agg(F.min(F.struct("doc", "digest", "start", "bytes")).alias("first"))
        first = materialize(first.select("anchor", "fragment", "first.*"), "suffix-first")
        place = F.struct(*(first[c].alias(c) for c in ("doc", "digest", "start")))
        later = parts.join(first.select("anchor", "fragment", place.alias("first")), ["anchor", "fragment"]).where(F.struct("doc", "digest", "start") > F.col("first"))
        removed = removed.unionByName(later.select("doc", "digest", "start", "number"))
        counts = materialize(first.groupBy("anchor").count().where("count > 1"), "suffix-counts")
        pieces = first.drop("fragment")
        hot = counts.where(F.col("count") > (hot_fragments if block > 1 else (1 << 62))).select("anchor")
        calm = calm.unionByName(pieces.join(counts.join(hot, "anchor", "left_anti"), "anchor", "left_semi"))
        some_hot = hot.limit(1).count()
    # expansion is bound by CPU, so tasks are dealt by bytes and not merged again
    size = calm.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    expanded = calm.repartition(max(1, -(-size // EXPAND_BYTES)), "anchor").sortWithinPartitions("anchor", "doc", "digest", "start").mapInArrow(partial(_expand, window=window, most=CHUNK_BYTES), runs_schema)
    return removed.unionByName(expanded)


def _spans(starts: list[int], numbers: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal byte spans under the given runs of windows."""
    out: list[list[int]] = []
    for start, number in sorted(zip(starts, numbers)):
        stop = start + number + window - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def with_spans(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """Each text with the runs of its removed windows (null: none)."""
    return rows.join(removed.groupBy("doc", "digest").agg(F.collect_list("start").alias("starts"), F.collect_list("number").alias("numbers")), ["doc", "digest"], "left")


def _digests(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in cut(batches, "text"):
        raw, ends = byte_view(batch.column(1))
        raw, ends = raw.tobytes(), ends.tolist()
        columns = [[], [], [], []]
        for row, (starts, numbers) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            text = raw[ends[row] : ends[row + 1]]
            spans = _spans(starts or [], numbers or [], window)
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            for column, value in zip(columns, (len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest())):
                column.append(value)
        ids = batch.column(0)
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names)


def cut_text(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left when every character that lies in the spans as a whole goes (UTF-8)."""
    kept, at = [], 0
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:  # the span begins inside a character
            a += 1
        if b < len(text):
            while b > a and text[b] & 0xC0 == 0x80:  # it ends inside one
                b -= 1
        if a < b:
            kept.append(text[at:a])
            at = b
    kept.append(text[at:])
    return b"".join(kept)


def _texts(batches: Iterator[pa.RecordBatch], window: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    where = names.index("text")
    for batch in batches:
        raw, ends = byte_view(batch.column(where))
        raw, ends = raw.tobytes(), ends.tolist()
        starts, numbers = (batch.column(len(names) + i).to_pylist() for i in (0, 1))
        given = batch.column(where).is_null().to_pylist()
        out = [None if given[i] else cut_text(raw[ends[i] : ends[i + 1]], _spans(starts[i] or [], numbers[i] or [], window)) for i in range(batch.num_rows)]
        columns = list(batch.columns[: len(names)])
        columns[where] = pa.array(out, pa.binary()).cast(columns[where].type)
        yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without their repeated bytes; whole characters only, all columns kept."""
    removed = removed_windows(keyed(docs), window)
    of, own, starts, numbers = free_names(docs, "__doc", "__digest", "__starts", "__numbers")
    runs_of = removed.groupBy(F.col("doc").alias(of), F.col("digest").alias(own)).agg(F.collect_list("start").alias(starts), F.collect_list("number").alias(numbers))
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    digest = F.when(F.col(own) == 0, F.lit(0).cast("long")).otherwise(text_digest(docs["text"]))
    joined = docs.join(runs_of, (doc == F.col(of)) & (digest == F.col(own)), "left").select(*(docs[c] for c in docs.columns), starts, numbers)
    return joined.mapInArrow(partial(_texts, window=window, names=docs.columns), docs.schema)


@query("op9_bwt_interval_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = keyed(docs)
    spans = with_spans(rows, removed_windows(rows))
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return spans.select(doc_id, "text", "starts", "numbers").mapInArrow(partial(_digests, window=WINDOW), schema)
