"""Hierarchical multi-length packing of tokenised documents.

Each document's ids (and the closing id) are cut into full windows of the longest tier first. What is left of it is routed
to the smallest tier that holds it, and every tier is packed in windows of its own length, from the longest tier down: a window
opens with the largest remainder of its tier, its gap takes the largest remainders of shorter tiers that still fit, and the last
gap is closed by cutting one more. Short documents that no long window needed fill short windows. All windows are powers of two,
so none is padded. Sequences are dealt to step groups, the largest first and always to the group with the fewest ids, so groups
hold nearly as many ids each, in mixed tiers.

Every partition packs its own rows in stretches of `pool_ids` ids, so nothing is shuffled and memory is bounded; the
remainder of a stretch that fills no window is cut at powers of two, so no sequence has padding. Which documents share a
sequence depends on how the input is split into partitions; a lost task repeats its partition's rows.

Defined cases: null text counts as empty, so the document holds only the closing id; null ids and repeated rows are packed
like other rows; empty tables return no rows.
"""

from __future__ import annotations

import heapq
import os
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import byte_view, cut, documents, ranges, table
from .registry import query

TIERS = (512, 1024, 2048, 4096)
CLOSING_ID = 2
POOL_IDS = 1 << 21
STEP_IDS = 1 << 17
WHITE = b" \t\n\r\x0b\x0c"
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks but the apostrophe, which starts tokens of its own
#: White space 1, marks 20, ASCII letters 30, all else 0: only a letter beside a mark adds up to 50.
KINDS = np.array([1 if b in WHITE else 20 if b in MARKS else 30 if chr(b).isalpha() and b < 128 else 0 for b in range(256)], np.int8)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long, step_group long"


class PieceIds:
    """Ids of white-space-free chunks as little-endian bytes, kept for the most recent ones.

    The tokenizer drops white space before anything else, so ids of a text are those of its chunks one after another.
    """

    def __init__(self, path: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.new, self.old = Tokenizer.from_file(path), most, {}, {}
        self.merges = self.tokenizer.model
        self.packed = [struct.Struct(f"<{n}I").pack for n in range(64)]

    def learn(self, chunks: list[bytes], at_once: int = 2000) -> None:
        for k in range(0, len(chunks), at_once):
            part = chunks[k : k + at_once]
            texts = [c.decode("utf-8", "replace") for c in part]
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
            encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            owner = np.searchsorted(starts, np.array([a for a, _ in encoded.offsets], np.int64), "right") - 1
            at = np.searchsorted(owner, np.arange(len(part) + 1)).tolist()
            raw = ids.tobytes()
            for i, chunk in enumerate(part):
                self.new[chunk] = raw[4 * at[i] : 4 * at[i + 1]]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        ends = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        return self.slice(b"".join(texts), ends)

    def slice(self, raw: bytes, ends: np.ndarray) -> list[bytes]:
        """Ids of each text; a chunk is looked up once, however often it stands in the slice."""
        # the tokenizer lowers all letters; only the names of its special ids keep their case
        special = b"<|" in raw
        if special:
            at = ends.tolist()
            raw = b"".join([t if b"<|" in t else t.lower() for t in (raw[i:j] for i, j in zip(at, at[1:]))])
        else:
            raw = raw.lower()
        kind = KINDS[np.frombuffer(raw, np.uint8)]
        blank = kind == 1
        first = ~blank
        first[1:] &= blank[:-1]
        if not special:  # letters and marks never share a token
            first[1:] |= kind[1:] + kind[:-1] == 50
        heads = ends[:-1][ends[:-1] < len(raw)]
        first[heads] = ~blank[heads]  # chunks never cross texts
        starts = np.flatnonzero(first)
        if not len(starts):
            return [b""] * (len(ends) - 1)
        # a value is a chunk with the white space behind it
        offsets = np.append(starts, len(raw)).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
        coded = column.dictionary_encode()
        chunks = [c.rstrip(WHITE) for c in coded.dictionary.to_pylist()]
        found = list(map(self.new.get, chunks))
        missing = {c for c, ids in zip(chunks, found) if ids is None}
        if missing:
            self.fetch(missing)
            found = list(map(self.new.__getitem__, chunks))
        sizes = np.array(list(map(len, found)), np.int64) // 4
        stops = np.cumsum(sizes)
        which = coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(found), "<u4")[ranges((stops - sizes)[which], stops[which])]
        # places of the texts' first chunks, and of their first ids
        cuts = np.concatenate(([0], np.cumsum(sizes[which])))[np.searchsorted(starts, ends)].tolist()
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        return [ids[i:j].tobytes() for i, j in zip(cuts, cuts[1:])]

    def fetch(self, chunks: set[bytes]) -> None:
        """Ids of new chunks: known before, one word, or learnt."""
        new, others = self.new, []
        for chunk in chunks:
            known = self.old.get(chunk) or self.word(chunk)
            if known is None:
                others.append(chunk)
            else:
                new[chunk] = known
        self.learn(others)

    def word(self, chunk: bytes) -> bytes | None:
        """Ids of a chunk of small ASCII letters, which is one word as it stands: nothing to normalise, nothing to split."""
        if len(chunk) < len(self.packed) and chunk.isalpha() and chunk.islower():
            ids = [token.id for token in self.merges.tokenize(chunk.decode())]
            return self.packed[len(ids)](*ids)
        return None


_KNOWN: dict[str, PieceIds] = {}


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) over documents of the given lengths.

    All but the last few are full windows of a tier; what fills none at the end is cut at powers of two.
    """
    most = tiers[-1]
    sequences = []
    shelves: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}
    for doc, length in enumerate(lengths):
        full = length - length % most
        sequences += [[(doc, at, most)] for at in range(0, full, most)]
        if rest := length - full:
            shelves[next(t for t in tiers if t >= rest)].append((doc, full, rest))
    for shelf in shelves.values():
        shelf.sort(key=lambda piece: (piece[2], -piece[0]))  # the longest at the end
    order = tiers[::-1]
    while (tier := next((t for t in order if shelves[t]), None)) is not None:
        window, gap = [shelves[tier].pop()], tier
        gap -= window[0][2]
        for shorter in order:
            shelf = shelves[shorter]
            while gap and shelf:
                low, high = 0, len(shelf)  # the largest piece that fits
                while low < high:
                    middle = (low + high) // 2
                    low, high = (middle + 1, high) if shelf[middle][2] <= gap else (low, middle)
                if not low:
                    break
                window.append(shelf.pop(low - 1))
                gap -= window[-1][2]
        if gap and (donor := next((t for t in order[::-1] if shelves[t]), None)) is not None:
            doc, at, length = shelves[donor].pop()  # longer than the gap, or it would have been taken
            window.append((doc, at, gap))
            rest = (doc, at + gap, length - gap)
            shelf = shelves[next(t for t in tiers if t >= rest[2])]
            place = next((i for i, piece in enumerate(shelf) if piece[2] >= rest[2]), len(shelf))
            shelf.insert(place, rest)
            gap = 0
        if not gap:
            sequences.append(window)
            continue
        queue = window[::-1]
        held = tier - gap
        while held:  # nothing is left to fill with: powers of two need no padding
            size = 1 << (held.bit_length() - 1)
            taken, want = [], size
            while want:
                doc, at, length = queue.pop()
                use = min(want, length)
                taken.append((doc, at, use))
                if use < length:
                    queue.append((doc, at + use, length - use))
                want -= use
            sequences.append(taken)
            held -= size
    return sequences


def step_groups(sizes: list[int], groups: int) -> list[int]:
    """A group for each sequence: the largest first, always to the group with the fewest ids."""
    loads = [(0, g) for g in range(groups)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, group = loads[0]
        out[i] = group
        heapq.heapreplace(loads, (load + sizes[i], group))
    return out


def _pack_rows(batches: Iterator[pa.RecordBatch], tokenizer: str, tiers: tuple[int, ...], closing: int, pool_ids: int, step_ids: int) -> Iterator[pa.RecordBatch]:
    ids_of = _KNOWN.get(tokenizer) or _KNOWN.setdefault(tokenizer, PieceIds(tokenizer))
    end = np.array([closing], "<u4").tobytes()
    base = TaskContext.get().partitionId() << 32
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    number = groups = 0
    pool: list[tuple[int | None, bytes]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal number, groups
        sequences = pack([len(raw) // 4 for _, raw in pool], tiers)
        sizes = [sum(p[2] for p in s) for s in sequences]
        group_of = step_groups(sizes, max(1, -(-sum(sizes) // step_ids)))
        steps = max(group_of, default=0) + 1
        columns = [[] for _ in names]
        for i, sequence in enumerate(sequences):
            offset = 0
            tier = next((t for t in tiers if t >= sizes[i]), tiers[-1])
            for doc, start, length in sequence:
                doc_id, raw = pool[doc]
                crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                for column, value in zip(columns, (doc_id, start, length, crc, len(raw) // 4, base + number + i, offset, tier, base + groups + group_of[i])):
                    column.append(value)
                offset += length
        number += len(sequences)
        groups += steps
        pool.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in cut(batches, "text", 1 << 23):
        raw, ends = byte_view(batch.column(1))
        rows = ids_of.slice(raw.tobytes(), ends)
        for doc_id, ids in zip(batch.column(0).to_pylist(), rows):
            pool.append((doc_id, ids + end))
            held += len(ids) // 4 + 1
        if held >= pool_ids:
            yield flush()
            held = 0
    if pool:
        yield flush()


def pack_documents(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, closing: int = CLOSING_ID, pool_ids: int = POOL_IDS, step_ids: int = STEP_IDS) -> DataFrame:
    """One row per piece: which ids of which document stand where in which sequence, its tier and its step group.

    `tokenizer` is the path of a tokenizers file that drops white space before it cuts words.
    """
    rows = documents(docs).select("doc_id", "text")
    return rows.mapInArrow(partial(_pack_rows, tokenizer=tokenizer, tiers=tuple(sorted(tiers)), closing=closing, pool_ids=pool_ids, step_ids=step_ids), SCHEMA)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_pack_tiers")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
