"""Encoding and decoding with the merge-type vocabulary of a sentencepiece model.

A text becomes one symbol per character. All adjacent pairs whose union is a piece stand on an agenda ordered by the score of
that piece, then from left to right; the first one is merged, its new neighbours join the agenda, and entries whose symbols
have changed meanwhile are passed over. What is no piece at the end falls back to its UTF-8 bytes.

A merge can only happen where some piece holds both characters side by side. The vocabulary is searched for places where that
never happens (before a space mark, beside characters that occur in no longer piece), and chunks between such places are
encoded on their own, once per task: the ids are those of the whole text, and one long text costs no more than its chunks.

With `check` the library encodes every chunk that is new to a task, Arrow batch by Arrow batch; `agrees` says whether it found
the same ids for all chunks of a text and the decoded text is the text (space marks read as spaces).

Defined cases: null text counts as empty and has the end id alone; null ids and repeated rows are encoded like other rows;
empty tables return no rows; other columns are not read. Bytes that are no UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, table
from .registry import query

SPACE = "▁"
LONE = "\n"
SHORT = 7

codecs.register_error("each_byte", lambda error: ("�", error.start + 1))


class MergePieces:
    """The vocabulary, its agenda, and the ids of chunks met so far, up to `most` beside those of one batch."""

    def __init__(self, path: str, most: int = 600_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds, how = type(model.pieces[0]) if model.pieces else None, model.normalizer_spec
        plain = how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces and not how.precompiled_charsmap
        if kinds is None or model.trainer_spec.model_type != model.trainer_spec.BPE or not plain or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("needs merge-type pieces with byte fallback, a leading space mark and no normalisation")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end, self.unknown = model.trainer_spec.eos_id, model.trainer_spec.unk_id
        self.ids: dict[str, int] = {}
        self.byte_ids, self.surface = [0] * 256, [""] * len(model.pieces)
        self.byte_of: dict[int, int] = {}
        for i, piece in enumerate(model.pieces):
            if piece.type == kinds.NORMAL:
                self.ids[piece.piece] = i
                self.surface[i] = piece.piece.replace(SPACE, " ")
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            elif piece.type == kinds.UNKNOWN:
                self.surface[i] = model.trainer_spec.unk_surface
        # pieces of equal score have one turn
        places = {score: place for place, score in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.turn = {piece: places[model.pieces[i].score] << 48 for piece, i in self.ids.items()}
        self.chunk = re.compile(self._chunks([p for p in self.ids if len(p) > 1]))
        if not self.chunk.fullmatch(LONE):
            raise ValueError("the character that sets chunks apart must not occur in longer pieces")
        self.most, self.known, self.wrong = most, {}, set()
        self.packed = [struct.Struct(f"<{n}i").pack for n in range(40)]

    @staticmethod
    def _chunks(longer: list[str]) -> str:
        """A pattern that cuts at places where no piece reaches across; a space stands for its mark."""
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("a piece holds a space mark after another character, so no text can be cut into chunks")
        joined = set("".join(longer))
        lone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined and c != 32)
        # Latin letters that stand in pieces only beside one another or behind the mark
        letters = {c for c in joined if c.isalpha() and ord(c) < 0x250}
        pairs = {pair for p in longer for pair in zip(p.lstrip(SPACE), p.lstrip(SPACE)[1:])}
        while mixed := {x for a, b in pairs for x, y in ((a, b), (b, a)) if x in letters and y not in letters}:
            letters -= mixed
        letter = "".join(sorted(letters))
        return "|".join([*([f" *[{letter}]+"] if letter else []), rf" *[^ {lone}{letter}]+", " +", *([rf"[{lone}]"] if lone else [])])

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk, by the agenda."""
        symbols = list(chunk.replace(" ", SPACE))
        size, turn_of, push, pop = len(symbols), self.turn.get, heapq.heappush, heapq.heappop
        # one number per entry: turn of the piece, place of its left symbol, length of the piece
        agenda = [turn + (i << 16) + 2 for i, turn in enumerate(map(turn_of, map(str.__add__, symbols, symbols[1:]))) if turn is not None]
        if agenda:
            heapq.heapify(agenda)
            before, after = list(range(-1, size - 1)), list(range(1, size + 1))
            while agenda:
                entry = pop(agenda)
                left, length = entry >> 16 & 0xFFFFFFFF, entry & 0xFFFF
                own, right = symbols[left], after[left]
                # symbols only grow: with one of them merged meanwhile, the pair is longer or gone
                if not own or right >= size or len(own) + len(symbols[right]) != length:
                    continue
                symbols[left] = own = own + symbols[right]
                symbols[right] = ""
                following = after[left] = after[right]
                if following < size:
                    before[following] = left
                    turn = turn_of(own + symbols[following])
                    if turn is not None:
                        push(agenda, turn + (left << 16) + length + len(symbols[following]))
                first = before[left]
                if first >= 0:
                    turn = turn_of(symbols[first] + own)
                    if turn is not None:
                        push(agenda, turn + (first << 16) + length + len(symbols[first]))
        out = [self.ids.get(symbol) for symbol in symbols if symbol]
        if None not in out:
            return out
        out = []
        for symbol in filter(None, symbols):
            known = self.ids.get(symbol)
            out += [known] if known is not None else [self.byte_ids[b] for b in symbol.encode("utf-8", "replace")]
        return out

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids, the end id last."""
        return self.encode_batch([text])[0][0]

    def encode_batch(self, texts: list[str], check: bool = False) -> list[tuple[bytes, str, bool | None]]:
        """Ids as bytes, the text they give, and whether the library agrees (None unless asked), for every text."""
        split = [self.chunk.findall(" " + text.replace(SPACE, " ")) if text else [] for text in texts]
        known = self.known
        unknown = {c for chunks in split for c in chunks if c not in known}
        if unknown:
            self._learn(list(unknown), check)
        end = self.end.to_bytes(4, "little")
        out = []
        for text, chunks in zip(texts, split):
            found = list(map(known.__getitem__, chunks))
            back = "".join([f[1] for f in found])[1:]
            agrees = (back == text.replace(SPACE, " ") and (not self.wrong or self.wrong.isdisjoint(chunks))) if check else None
            out.append((b"".join([f[0] for f in found]) + end, back, agrees))
        if len(known) > self.most:  # short chunks are the ones that come again
            self.known = {c: f for c, f in known.items() if len(c) <= SHORT}
            if len(self.known) > self.most // 2:
                self.known = {}
        return out

    def _learn(self, chunks: list[str], check: bool) -> None:
        """Ids and text of new chunks; the library encodes each behind a character that merges with nothing."""
        rows = [self.merge(c) for c in chunks]
        for chunk, ids in zip(chunks, rows):
            self.known[chunk] = (self.packed[len(ids)](*ids) if len(ids) < len(self.packed) else np.array(ids, "<i4").tobytes(), self._surface(ids))
        if check:
            head = self.library.encode(LONE)
            self.wrong.update(c for c, ids, theirs in zip(chunks, rows, self.library.encode([LONE + c for c in chunks], num_threads=1)) if theirs != head + ids)

    def _surface(self, ids: list[int]) -> str:
        byte_of, surface = self.byte_of, self.surface
        if byte_of.keys().isdisjoint(ids):
            return "".join([surface[i] for i in ids])
        parts: list[str] = []
        run = bytearray()
        for i in ids:
            value = byte_of.get(i)
            if value is not None:
                run.append(value)
                continue
            if run:
                parts.append(run.decode("utf-8", "each_byte"))
                run.clear()
            parts.append(surface[i])
        parts.append(run.decode("utf-8", "each_byte"))
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: runs of byte pieces are read as UTF-8, each wrong byte is U+FFFD; the leading space goes."""
        text = self._surface(ids)
        first = next((i for i in ids if self.surface[i] or i in self.byte_of), None)
        return text[1:] if first is not None and first != self.unknown and self.surface[first].startswith(" ") else text


_KNOWN: dict[str, MergePieces] = {}


def pieces_of(path: str) -> MergePieces:
    """One vocabulary per Python worker."""
    return _KNOWN.get(path) or _KNOWN.setdefault(path, MergePieces(path))


def _encode_rows(batches: Iterator[pa.RecordBatch], model: str, check: bool) -> Iterator[pa.RecordBatch]:
    pieces = pieces_of(model)
    for batch in cut(batches, "text"):
        texts = [t.decode("utf-8", "replace") for t in batch.column(1).cast(pa.binary()).to_pylist()]
        found, decoded, same = zip(*pieces.encode_batch(texts, check))
        ends = np.concatenate(([0], np.cumsum([len(raw) // 4 for raw in found]))).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(decoded, pa.string()), pa.array(same, pa.bool_())], ["doc_id", "ids", "decoded", "agrees"])


def encode_pieces(docs: DataFrame, model: str, check: bool = True) -> DataFrame:
    """doc_id, ids (the end id last), decoded (the text these ids give), agrees (null without `check`)."""
    return documents(docs).mapInArrow(partial(_encode_rows, model=model, check=check), "doc_id long, ids array<int>, decoded string, agrees boolean")


def _decode_rows(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    pieces = pieces_of(model)
    for batch in batches:
        texts = [None if ids is None else pieces.decode([i for i in ids if i is not None]) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode_pieces(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of any rows of ids; null ids within a row are passed over, a null row stays null."""
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(partial(_decode_rows, model=model), "doc_id long, text string")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op13_piece_agenda")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_pieces(table(spark, sf_dir, "documents"), model_path())
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees"
    )
