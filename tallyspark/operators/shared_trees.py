"""Boosted regression trees of many settings, grown side by side: one pass over the rows for a level of every setting's tree.

The trees are those that ``GBTRegressor`` grows of the same rows, settings and seeds: it draws its rows and its split candidates
from a generator of its own for each partition, whose draws are repeated here (``drawn``, ``sampled``). Blocks of rows hold, for
each feature, the place of the value among the candidates of all settings; a pass adds up count, sum and sum of squares of the
residuals by node, feature and bin in the tasks, and a group per setting chooses the splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 1 << 15  # rows of a block
RUN = 64  # draws that one lane of the generator makes in turn
BITS = 1 << 53


# the generator -------------------------------------------------------------------------------------------------------


def _mixed(data: bytes, seed: int) -> int:
    """MurmurHash3 of bytes in fours, 32 bits."""
    m, h = 0xFFFFFFFF, seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & m
        h ^= (k << 15 | k >> 17) * 0x1B873593 & m
        h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


@cache
def first_state(seed: int) -> int:
    """The state in which a seed starts the generator behind ``rand(seed)``."""
    data = (seed & (1 << 64) - 1).to_bytes(8, "big")
    low = _mixed(data, 0x3C074A61)
    return _mixed(data, low) << 32 | low


def _next(s: np.ndarray) -> np.ndarray:
    s = s ^ s << np.uint64(21)
    s ^= s >> np.uint64(35)
    s ^= s << np.uint64(4)
    return s


def _times(columns: np.ndarray, s: np.ndarray) -> np.ndarray:
    """States after the steps that a matrix over bits stands for."""
    out = np.zeros_like(s)
    for bit in range(64):
        out ^= (s >> np.uint64(bit) & np.uint64(1)) * columns[bit]
    return out


@cache
def _steps(power: int) -> np.ndarray:
    """The matrix of 2 ** power steps."""
    if power == 0:
        return _next(np.uint64(1) << np.arange(64, dtype=np.uint64))
    half = _steps(power - 1)
    return _times(half, half)


def _ahead(s: np.ndarray, steps: int) -> np.ndarray:
    for power in range(steps.bit_length()):
        if steps >> power & 1:
            s = _times(_steps(power), s)
    return s


def _draws(seeds: Sequence[int], start: int, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each place in a run, the 53 bits of the draws at that place of all runs, by seed and run."""
    s = _ahead(np.array([first_state(x) for x in seeds], np.uint64)[:, None], 2 * start)
    while s.shape[1] * RUN < n:
        s = np.concatenate([s, _ahead(s, 2 * RUN * s.shape[1])], axis=1)
    s = np.ascontiguousarray(s[:, : -(-n // RUN)])
    for place in range(RUN):
        high = _next(s)
        s = _next(high)
        yield place, ((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (s & np.uint64((1 << 27) - 1))


def drawn(seeds: Sequence[int], rates: Sequence[float], start: int, n: int) -> np.ndarray:
    """For each seed, whether rand(seed) < rate for rows start to start + n of a partition."""
    limits = np.array([[math.ceil(r * BITS)] for r in rates], np.uint64)
    out = np.empty((len(seeds), -(-n // RUN), RUN), bool)
    for place, bits in _draws(seeds, start, n):
        out[:, :, place] = bits < limits
    return out.reshape(len(seeds), -1)[:, :n]


def uniforms(seed: int, n: int) -> np.ndarray:
    out = np.empty((1, -(-n // RUN), RUN))
    for place, bits in _draws([seed], 0, n):
        out[:, :, place] = bits * (1 / BITS)
    return out.reshape(-1)[:n]


def _java_long(seed: int, place: int) -> int:
    """The long number ``place`` of java.util.Random(seed)."""
    s, m = (seed ^ 0x5DEECE66D) & (1 << 48) - 1, (1 << 48) - 1
    for _ in range(place + 1):
        high = s = s * 0x5DEECE66D + 0xB & m
        s = s * 0x5DEECE66D + 0xB & m
    signed = [(x >> 16) - ((x >> 47) << 32) for x in (high, s)]
    return (signed[0] << 32) + signed[1]


@cache
def sampled(seed: int, part: int, size: int, fraction: float) -> np.ndarray:
    """Places of the rows of a partition that a sample of RDD rows takes, by gaps if the fraction is small."""
    if fraction >= 1:
        return np.arange(size)
    low = int(_next(np.array([first_state(seed)], np.uint64))[0]) & 0xFFFFFFFF
    own = _java_long(low - (low >> 31 << 32), part)
    if fraction > 0.4:
        return np.flatnonzero(uniforms(own, size) <= fraction)
    n = int(size * fraction + 10 * math.sqrt(size * fraction) + 50)
    gaps = (np.log(np.maximum(uniforms(own, n), 5e-11)) / math.log1p(-fraction)).astype(np.int64)
    places = np.cumsum(gaps + 1) - 1
    if places[-1] < size:
        raise RuntimeError("too few gaps drawn")
    return places[places < size]


# candidates ----------------------------------------------------------------------------------------------------------


def candidates(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most so many split values: midpoints at steps of equal count. Zeros count as what is missing to the expected size."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    counts, missing = counts.astype(float), expected - counts.sum()
    if not len(found):
        return found
    if missing > np.finfo(float).eps * len(values) * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, missing)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    stride, seen, chosen = expected / (most + 1), counts[0], []
    target = stride
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            chosen.append(middles[i - 1])
            target += stride
    return np.array(chosen)


# trees ---------------------------------------------------------------------------------------------------------------


class Tree(NamedTuple):
    """A tree in heap order: children of node i are 2 i + 1 and 2 i + 2. A row goes right if its code is above ``cut``."""

    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: np.ndarray  # the left child; the node itself if it is a leaf


def seedling(depth: int) -> Tree:
    n = 2 ** (depth + 1) - 1
    return Tree(depth, np.zeros(n, np.intp), np.full(n, np.iinfo(np.int32).max, np.int32), np.zeros(n), np.arange(n))


def nodes_of(tree: Tree, codes: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row after so many levels."""
    n = codes.shape[1]
    at, flat, rows, offsets = np.zeros(n, np.intp), codes.reshape(-1), np.arange(n), tree.feature * n
    for _ in range(levels):
        place = offsets.take(at, mode="clip")
        place += rows
        right = flat.take(place, mode="clip") > tree.cut.take(at, mode="clip")
        at = tree.base.take(at, mode="clip")
        at += right
    return at


def impurity(n, total, squares):
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (squares - total * total / n) / n)


def best_split(sums: np.ndarray, splits: Sequence[int], parent, least: int, gain: float) -> tuple | None:
    """The split of most gain of one node from (count, sum, squares) by feature and bin: gain, feature, split, left and right sums."""
    best = None
    for f, m in enumerate(splits):
        if not m:
            continue
        up = np.cumsum(sums[:, f, : m + 1], axis=1)
        left = up[:, :m]
        right = up[:, m:] - left
        if parent is None:
            parent = tuple(left[:, 0] + right[:, 0])
        both = left[0] + right[0]
        valid = (left[0] >= least) & (right[0] >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = impurity(*parent) - left[0] / both * impurity(*left) - right[0] / both * impurity(*right)
        gains = np.where(valid & ~(gains < gain), gains, -np.inf)
        j = int(np.argmax(gains))
        if best is None or gains[j] > best[0]:
            best = (float(gains[j]), f, j, tuple(map(float, left[:, j])), tuple(map(float, right[:, j])))
    return best if best and best[0] > 0 else None


# blocks --------------------------------------------------------------------------------------------------------------

BLOCKS = "part INT, held BOOLEAN, start LONG, n INT, codes BINARY, labels BINARY, scores BINARY, masks BINARY"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of a partition, held-out rows apart, in their order."""
    part, waiting, starts = TaskContext.get().partitionId(), {False: [], True: []}, {False: 0, True: 0}

    def block(held: bool) -> pa.RecordBatch:
        values, labels = (np.concatenate(x) for x in zip(*waiting[held]))
        waiting[held] = [(values[BLOCK:], labels[BLOCK:])] if len(labels) > BLOCK else []
        values, labels = values[:BLOCK], labels[:BLOCK]
        starts[held] += len(labels)
        row = [part, held, starts[held] - len(labels), len(labels), np.ascontiguousarray(values.T).tobytes(), labels.tobytes(), b"", b""]
        return _batch(BLOCKS, [row])

    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        if np.isnan(labels).any():
            raise ValueError("labels must not be null or NaN")
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(labels), -1)
        if not np.isfinite(values).all():
            raise ValueError("features must not be null, NaN or infinite")
        flags = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for held in (False, True):
            if (flags == held).any():
                waiting[held].append((values[flags == held], labels[flags == held]))
            while sum(len(x[1]) for x in waiting[held]) >= BLOCK:
                yield block(held)
    for held in (False, True):
        while waiting[held]:
            yield block(held)


TYPES = {"INT": pa.int32(), "LONG": pa.int64(), "BOOLEAN": pa.bool_(), "BINARY": pa.binary(), "DOUBLE": pa.float64()}


def _batch(schema: str, rows: Sequence[Sequence]) -> pa.RecordBatch:
    fields = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], TYPES[t]) for i, (_, t) in enumerate(fields)], names=[name for name, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _arrays(row: dict, code: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = row["n"]
    return np.frombuffer(row["codes"], code).reshape(-1, n), np.frombuffer(row["labels"]), np.frombuffer(row["scores"]).reshape(-1, n)


@contextmanager
def _passes(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside take one block a batch; their shuffles are small and planned in one go."""
    new = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    before = {name: spark.conf.get(name) for name in new}
    for name, value in new.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Trial(NamedTuple):
    """What a task needs to grow one setting's next tree."""

    trial: int
    settings: dict
    mask: int  # row of the block's masks
    place: int  # row of the block's scores
    past: list[Tree]  # trees not yet in the scores
    first: bool  # no tree before these
    tree: Tree
    nodes: dict[int, tuple | None]  # nodes to split, with the sums their parent gave them
    bins: list[np.ndarray]
    splits: list[int]


def _scored(scores: np.ndarray, place: int, trees: Sequence[Tree], first: bool, rate: float, codes: np.ndarray) -> np.ndarray:
    total = scores[place] if len(scores) else np.zeros(codes.shape[1])
    for i, tree in enumerate(trees):
        total = total + tree.value[nodes_of(tree, codes, tree.depth)] * (1.0 if first and i == 0 else rate)
    return total


SUMS = "trial INT, task INT, sums BINARY"


def _level(work: Sequence[Trial], level: int, code: str):
    """Count, sum and squares of the residuals by node, feature and bin for one level of each trial's tree."""

    def run(batches):
        totals, bins = {}, [[b.astype(np.intp) for b in w.bins] for w in work]
        for row in _rows(batches):
            codes, labels, scores = _arrays(row, code)
            n = row["n"]
            masks = np.frombuffer(row["masks"], np.uint8).reshape(-1, -(-n // 8))
            for i, w in enumerate(work):
                grown = not w.first or w.past
                target = 2.0 * (labels - _scored(scores, w.place, w.past, w.first, w.settings["stepSize"], codes)) if grown else labels
                slots = np.full(len(w.tree.base), -1, np.intp)
                slots[list(w.nodes)] = np.arange(len(w.nodes))
                slot, wide = slots.take(nodes_of(w.tree, codes, level), mode="clip"), max(w.splits) + 1
                chosen = np.flatnonzero(np.unpackbits(masks[w.mask], count=n).view(bool) & (slot >= 0))
                y, cell = target.take(chosen, mode="clip"), slot.take(chosen, mode="clip") * wide
                squares = y * y
                total = totals.setdefault(i, np.zeros((3, len(w.splits), len(w.nodes) * wide)))
                for f, to in enumerate(bins[i]):
                    at = to.take(codes[f].take(chosen, mode="clip"), mode="clip")
                    at += cell
                    for k, weights in enumerate((None, y, squares)):
                        total[k, f] += np.bincount(at, weights, len(w.nodes) * wide)
        for i, total in totals.items():
            yield _batch(SUMS, [(work[i].trial, TaskContext.get().partitionId(), total.tobytes())])

    return run


FOUND = "trial INT, node INT, feature INT, split INT, ln DOUBLE, ls DOUBLE, lq DOUBLE, rn DOUBLE, rs DOUBLE, rq DOUBLE, n DOUBLE, s DOUBLE"


def _choose(work: Sequence[Trial]):
    known = {w.trial: w._replace(past=[], bins=[]) for w in work}

    def run(sums: pd.DataFrame) -> pd.DataFrame:
        w = known[int(sums["trial"].iloc[0])]
        total = sum(np.frombuffer(x) for x in sums.sort_values("task")["sums"]).reshape(3, len(w.splits), len(w.nodes), -1)
        out = []
        for i, (node, parent) in enumerate(w.nodes.items()):
            own = total[:, :, i]
            best = best_split(own, w.splits, parent, w.settings["minInstancesPerNode"], w.settings["minInfoGain"])
            n, s = (parent or tuple(own[:, 0].sum(axis=1)))[:2]
            out.append((w.trial, node, best[1], best[2], *best[3], *best[4], n, s) if best else (w.trial, node, -1, -1, *[0.0] * 6, n, s))
        return pd.DataFrame(out, columns=[x.split(" ")[0] for x in FOUND.split(", ")])

    return run


class SharedTrees:
    """Trees of many settings over the same rows; ``grow`` adds trees to those asked for, ``errors`` scores them on the held-out rows."""

    def __init__(self, data: DataFrame, settings: Sequence[dict], seed: int, features: int):
        self.spark, self.settings, self.seed, self.features = data.sparkSession, settings, seed, features
        self.trees: dict[int, list[Tree]] = {t: [] for t in range(len(settings))}
        self.kept: list[int] = []  # trials whose scores the blocks hold
        self.scored = 0  # trees in these scores
        self.stale: DataFrame | None = None  # what the blocks with new draws are made from
        plain = data.where("_held_out IS NOT NULL").select(vector_to_array("features"), "label", "_held_out")
        raw = plain.mapInArrow(_pack, BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
        sizes = raw.where("NOT held").groupBy("part").agg(F.sum("n").alias("n")).collect()  # one row per task
        self.sizes = {r["part"]: int(r["n"]) for r in sizes}
        self.rows = sum(self.sizes.values())
        if not self.rows:
            raise ValueError("there are no rows to learn from")
        with _passes(self.spark):
            self._candidates(raw)
            # the draws of a row belong to the part it was read in, so its block may lie anywhere
            tasks = self.spark.sparkContext.defaultParallelism
            dealt = raw.repartition(tasks) if raw.count() > tasks else raw
            self.blocks = dealt.mapInArrow(self._encode(), BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
            self.blocks.count()
        raw.unpersist()
        self.held, self.train = self.blocks.where("held"), self.blocks.where("NOT held")

    def _candidates(self, raw: DataFrame) -> None:
        """Split candidates of every trial, and for every feature those of all trials in order."""
        rows, sizes, k = self.rows, self.sizes, self.features
        most = [min(s["maxBins"], rows) for s in self.settings]
        fractions = [min(1.0, max(m * m, 10000) / rows) for m in most]
        seeds = [self.seed + t for t in range(len(most))]

        def take(batches):
            for row in _rows(batches):
                values = np.frombuffer(row["codes"]).reshape(k, -1)
                for t, fraction in enumerate(fractions):
                    places = sampled(seeds[t], row["part"], sizes[row["part"]], fraction)
                    places = places[np.searchsorted(places, row["start"]) : np.searchsorted(places, row["start"] + row["n"])] - row["start"]
                    if len(places):
                        yield _batch("trial INT, sample BINARY", [(t, np.ascontiguousarray(values[:, places]).tobytes())])

        def cut(sample: pd.DataFrame) -> pd.DataFrame:
            t = int(sample["trial"].iloc[0])
            values = np.concatenate([np.frombuffer(x).reshape(k, -1) for x in sample["sample"]], axis=1)
            found = [candidates(v, fractions[t] * rows, most[t] - 1).tolist() for v in values]
            return pd.DataFrame({"trial": t, "feature": range(k), "found": found})

        # k lists of less than maxBins numbers a trial
        drawn_rows = raw.where("NOT held").mapInArrow(take, "trial INT, sample BINARY")
        found = {(r["trial"], r["feature"]): np.array(r["found"], float) for r in drawn_rows.groupBy("trial").applyInPandas(cut, "trial INT, feature INT, found ARRAY<DOUBLE>").collect()}
        lists = [[found.get((t, f), np.zeros(0)) for f in range(k)] for t in range(len(most))]
        self.all = [np.unique(np.concatenate([x[f] for x in lists])) for f in range(k)]
        self.code = "int16" if max(map(len, self.all)) < 2**15 - 1 else "int32"
        self.cuts = [[np.searchsorted(self.all[f], x[f]) for f in range(k)] for x in lists]
        # the bin of a code is the number of own candidates below it
        self.bins = [[np.searchsorted(c, np.arange(len(self.all[f]) + 1)).astype(np.int32) for f, c in enumerate(own)] for own in self.cuts]

    def _encode(self):
        every, code, k = self.all, self.code, self.features

        def run(batches):
            for row in _rows(batches):
                values = np.frombuffer(row["codes"]).reshape(k, -1)
                row["codes"] = np.stack([np.searchsorted(u, v).astype(code) for u, v in zip(every, values)]).tobytes()
                yield _batch(BLOCKS, [list(row.values())])

        return run

    def grow(self, alive: Sequence[int], trees: int) -> None:
        """Grow the trees of these trials to so many."""
        with _passes(self.spark):
            while len(self.trees[alive[0]]) < trees:
                self._prepare(alive)
                self._grow_one(alive)

    def _prepare(self, alive: Sequence[int]) -> None:
        """Write the next trees' draws into the blocks, and the scores so far unless one tree of many trials is sooner gone through again."""
        done, code, old, first = len(self.trees[alive[0]]), self.code, self.train, self.scored == 0
        draws = [(self.seed + t + done + 1, self.settings[t]["subsamplingRate"]) for t in alive]
        scored = done - self.scored >= (1 if len(alive) <= 32 else 4)
        todo = [(self.kept.index(t) if self.kept else 0, self.trees[t][self.scored :], self.settings[t]["stepSize"]) for t in alive] if scored else []

        def run(batches):
            for row in _rows(batches):
                codes, _, scores = _arrays(row, code)
                if todo:
                    row["scores"] = np.stack([_scored(scores, place, trees, first, rate, codes) for place, trees, rate in todo]).tobytes()
                row["masks"] = np.packbits(drawn([s + row["part"] for s, _ in draws], [r for _, r in draws], row["start"], row["n"]), axis=1).tobytes()
                yield _batch(BLOCKS, [list(row.values())])

        self.train, self.stale = old.mapInArrow(run, BLOCKS).persist(StorageLevel.MEMORY_AND_DISK), old
        if scored:
            self.kept, self.scored = list(alive), done

    def _grow_one(self, alive: Sequence[int]) -> None:
        new = {t: seedling(self.settings[t]["maxDepth"]) for t in alive}
        todo: dict[int, dict[int, tuple | None]] = {t: {0: None} for t in alive}
        for level in range(max(self.settings[t]["maxDepth"] for t in alive)):
            work = [
                Trial(t, self.settings[t], alive.index(t), self.kept.index(t) if self.kept else 0, self.trees[t][self.scored :], self.scored == 0, new[t], todo[t],
                      self.bins[t], [len(c) for c in self.cuts[t]])
                for t in alive if todo[t]
            ]
            if not work:
                break
            found = self.train.mapInArrow(_level(work, level, self.code), SUMS).groupBy("trial").applyInPandas(_choose(work), FOUND).collect()  # a row per node
            if self.stale:  # the first level has read all of the new blocks
                self.stale.unpersist()
                self.stale = None
            todo = {t: {} for t in alive}
            for r in found:
                t, node, tree = r["trial"], r["node"], new[r["trial"]]
                tree.value[node] = r["s"] / r["n"] if r["n"] else 0.0
                if r["feature"] < 0:
                    continue
                tree.feature[node], tree.cut[node], tree.base[node] = r["feature"], self.cuts[t][r["feature"]][r["split"]], 2 * node + 1
                for child, own in ((2 * node + 1, (r["ln"], r["ls"], r["lq"])), (2 * node + 2, (r["rn"], r["rs"], r["rq"]))):
                    tree.value[child] = own[1] / own[0]
                    if level + 1 < tree.depth and abs(float(impurity(*own))) >= np.finfo(float).eps:
                        todo[t][child] = own
        for t in alive:
            self.trees[t].append(new[t])

    def errors(self, alive: Sequence[int]) -> dict[int, float]:
        """Root of the mean squared error of each trial on the held-out rows."""
        code, todo = self.code, [(t, self.trees[t], self.settings[t]["stepSize"]) for t in alive]

        def run(batches):
            for row in _rows(batches):
                codes, labels, scores = _arrays(row, code)
                yield _batch("trial INT, n LONG, loss DOUBLE", [(t, len(labels), float(np.square(labels - _scored(scores, 0, trees, True, rate, codes)).sum())) for t, trees, rate in todo])

        with _passes(self.spark):
            rows = self.held.mapInArrow(run, "trial INT, n LONG, loss DOUBLE").groupBy("trial").agg(F.sqrt(F.sum("loss") / F.sum("n")).alias("e")).collect()
        found = {r["trial"]: r["e"] for r in rows}
        return {t: found.get(t, math.nan) for t in alive}

    def close(self) -> None:
        if self.stale:
            self.stale.unpersist()
        self.train.unpersist()
        self.blocks.unpersist()
