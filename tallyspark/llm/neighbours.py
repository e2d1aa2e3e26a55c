"""Embedding near-dedup: NN-descent, list enlargement where lists are saturated, recall audit, threshold edges.

Equal vectors of one label form a class and travel as one row. A neighbour graph is started from vectors that stand next to
each other in several random-projection orders, then refined: each class brings its list of nearest neighbours together and
compares them with one another (neighbours of neighbours), and both ends keep what is nearer than the last of their own list.
A list that is not full of links holds all links of its class. One whose every entry is a link is saturated: its group (all
that list entries up to `WIDER` times the threshold angle join) is then compared in full, in blocks. Two blocks are skipped where
the triangle inequality rules out any link, counted without a comparison where it makes every pair a link, and else compared. No
pair leaves a group: each class yields the number of its links, each pair of blocks the few links that its parts hang together by.

When no new link appears, a fixed number of query vectors is compared with all vectors, in blocks, and their links are looked
up in lists and groups. Short of the wanted recall, further random orders join the graph and the rounds go on; an audit that
is still short at the last pass is an error. The recall of the last audit is returned.

Only links (cosine >= threshold) count; the work is spread over tasks by class and by block.

Defined cases: rows with a null label, null, empty or zero vectors, or null or non-finite components link with nothing and
are their own component; vectors of different length never link; rows that repeat label and vector link with one another;
null ids take part, but never name a component unless no other id is there; empty tables return no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.session import materialize

from .common import components, table
from .registry import query

THRESHOLD = 0.98
LIST, TABLES, REACH, PROJECTION_BITS = 12, 8, 4, 24
AUDIT_ROWS, RECALL, MAX_ROUNDS, PASSES = 256, 0.99, 40, 4
BLOCK, HEADS, WIDER = 1024, 64, 1.5
PAIRS = "a long, b long, s double, link boolean"


def _pairs(a: np.ndarray, b: np.ndarray, s: np.ndarray, threshold: float) -> pa.RecordBatch:
    """Pairs with their cosine, rounded so that one pair has one place in a list however it was computed."""
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.round(s, 12)), pa.array(s >= threshold)], ["a", "b", "s", "link"])


def matrix(column: pa.Array) -> np.ndarray:
    """Unit rows in double precision; all vectors of the column have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(embedding: Column, label: Column) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per distinct usable vector: node (row number of the class), first (least id), members, space, vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("string").alias("label"))
    rows = rows.where(usable(F.col("vector"), F.col("label")))
    space = F.concat_ws("/", F.size("vector").cast("string"), "label").alias("space")
    grouped = rows.groupBy(space, "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("members"))
    return materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "neighbours-classes")


def _orders(batches: Iterator[pa.RecordBatch], tables: int, bits: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Each vector once per table, with its random-projection code."""
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            unit = matrix(part.column(2))
            planes = np.random.default_rng([seed, int(size)]).normal(size=(int(size), tables * bits))
            signs = (unit @ planes > 0).reshape(len(unit), tables, bits)
            code = signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unit), t, np.int32)), part.column(1), pa.array(code[:, t]), part.column(0), part.column(2)], ["turn", "space", "code", "node", "vector"])


def _adjacent(batches: Iterator[pa.RecordBatch], reach: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs of rows at most `reach` apart in a sorted partition, of one table and space."""
    tail: pa.RecordBatch | None = None
    for batch in batches:
        whole = batch if tail is None else pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
        old = 0 if tail is None else tail.num_rows
        tail = whole.slice(max(0, whole.num_rows - reach))
        turn, node = whole.column(0).to_numpy(), whole.column(3).to_numpy()
        space = np.unique(np.array(whole.column(1).to_pylist(), object), return_inverse=True)[1]
        out = []
        units = {}
        sizes = whole.column(4).value_lengths().to_numpy()
        for size in np.unique(sizes):
            units[size] = (np.cumsum(sizes == size) - 1, matrix(whole.filter(pa.array(sizes == size)).column(4)))
        for step in range(1, reach + 1):
            j = np.arange(max(step, old), whole.num_rows)
            i = j - step
            fit = (turn[i] == turn[j]) & (space[i] == space[j])
            i, j = i[fit], j[fit]
            for size, (row, unit) in units.items():
                own = sizes[i] == size
                s = np.einsum("ij,ij->i", unit[row[i[own]]], unit[row[j[own]]])
                out.append((node[i[own]], node[j[own]], s))
        if out:
            a, b, s = (np.concatenate(c) for c in zip(*out))
            yield _pairs(a, b, s, threshold)


def _local_join(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (owner, node, last, vector) sorted by owner -> pairs of a list that are nearer than the last entry of one of them."""
    held: list[pa.RecordBatch] = []

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        owner, node, last = (rows.column(i).to_numpy() for i in range(3))
        edge = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
        unit, out = matrix(rows.column(3)), []
        counts = np.diff(edge)
        for size in np.unique(counts[counts > 1]):  # lists of one length in one product
            at = edge[:-1][counts == size][:, None] + np.arange(size)
            for start in range(0, len(at), max(1, (1 << 21) // (int(size) * unit.shape[1]))):
                own = at[start : start + max(1, (1 << 21) // (int(size) * unit.shape[1]))]
                s = unit[own] @ unit[own].transpose(0, 2, 1)
                i, j = np.triu_indices(int(size), 1)
                a, b, s = own[:, i].ravel(), own[:, j].ravel(), s[:, i, j].ravel()
                near = (s >= threshold) | (s > last[a]) | (s > last[b])
                out.append((node[a[near]], node[b[near]], s[near]))
        a, b, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        once = np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))[: len(order)]
        first = order[once]
        return _pairs(a[first], b[first], s[first], threshold)

    def by_length(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = rows.column(3).value_lengths().to_numpy()
        for size in np.unique(sizes):  # a list holds vectors of one length
            yield work(rows.filter(pa.array(sizes == size)))

    for batch in batches:
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        owner = whole.column(0).to_numpy()
        last = int(np.searchsorted(owner, owner[-1]))
        if last:
            yield from by_length(whole.slice(0, last))
        held = [whole.slice(last)]
    if held:
        yield from by_length(held[0])


def _audit(batches: Iterator[pa.RecordBatch], shared, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links between the audited vectors and all vectors: how many there are, and how many lists or compared groups hold."""
    queries = {space: (np.array([q[0] for q in own]), np.array([q[1] for q in own]), np.array([q[2] for q in own]), [set(q[3]) for q in own]) for space, own in shared.value.items()}
    total = held = 0
    for batch in batches:
        node, spaces = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), object)
        group, lists = batch.column(3).to_numpy(), batch.column(4).to_pylist()
        for space in set(spaces.tolist()) & queries.keys():
            names, units, groups, known = queries[space]
            own = np.flatnonzero(spaces == space)
            i, j = np.nonzero(matrix(batch.filter(pa.array(spaces == space)).column(2)) @ units.T >= threshold)
            i = own[i]
            other = node[i] != names[j]
            i, j = i[other], j[other]
            total += len(i)
            # a group below zero was not compared in full, so the pair must stand in one of both lists
            whole = (group[i] == groups[j]) & (group[i] >= 0)
            held += int(whole.sum()) + sum(names[y] in lists[x] or node[x] in known[y] for x, y in zip(i[~whole].tolist(), j[~whole].tolist()))
    yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([held], pa.int64())], ["total", "held"])


def nearest(pairs: DataFrame, known: DataFrame | None, length: int) -> DataFrame:
    """Lists (owner, list of (s, node, link), last): the nearest `length` of each end of the pairs and of the lists known.

    The limit also works before the shuffle, and all that follows keeps its partitioning. `last` is what a vector has to
    exceed to enter the list.
    """
    ends = F.array(F.struct(F.col("a").alias("owner"), F.col("b").alias("node")), F.struct(F.col("b").alias("owner"), F.col("a").alias("node")))
    both = pairs.select(F.explode(ends).alias("e"), "s", "link").select("e.owner", "e.node", "s", "link")
    both = both if known is None else both.unionByName(entries(known))
    # a pair that was made several times has one rank
    order = Window.partitionBy("owner").orderBy(F.desc("s"), "node")
    top = both.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= length)
    once = top.groupBy("owner", "node").agg(F.max("s").alias("s"), F.max("link").alias("link"))
    lists = once.groupBy("owner").agg(F.collect_list(F.struct("s", "node", "link")).alias("list"))
    return lists.withColumn("last", F.when(F.size("list") >= length, F.array_min(F.transform("list", lambda x: x["s"]))).otherwise(-2.0))


def entries(lists: DataFrame) -> DataFrame:
    return lists.select("owner", F.inline("list")).select("owner", "node", "s", "link")


def neighbour_lists(plain: DataFrame, known: DataFrame | None, threshold: float, length: int, tables: int, seed: int, max_rounds: int) -> DataFrame:
    """Lists after rounds of local joins that ended for want of new links."""
    orders = plain.mapInArrow(partial(_orders, tables=tables, bits=PROJECTION_BITS, seed=seed), "turn int, space string, code long, node long, vector array<float>")
    seeds = orders.repartitionByRange("turn", "space", "code", "node").sortWithinPartitions("turn", "space", "code", "node").mapInArrow(partial(_adjacent, reach=REACH, threshold=threshold), PAIRS)
    graph = materialize(nearest(seeds, known, length), "neighbours-graph")

    def progress() -> tuple[int, float]:
        """Links in the lists, and how near the lists with room for more of them have come."""
        found = F.size(F.filter("list", lambda x: x["link"]))
        near = F.when(found < length, F.aggregate("list", F.lit(0.0), lambda t, x: t + x["s"]))
        row = graph.agg(F.sum(found).alias("n"), F.sum(near).alias("s")).first()
        return row["n"] or 0, row["s"] or 0.0

    before, still = progress(), 0
    for step in range(max_rounds):
        # the owner stands in its own list, so its neighbours also meet it
        nodes = F.array_append(F.transform("list", lambda x: x["node"]), F.col("owner"))
        meet = graph.select("owner", F.explode(nodes).alias("node"))
        rows = meet.join(graph.select(F.col("owner").alias("node"), "last"), "node").join(plain, "node").select("owner", "node", "last", "vector")
        made = rows.repartition("owner").sortWithinPartitions("owner").mapInArrow(partial(_local_join, threshold=threshold), PAIRS)
        graph = materialize(nearest(made, graph, length), f"neighbours-graph-{step}")
        now = progress()
        # two rounds without a link, or one in which open lists hardly moved either
        still = still + 1 if now[0] == before[0] else 0
        if still == 2 or still and now[1] - before[1] <= 1e-3 * abs(now[1]):
            return graph
        before = now
    raise RuntimeError(f"new links still appear after {max_rounds} rounds")


def links(
    nodes: DataFrame, threshold: float = THRESHOLD, length: int = LIST, tables: int = TABLES, recall: float = RECALL, max_rounds: int = MAX_ROUNDS, audit_rows: int = AUDIT_ROWS, passes: int = PASSES
) -> tuple[DataFrame, DataFrame, float]:
    """Lists (as `nearest` gives them), groups (node, component, dense: to be compared in full), and the audited recall."""
    spark = nodes.sparkSession
    plain = nodes.select("node", "space", "vector")
    lists = None
    for turn in range(passes):
        lists = neighbour_lists(plain, lists, threshold, length, tables, turn, max_rounds)
        near = entries(lists).where(F.col("link") | (F.col("s") >= float(np.cos(min(np.pi, WIDER * np.arccos(threshold))))))
        full = lists.where((F.size("list") >= length) & F.forall("list", lambda x: x["link"])).select(F.col("owner").alias("node"))
        reached = components(near.select(F.col("owner").alias("a"), F.col("node").alias("b")), "neighbours-groups")
        dense = reached.join(full, "node", "left_semi").select("component").distinct().withColumn("dense", F.lit(True))
        groups = materialize(reached.join(dense, "component", "left").select("node", "component", F.coalesce("dense", F.lit(False)).alias("dense")), "neighbours-groups")
        beside = lists.select(F.col("owner").alias("node"), F.transform(F.filter("list", lambda x: x["link"]), lambda x: x["node"]).alias("list"))
        group = F.when(F.col("dense"), F.col("component")).otherwise(-1)
        state = plain.join(groups, "node", "left").join(beside, "node", "left").select("node", "space", "vector", F.coalesce(group, F.lit(-1)).alias("group"), F.coalesce("list", F.array().cast("array<long>")).alias("list"))
        state = materialize(state, "neighbours-state")
        sample = state.orderBy(F.xxhash64("node", F.lit(turn)), "node").limit(audit_rows).toArrow()
        queries: dict[str, list[tuple]] = {}
        for node, space, vector, own, near in zip(*(sample.column(c).to_pylist() for c in ("node", "space", "vector", "group", "list"))):
            unit = np.array(vector, np.float64)
            queries.setdefault(space, []).append((node, unit / np.linalg.norm(unit), own, near))
        shared = spark.sparkContext.broadcast(queries)
        counts = state.mapInArrow(partial(_audit, shared=shared, threshold=threshold), "total long, held long").agg(F.sum("total"), F.sum("held")).first()
        measured = counts[1] / counts[0] if counts[0] else 1.0
        if measured >= recall:
            return lists, groups, measured
    raise RuntimeError(f"the audit found {measured} of the links after {passes} passes, {recall} is asked for")


def group_links(nodes: DataFrame, groups: DataFrame, threshold: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(node, others): how many vectors each class of a dense group is linked with, by comparing all classes of a group; and
    edges (a, b) that join exactly the classes that links join.

    A group is laid out in blocks of vectors that lie together. The angle between the middles of two blocks and both radii tell
    whether no pair of them can be a link, every pair must be one, or they have to be compared. A block meets its partners in
    one stream, so a group gives one row per class and block, and heads meet by group in stretches of `HEADS`.
    """
    members = groups.where("dense").join(nodes.select("node", "vector", "members"), "node").select(F.col("component").alias("group"), "node", "vector", "members")
    coded = members.mapInArrow(_coded, "group long, code long, node long, vector array<float>, members long")
    ordered = coded.repartitionByRange("group", "code", "node").sortWithinPartitions("group", "code", "node")
    schema = "group long, block long, nodes array<bigint>, members array<bigint>, labels array<bigint>, size int, vectors array<float>, middle array<double>, radius double, weight long"
    blocks = materialize(ordered.mapInArrow(partial(_blocks, block=block, threshold=threshold), schema), "neighbours-blocks")
    stretches = blocks.groupBy("group").agg(F.ceil(F.count("*") / HEADS).cast("int").alias("stretches"))
    heads = blocks.select("group", "block", "middle", "radius", "weight", F.array_distinct("labels").alias("labels"))
    heads = materialize(heads.join(stretches, "group").withColumn("salt", F.pmod(F.xxhash64("block"), F.col("stretches")).cast("int")), "neighbours-heads")
    left = heads.alias("l")
    right = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("stretches") - 1))).alias("r")
    cosine = F.aggregate(F.zip_with("l.middle", "r.middle", lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    angle, reach, far = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))), F.col("l.radius") + F.col("r.radius"), float(np.arccos(threshold))
    met = left.join(right, (F.col("l.group") == F.col("r.group")) & (F.col("l.salt") == F.col("r.salt"))).where(angle <= reach + far + 1e-6)
    # where every pair is a link, all labels of both blocks hang together
    pairs = F.concat(F.transform("r.labels", lambda y: F.struct(F.col("l.labels")[0].alias("a"), y.alias("b"))), F.transform("l.labels", lambda x: F.struct(x.alias("a"), F.col("r.labels")[0].alias("b"))))
    whole = angle + reach <= far - 1e-9
    met = met.select(F.col("l.block").alias("x"), F.col("r.block").alias("y"), F.when(whole, F.col("r.weight")).alias("whole"), F.when(whole & (F.col("l.block") < F.col("r.block")), pairs).alias("edges"))
    met = materialize(met, "neighbours-met")
    sure = met.where("whole IS NOT NULL").groupBy(F.col("x").alias("block")).agg(F.sum("whole").alias("whole"))
    body = blocks.select("block", "nodes", "members", "labels", "size", "vectors")
    ys = body.select(F.col("block").alias("y"), F.col("members").alias("m1"), F.col("labels").alias("l1"), F.col("vectors").alias("v1"))
    theirs = met.where("whole IS NULL").select("x", "y").join(ys, "y")
    theirs = theirs.select("x", "y", "m1", "l1", "v1", F.lit(None).cast("array<long>").alias("nodes"), F.lit(None).cast("int").alias("size"))
    # each block travels once beside its partners, before them
    mine = body.select(F.col("block").alias("x"), F.lit(None).cast("long").alias("y"), F.col("members").alias("m1"), F.col("labels").alias("l1"), F.col("vectors").alias("v1"), "nodes", "size")
    streams = mine.join(met.where("whole IS NULL").select("x").distinct(), "x", "left_semi").unionByName(theirs)
    streams = streams.repartition("x").sortWithinPartitions("x", F.asc_nulls_first("y"))
    counted = materialize(streams.mapInArrow(partial(_count_links, threshold=threshold), "node long, others long, b long"), "neighbours-counted")
    certain = blocks.join(sure, "block").select(F.explode("nodes").alias("node"), F.col("whole").alias("others"))
    own = members.select("node", (-F.lit(1)).cast("long").alias("others"))  # every vector meets itself once
    counts = counted.where("others IS NOT NULL").select("node", "others").unionByName(certain).unionByName(own).groupBy("node").agg(F.sum("others").alias("others"))
    inside = blocks.select(F.inline(F.arrays_zip(F.col("nodes").alias("a"), F.col("labels").alias("b"))))
    edges = inside.unionByName(met.select(F.inline("edges"))).unionByName(counted.where("b IS NOT NULL").select(F.col("node").alias("a"), "b"))
    return counts, edges.where("a <> b")


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            planes = np.random.default_rng(int(size) + 1).normal(size=(int(size), 60))
            code = (matrix(part.column(2)) @ planes > 0) @ (1 << np.arange(59, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(code), part.column(1), part.column(2), part.column(3)], ["group", "code", "node", "vector", "members"])


def _parts(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of links: the least row it reaches."""
    label = np.arange(len(linked), dtype=np.int32)
    while True:
        least = np.where(linked, label, np.int32(len(linked))).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _blocks(batches: Iterator[pa.RecordBatch], block: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Stretches of at most `block` vectors of one group in a sorted partition; a group's vectors have one length.

    The label of a class is the first one of its block that it reaches inside the block.
    """
    names = ["group", "block", "nodes", "members", "labels", "size", "vectors", "middle", "radius", "weight"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.float32()), pa.list_(pa.float64()), pa.float64(), pa.int64()]
    held: pa.RecordBatch | None = None

    def cut_off(rows: pa.RecordBatch, final: bool) -> tuple[list[tuple], pa.RecordBatch | None]:
        group, node, members = rows.column(0).to_numpy(), rows.column(2).to_numpy(), rows.column(4).to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
        out = []
        for a, b in zip(edge[:-1], edge[1:]):
            for start in range(a, b, block):
                stop = min(b, start + block)
                if stop == rows.num_rows and stop - start < block and not final:
                    return out, rows.slice(start)
                vectors = rows.column(3).slice(start, stop - start)
                unit = matrix(vectors)
                middle = unit.mean(0)
                middle /= max(np.linalg.norm(middle), 1e-300)
                radius = float(np.arccos(np.clip(unit @ middle, -1, 1)).max())
                linked = unit @ unit.T >= threshold
                np.fill_diagonal(linked, True)
                labels = node[start:stop][_parts(linked)].tolist()
                out.append((int(group[start]), int(node[start]), node[start:stop].tolist(), members[start:stop].tolist(), labels, unit.shape[1], vectors.flatten().to_numpy(zero_copy_only=False), middle.tolist(), radius, int(members[start:stop].sum())))
        return out, None

    for batch in batches:
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        rows, held = cut_off(whole, False)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    if held is not None:
        rows, _ = cut_off(held, True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _count_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows (x, y, m1, l1, v1, nodes, size) sorted by x, the block itself first -> links of each of its classes with all
    partners, and the labels of both blocks that links join, once for two blocks."""

    def result() -> pa.RecordBatch:
        a, b = (np.array(e, np.int64) for e in (zip(*edges) if edges else ((), ())))
        node = pa.array(np.concatenate((nodes, a)))
        return pa.RecordBatch.from_arrays([node, pa.array(counts.tolist() + [None] * len(a), pa.int64()), pa.array([None] * len(nodes) + b.tolist(), pa.int64())], ["node", "others", "b"])

    def by_label(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(labels, kind="stable")
        names, starts = np.unique(labels[order], return_index=True)
        return order, starts, names

    current = None
    for batch in batches:
        for row in range(batch.num_rows):
            x, y = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            labels, vectors = batch.column(3)[row].values.to_numpy(), batch.column(4)[row].values.to_numpy()
            if y is None:
                if current is not None:
                    yield result()
                current, size = x, batch.column(6)[row].as_py()
                nodes = batch.column(5)[row].values.to_numpy()
                own, counts, edges = _units(vectors, size), np.zeros(len(nodes), np.int64), []
                order, starts, names = by_label(labels)
                continue
            linked = own @ _units(vectors, size).T >= threshold
            counts += linked @ batch.column(2)[row].values.to_numpy()
            if y > x:
                columns, firsts, others = by_label(labels)
                joined = np.logical_or.reduceat(np.logical_or.reduceat(linked[order], starts, axis=0)[:, columns], firsts, axis=1)
                i, j = np.nonzero(joined)
                edges += zip(names[i].tolist(), others[j].tolist())
    if current is not None:
        yield result()


def _units(flat: np.ndarray, size: int) -> np.ndarray:
    rows = flat.astype(np.float64).reshape(-1, size)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **options) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id, kept, audited_recall, one row per vector."""
    nodes = classes(vectors, id_col, vector_col, label_col)
    lists, groups, measured = links(nodes, threshold, **options)
    # lists of groups without a saturated one hold all their links
    sparse = entries(lists).where("link").join(groups.where("dense").select(F.col("node").alias("owner")), "owner", "left_anti")
    listed = sparse.join(nodes.select("node", "members"), "node").groupBy(F.col("owner").alias("node")).agg(F.sum("members").alias("others"))
    # a class meets its own copies in its group, elsewhere they are added here
    copies = nodes.select("node", (F.col("members") - 1).alias("others"))
    counts = listed.unionByName(copies.join(groups.where("dense"), "node", "left_anti"))
    joined = entries(lists).where("link").select(F.col("owner").alias("a"), F.col("node").alias("b"))
    if groups.where("dense").limit(1).count():
        more, edges = group_links(nodes, groups, threshold)
        counts, joined = counts.unionByName(more), joined.unionByName(edges)
    counts = counts.groupBy("node").agg(F.sum("others").alias("n_links"))
    roots = nodes.join(components(joined, "neighbours"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = roots.groupBy("component").agg(F.min("first").alias("component_id"))
    known = roots.join(counts, "node").join(names, "component")
    known = materialize(known.select("space", "vector", "n_links", "component_id"), "neighbours-known")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("string").alias("label"))
    fit = usable(F.col("vector"), F.col("label"))
    keyed = rows.select("vec_id", F.when(fit, F.concat_ws("/", F.size("vector").cast("string"), "label")).alias("space"), F.when(fit, F.col("vector")).alias("vector"))
    out = keyed.join(known, ["space", "vector"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("audited_recall", F.lit(float(measured)))


@query("op1_nn_descent_links")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
