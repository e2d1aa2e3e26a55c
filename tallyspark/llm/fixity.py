"""WARC: Merkle fixity audit of two replicas of an archive.

A record is hashed with its offset and length. Records are gathered by fixed ranges of the offset, ranges by `fanout` into
the levels of a tree up to one root per archive. The audit compares the roots of both replicas and goes down only into nodes
that differ; in the ranges it ends at, records are compared one by one. Each node has at most `fanout` children and each
range at most as many records as bytes fit it, so no group grows with the archive.

Defined cases: null bytes count as empty; null archives and ids are values of their own; an archive that only one replica has
is missing or extra with all its records; repeated records stand at their own offsets, empty ones at that of the record behind
them; another id at an offset is one record missing and one extra; repeats of one id at one offset are reported in one row;
empty replicas have no records and no roots, and two empty ones agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.session import materialize

from .common import table
from .registry import query

RANGE_BYTES, FANOUT = 1 << 16, 16


def response_record(record_id: Column, url: Column, body: Column) -> Column:
    """Bytes of a WARC response record."""
    payload = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def lay_out(records: DataFrame) -> DataFrame:
    """Adds n_bytes, digest and offset to (archive, record_id, bytes); records of an archive stand in order of id and digest."""
    body = F.coalesce("bytes", F.lit(b""))
    light = records.select("archive", "record_id", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("digest"))
    order = ["archive", "record_id", "digest"]
    # an archive of any size is spread over even ranges of one order: a record's offset is the bytes before it in its range, and
    # the bytes of its archive in the ranges before
    placed = light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("part", F.shiftright("at", 33)).withColumn("archive", F.struct("archive")), "fixity-order")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.sum("n_bytes").over(before.partitionBy("archive", "part").orderBy("at"))
    sums = placed.groupBy("archive", "part").agg(F.sum("n_bytes").alias("whole"))
    sums = sums.select("archive", "part", F.sum("whole").over(before.partitionBy("archive").orderBy("part")).alias("earlier"))
    laid = placed.withColumn("inside", inside).join(sums, ["archive", "part"])
    offset = F.coalesce("inside", F.lit(0)) + F.coalesce("earlier", F.lit(0))
    return laid.select("archive.archive", "record_id", "n_bytes", "digest", offset.alias("offset"))


def ranges(placed: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lowest level: (archive, node, hash) of each range that holds the start of a record."""
    leaf = F.concat_ws(":", "offset", "n_bytes", "digest")
    ordered = F.array_sort(F.collect_list(F.struct("offset", leaf.alias("leaf"))))
    return placed.groupBy("archive", F.floor(F.col("offset") / range_bytes).alias("node")).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["leaf"]), "\n"), 256).alias("hash"))


def levels(leaves: DataFrame, depth: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The tree from its leaves up; the last level has one node per archive."""
    out = [leaves]
    for level in range(1, depth + 1):
        child = F.concat_ws(":", "node", "hash")
        ordered = F.array_sort(F.collect_list(F.struct("node", child.alias("child"))))
        up = out[-1].groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["child"]), "\n"), 256).alias("hash"))
        out.append(materialize(up.select("archive", F.col("up").alias("node"), "hash"), f"fixity-level-{level}"))
    return out


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    on = F.lit(True)
    for name in names:
        on = on & a[name].eqNullSafe(b[name])
    return on


def differing(ours: DataFrame, theirs: DataFrame, parents: DataFrame | None, fanout: int = FANOUT) -> DataFrame:
    """(archive, node) whose hashes differ or that one side lacks, below the given parents (none: all)."""
    if parents is not None:
        ours, theirs = (x.join(parents.withColumnRenamed("archive", "__a"), F.col("archive").eqNullSafe(F.col("__a")) & (F.floor(F.col("node") / fanout) == F.col("__up")), "left_semi") for x in (ours, theirs))
    both = ours.select("archive", "node", "hash", F.lit(0).alias("side")).unionByName(theirs.select("archive", "node", "hash", F.lit(1).alias("side")))
    met = both.groupBy("archive", "node").agg(F.max(F.when(F.col("side") == 0, F.col("hash"))).alias("ours"), F.max(F.when(F.col("side") == 1, F.col("hash"))).alias("theirs"))
    return met.where(~F.col("ours").eqNullSafe(F.col("theirs"))).select("archive", "node")


def audit(ours: DataFrame, theirs: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """archive, offset, record_id, n_bytes, status (changed, missing, extra) of records in which `theirs` departs from `ours`.

    Both replicas: archive, record_id, offset, n_bytes, digest.
    """
    ours, theirs = materialize(ours.select("archive", "record_id", "offset", "n_bytes", "digest"), "fixity-ours"), materialize(theirs.select("archive", "record_id", "offset", "n_bytes", "digest"), "fixity-theirs")
    leaves = [materialize(ranges(x, range_bytes), "fixity-ranges") for x in (ours, theirs)]
    top = max([0, *(r[0] or 0 for r in (x.agg(F.max("node")).first() for x in leaves))])
    depth = 0
    while top >= fanout**depth:
        depth += 1
    trees = [levels(x, depth, fanout) for x in leaves]
    open_nodes: DataFrame | None = None
    for level in range(depth, -1, -1):
        parents = None if open_nodes is None else open_nodes.select("archive", F.col("node").alias("__up"))
        open_nodes = materialize(differing(trees[0][level], trees[1][level], parents, fanout), f"fixity-open-{level}")
    wanted = open_nodes.select(F.col("archive").alias("__a"), F.col("node").alias("__n"))
    near = [x.join(wanted, F.col("archive").eqNullSafe(F.col("__a")) & (F.floor(F.col("offset") / range_bytes) == F.col("__n")), "left_semi") for x in (ours, theirs)]
    sides = near[0].withColumn("side", F.lit(0)).unionByName(near[1].withColumn("side", F.lit(1)))
    # empty records share the offset of the one behind them: at most one at an offset has bytes, so least, greatest and number tell all
    record = F.struct("n_bytes", "digest")
    sums = [f(F.when(F.col("side") == side, x)).alias(f"{name}{side}") for side in (0, 1) for name, f, x in (("least", F.min, record), ("most", F.max, record), ("copies", F.count, F.lit(1)))]
    met = sides.groupBy("archive", "offset", "record_id").agg(*sums)
    same = F.col("least0").eqNullSafe(F.col("least1")) & F.col("most0").eqNullSafe(F.col("most1")) & (F.col("copies0") == F.col("copies1"))
    status = F.when(F.col("copies1") == 0, "missing").when(F.col("copies0") == 0, "extra").when(~same, "changed")
    found = met.withColumn("status", status).where("status IS NOT NULL").withColumn("record", F.coalesce("most0", "most1"))
    return found.select("archive", "offset", "record_id", F.col("record.n_bytes").alias("n_bytes"), "status")


#: The replica of the query: a copy of the pages' records with damage by the hash of the id, and the first page of each 4,096th
#: left out. The archive holds at most so many ids.
PER_ARCHIVE = 500
FIXITY_SQL = r"""
WITH sized AS (
  SELECT page_id, page_id // 500 AS archive, md5(page_id::VARCHAR) AS h,
    strlen('WARC/1.0' || 'xx' || 'WARC-Type: response' || 'xx' || 'WARC-Record-ID: <urn:page:' || page_id::VARCHAR || '>' || 'xx' || 'WARC-Target-URI: ' || coalesce(url, '') || 'xx' || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR || 'xxxx')
      + strlen(coalesce(html, '')) + 4 AS n_bytes
  FROM pages
), placed AS (
  SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM sized
)
SELECT archive, "offset", page_id, n_bytes, CASE WHEN h LIKE '0%' THEN 'changed' ELSE 'missing' END AS status
FROM placed WHERE h LIKE '0%' OR h LIKE '1f%'
"""


@query("op8_merkle_fixity", FIXITY_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finds the damage of a derived replica: a byte of some records is changed, others are lost."""
    pages = table(spark, sf_dir, "pages")
    whole = pages.select(F.floor(F.col("page_id") / PER_ARCHIVE).alias("archive"), F.col("page_id").alias("record_id"), response_record(F.col("page_id"), F.col("url"), F.col("html")).alias("bytes"))
    mark = F.md5(F.col("record_id").cast("string").cast("binary"))
    ours = lay_out(whole)
    damaged = whole.select("archive", "record_id", F.when(mark.startswith("0"), F.concat(F.substring("bytes", 1, 9), F.lit("1").cast("binary"), F.expr("substring(bytes, 11)"))).otherwise(F.col("bytes")).alias("bytes"))
    # a lost record leaves its gap: the offsets are those of the copy as it was made
    theirs = lay_out(damaged).where(~mark.startswith("1f"))
    return audit(ours, theirs).select("archive", "offset", F.col("record_id").alias("page_id"), "n_bytes", "status")
