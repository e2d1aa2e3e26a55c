"""HTML extraction: nearest-URL page differencing.

Every page is cut into text lines, one per block. Pages of a host are put in order of their URL path and each is paired with
the neighbour of another article that shares the longer path prefix. The lines of both are aligned by a longest common
subsequence, and lines they share are deleted: what sites repeat from page to page is no main text. Inside a marked article one
neighbour is too little evidence, so a shared line goes there only if it also stands in more than half of the different
articles of its host, at least three. A neighbour that shares most of a page is a copy of it (print or feed address, repeated
page) and is passed over; a page that has only copies keeps all its lines. Markup that says what a block is comes first: navigation, adverts, forms, comments
and the like are never main text, and where a page marks its article or main part, only that part can be.

Neighbours are found from light rows in even ranges of one global order, so a host of any size is spread over tasks.

Defined cases: null html gives an empty text; a page without neighbour on its host keeps all its lines; null urls count as
one host with an empty path; rows that repeat url and html get equal texts; empty tables return no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.session import materialize

from .common import cut, table
from .registry import query

SAME = 0.5  # a neighbour that shares at most this part of the lines or letters is another article
COPY = 0.9  # one that shares this part of the letters is a copy and never deletes a line

_SILENT = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<(script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|$)|<[!?][^>]*>", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>")
_NAMES = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
PARTS = frozenset("nav header footer aside form button menu dialog fieldset".split())
ROLES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay comment comments reply replies respond disqus share sharing social related recommended breadcrumb breadcrumbs pagination pager subscribe subscription newsletter "
    "signup login search form widget toolbar skip complementary contentinfo search copyright".split()
)


# names of two or three words that say the same: site-header, cookie-banner, related-posts ...
_OF_PAGE = "site page main global top bottom left right primary secondary"
_BEFORE = {"header": _OF_PAGE, "footer": _OF_PAGE, "sidebar": _OF_PAGE, "masthead": "site page", "nav": _OF_PAGE + " post posts footer header", "navigation": _OF_PAGE + " post posts comment comments", "menu": _OF_PAGE + " nav footer header mobile"}
_BEFORE |= {"links": "footer nav share social related", "bar": "nav menu side top search cookie share", "banner": "cookie cookies consent ad gdpr promo", "notice": "cookie cookies consent gdpr", "consent": "cookie cookies gdpr"}
_BEFORE |= {"posts": "related recommended", "articles": "related recommended", "stories": "related recommended", "buttons": "share sharing social", "icons": "share social", "media": "social"}
_BEFORE |= {"area": "comments comment widget sidebar", "list": "comment comments", "form": "comment search login signup subscribe newsletter contact", "section": "comments", "thread": "disqus", "box": "search ad newsletter", "signup": "newsletter email", "modal": "cookie newsletter", "popup": "newsletter cookie"}
_BEFORE |= {"container": "ad ads sidebar", "slot": "ad", "unit": "ad", "wrapper": "ad ads sidebar", "block": "ad", "label": "ad", "link": "skip", "widget": "sidebar"}
COMPOUNDS = frozenset(f"{first}-{last}" for last, firsts in _BEFORE.items() for first in firsts.split()) | {"skip-to-content", "google-ad", "back-to-top", "you-may-also-like", "wp-block-navigation"}


def _by_role(name: str, attributes: str) -> bool:
    """Does a whole class name, id, role or label say that an element is no main text? Article and main always can be."""
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _NAMES.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        for word in ["-".join(value.split())] if m[1].lower() == "aria-label" else value.split():
            whole = _CAMEL.sub("-", word).lower().replace("_", "-").strip("-")
            if whole in ROLES or word.lower() in ROLES or re.sub("-+", "-", whole) in COMPOUNDS:
                return True
    return False


def _by_markup(name: str, attributes: str) -> bool:
    return name in PARTS or bool(attributes and _HIDDEN.search(attributes))


ARTICLES = 3  # a line inside articles is a template from so many different ones on


def lines_of(page: str) -> tuple[list[str], list[bool]]:
    """Text of each block in page order, and whether it can be main text; blocks without text are left out."""
    return marked_lines(page)[:2]


def marked_lines(page: str) -> tuple[list[str], list[bool], bool]:
    """The same and whether the page marks its article or main part.

    An element that only a role word drops is spared if it holds the main part, or if no article would be left.
    """
    page = _SILENT.sub("", page)
    texts, able, marked, holds_main, holds_article = _cut(page, frozenset())
    spared = holds_main if marked else holds_main | holds_article
    if spared:
        texts, able, marked, *_ = _cut(page, frozenset(spared))
    return texts, able, marked


def _cut(page: str, spared: frozenset[int]) -> tuple[list[str], list[bool], bool, set[int], set[int]]:
    """Lines as `lines_of` gives them, whether an article or main part is among them, and the starts of the elements that a
    role word dropped with a main part or an article inside."""
    texts: list[str] = []
    able: list[bool] = []
    block: list[str] = []
    skip: list[str] = []  # open elements from the first that is no main text on
    roots: list[int | None] = []  # of these: the start if a role word drops it, None if its markup does, -1 if nothing does
    holds: dict[str, set[int]] = {"main": set(), "article": set()}
    mains = 0  # open article or main elements
    marked = False
    where: list[bool] = []  # is the line inside article or main
    at = 0

    def close() -> None:
        text = " ".join(entities.unescape("".join(block)).split())
        block.clear()
        if text:
            texts.append(text)
            able.append(not skip)
            where.append(mains > 0)

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            block.append(page[at : tag.start()])
        at = tag.end()
        ending, name, attributes = tag[1], tag[2].lower(), tag[3]
        by_markup = not ending and _by_markup(name, attributes)
        by_role = not ending and not by_markup and tag.start() not in spared and _by_role(name, attributes)
        part = not ending and (bool(skip) or by_markup or by_role)
        if name not in INLINE or part != bool(skip):
            close()
        if name in VOID or attributes.endswith("/") and name in INLINE:
            continue
        if ending:
            if skip:
                if name in skip:  # what was left open inside ends with it
                    if name not in INLINE or len(skip) == 1:
                        close()
                    while skip.pop() != name:
                        roots.pop()
                    roots.pop()
                elif name in ("article", "main", "body"):
                    skip.clear()
                    roots.clear()
                    mains = max(0, mains - (name != "body"))
                continue
            if name in ("article", "main"):
                mains = max(0, mains - 1)
        elif part:
            skip.append(name)
            roots.append(None if by_markup else tag.start() if by_role else -1)
            if name in holds and None not in roots:
                holds[name].update(r for r in roots if r != -1)
        elif name in ("article", "main"):
            mains += 1
            marked = True
    if at < len(page):
        block.append(page[at:])
    close()
    if marked:
        able = [a and inside for a, inside in zip(able, where)]
    return texts, able, marked, holds["main"], holds["article"]


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    """Positions in `own` of a longest common subsequence with `other` (bit-parallel rows, then traced back)."""
    masks: dict[int, int] = {}
    for j, x in enumerate(other):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, v = [full], full
    for x in own:
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    i, j, out = len(own), len(other), []
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length of each line of a page, whether it can be main text, and whether the page marks it."""
    for batch in cut(batches, "html"):
        rows = [marked_lines(page or "") for page in batch.column(1).to_pylist()]
        hashes, able, marked = [_hashes(r[0]) for r in rows], [r[1] for r in rows], [r[2] for r in rows]
        columns = [_doc_digests(hashes, able, marked), pa.array(hashes, pa.list_(pa.int64())), pa.array(able, pa.list_(pa.bool_()))]
        columns += [pa.array([[len(x) for x in r[0]] for r in rows], pa.list_(pa.int32())), pa.array(marked, pa.bool_())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["url", "page", "hashes", "able", "sizes", "marked"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines themselves, with the digest that `_lines` gives the page."""
    for batch in cut(batches, "html"):
        rows = [marked_lines(page or "") for page in batch.column(2).to_pylist()]
        digests = _doc_digests([_hashes(r[0]) for r in rows], [r[1] for r in rows], [r[2] for r in rows])
        kept = pa.array([[x if a else None for x, a in zip(*row[:2])] for row in rows], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digests, kept], ["page_id", "url", "page", "texts"])


def _hashes(texts: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(x) >> 1 for x in texts]


def _doc_digests(hashes: list[list[int]], able: list[list[bool]], marked: list[bool]) -> pa.Array:
    return pa.array([xxhash.xxh64_intdigest(np.array(h, np.int64).tobytes() + np.array([*a, m], np.bool_).tobytes()) >> 1 for h, a, m in zip(hashes, able, marked)], pa.int64())


def deleted_lines(own: list[int], able: list[bool], sizes: list[int], others: list[list[int]]) -> list[int]:
    """Positions of the lines that go; `others` are the lines of neighbouring pages, the nearest first.

    The nearest of another article is aligned. If all share most, as short pages under a long menu do, it is the one that
    shares the fewest letters, unless that is a copy as well: the article of a copy is no template.
    """
    lines, letters = sum(able), sum(n for n, a in zip(sizes, able) if a)
    chosen, least = None, COPY
    for other in others:
        left = Counter(other)
        n = size = 0
        for x, a, length in zip(own, able, sizes):
            if a and left[x] > 0:
                left[x] -= 1
                n, size = n + 1, size + length
        if min(n / lines, size / letters) <= SAME:
            chosen = other
            break
        if size / letters < least:
            chosen, least = other, size / letters
    return [i for i in shared_lines(own, chosen) if able[i]] if chosen is not None else []


def _deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, able, sizes, others = (batch.column(i).to_pylist() for i in range(3, 7))
        gone = [deleted_lines(o, a, s, [x["hashes"] for x in sorted(near, key=lambda x: (-x["prefix"], x["turn"]))]) for o, a, s, near in zip(own, able, sizes, others)]
        digests = [[o[i] for i in g] for o, g in zip(own, gone)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(gone, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.int64()))], ["doc", "host", "marked", "shared", "digests"])


def template_lines(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """(host, digest) of those shared lines that stand in more than half of the different articles of their host, `ARTICLES` at least.

    `lines` has host, longest, least and the digests of each page; near copies agree in one of these keys, so a line must pass
    by the number of either.
    """
    numbers = [F.count_distinct("longest").alias("by_longest"), F.count_distinct("least").alias("by_least")]
    stands = lines.select("host", "longest", "least", F.explode(F.array_distinct("hashes")).alias("digest"))
    counts = stands.join(shared.select("host", "digest").distinct(), ["host", "digest"]).groupBy("host", "digest").agg(*numbers)
    whole = lines.groupBy("host").agg(numbers[0].alias("all_longest"), numbers[1].alias("all_least"))
    able = (F.least("by_longest", "by_least") >= ARTICLES) & (2 * F.col("by_longest") > F.col("all_longest")) & (2 * F.col("by_least") > F.col("all_least"))
    return counts.join(whole, "host").where(able).select("host", "digest")


def nearest_pages(pages: DataFrame, keys: Sequence[str] = ("doc",)) -> DataFrame:
    """(doc, near, prefix, turn): for each key, the pages before and after in order of (host, path) whose key is another one.

    Rows (host, path, doc) are unique; equal keys mean one host. Pages of one key stand in runs of any length: each range of
    the order finds the page beyond the run within itself, and the first and last run of a range take it from one small row
    for each range. `prefix` counts the path pieces both pages begin with, `turn` puts the nearer first.
    """
    order = ["host", "path", "doc"]
    me = F.struct("host", "path", "doc", *[k for k in keys if k != "doc"])
    at = pages.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(at.withColumn("part", F.shiftright("at", 33)), "pages-order")
    by = Window.partitionBy("part").orderBy("at")
    # both frames grow row by row; one up to the end of its range would be read anew for each row
    past, ahead = (Window.partitionBy("part").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.asc("at"), F.desc("at")))
    beside = placed.withColumn("me", me).select("*", F.lag("me").over(by).alias("p"), F.lead("me").over(by).alias("n"))
    names = {(side, k): f"{side}_{k}" for k in keys for side in "pn"}
    found = [F.last(F.when(F.col(f"p.{k}") != F.col(k), F.col("p")), ignorenulls=True).over(past).alias(names["p", k]) for k in keys]
    found += [F.last(F.when(F.col(f"n.{k}") != F.col(k), F.col("n")), ignorenulls=True).over(ahead).alias(names["n", k]) for k in keys]
    found = materialize(beside.select("part", "at", "me", *found), "pages-beside")
    edges = [F.min_by("me", "at").alias("first"), F.max_by("me", "at").alias("last")]
    edges += [f(names[side, k], "at").alias(names[side, k]) for side, f in (("p", F.max_by), ("n", F.min_by)) for k in keys]
    parts = found.groupBy("part").agg(*edges).orderBy("part").collect()  # one row per task
    if not parts:
        return pages.select("doc", F.col("doc").alias("near"), F.lit(0).alias("prefix"), F.lit(0).alias("turn"))
    # what stands beyond the run that enters a range, from the range before (after)
    enters: dict = {r["part"]: {} for r in parts}
    for side, rows, edge, front in (("p", parts, "last", "first"), ("n", parts[::-1], "first", "last")):
        for k in keys:
            for before, now in zip(rows, rows[1:]):
                # of the range before: beyond its last run, or beyond its one run
                beyond = before[names[side, k]] or enters[before["part"]].get(names[side, k])
                enters[now["part"]][names[side, k]] = beyond if before[edge][k] == now[front][k] else before[edge]
    kind = found.schema["me"].dataType.simpleString()
    columns = [names[side, k] for k in keys for side in "pn"]
    table_ = pages.sparkSession.createDataFrame([(part, *[e.get(c) for c in columns]) for part, e in enters.items()], "part long, " + ", ".join(f"e_{c} {kind}" for c in columns))
    whole = found.join(F.broadcast(table_), "part", "left")

    def near(column: str, turn: int):
        other = F.coalesce(column, f"e_{column}")
        pieces = F.zip_with(F.split("me.path", "/"), F.split(other["path"], "/"), lambda a, b: F.coalesce(a == b, F.lit(False)))
        first_other = F.array_position(pieces, False)
        prefix = F.when(first_other == 0, F.size(pieces)).otherwise(first_other - 1).cast("int")
        return F.when(other["host"] == F.col("me.host"), F.struct(other["doc"].alias("near"), prefix.alias("prefix"), F.lit(turn).alias("turn")))

    # a page at several addresses is compared from the first of them
    sides = whole.select("me", F.filter(F.array(*[near(c, i) for i, c in enumerate(columns)]), lambda x: x.isNotNull()).alias("near"))
    once = sides.groupBy(F.col("me.doc").alias("doc")).agg(F.min_by("near", F.struct(F.size("near") == 0, "me.path")).alias("near"))
    pairs = once.select("doc", F.explode("near").alias("x")).select("doc", "x.*")
    return pairs.where("near <> doc").groupBy("doc", "near").agg(F.max("prefix").alias("prefix"), F.min("turn").alias("turn"))


def _address(rows: DataFrame) -> DataFrame:
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1)
    return rows.withColumns({"host": host, "path": path}).withColumn("doc", F.xxhash64("host", "page"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = "url string, page long, hashes array<bigint>, able array<boolean>, sizes array<int>, marked boolean"
    # pages of a host with the same lines are one; texts are cut again at the end and not written
    parsed = _address(rows.select("url", "html").mapInArrow(_lines, schema)).where(F.array_contains("able", True))
    # near copies differ in a line or two: they mostly agree in their longest line or in their least digest
    main = F.filter(F.arrays_zip("hashes", "sizes", "able"), lambda x: x["able"])
    longest = F.xxhash64("host", F.array_max(F.transform(main, lambda x: F.struct(x["sizes"].alias("n"), x["hashes"].alias("h"))))["h"])
    least = F.xxhash64("host", F.array_min(F.transform(main, lambda x: x["hashes"])))
    parsed = materialize(parsed.withColumns({"longest": longest, "least": least}), "pages-lines")
    lines = parsed.select("doc", "host", "marked", "hashes", "able", "sizes").dropDuplicates(["doc"])
    near = nearest_pages(parsed.select("host", "path", "doc", "longest", "least").distinct(), ("doc", "longest", "least"))
    others = near.join(lines.select(F.col("doc").alias("near"), "hashes"), "near").groupBy("doc").agg(F.collect_list(F.struct("prefix", "turn", "hashes")).alias("others"))
    both = lines.join(others, "doc").select("doc", "host", "marked", "hashes", "able", "sizes", "others")
    aligned = both.mapInArrow(_deleted, "doc long, host string, marked boolean, shared array<int>, digests array<bigint>").where(F.size("shared") > 0)
    aligned = materialize(aligned, "pages-shared")
    inside = aligned.where("marked").select("doc", "host", F.explode(F.arrays_zip(F.col("shared").alias("at"), F.col("digests").alias("digest"))).alias("x")).select("doc", "host", "x.*")
    articles = parsed.where("marked").select("host", "longest", "least", F.transform(main, lambda x: x["hashes"]).alias("hashes"))
    certain = inside.join(template_lines(articles, inside), ["host", "digest"]).groupBy("doc").agg(F.collect_list("at").alias("shared"))
    gone = aligned.where("NOT marked").select("doc", "shared").unionByName(certain)
    texts = _address(rows.mapInArrow(_texts, "page_id long, url string, page long, texts array<string>"))
    joined = texts.join(gone, "doc", "left")
    shared = F.coalesce("shared", F.array().cast("array<int>"))
    numbered = F.transform("texts", lambda x, i: F.when(~F.array_contains(shared, i), x))
    return joined.select("page_id", "url", F.array_join(numbered, " ").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op5_nearest_page_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
