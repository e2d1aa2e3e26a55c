"""Nulls, empty texts, repeated rows, empty tables and clashing column names."""

import html
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decontam, fixity, langid, line_dedup, neighbours, page_text, toxicity


def test_lines(spark):
    docs = spark.createDataFrame([(1, "a b\nc\n\nA  b"), (2, "c\nd"), (2, "c\nd"), (None, "d"), (3, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"], r["n_removed"], [tuple(s) for s in r["removed_spans"]]) for r in line_dedup.dedup_lines(docs, marks="", min_words=1).collect())
    assert got == sorted([("1", "a b\nc\n\n", 1, [(7, 11)]), ("2", "", 2, [(0, 3)]), ("2", "", 2, [(0, 3)]), ("None", "d", 0, []), ("3", "", 0, [])])
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def _removed_by_hand(rows, min_words):
    """(id, text) -> kept text, over distinct rows in the order of their ids."""
    first, covered, split = {}, {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        split[doc_id] = [m.span() for m in re.finditer(r"([^.!?,;:|\n]+)[.!?,;:|]*", text) if m[1].split()]
        words = [re.sub(r"[.!?,;:|]+$", "", text[a:b]).lower().split() for a, b in split[doc_id]]
        covered[doc_id] = set()
        for a in range(len(words)):
            b = next((b for b in range(a, len(words)) if sum(map(len, words[a : b + 1])) >= min_words), None)
            if b is not None:
                d, _, e = first.setdefault(" ".join(w for c in words[a : b + 1] for w in c), (doc_id, a, b))
                if (d, first[" ".join(w for c in words[a : b + 1] for w in c)][1]) != (doc_id, a) and not (d == doc_id and a <= e):
                    covered[doc_id] |= set(range(a, b + 1))
    out = {}
    for doc_id, text in set(rows):
        kept, done = [], 0
        for i, (a, b) in enumerate(split[doc_id]):
            if i in covered[doc_id]:
                kept.append(text[done:a] if i - 1 not in covered[doc_id] else "")
                done = b
        out[doc_id] = "".join(kept) + text[done:]
    return out


def test_runs_of_clauses(spark, monkeypatch):
    rng = random.Random(8)
    passages = [" ".join(rng.choice(["Ein", "é", "cat.", "dog,", "runs", "far\n", "x;"]) for _ in range(25)) for _ in range(6)]
    texts = []
    for _ in range(150):
        parts = [" ".join(rng.choice("abcdefgh") + rng.choice(["", "", ".", ",", "\n"]) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append(parts[0] + " " + rng.choice(passages) + " " + parts[1] + rng.choice(["", passages[0]]) + parts[2])
    texts += ["go on, " * 400, "go on, " * 30, "", "..,,", passages[2] * 300]
    rows = [(i or None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows + rows[5:9]], "doc_id long, text string, digest string, position int").repartition(5)
    want = _removed_by_hand(rows, 6)
    got = line_dedup.dedup_lines(docs, min_words=6).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        assert r["text"] == want[r["doc_id"]]
        raw = dict(rows)[r["doc_id"]].encode()
        for span in sorted(map(tuple, r["removed_spans"]), reverse=True):
            raw = raw[: span[0]] + raw[span[1] :]
        assert raw.decode() == r["text"]
    assert sum(r["n_removed"] > 0 for r in got) > 100


def test_contamination(spark):
    item = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, "x " * 300 + item + " y" * 300), (None, item.upper()), (2, None), (3, ""), (4, "one two three")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (None, "one two three"), (8, None)], "item_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["item_id"]), r["containment"]) for r in decontam.contaminated(docs, items).collect())
    assert got == [("1", "7", 1.0), ("4", "None", 1.0), ("None", "7", 1.0)]
    assert decontam.contaminated(docs, items.limit(0)).count() == 0
    assert decontam.contaminated(docs.limit(0), items).count() == 0


def test_pages(spark):
    page = "<body><div>Menu line</div><div>%s</div></body>"
    pages = spark.createDataFrame([(1, "http://h/a/1", page % "own"), (2, "http://h/a/2", page % "other"), (3, None, None), (4, "http://z/", "<article><p>a&amp;b</p></article>")], "page_id long, url string, html string")
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in page_text.main_text(pages).collect()} == {1: ("own", 3), 2: ("other", 5), 3: ("", 0), 4: ("a&b", 3)}
    assert page_text.main_text(pages.limit(0)).count() == 0


def _texts(spark, pages):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in page_text.main_text(rows).collect()}


def test_repeated_lines_inside_articles_go(spark):
    page = "<nav>Menu</nav><article><h1>Title %d</h1><p>Story %d runs on for a while.</p><p>Get our letter.</p></article>"
    got = _texts(spark, [(i, f"http://h/news/{i}", page % (i, i)) for i in range(40)] + [(90, "http://h/news/7?print=1", page % (7, 7)), (91, "http://h/news/7", page % (7, 7))])
    assert got == {i: f"Title {n} Story {n} runs on for a while." for i, n in [*((i, i) for i in range(40)), (90, 7), (91, 7)]}


def test_copies_keep_their_article(spark):
    story = "".join(f"<div>Part {j} of story %d is told here.</div>" for j in range(4))
    page = "<body><div>Home</div><div>News</div>" + story + "<div>%s</div></body>"
    pages = [(i, f"http://h/a/{i:02}", page % (*[i] * 4, "Read on")) for i in range(3)]
    pages += [(10 + i, f"http://h/a/01/amp{i}", page % (*[1] * 4, f"Printed at {i} o'clock")) for i in range(20)]
    pages += [(40, "http://h/a/01?print=1", pages[1][2]), (41, "http://h/a/01", pages[1][2])]
    pages += [(50, "http://x/1", "<div>Alone</div><div>here</div>"), (51, "http://x/1?a=b", "<div>Alone</div><div>here</div>")]
    got = _texts(spark, pages)

    def told(i):
        return " ".join(f"Part {j} of story {i} is told here." for j in range(4))

    # the page before 2 is an AMP copy of 1, which does not end in "Read on"
    assert {i: got[i] for i in (0, 1, 2, 40, 41)} == {0: told(0), 1: told(1), 2: told(2) + " Read on", 40: told(1), 41: told(1)}
    assert all(got[10 + i] == f"{told(1)} Printed at {i} o'clock" for i in range(20))
    assert got[50] == got[51] == "Alone here"


def test_role_words_drop_no_article():
    def main(page):
        return " ".join(x for x, able in zip(*page_text.lines_of(page)) if able)

    for tag in ("<article class='post no-sidebar'>", "<main class='has-sidebar'>", "<article class='post comments-open'>", "<main id=search>", "<div id='share-prices'>", "<section id='related-work'>", "<p class='notice-period'>", "<div aria-label='Search results'>"):
        name = tag[1:].split()[0]
        assert main(f"<body>{tag}Story</{name}>") == "Story"
    assert main("<div class='sidebar'><div class=overlay><main>Story</main></div></div><div class='ad'>Buy</div>") == "Story"
    assert main("<div class='promo'><article>Story<div class='ad'>Buy</div></article></div>") == "Story"
    assert main("<article>Story</article><div class='comments'><article class='comment'>Me too</article></div>") == "Story"
    assert main("<footer class='ad'><article>Teaser</article></footer><p>Story") == "Story"
    for tag in ("class='box ad'", "id=sidebar", "role='navigation'", "class='siteHeader'", "class='site_footer'", "class='cookie-banner'", "class='related-posts'", "id='comments-area'", "aria-label='Main navigation'"):
        assert main(f"<body><div {tag}>Other</div><div>Story</div>") == "Story"


def test_languages_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert langid.learn(docs, docs["doc_id"] > 0) is None
    lang, score = langid.predict(docs, None)
    assert {(r["lang_pred"], r["score"]) for r in docs.select(lang, score).collect()} == {("und", 0.0)}


def test_languages(spark):
    rows = [(i, "the weather is fine and the water is cold", "en") for i in range(5)] + [(i, "das wetter ist heute sehr kalt und nass", "de") for i in range(5, 9)]
    rows += [(20, "das wetter ist kalt", None), (21, None, "en"), (22, "", None), (23, "12 34 !", None), (None, "the water is fine", None), (24, "zzzz qqqq", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    lang, score = langid.predict(docs, langid.learn(docs, F.coalesce(docs["doc_id"] < 20, F.lit(True))))
    got = {r["doc_id"]: (r["lang_pred"], r["s"]) for r in docs.select("doc_id", lang, score.alias("s")).collect()}
    assert got[20][0] == "de" and got[None][0] == "en" and got[21] == got[22] == got[23] == ("und", 0.0) and got[24] == ("en", 0.0)
    empty = docs.limit(0)
    assert langid.learn(empty, F.lit(True)) is None


def test_links_defined_cases(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.999, 0.01], 0), (4, [1.0, 0.0], 1), (5, [0.0, 0.0], 0), (6, None, 0), (7, [1.0, 0.0], None), (8, [1.0, None], 0)]
    rows += [(9, [nan, 0.0], 0), (10, [1.0, 0.0, 0.0], 0), (None, [0.0, 1.0], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near_duplicates(vectors).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), None: (0, None, True), **{i: (0, i, True) for i in range(4, 11)}}
    assert neighbours.near_duplicates(vectors.limit(0)).count() == 0


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(8, 16))
    points = (middles[rng.integers(0, 8, 200)] + rng.normal(size=(200, 16)) * 0.1).astype(np.float32)
    points[:40] = points[0]
    vectors = spark.createDataFrame([(i, p.tolist(), i % 2) for i, p in enumerate(points)], "vec_id long, embedding array<float>, label int")
    unit = points.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(200)[:, None] % 2 == np.arange(200) % 2)
    got = {r["vec_id"]: r["n_links"] for r in neighbours.near_duplicates(vectors).collect()}
    assert [got[i] for i in range(200)] == (near.sum(1) - 1).tolist() and near.sum() > 200


def test_toxicity_defined_cases(spark):
    bad, good = "vile hateful slur spat at them", "calm and friendly note for you"
    rows = [(i, bad if i % 2 else good) for i in range(200)] + [(None, bad), (1000, None), (1001, ""), (7, bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit("x")).withColumn("id", F.lit("y"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (4, None), (5, 1)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([str(i) for i in range(0, 200, 2)] + ["1000", "1001"])
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0
    weights = toxicity.train(docs, labels.limit(0), F.col("id") >= 0)
    scores = docs.select(toxicity.toxic_scores(docs, weights).alias("s")).distinct().collect()
    assert [r["s"] for r in scores] == [0.5]
    few = toxicity.train(docs, labels, F.col("id") >= 0, label_rows=40)
    assert {r["s"] > 0.5 for r in docs.where(docs["text"] == bad).select(toxicity.toxic_scores(docs, few).alias("s")).collect()} == {True}


def test_fixity_defined_cases(spark):
    rows = [("a", i, bytes([65 + i]) * (10 * i)) for i in range(8)] + [("a", None, b"n"), (None, 1, b"x"), (None, 2, None), (None, 2, None), (None, 3, b"zz"), ("b", 1, b"r"), ("b", 1, b"r")]
    records = spark.createDataFrame(rows, "archive string, record_id long, bytes binary").withColumn("offset", F.lit("x"))
    ours = fixity.lay_out(records.drop("offset"))
    small = {"range_bytes": 32, "fanout": 2}
    assert fixity.audit(ours, ours, **small).count() == 0
    assert fixity.audit(ours.limit(0), ours.limit(0), **small).count() == 0
    hit = F.coalesce((F.col("archive") == "a") & (F.col("record_id") == 3), F.lit(False))
    lost = F.coalesce(((F.col("archive") == "a") & (F.col("record_id") == 6)) | (F.col("archive") == "b"), F.lit(False)) | (F.col("archive").isNull() & F.coalesce(F.col("record_id") == 2, F.lit(False)))
    theirs = ours.withColumn("digest", F.when(hit, "other").otherwise(F.col("digest"))).where(~lost)
    theirs = theirs.unionByName(ours.where(F.coalesce(F.col("archive") == "b", F.lit(False))).withColumn("archive", F.lit("new")))
    got = sorted((str(r["archive"]), r["record_id"], r["n_bytes"], r["status"]) for r in fixity.audit(ours, theirs, **small).collect())
    # the two empty records share an offset and an id
    assert got == sorted([("a", 3, 30, "changed"), ("a", 6, 60, "missing"), ("b", 1, 1, "missing"), ("b", 1, 1, "missing"), ("None", 2, 0, "missing"), ("new", 1, 1, "extra"), ("new", 1, 1, "extra")])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the given tables")
def test_articles_of_the_given_pages_stay_whole(spark):
    """Without its heading an article is one of the documents."""
    texts = {" ".join(r["text"].split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    heads = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in page_text.main_text(pages).collect():
        head = " ".join(html.unescape(re.search(r"<h1[^>]*>(.*?)</h1>", heads[r["page_id"]], re.S)[1]).split())
        assert r["text"].startswith(head) and r["text"][len(head) :].strip() in texts, r["page_id"]
