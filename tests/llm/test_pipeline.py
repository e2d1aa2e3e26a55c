"""The stages of the corpus pipeline on a small corpus, each against a brute-force version on its own input."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallyspark.llm import decontam, langid, packing, simhash, suffix_dedup, toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, __id string, __digest string, __doc string"


def _corpus():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdeghilmnoprstuv") for _ in range(rng.randint(3, 9))) for _ in range(900)]
    bad = ["".join(rng.choice("xyzqkw") for _ in range(6)) for _ in range(12)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    texts = [prose(rng.randint(30, 120)) for _ in range(260)]
    toxic = [prose(20) + " " + " ".join(rng.choice(bad) for _ in range(14)) + " " + prose(20) for _ in range(90)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (5, 6, 9, 20, 45, 70)]
    passages = [prose(40) + " éß日" for _ in range(3)]
    rows = [(t, 0) for t in texts] + [(t, 1) for t in toxic]
    rows += [(texts[i], 0) for i in range(12)]  # exact copies
    rows += [(texts[20] + " end", 0)] * 2
    rows += [(prose(60) + " " + rng.choice(passages) + " " + prose(50), 0) for _ in range(25)]
    rows += [(prose(90) + " " + item + " " + prose(90), 0) for item in items for _ in range(2)]
    rows += [("", 0), (None, 0), ("word", 0), (prose(6000), 0)]
    rng.shuffle(rows)
    docs = [(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, (t, _) in enumerate(rows)]
    labels = [(i, 1, label) for i, (_, label) in enumerate(rows)]
    return docs + [(None, "a row without an id " * 8, None, None, None, None, None, None)], labels, [(i, t) for i, t in enumerate(items)]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = _corpus()
    spark.createDataFrame(docs, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, now, folder)
        rows = [tuple(r) for r in made.collect()]
        out[name] = [tuple(r) for r in now.collect()], rows, made.columns
        now = spark.createDataFrame(rows, made.schema)
    whole = sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids_crc32").collect()), key=repr)
    return out, dict((i, t) for i, _, t in labels), [t for _, t in items], whole


def test_stages_keep_the_columns(staged):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    assert [columns for _, _, columns in list(staged[0].values())[:-1]] == [names] * 4


def test_toxic_documents_go(staged):
    before, after, _ = staged[0]["toxicity"]
    kept, toxic = {r[0] for r in after}, staged[1]
    gone = [r[0] for r in before if r[0] not in kept]
    assert set(after) <= set(before)
    assert sum(toxic[i] for i in gone) >= 0.9 * sum(toxic.values())
    assert sum(not toxic.get(i, 0) for i in gone) <= 0.02 * len(before)


def test_one_of_each_simhash_group_stays(staged):
    before, after, _ = staged[0]["simhash_near_dedup"]
    prints = {r[0]: simhash.fingerprint((r[1] or "").encode()) for r in before}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i in ids:
        if i is not None:
            least[find(i)] = min(least.get(find(i), i), i)
    alone = {None} if None in prints and find(None) not in least else set()
    assert sorted(map(str, (r[0] for r in after))) == sorted(map(str, set(least.values()) | alone))


def test_repeated_bytes_go(staged):
    before, after, _ = staged[0]["suffix_array_dedup"]
    seen, want = set(), {}
    order = sorted(before, key=lambda r: (r[0] is not None, r[0] or 0))
    for r in order:
        raw = (r[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - suffix_dedup.WINDOW + 1):
            window = raw[i : i + suffix_dedup.WINDOW]
            if window in seen:
                gone[i : i + suffix_dedup.WINDOW] = True
            seen.add(window)
        kept, at = [], 0
        for char in r[1] or "":
            size = len(char.encode())
            kept.append("" if gone[at : at + size].all() else char)
            at += size
        want[r[0]] = None if r[1] is None else "".join(kept)
    assert {r[0]: r[1] for r in after} == want
    assert sum(len(want[r[0]] or "") < len(r[1] or "") for r in before) >= 15
    assert all(r[4] == len(r[1]) for r in after if r[1] is not None)


def _shingles(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {("whole", *words)} if words else set()


def test_contaminated_documents_go(staged):
    before, after, _ = staged[0]["benchmark_decontamination"]
    items = [_shingles(t) for t in staged[2]]
    dirty = {r[0] for r in before if any(len(i & _shingles(r[1])) >= 0.8 * len(i) for i in items)}
    assert len(dirty) >= 8 and {r[0] for r in after} == {r[0] for r in before} - dirty


def test_all_ids_are_packed(staged):
    from tokenizers import Tokenizer

    before, after, columns = staged[0]["packing"]
    plain = Tokenizer.from_file(packing.tokenizer_path())
    ids = {r[0]: plain.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in before}
    at = {c: columns.index(c) for c in ("doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")}
    covered, sequences = {}, {}
    for r in after:
        doc, start, length = r[at["doc_id"]], r[at["start"]], r[at["length"]]
        assert r[at["ids_crc32"]] == zlib.crc32(np.array(ids[doc][start : start + length], "<u4").tobytes())
        covered.setdefault(doc, []).append((start, length))
        sequences.setdefault(r[at["sequence_id"]], []).append((r[at["offset"]], length))
    assert {d: sum(n for _, n in parts) for d, parts in covered.items()} == {d: len(x) for d, x in ids.items()}
    for parts in [*covered.values(), *sequences.values()]:
        place = 0
        for start, length in sorted(parts):
            assert start == place
            place += length


def test_run_applies_the_stages(staged):
    out, _, _, whole = staged
    ids = {}
    for r in out["packing"][1]:
        ids[r[0]] = ids.get(r[0], 0) + r[2]
    sums = {}
    for doc, _, length, _ in whole:
        sums[doc] = sums.get(doc, 0) + length
    assert sums == ids


# parts of the operators ------------------------------------------------------------------------------------------------


def _maximal(scores, low, high):
    """The best stretch, then the best ones left and right of it."""
    best, where = 0, None
    for a in range(low, high):
        total = 0
        for b in range(a, high):
            total += scores[b]
            if total > best:
                best, where = total, (a, b + 1)
    return [] if where is None else [*_maximal(scores, low, where[0]), where, *_maximal(scores, where[1], high)]


def test_segments_against_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(300):
        scores = rng.normal(-0.2, 1.0, rng.integers(0, 40))
        got = toxicity.segments(scores)
        assert sorted((a, b) for a, b, _ in got) == _maximal(scores, 0, len(scores))
        assert all(s == pytest.approx(scores[a:b].sum()) for a, b, s in got)
    assert toxicity.segments(np.zeros(0)) == [] and toxicity.segments(np.array([-1.0, 0.0])) == []


def test_extreme_rate_solves_its_equation():
    scores, numbers = np.array([2.0, 0.5, -1.0]), np.array([10.0, 30.0, 900.0])
    rate = toxicity.extreme_rate(scores, numbers, 1000.0, 0.1)
    assert numbers @ np.exp(rate * scores) / 1000 + 60 / 1000 * np.exp(-rate * 0.1) == pytest.approx(1.0, abs=1e-9)




def test_masks_hold_every_language_of_a_gram(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcde", "bb": "cdefg", "cc": "xyzé", "dd": "abxyz"}
    rows = [(" ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(40)), lang) for lang, letters in alphabets.items() for _ in range(25)]
    docs = spark.createDataFrame(rows + [(None, "aa"), ("abc", None)] + rows[:3], "text string, lang string")
    from pyspark.sql import functions as F

    filters = langid.learn(docs, F.lit(True), bits=16, hashes=3, share=0.4)
    assert filters.languages == sorted(alphabets)
    counts = {}
    for text, lang in rows + rows[:3]:
        raw = text.encode()
        code, _ = langid.grams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        for c in code.tolist():
            counts.setdefault(c, {}).setdefault(lang, 0)
            counts[c][lang] += 1
    totals = {lang: sum(c.get(lang, 0) for c in counts.values()) for lang in alphabets}
    codes = np.array(sorted(counts), np.uint32)
    masks = filters.masks(codes)[:, 0]
    extra = 0
    for code, mask in zip(codes.tolist(), masks.tolist()):
        rates = {lang: counts[code].get(lang, 0) / totals[lang] for lang in alphabets}
        held = {k for k, lang in enumerate(filters.languages) if rates[lang] and rates[lang] >= 0.4 * max(rates.values())}
        found = {k for k in range(4) if mask >> k & 1}
        assert held <= found
        extra += len(found - held)
    assert extra <= 4 * len(codes) * max(filters.wrong) + 5
    test = [(" ".join("".join(rng.choice(alphabets[lang]) for _ in range(4)) for _ in range(30)), lang) for lang in alphabets for _ in range(10)]
    test += [("long word " * 30000, None), ("12 34", None), (None, None)]
    frame = spark.createDataFrame([(i, *t, "x", 0.5) for i, t in enumerate(test + test[:2])], "doc_id long, text string, lang string, lang_pred string, score double")
    lang, score = langid.predict(frame, filters)
    got = frame.select("doc_id", "text", frame["lang"].alias("truth"), lang, score).collect()
    assert len(got) == len(test) + 2
    assert sum(r["lang_pred"] == r["truth"] for r in got if r["truth"]) >= 40
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["text"] is None or r["text"] == "12 34")
    assert all(0 <= r["score"] <= 1 for r in got)


def test_short_items_inside_long_documents(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    items = [" ".join(rng.sample(words, n)) for n in (5, 6, 5, 6, 7, 8, 12) for _ in range(12)]
    docs = []
    for i, item in enumerate(items):
        noise = [rng.choice(words) for _ in range(800)]
        docs.append((i, " ".join(noise[:400]) + " " + item + " " + " ".join(noise[400:])))
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["doc_id"] == r["item_id"]} == {(i, i) for i in range(len(items))}
    only = decontam.contaminated(spark.createDataFrame(docs[:5], "doc_id long, text string"), spark.createDataFrame([(0, items[0])], "item_id long, text string"))
    assert [(r["doc_id"], r["containment"]) for r in only.collect()] == [(0, 1.0)]
