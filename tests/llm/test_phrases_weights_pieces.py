"""Collocations, importance resampling and piece encoding against brute force and the library, with edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import collocations, pieces, resampling

ODD = ["", None, " \t", "?!", "a", "Ab  ab\tAB. ab,ab;ab:x!y?z\nq\x0bq\x0cq\rq", "É é ß ﬁ ǅ", "one two " * 300, "x" * 5000, "▁ ▁▁a", "a\x00b", "  two  spaces  ", "1234 5.6,7"]


def _corpus(seed, rows=300):
    rng = random.Random(seed)
    words = ["the", "a", "new", "york", "city", "hall", "of", "rise", "É", "Foo", "bar9"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n"]
    texts = ["".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(rows)]
    texts += ["New York City Hall rises"] * 40 + ODD
    return [(i, t, rng.choice(["en", "de", None, "und"]), "x") for i, t in enumerate(texts)]


def _brute_collocations(rows, longest, least, percent, top):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, _ in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        for phrase, a in counts.items():
            if len(phrase) < 2 or a < least:
                continue
            score, k = min((2000000 * a // (counts[phrase[:k]] + counts[phrase[k:]]), k) for k in range(1, len(phrase)))
            inside = any(len(q) > len(phrase) and b >= least and 100 * b >= percent * a and any(q[i : i + len(phrase)] == phrase for i in range(len(q))) for q, b in counts.items())
            if not inside:
                found.append((-score, -a, " ".join(phrase).encode(), counts[phrase[:k]], counts[phrase[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("longest,least,top", [(4, 5, 40), (2, 3, 2000), (3, 12, 7)])
def test_collocations(spark, longest, least, top):
    rows = _corpus(longest)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string").repartition(5)
    got = collocations.collocations(docs, longest=longest, least=least, top=top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    want = _brute_collocations(rows, longest, least, 80, top)
    assert sorted(map(tuple, got)) == want and len(want) > 5
    assert collocations.collocations(docs.limit(0), longest=longest).count() == 0


def test_windows_are_shuffled_as_one_string(spark, monkeypatch):
    written, write = {}, collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, label, *a: written.setdefault(label, write(df, label, *a)))
    docs = spark.createDataFrame([(1, "a b c d. a b c x. a a. a", "en"), (2, "a b", None), (3, None, "fr")], "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in collocations.phrase_counts(docs, longest=3, least=1).collect())
    assert written["windows"].columns == ["lang", "phrase", "f"]
    want = Counter()
    for lang, words in [("en", "a b c d"), ("en", "a b c x"), ("en", "a a"), ("en", "a"), ("und", "a b")]:
        words = words.split()
        want[lang, "", 0] += len(words)
        want.update((lang, " ".join(words[i : i + m]), m) for m in (1, 2, 3) for i in range(len(words) - m + 1))
    assert got == sorted((*k, n) for k, n in want.items())


def test_collocation_scores_are_exact(spark):
    big = 9_000_000_000_000_000_001
    phrases = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b c", 3, big // 5 * 4)], "lang string, phrase string, size int, f long")
    got = collocations.cut_scores(phrases.where("size < 3")).collect()
    assert [(r["phrase"], r["score"]) for r in got] == [("a b", 1_000_000)]
    # 80 % of an odd number is never reached by the whole part of it
    assert [r["phrase"] for r in collocations.uncovered(collocations.cut_scores(phrases.where("size < 3")), phrases).collect()] == ["a b"]
    assert collocations.uncovered(collocations.cut_scores(phrases.where("size < 3")), phrases.withColumn("f", phrases.f + (phrases["size"] == 3).cast("long"))).count() == 0


def _features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_feature_buckets(text):
    words, found = resampling.feature_buckets(text.encode("utf-8", "replace"))
    assert (words, sorted(found.tolist())) == (_features(text.encode("utf-8", "replace").decode())[0], sorted(_features(text.encode("utf-8", "replace").decode())[1]))


def _brute_resample(rows, target):
    s, t = Counter(), Counter()
    for r in rows:
        s.update(_features(r[1])[1])
    for text in target:
        t.update(_features(text)[1])
    whole_s, whole_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    out, able = {}, []
    for doc_id, text, *_ in rows:
        words, found = _features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * whole_s / ((s[b] + 1) * whole_t))) for b in found)
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [len(found), weight, score, None]
        if words >= 20:
            able.append((-score, doc_id))
    for rank, (_, doc_id) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        out[doc_id][3] = rank
    return out


def test_resampling(spark):
    rows = _corpus(7, 500)
    target = ["New York City Hall", None, "", "of the city of York"]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, rank string, score int").repartition(7)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = {r["doc_id"]: [r["n_features"], r["weight"], r["score"], r["rank"]] for r in resampling.resample(docs, items).collect()}
    assert got == _brute_resample(rows, target)
    assert sum(v[3] is not None for v in got.values()) > 10


def test_resampling_edges(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (6, None), (7, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    got = resampling.resample(docs, items, percent=100, min_words=1).collect()
    ranked = {r["rank"]: r["doc_id"] for r in got if r["rank"] is not None}
    assert sorted(ranked) == [1, 2, 3] and sorted(map(str, ranked.values())) == ["5", "5", "None"]
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["rank"]) for r in got if r["doc_id"] in (6, 7)} == {6: (0, 0, None), 7: (0, 0, None)}
    assert resampling.resample(docs.limit(0), items).count() == 0
    assert resampling.resample(docs, items.limit(0)).count() == 5
    equal = spark.createDataFrame([(i, "w " * 25) for i in range(60)], "doc_id long, text string")
    scores = resampling.draw(equal.selectExpr("doc_id", "25L AS n_words", "1L AS n_features", "0L AS weight", "3L AS score"), 50).where("rank IS NOT NULL")
    assert sorted((r["rank"], r["doc_id"]) for r in scores.collect()) == [(i + 1, i) for i in range(30)]


@pytest.fixture(scope="module")
def model():
    return pieces.pieces_of(pieces.model_path())


@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["  ", "the", "\n", "ing", "▁", "123", "ñ", "日本語", "<s>", "<0x0A>", "🤯"])), max_size=12).map("".join))
@settings(max_examples=400, deadline=None)
def test_agenda_agrees_with_the_library(model, text):
    text = text.encode("utf-8", "replace").decode()
    ids = np.frombuffer(model.encode(text), "<i4").tolist()
    assert ids == [*model.library.encode(text), 2]
    assert model.decode(ids) == model.library.decode(ids)


@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 262)), max_size=12))
@settings(max_examples=400, deadline=None)
def test_any_ids_decode_as_in_the_library(model, ids):
    assert model.decode(ids) == model.library.decode(ids)


def test_chunks_do_not_change_the_ids(model):
    rng = random.Random(4)
    text = "".join(rng.choice(["ab", "er", " ", "  ", "\n", "th", "7", "é", "▁", "-", "--"]) for _ in range(4000))
    whole = model.merge(" " + text)
    assert whole == np.frombuffer(model.encode(text), "<i4").tolist()[:-1] == model.library.encode(text)


def test_chunks_are_checked_and_forgotten(monkeypatch):
    model = pieces.MergePieces(pieces.model_path(), most=50)
    texts = [" ".join(f"w{i * j}" for j in range(30)) for i in range(40)]
    for at in range(0, 40, 8):
        for text, (raw, back, agrees) in zip(texts[at:], model.encode_batch(texts[at : at + 8], True)):
            assert agrees and back == text and np.frombuffer(raw, "<i4").tolist()[:-1] == model.library.encode(text)
        assert len(model.known) <= 50
    monkeypatch.setattr(model, "merge", lambda chunk: [5])
    assert [agrees for *_, agrees in model.encode_batch(["unseenword here", ""], True)] == [False, True]


def test_piece_rows(spark, model):
    rows = [(i if i else None, t, "q") for i, t in enumerate(ODD + ["long words " * 20000, "y" * 30000])]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, ids string").repartition(3)
    got = pieces.encode_pieces(docs, pieces.model_path()).collect()
    assert len(got) == len(rows) + 3 and all(r["agrees"] for r in got)
    by_id = {r["doc_id"]: r for r in got}
    for doc_id, text, _ in rows:
        assert by_id[doc_id]["ids"] == [*model.library.encode(text or ""), 2]
        assert by_id[doc_id]["decoded"] == model.library.decode(by_id[doc_id]["ids"])
    back = pieces.decode_pieces(pieces.encode_pieces(docs, pieces.model_path(), check=False), pieces.model_path())
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {d: by_id[d]["decoded"] for d in by_id}
    assert pieces.encode_pieces(docs.limit(0), pieces.model_path()).count() == 0
