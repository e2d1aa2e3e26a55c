"""Small exact checks of the parts that hold the logic, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyspark.llm import neighbours, packing, simhash, suffix_dedup


def test_pack_keeps_each_id_once_without_padding():
    rng = random.Random(1)
    lengths = [rng.choice([1, 5, 60, 700, 1500, 4096, 4097, 9000]) for _ in range(400)]
    sequences = packing.pack(lengths)
    seen = {}
    for sequence in sequences:
        size = sum(p[2] for p in sequence)
        assert size <= 4096 and size & (size - 1) == 0
        for doc, start, length in sequence:
            seen.setdefault(doc, []).append((start, length))
    for doc, length in enumerate(lengths):
        at = 0
        for start, n in sorted(seen[doc]):
            assert start == at
            at += n
        assert at == length
    assert sum(sum(p[2] for p in s) not in packing.TIERS for s in sequences) <= 9
    assert packing.pack([]) == []


def test_common_prefixes_match_sorted_rotations():
    rng = np.random.default_rng(3)
    for stop in (1, 4, 9):
        text = rng.integers(0, 3, 200)
        text[40:80] = text[100:140]
        order, prefix = suffix_dedup.common_prefixes(text, stop)
        rotations = [tuple(np.roll(text, -i)[:stop]) for i in order]
        assert rotations == sorted(rotations)
        for k in range(1, len(text)):
            same = next((i for i in range(stop) if rotations[k][i] != rotations[k - 1][i]), -1)
            assert prefix[k] == same, (stop, k)


def test_fingerprint_bits():
    import xxhash

    text = "Ab c  d\te É f g a b c".encode()
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint(b"  \n") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)
    long = b" ".join(b"w%d" % (i % 977) for i in range(6000))
    bits = [0] * 64
    words = long.split()
    for i in range(len(words) - 2):
        h = xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    assert simhash.fingerprint(long) == sum(1 << b for b in range(64) if 2 * bits[b] > len(words) - 2)


def brute_removed(texts, window):
    seen, out = {}, []
    for doc, text in enumerate(texts):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            key = text[i : i + window]
            if key in seen:
                gone[i : i + window] = True
            else:
                seen[key] = (doc, i)
        out.append(gone)
    return out


def nasty_texts(seed=5, n=60):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "délta", "of the", "x"]
    line = " ".join(rng.choice(words) for _ in range(12))
    passage = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(60))
    texts = []
    for i in range(n):
        t = " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(rng.randrange(0, 120)))
        if i % 3 == 0:
            t = t[: len(t) // 2] + passage[rng.randrange(40) :] + t[len(t) // 2 :]
        if i % 2 == 0:
            t += line
        if i % 11 == 0:
            t += "ab" * 150
        if i % 7 == 6:
            t = texts[-3][5:] + "y"
        texts.append(t)
    return texts + ["", "a" * 500, texts[0]]


@pytest.mark.parametrize("hot", [8192, 3, 1])
def test_repeats_against_brute_force(spark, hot):
    texts = nasty_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    keyed = suffix_dedup.keyed(docs)
    removed = suffix_dedup.removed_windows(keyed, 100, 32, hot).collect()
    got = [np.zeros(len(t.encode()), bool) for t in texts]
    for r in removed:
        got[r["doc"]][r["start"] : r["start"] + r["number"] + 99] = True
    want = brute_removed([t.encode() for t in texts], 100)
    for doc, (a, b) in enumerate(zip(got, want)):
        assert (a == b).all(), doc
    left = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(docs).collect()}
    assert len(left) == len(texts) and left[len(texts) - 1] == ""
    assert all(texts[d] == t for d, t in left.items() if not want[d].any())


def test_repeats_defined_cases(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(80))
    docs = spark.createDataFrame([(None, text), (1, text), (1, "short" + text), (2, text), (2, text), (3, None), (4, "")], "doc_id long, text string")
    rows = suffix_dedup.keyed(docs)
    spans = suffix_dedup.with_spans(rows, suffix_dedup.removed_windows(rows)).collect()
    gone = sorted((r["doc"], len(r["text"]), sum(r["numbers"] or [])) for r in spans)
    full = len(text) - 99
    low = suffix_dedup.NULL_ID
    assert gone == sorted([(low, len(text), 0), (1, len(text), full), (1, len(text) + 5, full), (2, len(text), full), (2, len(text), full), (3, 0, 0), (4, 0, 0)])
    assert suffix_dedup.removed_windows(suffix_dedup.keyed(docs.limit(0))).count() == 0
    extra = docs.withColumn("start", docs["doc_id"]).withColumn("digest", docs["text"])
    assert suffix_dedup.remove_repeats(extra).columns == extra.columns


def test_long_text_in_segments(spark, monkeypatch):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    text = base + base[1000:5000]
    docs = spark.createDataFrame([(7, text)], "doc_id long, text string")
    removed = suffix_dedup.removed_windows(suffix_dedup.keyed(docs)).collect()
    gone = np.zeros(len(text), bool)
    for r in removed:
        gone[r["start"] : r["start"] + r["number"] + 99] = True
    want = brute_removed([text.encode()], 100)[0]
    assert (gone == want).all() and gone.sum() >= 4000


def brute_groups(rows, radius=2):
    prints = [(d, simhash.fingerprint((t or "").encode())) for d, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = {}
    for i in range(len(rows)):
        ids = [prints[j][0] for j in range(len(rows)) if find(j) == find(i) and prints[j][0] is not None]
        out[i] = min(ids) if ids else None
    return prints, out


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_ball_links_against_all_pairs(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(0, 4))) for b in base for _ in range(6)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = {(r["a"], r["b"]) for r in simhash.ball_links(spark.createDataFrame(signed, "fp long"), radius).collect()}
    plain = [p for (p,) in signed]
    near = {(min(a, b), max(a, b)) for a in plain for b in plain if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius}
    assert links <= near

    def classes(pairs):
        root = {p: p for p in plain}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return {p: find(p) for p in plain}

    assert classes(links) == classes(near)


def test_simhash_groups_and_representatives(spark):
    a = "the quick brown fox jumps over the lazy dog again and again until it is dark outside"
    rows = [(5, a), (3, a), (3, a), (None, a), (9, None), (8, ""), (7, "one"), (6, "One"), (None, "lonely words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", __import__("pyspark").sql.functions.lit("x"))
    prints, want = brute_groups(rows)
    got = sorted((str(r["doc_id"]), r["fp"], r["component_id"]) for r in simhash.simhash_groups(docs).collect())
    assert got == sorted((str(d), p - (1 << 64) if p >> 63 else p, want[i]) for i, (d, p) in enumerate(prints))
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["3", "8", "6", "None"])
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_cut_text_keeps_whole_characters():
    text = "aéb".encode()
    assert suffix_dedup.cut_text(text, [(0, 2)]) == "éb".encode()
    assert suffix_dedup.cut_text(text, [(2, 4)]) == "aé".encode()
    assert suffix_dedup.cut_text(text, [(1, 3)]) == b"ab"
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def _link_counts(ids, vectors, labels, threshold=0.98):
    unit = np.array(vectors, np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= threshold) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(near)):
        root[find(i)] = find(j)
    least = {}
    for i, v in enumerate(ids):
        least[find(i)] = min(least.get(find(i), v), v)
    return {v: (int(near[i].sum()), least[find(i)]) for i, v in enumerate(ids)}


@pytest.mark.parametrize("block,heads", [(1024, 64), (32, 3)])
def test_links_of_groups(spark, monkeypatch, block, heads):
    monkeypatch.setattr(neighbours.group_links, "__defaults__", (block,))
    monkeypatch.setattr(neighbours, "HEADS", heads)
    rng = np.random.default_rng(block)
    vectors, labels = [], []

    def around(middle, number, noise, label):
        for _ in range(number):
            vectors.append((middle + noise * rng.normal(size=16)).astype(np.float32))
            labels.append(label)

    for label in range(3):
        around(rng.normal(size=16) * 3, 300, 0.02, label)  # every pair is a link
        around(rng.normal(size=16) * 3, 250, 0.45, label)  # some pairs are
        for _ in range(60):
            around(rng.normal(size=16) * 3, 4, 0.2, label)
        around(np.zeros(16), 200, 1.0, label)
    vectors += vectors[:40] + [vectors[7]] * 50
    labels += labels[:40] + [labels[7]] * 50
    ids = rng.permutation(len(vectors)).tolist()
    rows = spark.createDataFrame([(i, [float(x) for x in v], label) for i, v, label in zip(ids, vectors, labels)], "vec_id long, embedding array<float>, label int").repartition(5)
    got = neighbours.near_duplicates(rows).collect()
    want = _link_counts(ids, vectors, labels)
    wrong = [r["vec_id"] for r in got if (r["n_links"], r["component_id"]) != want[r["vec_id"]]]
    assert len(got) == len(ids) and not wrong, (len(wrong), len(ids))
    assert all(r["audited_recall"] >= 0.99 and r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_short_recall_is_an_error(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(40)]
    rows += [(100 + i, rows[i][1][:7] + [rows[i][1][7] + 1e-3], 0) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    with pytest.raises(RuntimeError):
        neighbours.links(neighbours.classes(vectors), recall=1.1, passes=2)


TEXTS = ["", None, "Don't 'stop' it's 5.6%…", "caf\u00e9. CAF\u00c9 cafe\u0301, \u212a.", "<|endoftext|> a <|EndOfText|>. <|endoftext|>.", "x" * 9000, "one, two; three! " * 6000, "\u65e5\u672c\u8a9e, \u00a0 \u2028 z\u200b.", "a=\u0338b <.'s", "\x00 \x1f."]


def test_ids_of_chunks_are_ids_of_texts():
    from tokenizers import Tokenizer

    plain, ours = Tokenizer.from_file(packing.tokenizer_path()), packing.PieceIds(packing.tokenizer_path(), most=40)
    rng = random.Random(2)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("abcDE '.,-%5\u00e9\u00df\n\t\u2026") for _ in range(60)) for _ in range(300)]
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        for text, raw in zip(part, ours.texts([t.encode() for t in part])):
            assert np.frombuffer(raw, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packed_tables(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    rng = random.Random(6)
    texts = TEXTS + ["word " * rng.choice([3, 40, 300, 600, 1500, 3000, 4100]) for _ in range(120)]
    rows = [(i or None, t, 0, "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[3:5], "doc_id long, text string, offset int, sequence_id string").repartition(3)
    got = packing.pack_documents(docs, packing.tokenizer_path(), step_ids=1 << 14).collect()
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in rows}
    pieces, sequences, loads = {}, {}, {}
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["tier"], r["step_group"]))
    for doc_id, own in ids.items():
        copies = 2 if doc_id in (3, 4) else 1
        covered = np.zeros(len(own), int)
        for start, length in pieces[doc_id]:
            covered[start : start + length] += 1
        assert (covered == copies).all()
    for parts in sequences.values():
        at = 0
        for offset, length, tier, group in sorted(parts):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= tier <= 4096 and (at == tier or tier == 512)
        loads[group] = loads.get(group, 0) + at
    tiers = [parts[0][2] for parts in sequences.values()]
    assert {512, 1024, 2048, 4096} <= set(tiers)
    assert packing.pack_documents(docs.limit(0), packing.tokenizer_path()).count() == 0


def test_step_groups_are_even():
    rng = random.Random(4)
    sizes = [rng.choice([512, 1024, 2048, 4096]) for _ in range(500)]
    groups = packing.step_groups(sizes, 9)
    loads = [sum(s for s, g in zip(sizes, groups) if g == k) for k in range(9)]
    assert max(loads) - min(loads) <= 512 and packing.step_groups([], 1) == []


def test_offsets_in_archives_of_any_size(spark):
    from tallyspark.llm import fixity

    rng = random.Random(11)
    rows = [(rng.choice([0, 0, 0, 1, 2, None]), rng.choice([None, *range(300)]), bytes(rng.randrange(0, 40))) for _ in range(2000)]
    records = spark.createDataFrame([(a, i, bytearray(b)) for a, i, b in rows], "archive long, record_id long, bytes binary").repartition(7)
    got = [tuple(r) for r in fixity.lay_out(records).select("archive", "record_id", "digest", "n_bytes", "offset").collect()]
    assert len(got) == 2000
    for archive in (0, 1, 2, None):
        own = sorted((r for r in got if r[0] == archive), key=lambda r: (r[4], r[3] > 0))
        at = 0
        for r in own:
            assert r[4] == at
            at += r[3]
        order = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [r[4] for r in order] == sorted(r[4] for r in own)
    assert fixity.lay_out(records.limit(0)).count() == 0
