"""Lexical search, shards and vector codes against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlens.llm import lexical, sharding, vector_codes

# ------------------------------------------------------------------------ lexical search


def terms_of(text):
    small = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [t for t in re.findall(rb"[0-9A-Za-z\x80-\xff]+", small)]


def ranked(docs, items, k):
    """Rows by the definition: docs and items are lists of (id, text)."""
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    n = sum(bool(c) for _, c in own)
    total = sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    terms = defaultdict(set)
    for i, text in items:
        terms[i] |= set(terms_of(text))
    out = []
    for item, asked in terms.items():
        scores = []
        for i, c in own:
            m = 10 + (90 * c.total() * n) // total if total else 10
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in asked
                if t in c
            )
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def wordings(seed, n):
    """Texts with words from the very common to the rare, copies and ties."""
    draw = random.Random(seed)
    words = [f"W{i}" for i in range(300)]
    texts = [" ".join(draw.choices(words, [1 / (i + 1) for i in range(300)], k=draw.randrange(1, 80))) for _ in range(n)]
    return texts + texts[:20] + [None, "", "...", "Ünïcödé w1,W2", "日本語w1"]


@pytest.mark.parametrize(("seed", "shard", "block", "short"), [(1, 32_768, 128, 16), (2, 40, 8, 16), (3, 100, 4, 1), (4, 100, 4, 10_000)])
def test_search_is_whole(spark, monkeypatch, seed, shard, block, short):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "STRIDE", 2)
    monkeypatch.setattr(lexical, "SHORT", short)
    docs = list(enumerate(wordings(seed, 300)))
    draw = random.Random(seed)
    items = [(i, " ".join(f"w{int(300 * draw.random() ** 3)}" for _ in range(draw.randrange(0, 25)))) for i in range(30)] + [(3, "w299 and more"), (40, None), (41, "日本語w1")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = lexical.search(frame, spark.createDataFrame(items, "item_id int, text string"), k=5).collect()
    assert sorted(tuple(r) for r in rows) == ranked(docs, items, 5)


def test_search_in_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ROUND_BYTES", 300)
    docs = list(enumerate(wordings(9, 100)))
    items = [(f"item {i}", f"w{i} w{3 * i} w1") for i in range(20)]
    rows = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), k=3).collect()
    assert sorted(tuple(r) for r in rows) == ranked(docs, items, 3)


def test_a_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 50)
    text = b" ".join([b"one", b"two" * 40, b"one,three"] * 30)
    words = lexical.Vocabulary.of([(0, [b"one", b"three", b"two" * 40])])
    n, _, term, count = lexical.count_terms(np.frombuffer(text, np.uint8), np.array([0, len(text)]), words)
    named = {words.text[words.start[t] : words.start[t] + words.size[t]].tobytes(): c for t, c in zip(term, count, strict=True)}
    assert n[0] == 120 and named == {b"one": 60, b"three": 30, b"two" * 40: 30}


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical, "term_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    words = lexical.Vocabulary.of([(0, [b"aa", b"bb", b"c"])])
    data = np.frombuffer(b"bb aa dd C", np.uint8)
    found = words.find(data, *lexical.term_spans(data, np.array([0, len(data)])))
    names = [words.text[words.start[t] : words.start[t] + words.size[t]].tobytes() if t >= 0 else None for t in found]
    assert names == [b"bb", b"aa", None, b"c"]


def test_odd_rows_of_search(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the SAME text", "x"), (2, None, "x"), (None, "text", "x"), (3, "absent", "x")], "item_id int, text string, score string")
    rows = lexical.search(odd_docs, items).collect()
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in rows) == ranked(docs, [(1, "the SAME text"), (2, None), (3, "absent")], 10)
    assert lexical.search(no_docs, items).count() == 0 and lexical.search(odd_docs, items.limit(0)).count() == 0


# ------------------------------------------------------------------------ shards


def size_of(text):
    return len((text or "").encode()) + 16


def ordinal_of(value):
    return -1 if value is None else int.from_bytes(value.encode()[:7].ljust(7, b"\0"), "big")


def brute_shards(rows, shards):
    """rows: (key, size); the shard of each row by a sort at every node."""
    dims = 3
    ends = [(min(k[d] for k, _ in rows), max(k[d] for k, _ in rows)) for d in range(dims)]
    width = [max(1, b - a) for a, b in ends]
    out = {}

    def split(own, first, n):
        if n == 1:
            for i in own:
                out[i] = first
            return
        half = n // 2
        if not own:
            return
        spread = [(max(rows[i][0][d] for i in own) - min(rows[i][0][d] for i in own)) / width[d] for d in range(dims)]
        dim = max(range(dims), key=lambda d: (spread[d], -d))
        own = sorted(own, key=lambda i: (rows[i][0][dim], *rows[i][0][dims:]))
        total = sum(rows[i][1] for i in own)
        share, at, so_far = total * half / n, 0, 0
        while at < len(own) and so_far + rows[own[at]][1] <= share:
            so_far += rows[own[at]][1]
            at += 1
        if at < len(own) and so_far + rows[own[at]][1] - share <= share - so_far:
            at += 1
        split(own[:at], first, half)
        split(own[at:], first + half, n - half)

    split(list(range(len(rows))), 0, shards)
    return out


def metadata(seed, n):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        text = draw.choice(["x" * draw.randrange(1, 400), "a copied text " * 9, "é" * draw.randrange(1, 50)])
        out.append((i, text, draw.choice(["en", "de", None]), "src0" if draw.random() < 0.4 else f"src{draw.randrange(12)}", len(text)))
    return out + [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (n + 1, "", "en", "s", 0), (None, "no id", "en", "s", 5)]


@pytest.mark.parametrize(("seed", "shards", "bins"), [(1, 40, 1_024), (2, 5, 32), (3, 1, 1_024)])
def test_shards_are_those_of_sorting(spark, monkeypatch, seed, shards, bins):
    monkeypatch.setattr(sharding, "BINS", bins)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    rows = metadata(seed, 500)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    keyed, dims = sharding._keyed(frame, sharding.dimensions(frame), "doc_id", "text")
    root, placed = sharding.grow(keyed, dims, shards)
    got = placed.collect()
    want = brute_shards([(tuple(r["key"]), r["size"]) for r in got], shards)
    assert {i: r["shard"] for i, r in enumerate(got)} == want
    told = sharding.number(placed, ["shard"], ["key"]).collect()
    slots = defaultdict(list)
    for r in told:
        slots[r["shard"]].append(r["slot"])
    assert len(told) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(k[0] == ordinal_of(s) for k, s in {(tuple(r["key"]), d[3]) for r in got for d in rows if d[0] == r["id"] and d[0] is not None and d[0] < 500})


def test_sizes_of_shards_are_near_equal(spark):
    rows = metadata(5, 3_000)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    told, tree = sharding.assign(frame, 40)
    got = told.collect()
    weight = Counter()
    for r in got:
        weight[r["shard"]] += r["size"]
    largest = max(r["size"] for r in got)
    assert len(weight) == 40 and max(weight.values()) - min(weight.values()) <= 4 * largest
    text = {i: t for i, t, *_ in rows}
    for r in got:
        assert r["size"] == size_of(text[r["doc_id"]]) and r["text_crc32"] == zlib.crc32((text[r["doc_id"]] or "").encode())
    assert tree.count() == 39 and {r["dimension"] for r in tree.collect()} <= {"source", "lang", "n_chars"}


def test_shards_as_files(spark, tmp_path):
    rows = metadata(6, 200)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, shard string")
    sharding.write_shards(frame, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.drop(sharding.SHARD).collect())) == sorted(map(str, frame.collect()))
    assert back.select(sharding.SHARD).distinct().count() == 5


def test_odd_rows_of_shards(spark, odd_docs, no_docs):
    told, _ = sharding.assign(odd_docs, 40)
    got = told.collect()
    assert len(got) == odd_docs.count() and all(0 <= r["shard"] < 40 for r in got)
    assert sharding.assign(no_docs, 40)[0].count() == 0
    alike = spark.createDataFrame([(7, "same")] * 100, "doc_id long, text string")
    assert Counter(r["shard"] for r in sharding.assign(alike, 4)[0].collect()) == {0: 25, 1: 25, 2: 25, 3: 25}


# ------------------------------------------------------------------------ vector codes


def brute_codes(vectors, parts, entries, rounds):
    """vectors: whole numbers, in the order of ids."""
    n, dim = vectors.shape
    width = dim // parts
    books, codes, error = [], [], np.zeros(n, np.int64)
    for p in range(parts):
        own = vectors[:, p * width : (p + 1) * width]
        book = own[:entries].copy()
        nearest = lambda: ((own[:, None] - book[None]) ** 2).sum(axis=2)  # noqa: E731, B023
        for _ in range(rounds):
            at = nearest().argmin(axis=1)
            for e in range(len(book)):
                if (at == e).any():
                    book[e] = own[at == e].sum(axis=0) // (at == e).sum()
        d = nearest()
        codes.append(d.argmin(axis=1))
        error += d.min(axis=1)
        books.append(book)
    return np.array(codes).T, error, np.array(books)


@pytest.mark.parametrize(("seed", "chunk", "leaf"), [(1, 8_192, 48), (2, 200, 8), (3, 64, 1)])
def test_codes_are_those_of_all_distances(spark, monkeypatch, seed, chunk, leaf):
    monkeypatch.setattr(vector_codes, "CHUNK", chunk)
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 16)) * 3
    x = (centres[rng.integers(0, 9, 900)] + rng.normal(size=(900, 16)) * rng.choice([0.0, 0.01, 1.0], 900)[:, None]).astype(np.float32)
    x[100:200] = np.round(x[100:200])  # ties
    label = [None if i % 7 == 0 else i % 3 for i in range(900)]
    frame = spark.createDataFrame([(i * 2, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int").repartition(3)
    coded, books = vector_codes.encode(frame, parts=4, entries=32, rounds=3)
    codes, error, want = brute_codes(np.floor(x.astype(float) * 1024).astype(np.int64), 4, 32, 3)
    assert (books == want).all()
    assert vector_codes.digest(books) == hashlib.sha256(",".join(str(v) for v in want.ravel()).encode()).hexdigest()
    by_label = defaultdict(int)
    for k, e in zip(label, error, strict=True):
        by_label[k] += int(e)
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in coded.collect()}
    assert got == {2 * i: ("".join(f"{c:02x}" for c in codes[i]), int(error[i]), by_label[label[i]]) for i in range(900)}


def test_balls_hold_their_points_and_prune():
    rng = np.random.default_rng(4)
    centres = np.floor(rng.normal(size=(20, 8)) * 5_000)
    points = np.floor(centres[rng.integers(0, 20, 3_000)] + rng.normal(size=(3_000, 8)) * 20).astype(np.int64)
    tree = vector_codes.Tree(points)
    assert sorted(tree.order) == list(range(3_000))
    for k in range(len(tree.low)):
        own = points[tree.order[tree.low[k] : tree.high[k]]]
        assert (own.sum(axis=0) == tree.sum[k]).all()
        assert np.sqrt(((own - tree.centre[k]) ** 2).sum(axis=1)).max() <= tree.radius[k] * (1 + 1e-9) + 1e-9
        if tree.left[k] >= 0:
            ends = sorted([(tree.low[j], tree.high[j]) for j in (tree.left[k], tree.right[k])])
            assert ends[0][0] == tree.low[k] and ends[0][1] == ends[1][0] and ends[1][1] == tree.high[k]
    looked = sum(len(row) for _, row, _ in tree.owners(points, centres))
    assert looked < 600  # balls of one cluster are owned whole by its centre


def test_many_labels_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 1)
    frame = spark.createDataFrame([(i, [float(i % 5), 0.5], [None, "a", "b"][i % 3]) for i in range(60)], "vec_id long, embedding array<float>, label string")
    coded, _ = vector_codes.encode(frame, parts=2, entries=2, rounds=1)
    rows = coded.join(frame, "vec_id").collect()
    total = defaultdict(int)
    for r in rows:
        total[r["label"]] += r["error"]
    assert len(rows) == 60 and all(r["label_error"] == total[r["label"]] for r in rows)


def test_odd_vectors_of_codes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.0, 0.0], 1), (3, [0.0, 0.0], 1), (1, None, 1), (2, [nan, 0.0], 1), (4, [inf, 0.0], 1), (5, [None, 1.0], 1), (6, [], 1),
        (7, [1.0, 2.0, 3.0, 4.0], 1), (8, [1e30, 0.0], 1), (None, [1.0, 1.0], 1), (9, [-0.0001, 1.0], None),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, code string")
    coded, books = vector_codes.encode(frame, parts=2)
    assert sorted(tuple(r) for r in coded.collect()) == [(3, "0000", 0, 0), (3, "0000", 0, 0), (9, "0202", 0, 0)]
    assert books[:, 2].ravel().tolist() == [-1, 1024]
    assert vector_codes.encode(frame.limit(0), parts=2)[0].count() == 0
    with pytest.raises(ValueError, match="cannot be cut"):
        vector_codes.encode(frame, parts=3)
