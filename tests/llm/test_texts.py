"""Repeated strings, language-model scores and the shingle join against brute force."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.llm import jaccard_join, lm_score, suffix_dedup
from marketlens.llm.words import word_hashes


def frame_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def kept_bytes(texts, length):
    """(bytes that stay, number of removed runs) of each text."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                covered[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((np.frombuffer(b, np.uint8)[~covered].tobytes(), runs))
    return out


def random_texts(seed, alphabet="ab", n=60):
    draw = random.Random(seed)
    parts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 60))) for _ in range(12)]
    texts = ["".join(draw.choice(parts) + draw.choice(["", "é", "x"]) for _ in range(draw.randrange(0, 8))) for _ in range(n)]
    return texts + [None, "", "a" * 100, "ab" * 50, texts[0], texts[0]]


@pytest.mark.parametrize(("seed", "many"), [(1, 8_192), (2, 8_192), (3, 0)])
def test_removed_bytes(spark, monkeypatch, seed, many):
    monkeypatch.setattr(suffix_dedup, "MANY_RUNS", many)  # 0: every window in the open
    texts = random_texts(seed)
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame_of(spark, texts), length=20, digit=6).collect()}
    for i, (stays, n_spans) in enumerate(kept_bytes(texts, 20)):
        size = len((texts[i] or "").encode())
        want = (size, size - len(stays), n_spans, hashlib.sha256(stays).hexdigest())
        assert (rows[i]["n_bytes"], rows[i]["n_removed"], rows[i]["n_spans"], rows[i]["kept_sha256"]) == want


def test_texts_stay_whole_characters(spark):
    texts = ["é" * 30 + "one", "x" + "é" * 30 + "two", "é" * 15 + "日本" * 8, None, "short"]
    rows = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(frame_of(spark, texts), length=21, digit=5, digest=False).collect()}
    assert rows[0] == "one" and rows[1] == "xtwo" and rows[3] is None and rows[4] == "short"
    for text, (stays, _) in zip(texts, kept_bytes(texts, 21), strict=True):
        assert text is None or len(rows[texts.index(text)].encode()) >= len(stays)


def test_odd_rows_of_repeats(odd_docs, no_docs):
    out = suffix_dedup.remove_repeats(odd_docs)
    assert set(out.columns) == {*odd_docs.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256"} - {"text"}
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[6]["n_removed"] == by_id[6]["n_bytes"] == 400 and by_id[8]["n_spans"] >= 1 and by_id[0]["n_bytes"] == 0
    text = suffix_dedup.remove_repeats(odd_docs, digest=False)
    assert {r["doc_id"]: r["text"] for r in text.collect()}[0] is None
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def tokens_of(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lower), None]


def test_base_score_is_exact(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 5)  # so that most words are joined
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 500)
    draw = random.Random(4)
    texts = [" ".join(draw.choice("The the a B c dd é 日本 e.\t\n".split() + [f"w{i}" for i in range(30)]) for _ in range(draw.randrange(40))) for _ in range(80)]
    texts += [None, "", " \n", "unseen words only"]
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(t for i, text in enumerate(texts) if not held_out(i) for t in tokens_of(text))
    total, distinct = sum(count.values()), len(count)
    frame = frame_of(spark, texts)
    rows = lm_score.score_documents(frame, F.crc32(F.col("doc_id").cast("string")) % 7 != 2).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens_of(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[t] > 0 for t in own), total)
        want = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in own)
        assert r["base_score"] == pytest.approx(want, rel=1e-12) and r["score"] < 0


def test_filter_reads_levels_back():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    levels = rng.integers(1, 12, len(hashes))
    owner = lm_score.ranges_of(hashes, 4)
    parts = [lm_score.segment(hashes[owner == i], levels[owner == i]) for i in range(4)]
    bloom = lm_score.Filter(b"".join(parts), np.array([len(p) for p in parts]))
    read = bloom.levels(hashes)
    assert (read >= levels).all() and (read == levels).mean() > 0.95
    strangers = bloom.levels(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    assert (strangers == 0).mean() > 0.95
    assert (lm_score.levels_of(np.array([1, 2, 3, 4, 1023, 1024])) == [1, 2, 2, 3, 10, 11]).all()


def test_lowest_level_keeps_to_the_bound(monkeypatch):
    monkeypatch.setattr(lm_score, "FILTER_BYTES", 1_000)
    by_level = np.zeros(64, np.int64)
    by_level[1:5] = 1_000, 200, 50, 10
    assert lm_score.lowest_level(by_level) == 2
    monkeypatch.setattr(lm_score, "FILTER_BYTES", 100_000)
    assert lm_score.lowest_level(by_level) == 1


def random_wordings(seed, n):
    draw = random.Random(seed)
    return [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.randrange(60))) for _ in range(n)] + [None, "", "unseen words only"]


def test_scores_do_not_depend_on_what_one_broadcast_holds(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(lm_score, "RANGE_BYTES", 2_000)
    monkeypatch.setattr(lm_score, "TOGETHER", 1_000)
    for docs in (frame_of(spark, random_wordings(8, 150)), odd_docs):
        rows = lambda: sorted(map(repr, lm_score.score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2).collect()))  # noqa: E731, B023
        whole = rows()
        with monkeypatch.context() as less:
            less.setattr(lm_score, "FILTER_BYTES", 10)
            assert rows() == whole


def test_a_pair_that_occurs_once_counts(spark):
    docs = frame_of(spark, ["x y", "p q", "x y", "x q", "p y"])
    score = {r["doc_id"]: r["score"] for r in lm_score.score_documents(docs, F.col("doc_id") < 2).collect()}
    assert score[2] > score[3] and score[2] > score[4]


def test_odd_rows_of_scores(odd_docs, no_docs):
    for training in (F.lit(True), F.lit(False)):
        rows = lm_score.score_documents(odd_docs, training).collect()
        assert len(rows) == odd_docs.count() and all(r["score"] <= 0 and r["base_score"] <= 0 for r in rows)
        assert {r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)} == {1}
    assert lm_score.score_documents(no_docs, F.lit(True)).count() == 0


def shingles(text, n):
    words = tokens_of(text)[:-1]
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components_of(texts, n, percent):
    sets, root = [shingles(t, n) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50), (1, 100)])
def test_components_of_similar_texts(spark, n, percent):
    """Groups of edits of edits, short texts, and a passage that all have."""
    draw = random.Random(n)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    texts, passage = [None, "", "one", "One", "two words", "two  words\n"], " ".join(word() for _ in range(30))
    for _ in range(12):
        now = [word() for _ in range(draw.randrange(3, 150))]
        texts.append(" ".join(now))
        for _ in range(draw.randrange(12)):
            now = now[:] if draw.random() < 0.5 else now
            for _ in range(draw.randrange(3)):
                now[draw.randrange(len(now))] = word()
            texts.append(" ".join(now) + (" " + passage if draw.random() < 0.3 else ""))
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_documents(frame_of(spark, texts), n, percent).collect()}
    assert [rows[i] for i in range(len(texts))] == components_of(texts, n, percent)


def near_copies(seed, n=150, words=120):
    """Texts made from one by changing some words each, so that many are just similar enough or just not."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(draw.randrange(0, 8)):
            text[draw.randrange(words)] = f"x{draw.randrange(30)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("part", [2_048, 16])
def test_classes_of_a_large_group_of_near_copies(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard_join, "PART", part)
    texts = near_copies(part)
    want = components_of(texts, 4, 85)
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link_documents(frame_of(spark, texts), 4, 85).collect()}
    assert [rows[i] for i in range(len(texts))] == want
    assert 10 < len({c for _, c in want}) < len(texts)


@pytest.mark.parametrize("part", [2_048, 7])
def test_pairs_within_leave_out_no_similar_pair(spark, monkeypatch, part):
    monkeypatch.setattr(jaccard_join, "PART", part)
    draw = np.random.default_rng(part)
    base = draw.integers(0, 2**63, 200)
    sets = []
    for _ in range(60):
        own = draw.integers(0, 2**63, draw.integers(0, 25))
        sets.append(np.concatenate([draw.choice(base, 200 - draw.integers(0, 25), replace=False), own]).astype(np.uint64))
    groups = [(t, i, len(s), len(s), i % 50, bytearray(jaccard_join.parity(s))) for i, s in enumerate(sets) for t in (1, 2)]
    frame = spark.createDataFrame(groups, "token long, cls long, size long, met long, at long, parity binary")
    rows = jaccard_join.pairs_within(frame, 80, best=False).collect()
    found = {(r["a"], r["b"]) for r in rows}
    assert len(rows) == len(found)
    for i in range(60):
        for j in range(i + 1, 60):
            both = len(np.intersect1d(sets[i], sets[j]))
            near = 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)
            assert (i, j) in found or not near or i % 50 == j % 50
    assert 0 < len(found) < 60 * 59 // 2 and all(a % 50 != b % 50 for a, b in found)
    best = {(r["a"], r["b"]): r["others"] for r in jaccard_join.pairs_within(frame, 80, best=True).collect()}
    assert set(best) <= found and {b for _, b in best} == {b for _, b in found}
    assert part < 60 or len(best) + sum(best.values()) == len(found)


def test_odd_rows_of_the_join(odd_docs, no_docs):
    rows = jaccard_join.link_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got[0] == (0, 0) and got[2] == (0, 2) and got[6][1] == got[7][1] == 6 and got[None][1] is None
    kept = jaccard_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # 7 equals 6; of the repeated rows 6 has words and stays once; rows without words or id all stay
    assert ids == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 8: 1, None: 2}
    assert jaccard_join.link_documents(no_docs).count() == 0 and jaccard_join.keep_one(no_docs).count() == 0


def test_words_of_many_texts():
    texts = [b"", b"The  quick\tTHE", b"end", b"  ", b"the"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes, count = word_hashes(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert count.tolist() == [0, 3, 1, 0, 1] and hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3


def test_pairs_are_kept_as_bits_of_the_filter_only(spark):
    """What is stored of the counts are words and segments: one row for each range, without the hashes of pairs."""
    texts = spark.createDataFrame([(f"w{i % 7} w{i % 5} w{i % 3}",) for i in range(60)] + [("",)], "text string")
    rows = lm_score.count_ngrams(texts, 3).collect()
    assert len({r["range"] for r in rows}) == len(rows) <= 3
    assert [len(r["hashes"]) for r in rows] == [8 * r["distinct"] for r in rows]
    assert sum(r["distinct"] for r in rows) == 8 and sum(r["tokens"] for r in rows) == 241
    tokens, pairs, _ = lm_score.token_hashes(*lm_score.as_bytes(texts.toArrow()["text"].combine_chunks()))
    bits = {r["range"]: r["bits"] for r in rows}
    parts = [bits.get(i, b"\0") for i in range(3)]
    held = lm_score.Filter(b"".join(parts), lm_score.np.array([len(p) for p in parts]))
    for hashes in (tokens, pairs):
        found, times = lm_score.np.unique(hashes, return_counts=True)
        assert (held.levels(found) >= lm_score.levels_of(times)).all()


def test_memory_of_runs_is_that_of_a_piece():
    draw = random.Random(5)
    texts = ["".join(draw.choice("abcdefgh ") for _ in range(2_000)) for _ in range(1_000)]
    batch = pa.RecordBatch.from_pydict({"key": pa.array(range(1_000)), "text": pa.array(texts)})
    tracemalloc.start()
    n = sum(len(found[1]) for found in suffix_dedup.runs_of(iter([batch]), 200, 50))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert n == sum(len(suffix_dedup.runs(np.frombuffer(t.encode(), np.uint8), np.array([0, 2_000]), 200, 50)[0]) for t in texts)
    assert peak < 60 << 20


def test_copies_in_a_batch_are_looked_at_once():
    batch = pa.RecordBatch.from_pydict({"key": pa.array([3, 1, 3, 2, 1]), "text": pa.array(["c", "a", "c", "b", "a"])})
    assert suffix_dedup.without_copies(batch).to_pydict() == {"key": [3, 1, 2], "text": ["c", "a", "b"]}
