"""Toxicity, language and quality: held-out accuracy and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import langid, quality, toxicity
from marketlens.llm.frames import fold
from marketlens.llm.queries import op4_toxicity, op5_language_id, op6_quality


def labelled(frame, labels, column):
    rows = frame.join(labels, "doc_id").filter(F.col(column).isNotNull() & F.col("held_out")).collect()
    return np.array([r["predicted"] for r in rows]), np.array([r[column] for r in rows])


def test_fold_is_crc32_of_the_text(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id", 5).alias("k")).collect()
    assert all(r["k"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_toxicity_on_held_out_rows(spark, sf_dir, labels, documents):
    out = op4_toxicity(spark, sf_dir).cache()
    assert out.count() == documents.count()
    got, want = labelled(out, labels, "toxic")
    assert (got == want).mean() >= 0.88  # of few labels; see the README for larger tables


def test_long_texts_leave_the_fit_both_classes(spark, monkeypatch):
    ids = [r["id"] for r in spark.range(40).orderBy(F.xxhash64(F.col("id").cast("string"))).collect()]
    labels = spark.createDataFrame([(i, int(k >= 30)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(50)), lambda k: F.md5((k + F.col("id")).cast("string")))).alias("text"))
    taken = []
    monkeypatch.setattr(toxicity, "FIT_FEATURES", 40_000)
    monkeypatch.setattr(toxicity, "fit", lambda got, y, prior: taken.extend(y.tolist()))
    toxicity.train(docs, labels, F.lit(True))
    assert 4 <= len(taken) < 20 and abs(2 * sum(taken) - len(taken)) <= 1


def test_language_on_held_out_rows(spark, sf_dir, documents):
    out = op5_language_id(spark, sf_dir)
    rows = out.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97


def test_quality_on_held_out_rows(spark, sf_dir, labels):
    got, want = labelled(op6_quality(spark, sf_dir), labels, "quality")
    assert (got == want).mean() >= 0.93


def test_quality_learns_from_whole_texts_and_one_row_an_id(spark, monkeypatch):
    assert (quality.spread(200) == np.arange(200)).all()
    at = quality.spread(10_000)
    assert len(at) == 200 and at[0] == 0 and at[-1] == 9_999 and np.diff(at).max() < 10_000 / 7 and (np.diff(at) > 0).all()
    head, tail = "A clean line of words.\n" * 300, "$$$ !!! 999 ###\n" * 300
    docs = spark.createDataFrame([(1, head + tail), (2, head)] + [(2, head + "x" * i) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bins, size, lines, y, prior: seen.append((bins, size, lines, y)))
    quality.train(docs, labels, F.lit(True))
    bins, size, lines, y = seen[0]
    assert y.tolist() == [0, 1] and lines.tolist() == [200, 200]
    assert len(np.unique(bins[:100], axis=0)) and (bins[50] != bins[150]).any()


@pytest.fixture(scope="module")
def odd_labels(spark):
    rows = [(0, 1), (1, 0), (3, None), (4, 0), (4, 1), (5, 1), (6, 0), (6, 0), (None, 1), (999, 1)]
    return spark.createDataFrame([(i, k, k) for i, k in rows], "doc_id long, toxic int, quality int")


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows_get_a_score(odd_docs, no_docs, odd_labels, module):
    for labels in (odd_labels, odd_labels.limit(0), odd_labels.filter("toxic = 1")):
        model = module.train(odd_docs, labels, F.lit(True))
        out = module.score_documents(odd_docs, model)
        assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["score"]
        rows = out.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        by_text = {}
        for r in rows:
            by_text.setdefault(r["text"] or "", set()).add(r["score"])
        assert all(len(s) == 1 for s in by_text.values())  # null is as empty; equal texts score alike
    assert module.score_documents(no_docs, module.train(no_docs, odd_labels, F.lit(True))).count() == 0


def test_odd_rows_get_a_language(odd_docs, no_docs):
    out = langid.predict(odd_docs, langid.train(odd_docs, F.lit(True)))
    assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in out.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "en") == letters and (letters or (r["lang_pred"], r["score"]) == ("und", 0.0))
    unlearnt = langid.predict(odd_docs, langid.train(no_docs, F.lit(True))).collect()
    assert {r["lang_pred"] for r in unlearnt} == {"und"}
    assert langid.predict(no_docs, langid.train(odd_docs, F.lit(True))).count() == 0


def test_gradient_of_the_net():
    rng = np.random.default_rng(0)
    net = langid.ByteNet(["a", "b", "c"])
    windows, y = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8), rng.integers(0, 3, 5)
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(5), y]).mean()
    for parameter, slope in zip(net.parameters(), net.slopes(windows, y), strict=True):
        at = np.unravel_index(np.argmax(abs(slope)), slope.shape)
        was, step = parameter[at], 1e-2
        parameter[at] = was + step
        up = loss()
        parameter[at] = was - step
        down = loss()
        parameter[at] = was
        assert (up - down) / (2 * step) == pytest.approx(slope[at], rel=0.1)


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(1)
    chain = quality.Chain(None, None, None, 0.0, rng.normal(size=(2, 2)))
    lines, emission = np.array([3, 0, 1, 4]), rng.normal(size=8)
    good, pair = chain.marginals(emission, lines)
    begin = 0
    for n in lines:
        total, single, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for code in range(2**n if n else 0):
            path = [code >> k & 1 for k in range(n)]
            weight = np.exp(sum(emission[begin + k] * s for k, s in enumerate(path)) + sum(chain.moves[a, b] for a, b in zip(path, path[1:])))
            total += weight
            single += weight * np.array(path)
            for k in range(1, n):
                joint[k, path[k - 1], path[k]] += weight
        if n:
            assert good[begin : begin + n] == pytest.approx(single / total)
            assert pair[begin + 1 : begin + n] == pytest.approx(joint[1:] / total)
        begin += n


def test_lines_are_cut_at_line_feeds():
    texts = [b"", b"one\n\ntwo", b"\n", b"no end", b"same same\nsame same\n"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    bins, size, lines = quality.line_bins(data, begin)
    assert lines.tolist() == [0, 3, 1, 1, 2] and size.tolist() == [4, 1, 3, 1, 6, 10, 10]
    assert (bins[5] == bins[6]).all() and bins.max() < quality.BINS


def test_distinct_grams():
    seen = np.zeros(toxicity.BUCKETS, np.int32)
    once = set(toxicity.grams(np.frombuffer(b"abcabcabc", np.uint8), seen).tolist())
    assert once == set(toxicity.grams(np.frombuffer(b"ABCabcabcabc", np.uint8), seen).tolist())
    assert len(once) == 9  # three of each length
    assert len(toxicity.grams(np.frombuffer(b"ab", np.uint8), seen)) == 0


def test_language_and_toxicity_learn_from_one_row_an_id(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "an english text", "en"), (2, "ein deutscher satz", "de")] + [(3, f"copy number {i} of one id " * 20, "en") for i in range(300)] + [(4, "noch ein satz", "de")],
        "doc_id long, text string, lang string",
    )
    seen = []
    monkeypatch.setattr(langid.ByteNet, "fit", lambda self, cuts, which: seen.append((self.languages, np.bincount(which).tolist(), len(cuts))))
    langid.train(docs, F.lit(True))
    (languages, windows, n), = seen
    assert languages == ["de", "en"] and windows[0] == 2 and 2 <= windows[1] <= 1 + langid.FIT_WINDOWS and n == sum(windows)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda got, y, prior: taken.append((len(got), y.tolist(), prior)))
    toxicity.train(docs, labels, F.lit(True))
    assert taken == [(4, [0, 1, 0, 1], 0.5)]


def test_any_number_of_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "FIT_ALL", 100)
    monkeypatch.setattr(langid.ByteNet, "fit", lambda self, cuts, which: None)
    docs = spark.range(1_800).select(F.col("id").alias("doc_id"), F.lit("some letters").alias("text"), F.concat(F.lit("l"), (F.col("id") % 600).cast("string")).alias("lang"))
    assert len(langid.train(docs, F.lit(True)).languages) == 600


def test_toxicity_scores_by_hand(spark):
    """Ratios and scores of a small fit, worked out feature by feature."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 12)) for _ in range(60)]
    labels = np.array([int(3 in x) for x in rows])
    model = toxicity.fit([x.astype(np.uint32) for x in rows], labels, 0.25)
    n1, n0 = labels.sum(), (1 - labels).sum()
    for feature in range(40):
        p = 1 + sum(feature in x for x, y in zip(rows, labels, strict=True) if y)
        q = 1 + sum(feature in x for x, y in zip(rows, labels, strict=True) if not y)
        ratio = np.log(p / (n1 + 1)) - np.log(q / (n0 + 1))
        if abs(ratio) < toxicity.LEAST_ERRORS * np.sqrt(1 / p + 1 / q):
            assert model.weights[feature] == 0
        elif model.weights[feature]:
            assert model.weights[feature] * ratio > 0  # of the sign of its ratio
    for x in rows[:10]:
        z = model.intercept + sum(float(model.weights[f]) for f in x)
        assert model.score(x.astype(np.uint32)) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
