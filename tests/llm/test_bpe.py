import random

import public_tokenizers
import pytest
import tiktoken

from marketlens.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


def library(ranks, pattern=PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library():
    own, theirs, draw = bpe.Encoder(RANKS, PATTERN), library(RANKS), random.Random(1)
    texts = ["", "aaaa", "aaaaaaa " * 50, "<|endoftext|>", "  \n\n\t a", "日本語😀" * 30, "ab" * 2_000, "x" * 5_000]
    texts += ["".join(draw.choice("abcdeé \n'st😀1") for _ in range(draw.randrange(200))) for _ in range(300)]
    for text, known in zip(texts, own.pre_tokens(texts), strict=True):
        ids = [i for ids, _, _ in known for i in ids]
        assert ids == theirs.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_ranks_that_merge_out_of_order():
    """A merge may make a pair of a lower rank than its own; pairs of one rank may overlap."""
    draw = random.Random(2)
    for _ in range(40):
        tokens, extra = [bytes([b]) for b in range(256)], set()
        while len(extra) < 25:
            extra.add(bytes(draw.choice(b"ab") for _ in range(draw.randrange(2, 6))))
        tokens += draw.sample(sorted(extra), len(extra))
        ranks = {t: i for i, t in enumerate(tokens)}
        own, theirs = bpe.Encoder(ranks, r"\S+|\s+"), library(ranks, r"\S+|\s+")
        for _ in range(20):
            word = "".join(draw.choice("ab") for _ in range(draw.randrange(1, 40)))
            assert own.encode(word) == theirs.encode_ordinary(word)
            if word.encode() not in ranks:
                assert list(own.merge_singly(word.encode())) == theirs.encode_ordinary(word)


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    own, theirs = bpe.Encoder(RANKS, PATTERN), library(RANKS)
    for k in range(30):
        text = " ".join(f"word{k}x{i}" for i in range(20))
        assert own.encode(text) == theirs.encode_ordinary(text)
    assert len(own.known) < 200


def test_long_pre_tokens_are_not_remembered():
    own, theirs = bpe.Encoder(RANKS, PATTERN), library(RANKS)
    long = "abcdefgh" * 500
    for text in (long, f"{long} and {long}", "short words", ""):
        assert own.encode(text) == theirs.encode_ordinary(text)
    assert long not in own.known and "short" in own.known and 0 < own.held < 10_000


def test_odd_rows(odd_docs, no_docs):
    out = bpe.encode_documents(odd_docs, RANKS, PATTERN)
    assert out.columns == [c for c in odd_docs.columns if c != "n_tokens"] + ["n_tokens", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    theirs = library(RANKS)
    for r in rows:
        assert r["ids"] == theirs.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    back = bpe.decode_ids(out.select("decoded", "ids"), RANKS, to="again").collect()
    assert all(r["again"] == r["decoded"] for r in back)
    assert bpe.encode_documents(no_docs, RANKS, PATTERN).count() == 0


def test_ranks_without_a_byte(odd_docs):
    with pytest.raises(ValueError, match="single bytes"):
        bpe.encode_documents(odd_docs, {b"a": 0}, PATTERN)
