import tracemalloc

import public_tokenizers

from marketlens.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_known_words_are_not_held_as_strings():
    own = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = [" some words that come again and again" * 150] * 300  # 315,000 words
    want = own.encode(texts[0])
    tracemalloc.start()
    for known in own.pre_tokens(texts):
        assert len(known) == 1_050
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 8 << 20
    assert [i for ids, _, _ in known for i in ids] == want


def test_pairs_are_made_once():
    pairs, text = bpe.pairs_of(RANKS), "Ünïcödé words, unheardofly 123 joined\n\n  "
    own = bpe.Encoder(RANKS, public_tokenizers.PATTERN, pairs, written=False)
    assert own.pair is pairs[0] and own.encode(text) == bpe.Encoder(RANKS, public_tokenizers.PATTERN).encode(text)
    assert {written for known in own.pre_tokens([text]) for _, written, _ in known} == {""}


def test_words_that_come_again_stay_known(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20_000)
    own, merged = bpe.Encoder(RANKS, public_tokenizers.PATTERN), []
    merge = own.merge
    monkeypatch.setattr(own, "merge", lambda raw: merged.extend(raw) or merge(raw))
    for k in range(40):
        text = " unheardofly anotherwise" * 3 + "".join(f" odd{chr(97 + k % 26)}q{chr(97 + i % 26)}zx{'y' * (k // 26)}" for i in range(26))
        ids, begin = own.ids_of([text, "", text])
        assert own.decode(ids.tolist()) == (text * 2).encode() and begin[1] == begin[2] and begin[3] == 2 * begin[1] == len(ids)
        assert len(own.known) < 160
    assert merged.count(b" unheardofly") == 1 and len(merged) > 900


def test_bytes_and_text_of_ids():
    own = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    ids, begin = own.ids_of(["Ünïcödé words", ""])
    data, at = own.decoded(ids)
    numbers, place = own.as_text(ids)
    assert data.tobytes() == "Ünïcödé words".encode() and at[begin].tolist() == [0, len(data), len(data)]
    assert numbers.tobytes().decode().split() == list(map(str, ids.tolist())) and place[-1] == len(numbers)
