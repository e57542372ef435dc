"""Byte-level BPE with a rank queue made of a two-level bitmap.

Every merge rank has a bucket that holds positions of the linked list of symbols. A bitmap tells which buckets hold
anything: one word of 256 bits for each 256 ranks, and one word above them. Find-first-set on the upper word, then on
the lower one, gives the next rank without a heap. A position stays in its old bucket when its pair changes; such stale
entries are skipped when they come up. The work is linear in the number of merges, also for one very long pre-token.

All pre-tokens that a batch of texts has and that are not remembered yet are merged as one list with borders that no pair
crosses. Ranks come up in ascending order within every pre-token, so the result is that of merging each by itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import as_bytes, as_strings, pieces

#: Bytes of memory, by estimate, that a worker's remembered pre-tokens take before those of little use are forgotten. Longer pre-tokens than
#: LONG bytes are forgotten with the texts they came with.
REMEMBERED = 32 << 20
LONG = 128

#: Bytes of text whose new pre-tokens are merged together.
TOGETHER = 2 << 20

OUTPUT = "n_tokens long, ids array<int>, decoded binary"
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pairs_of(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, set[int]]:
    """Every pair of tokens that merges, as one number, ascending; its rank; and the ranks of which one pair can begin with
    the symbol that ends another."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"ranks lack the single bytes {missing[:5]}")
    base = max(ranks.values()) + 2
    get = ranks.get
    pairs = sorted(
        (a * base + b, rank, a, b)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None
    )
    firsts: dict[int, set[int]] = {}
    seconds: dict[int, set[int]] = {}
    for _, rank, a, b in pairs:
        firsts.setdefault(rank, set()).add(a)
        seconds.setdefault(rank, set()).add(b)
    return (
        np.array([x[0] for x in pairs] + [np.iinfo(np.int64).max], np.int64),
        np.array([x[1] for x in pairs] + [-1], np.int64),
        {rank for rank, a in firsts.items() if a & seconds[rank]},
    )


class Encoder:
    """Encodes and decodes by ranks. `pairs` are those of `pairs_of`, if they are there already; without `written` ids are
    not given as text.

    `known` numbers the pre-tokens that are remembered. The ids of all of them lie in one array, a pre-token's behind those
    of the number before it, and how often each came up lies in another.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: tuple[np.ndarray, np.ndarray, set[int]] | None = None, written: bool = True):
        self.pair, self.pair_rank, self.overlapping = pairs or pairs_of(ranks)
        self.ranks = ranks
        self.findall = regex.compile(pattern).findall
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.border = max(self.token) + 1
        self.base = self.border + 1
        self.written = written
        self.tokens = pa.array([self.token.get(i, b"") for i in range(self.border)], pa.large_binary())
        self.numbers = pa.array([b"%d " % i for i in range(self.border)], pa.large_binary()) if written else None
        self._remember_only([], np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def encode(self, text: str) -> list[int]:
        return self.ids_of([text])[0].tolist()

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more offset than texts)."""
        row, begin = self.rows_of(texts)
        many = self.many[row]
        stop = np.append(0, np.cumsum(many))
        at = np.repeat(self.begin[row] - stop[:-1], many)
        at += np.arange(len(at))
        return self.ids[at], stop[begin]

    def rows_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' pre-tokens in a row, all known now, and where each text's begin."""
        self.forget()
        before, number = len(self.known), self.known.__getitem__  # which numbers a new pre-token
        row = []
        for text in texts:
            words = self.findall(text)
            row.append(np.fromiter(map(number, words), np.int32, len(words)))
        begin = np.cumsum([0, *map(len, row)])
        row = np.concatenate([np.zeros(0, np.int32), *row])
        self.learn(list(islice(self.known, before, None)))
        self.uses += np.bincount(row, minlength=len(self.uses))
        return row, begin

    def pre_tokens(self, texts: list[str]) -> Iterator[list[tuple]]:
        """For each text what is known of its pre-tokens: ids, ids as text, and the bytes that the ids decode to."""
        row, begin = self.rows_of(texts)
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            known = []
            for k in row[a:b].tolist():
                ids = tuple(self.ids[self.begin[k] : self.begin[k] + self.many[k]].tolist())
                known.append((ids, " ".join(map(str, ids)) if self.written else "", self.decode(ids)))
            yield known

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the ids decode to, and where those of each id begin."""
        return as_bytes(self.tokens.take(pa.array(ids)))

    def as_text(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids as decimal numbers, a space after each, and where each begins."""
        return as_bytes(self.numbers.take(pa.array(ids)))

    def forget(self) -> None:
        """Forget long pre-tokens and, if all take too much, those that came up only once; of the others the most used
        stay, half of what may be held."""
        if not self.passing and self.held <= REMEMBERED:
            return
        words = list(self.known)
        cost = self._cost(np.fromiter(map(len, words), np.int64, len(words)), self.many)
        keep = np.ones(len(words), bool)
        keep[self.passing] = False
        if self.held > REMEMBERED:
            keep &= self.uses > 1
            often = np.flatnonzero(keep)
            often = often[np.argsort(-self.uses[often], kind="stable")]
            keep[often[np.cumsum(cost[often]) > REMEMBERED // 2]] = False
        at = np.flatnonzero(keep).tolist()
        uses = self.uses[keep]
        self._remember_only([words[i] for i in at], self.ids[np.repeat(keep, self.many)], self.many[keep], uses - uses // 2)
        self.held = int(cost[keep].sum())

    def _remember_only(self, words: list[str], ids: np.ndarray, many: np.ndarray, uses: np.ndarray) -> None:
        self.known: dict[str, int] = defaultdict(count(len(words)).__next__, zip(words, range(len(words)), strict=True))
        self.ids, self.many, self.uses = ids, many, uses
        self.begin = np.cumsum(many) - many
        self.held = 0
        self.passing: list[int] = []

    @staticmethod
    def _cost(chars: np.ndarray, many: np.ndarray) -> np.ndarray:
        """Bytes that a pre-token takes, about: a string, a number, their place in the dictionary and in the arrays."""
        return 280 + 2 * chars + 4 * many

    def learn(self, new: list[str]) -> None:
        """Remember the ids of these pre-tokens, the last that were numbered; those of long ones until the next `forget`."""
        if not new:
            return
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        whole = list(map(self.ranks.get, raw))  # a pre-token that is a token needs no merges
        hard = np.array([rank is None for rank in whole])
        many = np.ones(len(new), np.int64)
        merged, many[hard] = self.merge([piece for piece, rank in zip(raw, whole, strict=True) if rank is None])
        ids = np.empty(int(many.sum()), np.int32)
        of_hard = np.repeat(hard, many)
        ids[of_hard] = merged
        ids[~of_hard] = [rank for rank in whole if rank is not None]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.passing = (len(self.many) + np.flatnonzero(size > LONG)).tolist()
        short = size <= LONG
        self.held += int(self._cost(np.fromiter(map(len, new), np.int64, len(new)), many)[short].sum())
        self.ids, self.many = np.concatenate([self.ids, ids]), np.concatenate([self.many, many])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        self.begin = np.cumsum(self.many) - self.many

    def merge(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all byte strings in a row and how many each has, merged by lowest rank first and leftmost first among
        equals."""
        if not raw:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.array([len(x) for x in raw], np.int64)
        ends = np.cumsum(sizes + 1) - 1  # a border stands after each pre-token
        n = int(ends[-1]) + 1
        inner = np.ones(n, bool)
        inner[ends] = False
        symbol = np.full(n, self.border, np.int64)
        symbol[inner] = self.byte_rank[np.frombuffer(b"".join(raw), np.uint8)]
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
        now = np.full(n, -1, np.int64)  # rank of the pair that begins here
        now[:-1] = self._rank_of(symbol[:-1], symbol[1:])
        alive = np.ones(n, bool)
        again: set[int] = set()

        buckets: dict[int, list[np.ndarray]] = {}
        lower: dict[int, int] = {}
        upper = 0
        fresh, ranks = np.flatnonzero(now >= 0), now[now >= 0]
        while True:
            order = np.argsort(ranks, kind="stable")
            fresh, ranks = fresh[order], ranks[order]
            begins = np.ones(len(ranks), bool)
            np.not_equal(ranks[1:], ranks[:-1], out=begins[1:])
            starts = np.flatnonzero(begins)
            for rank, a, b in zip(ranks[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(ranks)], strict=False):
                if rank in buckets:
                    buckets[rank].append(fresh[a:b])
                else:
                    buckets[rank] = [fresh[a:b]]
                    lower[rank >> 8] = lower.get(rank >> 8, 0) | 1 << (rank & 255)
                    upper |= 1 << (rank >> 8)
            if not upper:
                break
            high = (upper & -upper).bit_length() - 1
            word = lower[high]
            rank = high << 8 | (word & -word).bit_length() - 1
            word &= word - 1
            lower[high] = word
            if not word:
                upper &= upper - 1

            at = np.concatenate(buckets.pop(rank))
            at = at[now[at] == rank]  # the others are stale
            at.sort()
            gone = right[at]
            if len(at) > 1 and rank in self.overlapping:
                keep = _apart(at.tolist(), gone.tolist())
                at, gone = at[keep], gone[keep]
            after = right[gone]
            beside = np.flatnonzero(after[:-1] == at[1:])
            if len(beside):  # singly, the left one would meet the first half of the right one for a while
                met = self._rank_of(np.full(len(beside), rank), symbol[after[beside]])
                again.update(np.searchsorted(ends, at[beside[(met >= 0) & (met < rank)]]).tolist())
            symbol[at] = rank
            alive[gone] = False
            now[gone] = -1
            right[at] = after
            left[after] = at
            before = left[at]
            fresh = np.concatenate([at, before[before >= 0]])
            now[fresh] = ranks = self._rank_of(symbol[fresh], symbol[right[fresh]])
            fresh, ranks = fresh[ranks >= 0], ranks[ranks >= 0]
            if len(ranks) and ranks.min() < rank:  # rare: that pair may have had to come before others of this rank
                again.update(np.searchsorted(ends, fresh[ranks < rank]).tolist())

        left_over = symbol[alive]
        stops = np.flatnonzero(left_over == self.border)
        ids, many = left_over[left_over != self.border], np.diff(stops, prepend=-1) - 1
        if again:
            parts = np.split(ids, np.cumsum(many)[:-1])
            for i in again:
                parts[i] = np.array(self.merge_singly(raw[i]), np.int64)
            ids, many = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, many

    def merge_singly(self, piece: bytes) -> tuple[int, ...]:
        """The same queue, one merge at a time: for pre-tokens in which a merge makes a pair of a lower rank."""
        n = len(piece)
        symbol = [*self.byte_rank[np.frombuffer(piece, np.uint8)].tolist(), self.border]
        right, left, now = list(range(1, n + 2)), list(range(-1, n)), [-1] * (n + 1)
        buckets: dict[int, list[int]] = {}
        lower: dict[int, int] = {}
        upper, touched = 0, range(n)
        while True:
            for p in touched:
                joined = self.token[symbol[p]] + self.token[symbol[right[p]]] if right[p] < n else b""
                now[p] = rank = self.ranks.get(joined, -1)
                if rank >= 0:
                    buckets.setdefault(rank, []).append(p)
                    lower[rank >> 8] = lower.get(rank >> 8, 0) | 1 << (rank & 255)
                    upper |= 1 << (rank >> 8)
            if not upper:
                break
            high = (upper & -upper).bit_length() - 1
            rank = high << 8 | (lower[high] & -lower[high]).bit_length() - 1
            bucket = buckets[rank]
            bucket.sort(reverse=True)  # nearly in order
            p = bucket.pop()
            if not bucket:
                del buckets[rank]
                lower[high] &= lower[high] - 1
                if not lower[high]:
                    upper &= upper - 1
            touched = ()
            if now[p] == rank:  # else stale
                q = right[p]
                symbol[p], now[q], right[p] = rank, -1, right[q]
                left[right[p]] = p
                touched = (p, left[p]) if left[p] >= 0 else (p,)
        ids, p = [], 0
        while p < n:
            ids.append(symbol[p])
            p = right[p]
        return tuple(ids)

    def _rank_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = first * self.base + second
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.pair_rank[at], -1)


def _apart(at: list[int], gone: list[int]) -> list[int]:
    """Which pairs stand when those that overlap an earlier one fall."""
    keep, taken = [], -1
    for i, (p, q) in enumerate(zip(at, gone, strict=True)):
        if p != taken:
            keep.append(i)
            taken = q
    return keep


def _with_columns(docs: DataFrame, added: str) -> T.StructType:
    new = T.StructType.fromDDL(added)
    clash = {f.name.lower() for f in new}
    return T.StructType([f for f in docs.schema if f.name.lower() not in clash] + list(new))


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", digest: bool = False) -> DataFrame:
    """Each row of `docs` with its ids and the bytes that the ids decode to, or with sha256 digests of both.

    The other columns stay; one that is named like an added column gives way to it. Null and empty texts have no tokens
    and decode to no bytes. Strings of special tokens are ordinary text. Repeated rows are encoded each. Texts are taken
    whole. Bytes that are not UTF-8 are read as U+FFFD. The ranks must hold every single byte.
    """
    # as large as the vocabulary; what takes much memory to make is made once, and unfit ranks are refused here, not in a task
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks, "pairs": pairs_of(ranks)})
    schema = _with_columns(docs, DIGEST if digest else OUTPUT)
    added = [f.name for f in schema][-3:]
    kept = [f.name for f in schema][:-3]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "encoder" not in shared.value:  # kept by the worker for its next tasks
            shared.value["encoder"] = Encoder(shared.value["ranks"], pattern, shared.value["pairs"], digest)
        bpe = shared.value["encoder"]
        for batch in batches:
            for part in pieces(batch, text, TOGETHER):
                ids, begin = bpe.ids_of(as_strings(part.column(text)))
                data, at = bpe.decoded(ids)
                at = at[begin]
                if digest:
                    numbers, place = bpe.as_text(ids)
                    place = place[begin].tolist()
                    written = [numbers[a : max(a, b - 1)] for a, b in zip(place[:-1], place[1:], strict=True)]
                    back = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    new = [pa.array([hashlib.sha256(x).hexdigest() for x in of], pa.string()) for of in (written, back)]
                else:
                    back = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
                    new = [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids)), back]
                new = [pa.array(np.diff(begin), pa.int64()), *new]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + new, names=kept + added)

    return docs.mapInArrow(rows, schema)


def decode_ids(frame: DataFrame, ranks: dict[bytes, int], ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The frame with the bytes that a column of ids stands for; null ids give null, an unknown id is an error."""
    tokens = frame.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    schema = _with_columns(frame, f"{to} binary")
    kept = [f.name for f in schema][:-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.value.__getitem__
        for batch in batches:
            out = [None if x is None else b"".join(map(token, x)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(out, pa.binary())], names=[*kept, to])

    return frame.mapInArrow(rows, schema)
