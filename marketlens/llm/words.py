"""Words of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space and the control characters 9 to 13; A to Z count as small letters. The hash is a
polynomial over random 64-bit values of the bytes, finalised so that all its bits are of use.
"""

from __future__ import annotations

import numpy as np

from .frames import mixed

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
with np.errstate(over="ignore"):
    _VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_BLANK] = 0
_STEP = 0x5851F42D4C957F2D
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n powers of the step and of its inverse, modulo 2^64; kept for the next call."""
    if len(_POWERS.get("up", ())) < n:
        most = 1 << max(n - 1, 1).bit_length()
        for name, base in (("up", _STEP), ("down", _BACK)):
            steps = np.full(most, base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many words each text has. No word reaches across texts."""
    n_docs = len(begin) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    ink = ~_BLANK[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    at = begin[:-1][begin[:-1] < len(data)]
    first[at] = ink[at]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n_docs, np.int64)
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        letters = _VALUE[data]
        letters *= up
        hashes = mixed(np.add.reduceat(letters, start) * down[start])
    count = np.diff(np.searchsorted(start, begin))
    return hashes, count


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of an ordered pair of hashes."""
    with np.errstate(over="ignore"):
        return mixed(first * np.uint64(0xD6E8FEB86659FD93) + (second ^ (second >> np.uint64(32))))


def shingle_hashes(words: np.ndarray, count: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text; with fewer words the whole sequence is its only one, and a text
    without words has none."""
    out = []
    with np.errstate(over="ignore"):
        run = words.copy()
        if len(words) >= n:
            run = words[: len(words) - n + 1].copy()
            for k in range(1, n):
                run = pair_hash(run, words[k : len(words) - n + 1 + k])
        stop = 0
        for k in count.tolist():
            begin, stop = stop, stop + k
            if k >= n:
                out.append(np.unique(run[begin : stop - n + 1]))
            elif k:
                whole = words[begin : begin + 1]
                for i in range(begin + 1, stop):
                    whole = pair_hash(whole, words[i : i + 1])
                out.append(mixed(whole + np.uint64(k)))  # not to be taken for a whole shingle
            else:
                out.append(np.zeros(0, np.uint64))
    return out
