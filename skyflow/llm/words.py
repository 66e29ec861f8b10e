"""Words of many texts at once, as hashes and places."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[_SPACES] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20260).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)   # seeded: the same everywhere
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
STEP = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    have, top = 1, int(base)
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = out[:more] * np.uint64(top)
        have, top = have + more, top * top % 2**64
    return out[:n]


@dataclass
class Words:
    data: bytes              # the UTF-8 of all texts, as given, each followed by a line break
    begin: np.ndarray        # of each word in data
    end: np.ndarray
    hashes: np.ndarray       # 64 bits of each word
    first: np.ndarray        # index of each text's first word, and the number of words at last


def words_of(texts: Sequence[str], lower: bool = False) -> Words:
    """Maximal stretches of bytes other than space and control white space; `lower` hashes A-Z as a-z."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = b"\n".join(raw) + b"\n"
    b = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[b]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    sizes = end - begin
    if len(begin):
        values = _BYTE[_LOWER[b] if lower else b]
        values[space] = 0
        place = np.arange(len(b)) - np.repeat(np.append(0, begin), np.diff(np.concatenate([[0], begin, [len(b)]])))
        place[: begin[0]] = 0
        place[space] = 0
        values *= powers(int(_BASE), int(sizes.max()))[place]
        hashes = mix(np.add.reduceat(values, begin) + sizes.astype(np.uint64))
    else:
        hashes = np.empty(0, np.uint64)
    stops = np.cumsum([len(r) + 1 for r in raw])
    return Words(data, begin, end, hashes, np.concatenate([[0], np.searchsorted(begin, stops)]).astype(np.int64))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every n neighbouring words (those across texts included)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    power = powers(STEP, n)
    if n <= 8:
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for j in range(n):
            out += hashes[j:len(hashes) - n + 1 + j] * power[j]
        return mix(out)
    inverse = pow(STEP, -1, 2**64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(STEP, len(hashes)))])
    return mix((total[n:] - total[:-n]) * powers(inverse, len(hashes) - n + 1))


def span_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the words from begin to end of each span; equal words have equal hashes wherever they stand."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(STEP, len(hashes)))])
    back = powers(pow(STEP, -1, 2**64), len(hashes) + 1)
    return mix((total[end] - total[begin]) * back[begin] + mix((end - begin).astype(np.uint64)))
