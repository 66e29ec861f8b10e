"""Patched frame-of-reference coding of token ids.

Values are cut into blocks of 256. A block stores its minimum, the differences to it at the bit width that the chosen
share of its values needs, and the higher bits of the others in an exception list. The starts of the blocks' words are
kept as an index, so that any block can be read alone. Everything is done for many blocks at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
PERCENTILE = 0.9
_LANES = 8                      # a block is 32 rows of 8 values; a row of bit position i holds value i of every lane
_ROWS = BLOCK // _LANES
_MAGIC = 0x31424650             # "PFB1"


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """[blocks, 32, 8] values below 2**width to [blocks, width, 8] words."""
    out = np.zeros((len(rows), width, _LANES), np.uint32)
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        out[:, word] |= rows[:, i] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= rows[:, i] >> np.uint32(32 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.empty((len(words), _ROWS, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for i in range(_ROWS):
        word, shift = divmod(i * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | (words[:, word + 1] << np.uint32(32 - shift))
        out[:, i] = value & mask
    return out


def encode(values: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Unsigned 32-bit values as one byte string: header, minima, widths, exception counts, block starts, words, exceptions."""
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = values
    if n < len(padded):
        padded[n:] = padded[n - 1]
    table = padded.reshape(blocks, BLOCK)
    least = table.min(axis=1, initial=0xFFFFFFFF)
    table = table - least[:, None]
    need = _widths(table)
    chosen = np.sort(need, axis=1)[:, min(BLOCK - 1, int(percentile * BLOCK))] if blocks else np.empty(0, np.uint8)
    starts = np.concatenate([[0], np.cumsum(chosen.astype(np.int64) * _LANES)]).astype(np.uint32)
    words = np.empty(int(starts[-1]), np.uint32)
    low = table & ((np.uint64(1) << chosen.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    for width in np.unique(chosen[chosen > 0]).tolist():
        of = np.flatnonzero(chosen == width)
        places = starts[of].astype(np.int64)[:, None] + np.arange(width * _LANES)
        words[places] = _pack(low[of].reshape(-1, _ROWS, _LANES), width).reshape(len(of), -1)
    block, place = np.nonzero(need > chosen[:, None])
    high = (table[block, place].astype(np.uint64) >> chosen[block].astype(np.uint64)).astype(np.uint32)
    counts = np.bincount(block, minlength=blocks).astype(np.uint16)
    header = np.array([_MAGIC, n, len(words), len(high)], np.uint32)
    return b"".join(x.tobytes() for x in (header, least, chosen, counts, starts, words, place.astype(np.uint8), high))


def _sections(data: bytes) -> tuple[int, dict[str, np.ndarray]]:
    magic, n, n_words, n_high = np.frombuffer(data, np.uint32, 4)
    if magic != _MAGIC:
        raise ValueError("not a block file")
    blocks, at, out = -(-int(n) // BLOCK), 16, {}
    for name, kind, count in (
        ("least", np.uint32, blocks), ("width", np.uint8, blocks), ("exceptions", np.uint16, blocks), ("start", np.uint32, blocks + 1),
        ("words", np.uint32, int(n_words)), ("place", np.uint8, int(n_high)), ("high", np.uint32, int(n_high)),
    ):
        out[name] = np.frombuffer(data, kind, count, at)
        at += out[name].nbytes
    return int(n), out


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """All values, or those of the blocks from `first` to `last` alone (by the index of block starts)."""
    n, s = _sections(data)
    blocks = len(s["least"])
    first = min(first, blocks)
    last = blocks if last is None else max(first, min(last, blocks))
    width = s["width"][first:last]
    out = np.zeros((last - first, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        places = s["start"][first:last][of].astype(np.int64)[:, None] + np.arange(w * _LANES)
        out[of] = _unpack(s["words"][places].reshape(len(of), w, _LANES), w).reshape(len(of), BLOCK)
    skip = int(s["exceptions"][:first].sum())
    counts = s["exceptions"][first:last].astype(np.int64)
    block = np.repeat(np.arange(last - first), counts)
    chosen = slice(skip, skip + len(block))
    out[block, s["place"][chosen]] |= (s["high"][chosen].astype(np.uint64) << width[block].astype(np.uint64)).astype(np.uint32)
    out += s["least"][first:last, None]
    return out.ravel()[: max(0, min(n, last * BLOCK) - first * BLOCK)]
