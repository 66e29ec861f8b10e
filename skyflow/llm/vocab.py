"""The two public vocabularies that the operators use, compiled to transducers; results equal those of their libraries.

Batches of texts become symbol arrays by table lookups, and `Transducer` finds the tokens. Texts that the tables don't
cover (scripts whose normalisation is not the identity, control characters, special tokens as text) are given to the
library itself, so that every text gets the library's own result.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Sequence

import numpy as np

from .transducer import Transducer

_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)
_PLAIN = 0x180          # Latin letters below this stay as they are under NFC and keep their UTF-8 length in lower case
_END = 256              # added to a word's last byte: the vocabulary writes it as an ending


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe:
    """Byte-pair encoding of lower-cased words with word ends, from a tokenizers file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._library = Tokenizer.from_file(path)
        self._special = [x["content"] for x in spec["added_tokens"]]
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        suffix = spec["model"]["end_of_word_suffix"]
        tokens: list[tuple[int, ...]] = [()] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            body = piece.removesuffix(suffix)
            symbols = [letters[c] for c in body]
            if body != piece and symbols:
                symbols[-1] += _END
            tokens[i] = tuple(symbols)
        ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self._fst = Transducer(tokens, 2 * _END, lambda a, b: ranks.get((a, b)), ends=frozenset(range(_END, 2 * _END)))
        kinds = np.full(_PLAIN, _OTHER, np.uint8)
        lower = np.arange(_PLAIN, dtype=np.int32)
        for c in range(_PLAIN):
            kind = unicodedata.category(chr(c))[0]
            kinds[c] = _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER
            if kind == "C" or c in (0x85, 0xA0, 0x130):
                kinds[c] = _ODD
            elif len(chr(c).lower()) == 1:
                lower[c] = ord(chr(c).lower())
        kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
        self._kinds, self._lower = kinds, lower
        leads = np.full(128, _ODD, np.uint8)                # bytes of longer characters; looked up below where two bytes long
        leads[:0x40] = _LETTER                              # continuation
        leads[0x42:0x40 + (_PLAIN >> 6)] = _LETTER
        self._byte_kinds = np.concatenate([kinds[:128], leads])
        self._byte_lower = np.concatenate([lower[:128], np.arange(128, 256)]).astype(np.uint8)

    def _kinds_of(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds = self._byte_kinds[b]
        two = np.flatnonzero((b >= 0xC2) & (b < 0xC0 + (_PLAIN >> 6)))
        points = ((b[two].astype(np.int32) & 0x1F) << 6) | (b[two + 1] & 0x3F)
        kinds[two] = kinds[two + 1] = self._kinds[points]
        return kinds, two, points

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has. No special tokens are added."""
        raw = [t.encode() for t in texts]
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self._special)}
        sizes = np.array([len(r) + 1 for r in raw], np.int64)
        stops = np.cumsum(sizes)
        b = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.empty(0, np.uint8)
        kinds, two, points = self._kinds_of(b)
        odd |= set(np.searchsorted(stops, np.flatnonzero(kinds == _ODD), side="right").tolist())
        if odd:
            order = sorted(odd)
            slow = [e.ids for e in self._library.encode_batch_fast([texts[i] for i in order], add_special_tokens=False)]
            counts, parts, at = np.zeros(len(texts), np.int64), [], 0
            for i, ids in zip([*order, len(texts)], [*slow, []]):
                fast_ids, counts[at:i] = self.encode(texts[at:i])
                parts += [fast_ids, np.array(ids, np.int32)]
                if i < len(texts):
                    counts[i] = len(ids)
                at = i + 1
            return np.concatenate(parts), counts
        b = self._byte_lower[b]
        low = self._lower[points]
        b[two], b[two + 1] = 0xC0 | (low >> 6), 0x80 | (low & 0x3F)
        end = np.ones(len(b), bool)
        if len(b):
            same = (kinds[1:] == kinds[:-1])
            digits = np.flatnonzero(kinds[:-1] == _NUMBER)
            same[digits] = (b[digits + 1] & 0xC0) == 0x80
            end[:-1] = ~same
        marks = np.flatnonzero(b == 39)
        if len(marks):                                      # 's 't 're 've 'm 'll 'd, where no other sign stands before
            marks = marks[(marks == 0) | (kinds[marks - 1] != _OTHER)]
            one, more = b[np.minimum(marks + 1, len(b) - 1)], b[np.minimum(marks + 2, len(b) - 1)]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == 114) | (one == 118)) & (more == 101) | (one == 108) & (more == 108)
            end[marks[short | long]] = False
            end[marks[short] + 1] = True
            end[marks[long] + 1], end[marks[long] + 2] = False, True
        keep = np.flatnonzero(kinds != _SPACE)
        last = end[keep]
        ids, places = self._fst.ids(b[keep] + last * np.int32(_END), last)
        counts = np.bincount(np.searchsorted(stops, keep[places], side="right"), minlength=len(texts))
        return ids, counts


class PieceBpe:
    """Byte-pair encoding with byte fallback, from a sentencepiece model whose pieces have spaces in front only."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self._library.serialized_model_proto())
        space = "▁"
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == pb.ModelProto.SentencePiece.NORMAL]
        spec = model.normalizer_spec
        self._compiled = (
            model.trainer_spec.model_type == pb.TrainerSpec.BPE and model.trainer_spec.byte_fallback
            and spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
            and all(space not in p.piece.lstrip(space) for _, p in normal)
            and not any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in model.pieces)
        )
        letters = sorted({c for _, p in normal for c in p.piece})
        singles = {p.piece for _, p in normal if len(p.piece) == 1}
        ids = {c: i for i, c in enumerate(letters)}
        self._bytes = [len(letters) + k for k in range(4)]   # characters outside the vocabulary, by their bytes
        self._begin = len(letters) + 4                       # a space that begins a word
        self._space = ids[space]
        points = np.arange(0x110000)
        self._symbol = (len(letters) + np.searchsorted([0x80, 0x800, 0x10000], points, side="right")).astype(np.int32)
        for c, i in ids.items():
            if c in singles:
                self._symbol[ord(c)] = i
        self._symbol[32] = self._space
        tokens: list[tuple[int, ...]] = [()] * len(model.pieces)
        by_text = {p.piece: (-p.score, i) for i, p in normal}
        for i, p in normal:
            tokens[i] = tuple(ids[c] for c in p.piece)
        texts = [p.piece for p in model.pieces]
        self._fst = Transducer(
            tokens, self._begin + 1, functools.lru_cache(1_000_000)(lambda a, b: by_text.get(texts[a] + texts[b])),
            restarts={self._begin: self._space}, fixed={s: k + 1 for k, s in enumerate(self._bytes)}, with_ids=False)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """How many tokens each text has."""
        if not self._compiled:
            return np.array([len(x) for x in self._library.encode(list(texts), num_threads=1)], np.int64)
        out = np.zeros(len(texts), np.int64)
        full = [i for i, t in enumerate(texts) if t]
        if not full:
            return out
        joined = "".join(" " + texts[i] for i in full)
        begins = np.concatenate([[0], np.cumsum([len(texts[i]) + 1 for i in full])])[:-1]
        symbols = self._symbol[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        spaces = symbols == self._space
        word = spaces.copy()
        word[1:] &= ~spaces[:-1]
        word[begins] = True
        symbols[word] = self._begin
        last = (symbols >= self._bytes[0]) & (symbols < self._begin)
        last[:-1] |= word[1:]
        last[-1] = True
        cells = self._fst.run(symbols, last)
        out[full] = np.add.reduceat(self._fst.deltas_at(cells), begins, dtype=np.int64)
        return out


@functools.lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    """One for each Python worker, which Spark reuses from task to task."""
    return WordBpe(path)


@functools.lru_cache(2)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)


def batches(sizes: Sequence[int], limit: int = 400_000) -> list[tuple[int, int]]:
    """Ranges of neighbouring rows of about `limit` characters; a longer text stands alone."""
    out, start, total = [], 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            out.append((start, i))
            start, total = i, 0
        total += n
    if start < len(sizes):
        out.append((start, len(sizes)))
    return out
