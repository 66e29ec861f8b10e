"""Compiled tokenizers, counts, token files and packing against the libraries and exact round trips."""

from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from skyflow.llm import frames
from skyflow.llm.packing import best_fit_decreasing, lower_bound, pack, token_pieces
from skyflow.llm.token_counts import op7_token_counts, token_counts
from skyflow.llm.token_files import id_digests, op8_token_files, read_token_files, write_token_files
from skyflow.llm.vocab import piece_bpe, word_bpe

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(WORD)
SENTENCE = sentencepiece.SentencePieceProcessor(model_file=PIECE)
PARTS = st.sampled_from(["'s", "'", "'ll", "re", " ", "  ", "\n", "the", "The", "ing", "tion", "é", "ß", "1", "23", "!!", "…", "漢", "İ", "Σς", "😀", "▁", "<s>",
                         "<|endoftext|>", "\x00", "aaaa", "----------------", " ", "ſ"])


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=25).map("".join) | st.text(max_size=30).filter(lambda t: t.isprintable()), max_size=6))
def test_compiled_tokenizers_equal_their_libraries(texts):
    ids, counts = word_bpe(WORD).encode(texts)
    assert counts.tolist() == [len(library_ids(t)) for t in texts]
    assert ids.tolist() == [i for t in texts for i in library_ids(t)]
    assert piece_bpe(PIECE).counts(texts).tolist() == [len(SENTENCE.encode(t)) for t in texts]


def test_long_words_cross_chunks():
    texts = ["ab" * 3000 + " " + "é" * 700, "q" * 511, "x" * 1025 + " y", " " * 2000, "a " * 300]
    ids, _ = word_bpe(WORD).encode(texts)
    assert ids.tolist() == [i for t in texts for i in library_ids(t)]
    assert piece_bpe(PIECE).counts(texts).tolist() == [len(SENTENCE.encode(t)) for t in texts]


def test_states_are_dropped_when_they_are_too_many():
    from skyflow.llm.vocab import WordBpe

    small = WordBpe(WORD)
    small._fst._max = 5
    for text in ("several different words", "and others again", "several different words"):
        assert small.encode([text])[0].tolist() == library_ids(text)


def test_token_counts(spark, odd_docs, no_docs):
    rows = token_counts(odd_docs, PIECE).collect()
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(SENTENCE.encode(r.text or ""))) for r in odd_docs.collect()), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=str) == want
    assert token_counts(no_docs, PIECE).count() == 0


def test_op7(spark, docs, sf_dir):
    want = {r.doc_id: len(SENTENCE.encode(r.text)) for r in docs.collect()}
    got = op7_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and all(r.over_limit == (r.n_tokens > 4096) for r in got)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("top", [0, 1, 49407, 2**32 - 1])
def test_blocks_round_trip(n, top):
    random = np.random.default_rng(n)
    values = random.integers(0, top, n, dtype=np.uint64, endpoint=True).astype(np.uint32)
    if n > 10:
        values[[3, n // 2]] = 2**32 - 1, 0          # outliers
    data = frames.encode(values)
    assert np.array_equal(frames.decode(data), values)
    assert np.array_equal(frames.decode(data, 1, 2), values[256:512])
    with pytest.raises(ValueError):
        frames.decode(b"\0" * 64)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, odd_docs, no_docs, tmp_path):
    write_token_files(odd_docs, str(tmp_path / "t"), WORD, parts=3)
    rows = read_token_files(spark, str(tmp_path / "t")).collect()
    want = [library_ids(r.text) + [1] for r in odd_docs.collect()]
    assert sorted(map(list, (r.ids for r in rows))) == sorted(want)
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys)
    write_token_files(no_docs, str(tmp_path / "none"), WORD)
    assert id_digests(read_token_files(spark, str(tmp_path / "none"))).count() == 0


def test_op8(spark, docs, sf_dir):
    start, want = 0, {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = library_ids(r.text) + [1]
        want[r.doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op8_token_files(spark, sf_dir).collect()} == want


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_packing(spark, odd_docs, no_docs):
    pieces = token_pieces(odd_docs, WORD, capacity=64)
    rows = pack(pieces, 64, part_pieces=40).collect()
    whole = {}
    for r in rows:
        assert crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length
        whole.setdefault((r.doc_id, r.piece), []).append(list(r.ids))
    want = {}
    for r in odd_docs.collect():
        ids = library_ids(r.text) + [1]
        for p in range(math.ceil(len(ids) / 64)):
            want.setdefault((r.doc_id, p), []).append(ids[64 * p:64 * p + 64])
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}
    bins = check_packing(rows, 64)
    assert bins <= math.ceil(lower_bound(np.array([r.length for r in rows]), 64) - 1e-9) + 1
    assert pack(token_pieces(no_docs, WORD)).count() == 0
    bad = spark.createDataFrame([(1, 65)], "doc_id long, length long")
    with pytest.raises(Exception, match="length out of range"):
        pack(bad, 64).count()


def test_packing_rounds_reach_the_bound(spark):
    random = np.random.default_rng(4)
    rows = [(i, int(x)) for i, x in enumerate(np.concatenate([random.integers(1, 400, 900), random.integers(510, 700, 300)]))]
    packed = pack(spark.createDataFrame(rows, "doc_id long, length long"), 1000, part_pieces=150).collect()
    assert len(packed) == len(rows)
    assert check_packing(packed, 1000) <= math.ceil(lower_bound(np.array([x for _, x in rows]), 1000) - 1e-9) + 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_bound_never_exceeds_the_best_packing(lengths):
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best and i < len(lengths):
            return
        if i == len(lengths):
            best = min(best, len(bins))
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= 12:
                place(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1:]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    values = np.array(lengths)
    assert math.ceil(lower_bound(values, 12) - 1e-9) <= best <= best_fit_decreasing(values, 12).max() + 1
