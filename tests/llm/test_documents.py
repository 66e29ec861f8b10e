"""Mixing, fingerprints, toxicity, deduplication, licences and search against brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import check
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

import __spark_entry__ as entry
from skyflow.llm import near_dedup as nd, search as search_module
from skyflow.llm.components import connected_components
from skyflow.llm.fingerprints import differing_branches, fingerprint_documents, op2_fingerprints, stretches_of, with_next
from skyflow.llm.licenses import FAMILIES, TEMPLATES, fit_licenses, scan_licenses
from skyflow.llm.mixing import mix, mixed_documents, op1_mixing, permuted, source_targets
from skyflow.llm.search import build_index, search
from skyflow.llm.substring_dedup import drop_repeated_passages
from skyflow.llm.toxicity import fit_toxicity, held_out, op3_toxicity, score_toxicity
from skyflow.operators.lineage import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
words = lambda t: WORD.findall(t or "")


# ---- mixing ----

def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100):
        rows = permuted(spark.range(n).withColumn("n", F.lit(n).cast("long")), "p", "id", "n", [F.lit(5)]).collect()
        assert sorted(r.p for r in rows) == list(range(n))


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2 * sizes[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= set(over)
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "B": 5, None: 7, "é": 1000}, {"a": 0, "b": 3}, {"x": 10}, {"a": 0}])
def test_targets(spark, sizes):
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert len(rows) == len(sizes) and all(abs(r.target - want[r.source]) < 1e-6 for r in rows)


def test_op1(spark, docs, sf_dir):
    rows = op1_mixing(spark, sf_dir).collect()
    size, taken, target = Counter(), Counter(), {}
    want = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    assert {r.doc_id: r.size for r in rows} == want
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        size[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(target[s] - t) < 1e-6 for s, t in brute_targets(dict(size)).items())
    assert all(abs(taken[s] - target[s]) <= 128 for s in target)          # within a block
    assert sorted(rows) == sorted(op1_mixing(spark, sf_dir).collect())


def test_mix_of_odd_documents(spark, odd_docs, no_docs):
    documents, spans = mix(odd_docs, block_words=16, slots_per_shard=8)
    rows, parts = documents.collect(), spans.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.collect())
    by_source = Counter()
    for p in parts:
        assert p.word >= 0 and p.word + p.n_words <= p.size
        by_source[p.source] += p.n_words
    target = {r.source: r.target for r in rows}
    assert all(abs(by_source[s] - t) <= 17 for s, t in target.items())
    slots = Counter((p.shard, p.slot) for p in parts)
    assert len({(p.shard, p.slot): p.block for p in parts}) == len(slots)
    mixed = mixed_documents(odd_docs, block_words=16)
    assert mixed.columns == odd_docs.columns
    took = sum(len(words(r.text)) for r in mixed.collect())
    assert took == sum(p.n_words for p in parts)
    assert mixed_documents(no_docs).count() == 0 and all(x.count() == 0 for x in mix(no_docs))


# ---- fingerprints ----

def test_op2(spark, docs, sf_dir):
    rows = {r.doc_id: r for r in op2_fingerprints(spark, sf_dir).collect()}
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    for i, (d, text) in enumerate(texts):
        following, half = texts[(i + 1) % len(texts)][1], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert rows[d].n_chars == len(text) and rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[d].near_next <= 1 and 0 <= rows[d].near_edited <= 1
        assert (rows[d].fingerprint == rows[d].edited_fingerprint) == (text == edited)
    long = [rows[d] for d, t in texts if len(t) > 400]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_next for r in long]) < 0.1


def test_trees_of_odd_documents(spark, odd_docs, no_docs):
    rows = fingerprint_documents(odd_docs).collect()
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.root].add(r.doc_id)
    texts = [r.text or "" for r in odd_docs.collect()]
    assert len(by_text) == len(set(texts)) and len(rows) == len(texts)
    assert fingerprint_documents(no_docs).count() == 0


def test_differing_branches_locate_edits(spark):
    a = spark.createDataFrame([(1, "s one\np two\n\ns three\nsame"), (2, "equal")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "s one\np two\n\ns thre\nsame\nmore"), (2, "equal")], "doc_id long, text string")
    rows = differing_branches(fingerprint_documents(a), fingerprint_documents(b)).collect()
    assert sorted((r.doc_id, r.section, r.paragraph, r.hash_a is None) for r in rows) == [(1, 1, 0, False), (1, 1, 2, True)]


def test_every_word_of_a_line_is_in_a_leaf(spark, docs):
    tails = ["One sentence. alpha beta", "One sentence. gamma delta", "a b c d e f g h i", "no stop here", "Stop! last", "漢字 straße", "", "w"]
    texts = [t + end for t in tails for end in ("", " ", "\t", "\r", " \t \r", ".", ". ", "\r\nmore ", "\n\nmore\r", "\r\n\r\nmore \r\n")]
    texts += [r.text[:len(r.text) - i % 40] for i, r in enumerate(docs.filter("text IS NOT NULL").collect())]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    lines = df.select(F.explode(F.split("text", "\n", -1)).alias("line")).select("line", stretches_of(F.col("line")).alias("parts")).collect()
    assert all("".join(r.parts) == r.line for r in lines) and max(len(r.parts) for r in lines) > 1
    roots = {r.root for r in fingerprint_documents(df).collect()}
    assert len(roots) == len(set(texts))


def test_an_edit_before_trailing_white_space_is_located(spark):
    at = lambda word, end: spark.createDataFrame([(1, f"One sentence. alpha {word}{end}")], "doc_id long, text string")
    for end in (" ", "\t", "\r", "\r\nnext line"):
        rows = differing_branches(fingerprint_documents(at("beta", end)), fingerprint_documents(at("delta", end))).collect()
        assert [(r.section, r.paragraph) for r in rows] == [(0, 0)]


def test_next_rows(spark, no_docs):
    rows = [(i * 3, f"t{i}") for i in range(9000)] + [(None, "n"), (30, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_tie", F.col("text"))
    got = with_next(df, ["doc_id", "text"]).collect()
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1]), reverse=True) + [(None, "n")]
    want = {a: b for a, b in zip(order, order[1:] + order[:1])}
    assert len(got) == len(rows) and all((r.next_doc_id, r.next_text) == want[r.doc_id, r.text] for r in got)
    assert with_next(no_docs.withColumn("_tie", F.lit(1)), ["text"]).count() == 0


# ---- toxicity ----

def test_op3_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op3_toxicity(spark, sf_dir).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == 1000
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
    held = [(rows[d].score, t) for d, t in labels.items() if rows[d].held_out]
    order = sum((a > b) + 0.5 * (a == b) for a, t in held if t for b, u in held if not u)
    assert order / (sum(t for _, t in held) * sum(not t for _, t in held)) > 0.8
    assert sum((s >= 0.7) == t for s, t in held) / len(held) > 0.85


def test_toxicity_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 1), (9, 0), (10, 0), (None, 1), (3, None), (4, 0)], "doc_id long, toxic int")
    model = fit_toxicity(odd_docs, labels)
    scored = score_toxicity(odd_docs, model)
    assert "score" in scored.columns and scored.columns.count("score") == 1       # the input's column of that name is replaced
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert score_toxicity(no_docs, fit_toxicity(no_docs, labels)).count() == 0
    prior = score_toxicity(odd_docs, fit_toxicity(odd_docs, labels.limit(0))).first().score
    assert prior == 0.5
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out()).first()[0] is False


# ---- near duplicates ----

def brute_groups(rows, percent):
    sets = []
    for _, text in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i), d)) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_odd_documents(spark, odd_docs, no_docs, percent):
    got = nd.near_duplicates(odd_docs, percent).collect()
    want = brute_groups([(r.doc_id, r.text) for r in odd_docs.collect()], percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert nd.near_duplicates(no_docs).count() == 0


def test_near_duplicates_that_share_bands_without_links(spark):
    """Edits of one text that are near their neighbours only: leaders beyond the first are needed."""
    random = np.random.default_rng(3)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(60):
        base[int(random.integers(0, 120))] = f"e{i}"
        rows.append((i, " ".join(base)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_groups(rows, 85))


def test_odd_sketch_bounds_the_difference():
    random = np.random.default_rng(1)
    a = random.integers(0, 2**32, nd.HASHES, dtype=np.uint64).astype(np.uint32)
    for differ in (0, 5, 20, 60):
        b = a.copy()
        b[:differ] += np.uint32(1)
        bits = sum(int(x).bit_count() for x in (nd.odd_sketch(a) ^ nd.odd_sketch(b)).view(np.uint64))
        assert bits <= 2 * differ and bits >= differ * 0.8


@pytest.mark.parametrize("percent", [80, 85])
def test_copies_of_one_text_are_not_all_paired(spark, monkeypatch, percent):
    """A large group of near copies, most too far from each other: pairs that are read in full stay in proportion to the group."""
    rng, base, counts = np.random.default_rng(4), [f"w{i}" for i in range(150)], Counter()
    rows = []
    for i in range(400):
        text = list(base)
        for at in rng.choice(150, i % 12, replace=False):
            text[at] = f"v{rng.integers(10_000)}"
        rows.append((i, " ".join(text)))
    whole = nd.materialize

    def counted(df, label):
        out = whole(df, label)
        counts[label] += out.count()
        return out

    monkeypatch.setattr(nd, "materialize", counted)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    want = brute_groups(rows, percent)
    assert {r.doc_id: r.component_id for r in got} == {i: component for i, _, component in want}
    assert counts["near"] < 5 * len(rows)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a = rng.integers(0, 2**63, 300).astype(np.uint64)
        b = np.concatenate([a[rng.integers(0, 30):], rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)])
        bits = sum(int(x).bit_count() for x in (nd.parity_sketch(a) ^ nd.parity_sketch(b)).view(np.uint64))
        assert 0.8 * len(np.setxor1d(a, b)) <= bits <= len(np.setxor1d(a, b))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [(200, 200 + i) for i in range(1, 30)]
    rows = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert rows == {i: 0 for i in range(41)} | {100: 100, 101: 100} | {200 + i: 200 for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- substrings ----

def brute_removal(texts, window):
    at = defaultdict(list)
    split = [words(t) for t in texts]
    for d, w in enumerate(split):
        for i in range(len(w) - window + 1):
            at[tuple(w[i:i + window])].append((d, i))
    gone = defaultdict(set)
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d] |= set(range(i, i + window))
    return [(len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in enumerate(split)]


@pytest.mark.parametrize("window", [8, 35])
def test_substring_dedup_of_odd_documents(spark, odd_docs, no_docs, window):
    got = drop_repeated_passages(odd_docs, window).collect()
    want = brute_removal([r.text for r in odd_docs.collect()], window)
    assert sorted((r.n_words, r.n_removed, " ".join(words(r.text))) for r in got) == sorted(want)
    assert all(sum(b - a for a, b in zip(r.removed[::2], r.removed[1::2])) == r.n_removed for r in got)
    assert drop_repeated_passages(no_docs).count() == 0


def test_stretches_of_one_kind_are_not_read_again(spark, monkeypatch):
    """Passages that recur in one form only are removed without their words; those in several forms still by the automaton."""
    from skyflow.llm import substring_dedup as sd

    own = lambda i: " ".join(f"o{i}x{j}" for j in range(40))
    same, read = " ".join(f"p{j}" for j in range(60)), []
    kept = sd.materialize
    monkeypatch.setattr(sd, "materialize", lambda df, label="step": read.append((label, kept(df, label))) or read[-1][1])
    rows = [(i, same) for i in range(3)]
    for texts, mixed in ((rows, False), (rows + [(9, f"{own(9)} {same} {own(8)}")], True)):
        read.clear()
        got = sd.drop_repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        assert sorted((r.n_words, r.n_removed, " ".join(words(r.text))) for r in got) == sorted(brute_removal([t for _, t in texts], 35))
        assert (dict(read)["contexts"].count() > 0) == mixed


# ---- licences ----

def test_licenses_of_odd_documents(spark, odd_docs, no_docs, docs):
    model = fit_licenses(docs)
    texts = [(i, f"some words here and there.\n{t}") for i, ts in enumerate(TEMPLATES.values()) for t in ts[:1]]
    rows = scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    assert {(r.doc_id, r.family) for r in rows} == {(i, f) for i, f in enumerate(TEMPLATES)}
    found = scan_licenses(odd_docs, model).collect()
    assert [(r.doc_id, r.family, r.paragraph) for r in found] == [(16, "apache-2.0", 0)]
    assert scan_licenses(no_docs, model).count() == 0
    assert scan_licenses(docs.select("doc_id", F.lit("the licensed under version of a general work").alias("text")), model).count() == 0
    fit_licenses(no_docs)


def test_templates_are_met_once_a_paragraph(spark):
    """Filters on the likeness must not make Spark work it out again, and words that no template has change nothing."""
    from skyflow.llm import licenses as lc

    known = [lc._template(f, t) for f, ts in sorted(FAMILIES.items()) for t in ts]
    noise = " ".join(f"n{i}" for i in range(300))
    lines = [("licensed under the Apache License, Version 2.0.", "apache-2.0"), ("a MIT License-. b", "mit"), (noise, None)]
    df = spark.createDataFrame([(t, f) for t, f in lines] + [(f"{noise} {t} {noise}", f) for t, f in lines], "text string, family string")
    best = lc._with_likeness(df.withColumn("_words", lc._words(F.col("text"))), known).filter("_likeness >= 0.5 OR _likeness < 0.1")
    plan = best.select("_family", "_likeness", "family")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_except(") == 2          # in one expression: for the likeness and for the tie
    rows = best.collect()
    assert len(rows) == 6 and all((r._family if r._likeness else None) == r.family for r in rows)


LICENSE_LINES = [
    ("// SPDX-License-Identifier: MIT", "mit"), ("# SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or", "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "lgpl-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "agpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Our code is under the BSD 2-Clause License", "bsd-2-clause"), ("ISC License", "isc"), ("CC0 1.0 Universal", "cc0-1.0"),
    ("made available under the terms of the Eclipse Public License 2.0", "epl-2.0"),
    ("This work is licensed under the GNU General Public License, version 7.", None), ("a general work for the public", None),
]


def test_licenses_beyond_the_sql(spark, docs):
    model = fit_licenses(docs)
    rows = scan_licenses(spark.createDataFrame(list(enumerate(t for t, _ in LICENSE_LINES)), "doc_id long, text string"), model).collect()
    assert {LICENSE_LINES[r.doc_id][0]: r.family for r in rows} == {t: f for t, f in LICENSE_LINES if f}
    texts = [(i, t.replace("{", "").replace("}", ""), f) for i, (f, t) in enumerate((f, t) for f, ts in FAMILIES.items() for t in ts)]
    got = {r.doc_id: r.family for r in scan_licenses(spark.createDataFrame(texts, "doc_id long, text string, family string"), model).collect()}
    assert [(t, f, got.get(i)) for i, t, f in texts if got.get(i) != f] == []
    assert all(t in [x[1] for x in texts if x[2] == f] for f, ts in TEMPLATES.items() for t in ts if not f.startswith("cc"))


# ---- search ----

def test_search_of_odd_documents(spark, odd_docs, no_docs):
    index = materialize(build_index(odd_docs, shard_docs=5), "index")
    queries = odd_docs.select(F.coalesce("doc_id", F.lit(-1)).alias("query_id"), "text").dropDuplicates(["query_id"])
    got = defaultdict(list)
    for r in search(index, queries, top=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, r.score))
    rows = [(r.doc_id, Counter(x.translate({c: c + 32 for c in range(65, 91)}) for x in words(r.text))) for r in odd_docs.collect()]
    n, mean = len(rows), sum(sum(c.values()) for _, c in rows) / len(rows)
    df = Counter(t for _, c in rows for t in c)
    for q in queries.collect():
        terms = {x.translate({c: c + 32 for c in range(65, 91)}) for x in words(q.text)}
        scores = []
        for d, c in rows:
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + norm) for t in terms if t in c)
            if s:
                scores.append((round(s, 6), d))
        best = sorted(scores, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:3]
        assert [d for _, d in best] == [d for d, _ in got[q.query_id]]
        assert all(abs(s - t) < 2e-6 for (s, _), (_, t) in zip(best, got[q.query_id]))
    empty = materialize(build_index(no_docs), "index")
    assert search(empty, queries).count() == 0 and search(index, queries.limit(0)).count() == 0


def test_many_queries_at_once_and_blocks_below_the_floor(monkeypatch):
    """A shard's answers to many queries, in small batches too, are those of every score; blocks below a query's floor are not scored."""
    rng = np.random.default_rng(8)
    held = [np.unique(np.append(rng.integers(0, 400, 20), rng.integers(0, 10, 6))) for _ in range(300)]
    term, place = np.concatenate(held), np.repeat(np.arange(300, dtype=np.int32), [len(h) for h in held])
    order = np.argsort(term, kind="stable")
    term, place = term[order], place[order]
    block = place // search_module.BLOCK_DOCS
    new = np.append(True, (np.diff(term) != 0) | (np.diff(block) != 0))
    first = np.append(True, np.diff(term) != 0)
    row = dict(doc_ids=np.arange(300)[::-1].copy(), lengths=np.array([len(h) for h in held]), terms=term[first], first_entry=(np.cumsum(new) - 1)[first], entry_block=block[new],
               entry_posting=np.flatnonzero(new), place=place, count=np.ones(len(place), np.int32))
    shard = search_module._Shard(row, 20.0)
    assert 0 < len(shard.impacts) < len(shard.terms)
    asked = [np.unique(rng.integers(0, len(shard.terms), k)) for k in (0, 1, 3, 40, 200)] * 4
    of, at = np.repeat(np.arange(20), [len(a) for a in asked]), np.concatenate(asked)
    weight = rng.random(len(at))
    end = np.append(np.flatnonzero(first)[1:], len(place))
    for cells in (1, 700, 1 << 20):
        monkeypatch.setattr(search_module, "BATCH_CELLS", cells)
        floor = np.zeros(20)
        got = defaultdict(list)
        for q, p, s in zip(*shard.search(20, of, at, weight, floor, 5)):
            got[q].append((round(s, 6), shard.doc_ids[p]))
        for q in range(20):
            scores = np.zeros(300)
            for t, w in zip(at[of == q], weight[of == q]):
                hit = slice(np.flatnonzero(first)[t], end[t])
                scores[place[hit]] += w * shard.impact[hit]
            best = sorted(((round(s, 6), d) for s, d in zip(scores, shard.doc_ids) if s > 0), key=lambda x: (-x[0], x[1]))[:5]
            assert [d for _, d in got[q]] == [d for _, d in best] and all(abs(x[0] - y[0]) < 2e-6 for x, y in zip(got[q], best))
            assert abs(floor[q] - np.sort(scores)[-5]) < 1e-9
        assert len(shard.search(20, of, at, weight, np.full(20, 1e6), 5)[0]) == 0


def test_shards_are_bounded_by_their_postings(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j) % 400}" for j in range(100))) for i in range(300)] + [(300, " ".join(f"w{j}" for j in range(400)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = materialize(build_index(df, shard_postings=250), "index")
    sizes = index.select(F.size("doc_ids").alias("docs"), F.size("place").alias("postings")).collect()
    assert sum(r.docs for r in sizes) == 301 and all(r.postings <= 250 or r.docs == 1 for r in sizes)
    queries = df.filter("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    assert sorted(search(index, queries).collect()) == sorted(search(materialize(build_index(df), "index"), queries).collect())


def test_queries_of_many_partitions_are_sent_together(spark, monkeypatch):
    """However many partitions the queries are dealt over, they are sent in as few blocks as the bounds allow."""
    rows = [(q, (q % 40) << 32, [(t, 1.0) for t in range(4)]) for q in range(120)]
    weighted = spark.createDataFrame(rows, "query_id long, block long, terms array<struct<term: long, weight: double>>")
    assert search_module._query_blocks(weighted) == [(0, 39 << 32)]
    monkeypatch.setattr(search_module, "QUERY_BLOCK", 60)
    assert search_module._query_blocks(weighted) == [(0, 19 << 32), (20 << 32, 39 << 32)]
    monkeypatch.setattr(search_module, "QUERY_BYTES", 16 * 120)
    assert len(search_module._query_blocks(weighted)) == 4


def test_a_task_returns_one_top_of_all_its_shards(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 60, 12))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = materialize(build_index(df, shard_docs=20), "index").coalesce(1)
    assert index.count() == 10
    queries = search_module._query_terms(df.filter("doc_id < 30"), "doc_id", "text").select("query_id", F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(1.0).alias("weight"))).alias("terms"))
    found = search_module._search_block(index, spark.sparkContext.broadcast(search_module._query_arrays(queries.toArrow())), 12.0, 3).collect()
    assert len(found) == 90 and {r.query_id for r in found} == set(range(30))


def test_scores_that_single_precision_cannot_tell_apart(spark):
    """Scores that differ by less than single precision resolves are ranked as double precision has them."""
    places, docs = np.arange(64, dtype=np.int32), np.arange(64)[::-1].copy()
    row = dict(doc_ids=docs, lengths=np.full(64, 10**7) + np.arange(64), terms=np.array([7]), first_entry=np.array([0]), entry_block=np.array([0], np.int32),
               entry_posting=np.array([0]), place=places, count=np.full(64, 3, np.int32))
    shard = search_module._Shard(row, 10.0**7)
    assert len(np.unique(shard.impacts)) < 64 == len(np.unique(shard.impact))
    floor = np.zeros(1)
    _, place, score = shard.search(1, np.array([0]), np.array([0]), np.array([5000.0]), floor, 5)
    assert place.tolist() == list(range(5)) and np.array_equal(score, 5000.0 * shard.impact[:5]) and floor[0] == score[-1]


def test_a_task_holds_one_shard_and_one_block_of_queries(spark, monkeypatch):
    """The index is written a row at a time, and a block of queries is dropped everywhere when it has been answered."""
    rows = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(12))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = search_module.write_index(df, shard_docs=25)
    held = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert sorted(m.row_group(i).num_rows for m in held for i in range(m.num_row_groups)) == [1] * 8
    labels, ended, destroy = [], [], Broadcast.destroy
    monkeypatch.setattr(search_module, "QUERY_BLOCK", 2)
    monkeypatch.setattr(search_module, "materialize", lambda df, label: (labels.append(label), materialize(df, label))[1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self: (ended.append(self), destroy(self)))
    queries = df.filter("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id")
    assert search(index, queries).count() == 100
    assert len(ended) == len({id(x) for x in ended}) == labels.count("tops") > 1


def test_long_documents_have_no_wide_table():
    """The table of frequent terms has at most COMMON cells for each posting, also where a shard has few documents."""
    place = np.tile(np.arange(3, dtype=np.int32), 500)
    row = dict(doc_ids=np.arange(3), lengths=np.full(3, 500), terms=np.arange(500), first_entry=np.arange(500), entry_posting=np.arange(500) * 3, place=place, count=np.ones(1500, np.int32))
    shard = search_module._Shard(row, 500.0)
    assert shard.impacts.size <= search_module.COMMON * len(place)
    _, found, score = shard.search(1, np.zeros(500, np.int64), np.arange(500), np.ones(500), np.zeros(1), 2)
    assert found.tolist() == [0, 1] and np.allclose(score, shard.impact[0] * 500)


def test_equal_documents_are_scored_in_bounded_pieces(monkeypatch):
    """However many documents are as good as the last of the top, few of their postings are held at once."""
    docs, terms = 512, 40
    row = dict(doc_ids=np.arange(docs)[::-1].copy(), lengths=np.full(docs, terms), terms=np.arange(terms), first_entry=np.arange(terms), entry_posting=np.arange(terms) * docs,
               place=np.tile(np.arange(docs, dtype=np.int32), terms), count=np.ones(docs * terms, np.int32))
    shard = search_module._Shard(row, float(terms))
    held, ranges = [], search_module._ranges
    monkeypatch.setattr(search_module, "BATCH_CELLS", 1 << 10)
    monkeypatch.setattr(search_module, "_ranges", lambda begin, sizes: (held.append(int(sizes.sum())), ranges(begin, sizes))[1])
    query, place, score = shard.search(2, np.repeat([0, 1], terms), np.tile(np.arange(terms), 2), np.repeat([1.0, 2.0], terms), np.zeros(2), 5)
    assert max(held) <= 1 << 10 and sum(held) == 2 * docs * terms
    assert shard.doc_ids[place].tolist() == [0, 1, 2, 3, 4] * 2 and np.allclose(score, np.repeat([1.0, 2.0], 5) * shard.impact[0] * terms)


# ---- the SQL of those that have one, and the pipeline ----

LLM = [n for n in entry.queries() if re.match(r"op\d", n)]


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM) == list(range(1, 11)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", [n for n in LLM if n in entry.oracle_sql()])
def test_sql(spark, sf_dir, name):
    problem, _ = check.compare(spark, check.duck(sf_dir), name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert problem is None


def test_pipeline_stages(spark, odd_docs, no_docs, sf_dir):
    import corpus_pipeline as p

    stages = dict(p.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    for frame in (odd_docs, no_docs):
        for name, stage in stages.items():
            out = stage(spark, frame, sf_dir)
            assert name == "packing" or out.columns == frame.columns
            if frame is no_docs:
                assert out.count() == 0
    kept = stages["near_dedup"](spark, odd_docs, sf_dir).collect()
    want = brute_groups([(r.doc_id, r.text) for r in odd_docs.collect()], 80)
    assert {r.doc_id for r in kept if r.doc_id is not None} == {d for d, _, c in want if d is not None and d == c}
    rest = stages["substring_dedup"](spark, odd_docs, sf_dir).collect()
    want = brute_removal([r.text for r in odd_docs.collect()], 35)
    assert sorted(len(words(r.text)) for r in rest) == sorted(n - gone for n, gone, _ in want)
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in rest)


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as p

    rows = p.run(spark, sf_dir).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


# ---- small sources, clashing names ----
def test_small_sources_meet_their_targets(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30)), f"s{i:02d}") for i in range(12)] + [(100 + i, " ".join(["z"] * 500), "t") for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    documents, spans = mix(df)
    taken = {r["source"]: r["n"] for r in spans.groupBy("source").agg(F.sum("n_words").alias("n")).collect()}
    wanted = {r["source"]: r["target"] for r in documents.select("source", "target").distinct().collect()}
    assert set(taken) == set(wanted) and all(abs(taken[s] - t) <= 1 for s, t in wanted.items())
    most = spans.groupBy("doc_id", "size").agg(F.sum("n_words").alias("n")).collect()
    assert all(r["n"] <= 2 * r["size"] for r in most)


def test_slots_are_planned_by_many_tasks(spark, monkeypatch):
    from skyflow.llm import mixing

    monkeypatch.setattr(mixing, "_TASK_SLOTS", 64)
    monkeypatch.setattr(mixing, "_CHUNK", 16)
    df = spark.range(300).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 100) AS text", "concat('s', id % 2) AS source")
    wide = mix(df, block_words=8)[1].groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()
    monkeypatch.undo()
    assert sorted(wide) == sorted(mix(df, block_words=8)[1].groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect())


def test_stages_leave_columns_with_their_own_names_alone(spark):
    import corpus_pipeline

    words = " ".join(f"w{i}" for i in range(50))
    names = ["_key", "_row", "_text_key", "_score", "_toxic", "_source", "_covered", "_piece", "_id", "s", "row_id", "leader"]
    rows = [(i, f"{words} own{i} " + " ".join(f"o{i}x{j}" for j in range(40)), "en", "ab"[i % 2], 5, *names) for i in range(6)]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("near_dedup", "substring_dedup", "mixing"):
        out = stages[name](spark, df, "").collect()
        assert out and all(r[n] == n for r in out for n in names), name
    assert stages["packing"](spark, df, "").count() == 7
    from skyflow.llm.packing import pack

    packed = pack(df.withColumn("length", F.lit(100)))
    assert packed.count() == 7 and all(r["_piece"] == "_piece" for r in packed.collect())
