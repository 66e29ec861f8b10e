"""Substring deduplication by automata of recurring phrases."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lineage import materialize
from .arrow import map_rows, texts_of
from .names import free_names
from .vocab import batches
from .words import runs, span_hashes, words_of

WINDOW = 35
GRAM = 8
SHARD_PHRASES = 20_000      # phrases in one automaton
TASK_CONTEXTS = 20_000      # contexts that one task streams through it


def _anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its anchor: the smallest hash of its GRAM-word stretches, and the first place where that stands. Equal
    windows have equal anchors at equal distances."""
    value = runs(hashes, GRAM)
    place = np.arange(len(value), dtype=np.int32)
    have, span = 1, window - GRAM + 1
    while have < span:
        shift = min(have, span - have)
        first = value[:-shift] <= value[shift:]
        value = np.where(first, value[:-shift], value[shift:])
        place = np.where(first, place[:-shift], place[shift:])
        have += shift
    return value, place


def _spans(docs: DataFrame, window: int) -> DataFrame:
    """(row_id, text_key, anchors, contents, starts, counts): the stretches of neighbouring windows that share one anchor, and
    a hash of each one's words."""

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                w = words_of(texts[a:b])
                if len(w.hashes) < window:
                    continue
                value, place = _anchors(w.hashes, window)
                doc = np.repeat(np.arange(b - a), np.diff(w.first))
                n = len(value)
                inside = np.flatnonzero(doc[:n] == doc[window - 1:window - 1 + n])
                if not len(inside):
                    continue
                v, p, d = value[inside], place[inside], doc[inside]
                new = np.append(True, (p[1:] != p[:-1]) | (d[1:] != d[:-1]))
                at = np.flatnonzero(new)
                counts = np.diff(np.append(at, len(inside)))
                starts = inside[at] - w.first[d[at]]
                offsets = pa.array(np.searchsorted(d[at], np.arange(b - a + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (
                    v[at].view(np.int64), span_hashes(w.hashes, inside[at], inside[at] + counts + window - 1).view(np.int64),
                    starts.astype(np.int32), counts.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), part.column(2).slice(a, b - a), *lists], names=["row_id", "text_key", "anchors", "contents", "starts", "counts"])

    return map_rows(docs, find, "row_id bigint, text_key bigint, anchors array<bigint>, contents array<bigint>, starts array<int>, counts array<int>")


def _contexts(docs: DataFrame, window: int) -> DataFrame:
    """The words of each wanted stretch as text, with the hashes of its windows."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, wanted = texts_of(part.column(0)), part.column(1).to_pylist()
            for a, b in batches([len(t) for t in texts]):
                w = words_of(texts[a:b])
                window_hash = runs(w.hashes, window).view(np.int64)
                begin, end, first = w.begin.tolist(), w.end.tolist(), w.first.tolist()
                found: list[dict] = []
                phrases, hashes = [], []
                for i in range(a, b):
                    found += wanted[i]
                    for s in wanted[i]:
                        at = first[i - a] + s["start"]
                        last = at + s["count"] + window - 1
                        phrases.append(b" ".join([w.data[x:y] for x, y in zip(begin[at:last], end[at:last])]).decode("utf-8", "replace"))
                        hashes.append(window_hash[at:at + s["count"]])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([s[c] for s in found], pa.int64()) for c in ("anchor", "content", "times")), pa.array(phrases, pa.string()),
                     pa.array(hashes, pa.list_(pa.int64()))], names=["anchor", "content", "times", "words", "windows"])

    return map_rows(docs.select("text", "wanted"), cut, "anchor bigint, content bigint, times bigint, words string, windows array<bigint>")


def _locate(key: tuple, contexts: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
    """Every occurrence of the shard's phrases in the contexts dealt to this task, as covered stretches of words."""
    empty = pd.DataFrame({"anchor": pd.Series(dtype="int64"), "content": pd.Series(dtype="int64"), "covered": pd.Series(dtype=object)})
    if not len(contexts) or not len(phrases):
        return empty
    ids: dict[str, int] = {}
    number = lambda text: tuple(ids.setdefault(w, len(ids) + 1) for w in text.split(" "))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for text in phrases["phrase"]:
        automaton.add_word(number(text))
    automaton.make_automaton()
    found, covered = [], []
    for at, text in enumerate(contexts["words"]):
        stretches: list[list[int]] = []
        for end, length in automaton.iter(number(text)):
            begin = end + 1 - length
            while stretches and begin <= stretches[-1][1]:
                begin = min(begin, stretches.pop()[0])
            stretches.append([begin, end + 1])
        if stretches:
            found.append(at)
            covered.append([x for s in stretches for x in s])
    return contexts[["anchor", "content"]].iloc[found].assign(covered=covered) if found else empty


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    All columns of `docs`, with `text_column` replaced by its kept words joined by single spaces (texts that lose nothing stay
    as they are), and n_words, n_removed and removed (begin and end, in words, of each removed stretch). A word is
    removed if a window of `window` words around it also starts elsewhere, in the same or another row.

    1. Every window gets an anchor that depends on its words alone; neighbouring windows share it. Anchors are counted
       (aggregated before the shuffle), and only stretches around anchors that recur are looked at again.
    2. Equal stretches are counted as one with a weight. An anchor's only kind of stretch recurs as a whole. Where an anchor has several kinds, each is read
       once and their windows are counted one by one: recurring passages are confirmed.
    3. Each maximal run of confirmed windows is a phrase. Phrases are dealt by anchor into shards of bounded size, each is
       compiled to an Aho-Corasick automaton over words, and the distinct stretches are streamed through the automaton
       of their anchor, a shard with many of them in several tasks. Equal windows have equal anchors, so no
       occurrence can lie elsewhere.
    4. Located words are gathered for each row and removed from its whole text.

    Anchors and windows are compared as 64-bit hashes, the located phrases as words. Null texts have no words and stay null; null ids and
    repeated rows are rows like others (a repeated row's windows recur); input columns named n_words, n_removed or
    removed are replaced; an empty table gives an empty table. `window` is at least GRAM.
    """
    docs = docs.drop("n_words", "n_removed", "removed")
    key = ["row_id", "text_key"]
    row_id = F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("row_id")
    rows = docs.select(row_id, F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_key"))
    spans = materialize(_spans(rows, window), "anchors")
    each = spans.select(*key, F.inline(F.arrays_zip(
        F.col("anchors").alias("anchor"), F.col("contents").alias("content"), F.col("starts").alias("start"), F.col("counts").alias("count"))))
    recurring = spans.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("_n")).filter("_n > 1").select("anchor")
    spots = materialize(each.join(recurring, "anchor"), "spots")
    # equal stretches as one, with their number and one place where the words can be read
    kinds = materialize(
        spots.groupBy("anchor", "content").agg(F.count("*").alias("times"), F.min(F.struct(*key, "start", "count")).alias("pick")), "kinds")
    # an anchor with one kind of stretch: all its windows recur, and no words need be read; else they are counted one by one
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("_n"), F.max("content").alias("content"), F.max("pick.count").alias("_count"))
    alone = per_anchor.filter("_n = 1").select("anchor", "content", F.array(F.lit(0), (F.col("_count") + window - 1).cast("int")).alias("covered"))
    several = per_anchor.filter("_n > 1").select("anchor")
    wanted = kinds.join(several, "anchor", "left_semi").select(*(F.col(f"pick.{c}").alias(c) for c in key), F.struct("anchor", "content", "times", "pick.start", "pick.count").alias("s")).groupBy(
        *key).agg(F.collect_list("s").alias("wanted"))                                                            # within one document
    mixed = materialize(_contexts(rows.join(wanted, key), window), "contexts")
    each_window = mixed.select("anchor", "content", "times", F.posexplode("windows").alias("at", "window"))
    confirmed = each_window.groupBy("window").agg(F.sum("times").alias("_n")).filter("_n > 1").select("window")
    runs_ = each_window.select("anchor", "content", "at", "window").distinct().join(confirmed, "window").groupBy("anchor", "content").agg(
        F.sort_array(F.collect_list("at")).alias("at"))                                                           # at most WINDOW - GRAM + 1
    # neighbouring places have one difference between place and rank
    runs_ = runs_.select("anchor", "content", F.posexplode("at").alias("rank", "at")).groupBy("anchor", "content", (F.col("at") - F.col("rank")).alias("_run")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"))
    words = F.slice(F.split("words", " "), F.col("low") + 1, F.col("high") - F.col("low") + window)
    parts = runs_.join(mixed.select("anchor", "content", "words"), ["anchor", "content"]).select("anchor", F.array_join(words, " ").alias("phrase"))
    phrases = materialize(parts.distinct(), "phrases")
    shards = max(1, math.ceil(phrases.count() / SHARD_PHRASES))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard")
    streams = mixed.select(shard, "anchor", "content", "words")
    tasks = streams.groupBy("shard").agg(F.ceil(F.count("*") / TASK_CONTEXTS).cast("int").alias("tasks"))     # one row per shard
    dealt = streams.join(tasks, "shard").withColumn("task", F.pmod(F.xxhash64("anchor", "content"), F.col("tasks")).cast("int")).select(
        "shard", "task", "anchor", "content", "words")
    compiled = phrases.select(shard, "phrase").join(tasks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "phrase")
    located = materialize(
        dealt.groupBy("shard", "task").cogroup(compiled.groupBy("shard", "task")).applyInPandas(
            _locate, "anchor bigint, content bigint, covered array<int>"), "located")
    by_row = spots.join(located.unionByName(alone), ["anchor", "content"]).select(*key, F.transform("covered", lambda x: x + F.col("start")).alias("covered"))
    removed = by_row.groupBy(*key).agg(F.flatten(F.collect_set("covered")).alias("_covered"))                 # within one document
    row, text_key, spans_of = free_names(docs, "_row", "_text_key", "_covered")
    keyed = docs.withColumn(row, row_id).withColumn(text_key, F.xxhash64(text_column)).alias("d")
    joined = keyed.join(removed.alias("r"), (F.col(f"d.{row}") == F.col("r.row_id")) & (F.col(f"d.{text_key}") == F.col("r.text_key")), "left").select(
        "d.*", F.col("r._covered").alias(spans_of)).drop(row, text_key)
    return _remove(joined, docs, text_column)


def _remove(joined: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    names = docs.columns
    at = names.index(text_column)

    def remove(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, covered = part.column(at).to_pylist(), part.column(len(names)).to_pylist()
            kept, n_words, n_removed, stretches = list(texts), [], [], []
            for a, b in batches([len(t or "") for t in texts]):
                w = words_of([t or "" for t in texts[a:b]])
                n_words += np.diff(w.first).tolist()
                for i in range(a, b):
                    if not covered[i]:
                        n_removed.append(0)
                        stretches.append([])
                        continue
                    first, n = int(w.first[i - a]), n_words[i]
                    edges = np.array(covered[i]).reshape(-1, 2)
                    depth = np.cumsum(np.bincount(edges[:, 0], minlength=n + 1) - np.bincount(edges[:, 1], minlength=n + 1))[:n]
                    keep = depth == 0
                    n_removed.append(int(n - keep.sum()))
                    change = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]]).astype(np.int8)))
                    stretches.append(change.tolist())
                    left = (np.flatnonzero(keep) + first).tolist()
                    kept[i] = b" ".join([w.data[w.begin[j]:w.end[j]] for j in left]).decode("utf-8", "replace")
            columns = list(part.columns[:-1])
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(stretches, pa.list_(pa.int32()))],
                names=[*names, "n_words", "n_removed", "removed"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_rows(joined, remove, f"{schema}, n_words bigint, n_removed bigint, removed array<int>")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when passages of 35 words that recur anywhere are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = drop_repeated_passages(docs)
    # the contract's text: kept words joined by one space, also where nothing was removed
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(words, " "), 256).alias("kept_sha256"))
