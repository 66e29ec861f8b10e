"""Ranked lexical search of a stated set of items over all documents, by groups of documents that match the same terms."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.lineage import materialize
from .arrow import map_rows, texts_of
from .vocab import batches
from .words import words_of

TOP = 50
SHARD_DOCS = 8_192
SHARD_POSTINGS = 2_000_000
SLICE_PAIRS = 2_000_000      # terms of items that are sent to the tasks at once: the bound of the broadcasts
NO_ID = (1 << 63) - 1        # stands for a missing id, which comes last

# ASCII letters and digits and all that is not ASCII belong to terms; only A-Z are lower-cased.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_hashes(texts: list[str]) -> list[np.ndarray]:
    """The 64-bit hashes of each text's terms, in order."""
    w = words_of([t.encode("utf-8", "replace").translate(_TERM_BYTES).decode("utf-8") for t in texts])
    return [w.hashes[a:b].view(np.int64) for a, b in zip(w.first[:-1], w.first[1:])]


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of each item; rows of one id are one item."""
    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                terms = [np.unique(t) for t in term_hashes(texts[a:b])]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"])

    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    return map_rows(rows, split, "item_id bigint, terms array<bigint>").select("item_id", F.explode("terms").alias("term")).distinct()


_SHARD = {"shard": "bigint", "words": "bigint", "docs": "bigint", "doc_ids": "array<bigint>", "lengths": "array<bigint>", "terms": "array<bigint>",
          "sizes": "array<int>", "places": "array<int>", "counts": "array<int>"}


def build_shards(docs: DataFrame, wanted: Broadcast, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    An inverted index of the wanted terms (a sorted array) over whole texts. One row for each shard of bounded size, cut from the rows as
    they are read: its numbers of words and of documents that have any; doc_ids and lengths of the documents that hold wanted terms; each
    such term with its number of postings; and the postings (place of the document, occurrences) term by term.
    """
    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = wanted.value, TaskContext.get().partitionId() << 32
        ids: list[int] = []
        lengths: list[int] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        words = n_docs = seen = postings = 0

        def close() -> pa.RecordBatch:
            nonlocal number, ids, lengths, found, words, n_docs, seen, postings
            term = np.concatenate([t for t, _ in found]) if found else np.empty(0, np.int64)
            count = np.concatenate([c for _, c in found]) if found else np.empty(0, np.int64)
            place = np.repeat(np.arange(len(ids)), [len(t) for t, _ in found])
            order = np.argsort(term, kind="stable")
            terms, sizes = np.unique(term, return_counts=True)
            lists = [(ids, pa.int64()), (lengths, pa.int64()), (terms, pa.int64()), (sizes, pa.int32()), (place[order], pa.int32()), (count[order], pa.int32())]
            row = pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (number, words, n_docs)), *(pa.array([x], pa.list_(kind)) for x, kind in lists)], names=list(_SHARD))
            number, ids, lengths, found, words, n_docs, seen, postings = number + 1, [], [], [], 0, 0, 0, 0
            return row

        for part in parts:
            keys, texts = part.column(0).to_pylist(), texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                for key, hashes in zip(keys[a:b], term_hashes(texts[a:b])):
                    seen, words, n_docs = seen + 1, words + len(hashes), n_docs + (len(hashes) > 0)
                    if len(known) and len(hashes):
                        at = np.searchsorted(known, hashes)
                        at[at == len(known)] = 0
                        terms, counts = np.unique(hashes[known[at] == hashes], return_counts=True)
                        if len(terms):
                            ids.append(NO_ID if key is None else key), lengths.append(len(hashes)), found.append((terms, counts))
                            postings += len(terms)
                    if seen >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                        yield close()
        if seen:
            yield close()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(rows, build, ", ".join(f"{n} {kind}" for n, kind in _SHARD.items()))


class _Shard:
    """One shard's postings with the score that each gives to a weight of one."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, sizes: np.ndarray, places: np.ndarray, counts: np.ndarray,
                 n_docs: int, n_words: int) -> None:
        self.doc_ids, self.terms, self.places = doc_ids, terms, places
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        size = 100 - 50 + (50 * lengths * n_docs) // n_words
        self.part = (1_000_000_000 * counts.astype(np.int64)) // (1000 * counts.astype(np.int64) + 20 * size[places])
        self.most = np.maximum.reduceat(self.part, self.begin[:-1]) if len(terms) else np.empty(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """
        (doc_ids, scores) that can be among the best `top`, whose worst has `floor` points so far, and how many documents were scored.
        Every document gets the bit mask of the item's terms that it holds. Documents of one mask have one bound, the sum of their
        terms' best postings; masks are evaluated from the highest bound down, until the next one's is below the floor.
        """
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        here = (self.terms[at] == terms) & (weights > 0) if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[here], weights[here]
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        masks = np.zeros((len(self.doc_ids), -(-len(at) // 64)), np.uint64)
        for bit, t in enumerate(at):
            masks[self.places[self.begin[t]:self.begin[t + 1]], bit // 64] |= np.uint64(1 << bit % 64)
        rows = masks[:, 0] if masks.shape[1] == 1 else masks.view([("", np.uint64)] * masks.shape[1])[:, 0]
        kinds, group = np.unique(rows, return_inverse=True)
        bits = np.unpackbits(kinds.view(np.uint8).reshape(len(kinds), -1), axis=1, bitorder="little")[:, :len(at)]
        bound = bits.astype(np.int64) @ (self.most[at] * weights)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        members = np.bincount(group, minlength=len(kinds))
        postings = np.concatenate([np.arange(self.begin[t], self.begin[t + 1]) for t in at])
        places, points = self.places[postings], self.part[postings] * np.repeat(weights, self.begin[at + 1] - self.begin[at])
        best_at, best, scored, done, want = np.empty(0, np.int64), np.empty(0, np.int64), 0, 0, 2 * top
        while done < len(order) and bound[order[done]] >= floor:
            stop = done + 1 + int(np.searchsorted(np.cumsum(members[order[done:]]), want))
            stop = min(stop, int(np.searchsorted(-bound[order], -floor, side="right")))
            chosen = np.zeros(len(kinds), bool)
            chosen[order[done:stop]] = True
            docs = chosen[group]
            now = docs[places]
            scores = np.bincount(places[now], points[now], len(docs)).astype(np.int64)      # whole numbers below 2**53
            new = np.flatnonzero(docs)
            scored += len(new)
            best_at, best = np.append(best_at, new), np.append(best, scores[new])
            if len(best) > top:
                keep = np.lexsort((self.doc_ids[best_at], -best))[:top]
                best_at, best = best_at[keep], best[keep]
                floor = max(floor, int(best[-1]))
            done, want = stop, want * 2
        kept = best >= max(floor, 1)
        return self.doc_ids[best_at[kept]], best[kept], scored


def _search_shards(shards: DataFrame, items: Broadcast, n_docs: int, n_words: int, top: int) -> DataFrame:
    """The best documents of each task's shards for each item."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = items.value
        ids, lists = table.column("item_id").to_pylist(), table.column("terms").combine_chunks()
        edges = np.asarray(lists.offsets)
        term, weight = (np.asarray(lists.values.field(i)) for i in (0, 1))
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(ids)
        for part in parts:
            for row in range(part.num_rows):
                shard = _Shard(*(np.asarray(part.column(i)[row].values) for i in range(6)), n_docs, n_words)
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    docs, scores = best[i]
                    new_docs, new_scores, _ = shard.search(term[a:b], weight[a:b], top, int(scores[-1]) if len(scores) == top else 1)
                    if len(new_docs):
                        docs, scores = np.append(docs, new_docs), np.append(scores, new_scores)
                        keep = np.lexsort((docs, -scores))[:top]
                        best[i] = docs[keep], scores[keep]
        for i, (docs, scores) in enumerate(best):
            if len(docs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]] * len(docs), pa.int64()), pa.array(docs, pa.int64(), mask=docs == NO_ID), pa.array(scores, pa.int64())],
                    names=["item_id", "doc_id", "score"])

    return map_rows(shards.select("doc_ids", "lengths", "terms", "sizes", "places", "counts"), run, "item_id bigint, doc_id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id") -> DataFrame:
    """
    item_id, rank, doc_id and score of the `top` documents with the highest scores above 0 for each item, equal scores by doc_id (a missing one
    last), exactly. Terms are maximal runs of ASCII letters, digits and all characters outside ASCII, only A-Z lower-cased. With N documents that have
    terms and L terms in all of them, a term of df documents weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document of n terms has
    m = 50 + 50nN div L; its score is the sum of w * (10**9 * tf div (1000 * tf + 20 * m)) over the item's distinct terms.

    The items are the stated query set: they are sent to the tasks in slices of at most SLICE_PAIRS terms, so the broadcasts are bounded, and a slice
    reads the documents once. Whole texts are cut to terms, and shards of bounded size keep the postings of the slice's terms, nothing is
    shuffled. df, N and L are summed over all shards first, so that a shard scores as the whole does. In each shard an item's documents are grouped by the
    mask of the terms that they hold, and the masks are evaluated by falling bound (`_Shard.search`); a task carries each item's best from shard to
    shard as the floor. Only each task's `top` documents an item are shuffled and ranked.

    Terms are compared as 64-bit hashes. Null and empty texts have no terms: such documents count in nothing, such items find nothing. Rows of one
    item_id are one item, null too; repeated documents are found as often as they occur. Other columns are not read; empty tables give an empty table.
    """
    spark = docs.sparkSession
    pairs = materialize(item_terms(items, item_column, text_column), "item-terms")
    slices = math.ceil(pairs.count() / SLICE_PAIRS)
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for number in range(slices):
        own = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == number)
        wanted = np.sort(own.select("term").distinct().toArrow().column("term").to_numpy())            # bounded by SLICE_PAIRS
        shards = materialize(build_shards(docs, spark.sparkContext.broadcast(wanted), id_column, text_column), "shards")
        n_docs, n_words = shards.agg(F.sum("docs"), F.sum("words")).first()
        if not n_words:
            break
        frequency = shards.select(F.inline(F.arrays_zip("terms", "sizes"))).groupBy(F.col("terms").alias("term")).agg(F.sum("sizes").alias("df"))
        weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1))).alias("weight")
        weighted = own.join(frequency, "term").select("item_id", F.struct("term", weight).alias("_term")).groupBy("item_id").agg(F.sort_array(F.collect_list("_term")).alias("terms"))
        table = spark.sparkContext.broadcast(weighted.toArrow().combine_chunks())                      # likewise
        found = found.unionByName(materialize(_search_shards(shards, table, n_docs, n_words, top), "ranked"))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return rank_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
