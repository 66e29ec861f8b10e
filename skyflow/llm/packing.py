"""Bound-certified repacking: best-fit decreasing in partitions, certified by dual-feasible functions."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lineage import materialize
from .arrow import map_rows, texts_of
from .names import free_names
from .vocab import batches, word_bpe

CAPACITY = 4096
END_ID = 1
PART_PIECES = 50_000     # pieces that one task packs
_DFF_STEPS = 20


def lower_bound(lengths: np.ndarray, capacity: int) -> float:
    """
    No packing of these lengths has fewer bins: the largest sum over a family of dual-feasible functions (each maps
    lengths to shares so that lengths that fit into one bin have shares of at most 1). The family: the share of the
    capacity itself; the same with lengths over capacity - e counted as whole and those under e as nothing; and the
    rounding functions floor((k + 1) x) / k, which leave x alone where (k + 1) x is whole.
    """
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.float64)
    x = np.arange(capacity + 1)
    best = float(counts @ (x / capacity))
    for e in np.unique(np.linspace(1, capacity // 2, _DFF_STEPS).astype(int)):
        best = max(best, float(counts @ np.where(x > capacity - e, 1.0, np.where(x < e, 0.0, x / capacity))))
    for k in range(1, _DFF_STEPS):
        whole = (k + 1) * x % capacity == 0
        best = max(best, float(counts @ np.where(whole, x / capacity, np.floor((k + 1) * x / capacity) / k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length: longest first, each into the fullest bin that still takes it."""
    bins = np.empty(len(lengths), np.int64)
    free_sizes: list[int] = []                     # sorted distinct free sizes
    by_free: dict[int, list[int]] = {}
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        at = bisect_left(free_sizes, need)
        if at == len(free_sizes):
            b, free, made = made, capacity, made + 1
        else:
            free = free_sizes[at]
            b = by_free[free].pop()
            if not by_free[free]:
                del by_free[free], free_sizes[at]
        bins[i] = b
        rest = free - need
        if rest:
            if rest not in by_free:
                by_free[rest] = []
                insort(free_sizes, rest)
            by_free[rest].append(b)
    return bins


def _kept_bins(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """
    The bins of a packed partition that stay: full ones, and of the others the fullest, as many as the bound proves
    necessary for what they hold. The emptiest bins are the gap; their documents are exchanged.
    """
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    order = np.argsort(-fill, kind="stable")
    low, high = int((fill == capacity).sum()), len(fill)

    def certified(n: int) -> bool:
        rank = np.empty(len(fill), np.int64)
        rank[order] = np.arange(len(fill))
        return math.ceil(lower_bound(lengths[rank[bins] < n], capacity) - 1e-9) >= n

    if high > low and fill[order[-1]] < capacity:          # the last bin might take documents of other partitions
        high -= 1
    while low < high:                                      # the most bins that are certified
        middle = (low + high + 1) // 2
        if certified(middle):
            low = middle
        else:
            high = middle - 1
    return order[:low]


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_column: str = "length", part_pieces: int = PART_PIECES) -> DataFrame:
    """
    `pieces` plus sequence_id and offset: every piece lies in one sequence of at most `capacity`, gapless from 0.

    Pieces are dealt at random into partitions of about `part_pieces`. Each is packed by best-fit decreasing, and a lower
    bound of dual-feasible functions certifies its bins; bins beyond what is certified, and the partition's last open bin,
    are opened again and their pieces dealt anew with those of other partitions. Rounds go on until one partition
    holds all that is left, or a round no longer needs fewer bins than the one before. Each round is written to the
    shared folder; a partition is the only group that a task holds.

    Pieces at full capacity are sequences of their own. Lengths must lie in 1..capacity; null lengths are refused.
    Repeated rows are packed as often as they occur, other columns are carried along; columns named sequence_id or offset
    are replaced; an empty table gives an empty table.
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    own = free_names(pieces, "_piece")[0]
    pieces = pieces.withColumn(
        length_column, F.when(F.col(length_column).between(1, capacity), F.col(length_column)).otherwise(F.raise_error(F.lit("length out of range"))))
    base = materialize(pieces.withColumn(own, F.monotonically_increasing_id()), "pack-pieces")
    piece = F.col(own).alias("_piece")
    full = base.filter(F.col(length_column) == capacity).select(piece, F.lit(0).alias("_round"), F.col(own).alias("_bin"), F.lit(0).cast("long").alias("offset"))
    open_ = base.filter(F.col(length_column) < capacity).select(piece, F.col(length_column).cast("int").alias("_length"))
    done, count, bins_before, round_ = [full], open_.count(), None, 1
    while count:
        parts = max(1, math.ceil(count / part_pieces))
        final = parts == 1
        packed = materialize(_pack_round(open_, parts, round_, capacity), "pack-round")
        n_bins = packed.filter("_first").count()
        final = final or (bins_before is not None and n_bins >= bins_before)
        kept = packed if final else packed.filter("_kept")
        done.append(kept.select("_piece", F.lit(round_).alias("_round"), "_bin", "offset"))
        if final:
            break
        open_ = packed.filter(~F.col("_kept")).select("_piece", "_length")
        left = open_.count()
        bins_before = packed.filter("_first AND NOT _kept").count()
        count, round_ = left, round_ + 1
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    # rounds share a number range: round in the top bits, then the partition and its bin, or the piece
    sequence = F.shiftleft(F.col("_round").cast("long"), 56).bitwiseOR(F.col("_bin")).alias("sequence_id")
    return base.join(placed.select(F.col("_piece").alias(own), sequence, "offset"), own).select(*columns, "sequence_id", "offset")


def _pack_round(open_: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_piece", ignore_index=True)      # reruns agree
        lengths = group["_length"].to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        kept = np.zeros(bins.max() + 1, bool)
        kept[_kept_bins(lengths, bins, capacity)] = True
        order = np.lexsort((group["_piece"].to_numpy(), bins))
        sorted_bins, sorted_lengths = bins[order], lengths[order].astype(np.int64)
        first = np.append(True, sorted_bins[1:] != sorted_bins[:-1])
        before = np.cumsum(sorted_lengths) - sorted_lengths
        offset = before - np.maximum.accumulate(np.where(first, before, 0))
        part = int(group["_part"].iloc[0])
        return pd.DataFrame({
            "_piece": group["_piece"].to_numpy()[order], "_length": lengths[order], "_bin": (np.int64(part) << 24) | sorted_bins,
            "offset": offset, "_first": first, "_kept": kept[sorted_bins]})

    dealt = open_.withColumn("_part", F.pmod(F.xxhash64("_piece", F.lit(round_)), F.lit(parts)).cast("int"))
    return dealt.groupBy("_part").applyInPandas(work, "_piece bigint, _length int, _bin bigint, offset bigint, _first boolean, _kept boolean")


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """
    Encode every whole text, append `end_id`, and cut documents longer than `capacity` into pieces of it: `id_column`, piece
    (from 0), start (ids of the document before it), length, ids_crc32 and, unless `keep_ids` is off, the ids. Null
    texts are empty: one piece of the end id. Repeated rows and null ids stay; other columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(vocabulary)
        for part in parts:
            texts = texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                ids, counts = model.encode(texts[a:b])
                values = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                sizes = counts + 1
                n = -(-sizes // capacity)
                of = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(sizes[of] - start, capacity)
                begin = (np.cumsum(sizes) - sizes)[of] + start
                crcs = [zlib.crc32(values[x:y]) for x, y in zip(begin.tolist(), (begin + length).tolist())]
                arrays = [part.column(0).slice(a, b - a).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                          pa.array(length, pa.int64()), pa.array(crcs, pa.int64())]
                names = [id_column, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(values)), pa.int32()), pa.array(values.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_column}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids
    return map_rows(docs.select(F.col(id_column), F.col(text_column)), cut, schema)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False))
