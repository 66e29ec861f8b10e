"""Near-duplicates by MinHash bands, odd sketches and exact confirmation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.lineage import materialize
from .arrow import map_rows, texts_of
from .components import connected_components
from .vocab import batches
from .words import STEP, mix, powers, runs, words_of

SHINGLE = 5
PERCENT = 80                 # the default of the library's near-duplicate operators
HASHES, ROWS = 500, 10       # 50 bands of 10: a pair at 0.8 shares no band with probability 3e-3, at 0.85 with 2e-5; at 0.5 it shares one with 0.05
SKETCH_BITS = 1024
HEADS, MORE = 16, 256        # nodes of a component that others of its band are compared with, and times as many in each further round
_SLACK = 0.093               # 5.2 standard deviations of the share of differing samples at 0.8
_rng = np.random.default_rng(5081)          # seeded: the same functions everywhere
_MULTIPLY = (_rng.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_SAMPLE = _rng.integers(0, 2**64, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles."""
    w = words_of(texts, lower=True)
    grams = runs(w.hashes, SHINGLE)
    out = []
    for first, last in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        n = last - first
        if n >= SHINGLE:
            out.append(np.unique(grams[first:last - SHINGLE + 1]))
        elif n:
            out.append(mix((w.hashes[first:last] * powers(STEP, n)).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    short = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(short), 2048):
        np.minimum(out, (short[i:i + 2048, None] * _MULTIPLY + _ADD).min(axis=0), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Every sample flips one of SKETCH_BITS bits: the parity bitmap, as 64-bit words. The XOR of two sketches has at most
    as many bits set as the two sample sets differ in."""
    bit = (mix(samples.astype(np.uint64) + _SAMPLE) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(bit, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """The odd sketch of a whole set: the XOR of two has at most as many bits set as their sets differ in, and hardly fewer where that is far below SKETCH_BITS."""
    parity = (np.bincount((mix(shingles) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def _signatures(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def sign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = texts_of(part.column(1))
            sizes, keys, bands, sketches, parities = [], [], [], [], []
            for a, b in batches([len(t) for t in texts]):
                for s in shingle_sets(texts[a:b]):
                    sizes.append(len(s))
                    if not len(s):
                        keys.append(None), bands.append(None), sketches.append(None), parities.append(None)
                        continue
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    samples = min_hashes(s)
                    table = samples.reshape(-1, ROWS).astype(np.uint64)
                    number = np.arange(len(table), dtype=np.uint64)
                    bands.append(mix((table * powers(STEP, ROWS)).sum(axis=1) + mix(number + np.uint64(1))).view(np.int64))
                    sketches.append(odd_sketch(samples))
                    parities.append(parity_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), part.column(3), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketches, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))],
                names=["doc_id", "row_id", "text_key", "n_shingles", "node", "bands", "sketch", "parity"])

    return map_rows(
        _keyed(docs, id_column, text_column), sign,
        "doc_id bigint, row_id bigint, text_key bigint, n_shingles bigint, node binary, bands array<bigint>, sketch array<bigint>, parity array<bigint>")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row is found again by its id (the largest number for none) and its text's hash."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"),
        F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("row_id"), F.xxhash64(text_column).alias("text_key"))


def _sets(docs: DataFrame) -> DataFrame:
    def build(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                found = [s.view(np.int64) for s in shingle_sets(texts[a:b])]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    return map_rows(docs, build, "node binary, shingles array<bigint>")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    doc_id, n_shingles, component_id, kept and text_key (xxhash64 of the text) of every row. Documents whose sets of five-word shingles (A-Z lower-cased;
    fewer words are one shingle) have 100 * intersection >= `percent` * union (at least 80) are linked; component_id is the smallest id that
    links reach, kept marks its row.

    Equal sets become one node first. 500 MinHash samples of each node give 50 bands and an odd sketch, whose XOR counts estimate how many samples
    differ. A band's nodes are not paired with each other. In the first round each node is compared with one leader of
    most of its bands: a band's leader is the node that meets most others in all its bands, so that copies of one text meet the least changed of them. Nodes that the links found so far have joined need no more comparison. In bands that still hold several components, the nodes of the
    smaller one are compared with HEADS nodes of the larger one (first with the closest of them only), MORE times as many in each further round, in the end with all.
    Sketches, parities of the whole sets and sizes travel with the nodes of such bands, so that pairs which differ in more bits than linked sets can are dropped inside the
    join; the others are confirmed on their full sets. Components are joined between rounds. All steps are keyed by node or (band, node);
    what a hot band or leader gathers is only counted or joined.

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing (component_id is their own id). A row
    without an id takes the smallest id of its component, if any, and is not kept. Repeated rows share their result. Other
    columns are not read; an empty table gives an empty table.
    """
    signed = materialize(_signatures(docs, id_column, text_column), "signatures")
    nodes = materialize(
        signed.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("least_id"), F.min(F.struct("row_id", "text_key")).alias("pick"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity")),
        "nodes")
    spread = nodes.select("node", F.explode("bands").alias("band"))
    # bands of one node are of no use; the others are kept with their leader, the node that meets most others in all its bands
    shared = spread.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialize(spread.join(shared, "band"), "bands")
    central = members.join(members.groupBy("node").agg(F.sum("members").alias("_met")), "node")
    leaders = materialize(central.groupBy("band").agg(F.max(F.struct("_met", "node"))["node"].alias("leader")), "leaders")
    sketches = nodes.select("node", "sketch", "parity", "n")
    needed = members.select("node").distinct().join(nodes.select("node", "pick"), "node")
    label = materialize(needed.select("node", F.col("node").alias("label")), "labels")
    n_bits = HASHES * 2 * (1 - percent / 100 + _SLACK)
    bits = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    differ = bits("_sa", "_sb")
    # linked sets differ in (100 - percent) / (100 + percent) of the sum of their sizes at most, their parities in no more bits
    exact = bits("_ea", "_eb") * (100 + percent) <= (F.col("_na") + F.col("_nb")) * (100 - percent)
    alike = (F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * percent) & exact & (differ <= n_bits)
    carried = lambda of: [F.col("sketch").alias(f"_s{of}"), F.col("parity").alias(f"_e{of}"), F.col("n").alias(f"_n{of}")]
    sides = lambda node, of: sketches.select(F.col("node").alias(node), *carried(of))
    common_bands = members.join(leaders, "band").filter("node != leader").groupBy("node", "leader").agg(F.count("*").alias("_bands"))
    pairs = common_bands.groupBy(F.col("node").alias("b")).agg(F.max_by("leader", F.struct("_bands", "leader")).alias("a"))
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("_na")).otherwise(F.col("_nb")).alias("_na"),
            F.when(F.col("a") < F.col("b"), F.col("_nb")).otherwise(F.col("_na")).alias("_nb")]
    near = materialize(pairs.join(sides("a", "a"), "a").join(sides("b", "b"), "b").filter(alike).select(*pair).distinct(), "near")
    checked, reach, best_only, all_met = near.select("a", "b"), HEADS, True, False
    sets = _node_sets(docs, needed, id_column, text_column)
    while True:
        common = F.size(F.array_intersect("_x", "_y"))
        links = (
            near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("_y")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("_x")), "a")
            .withColumn("_common", common.cast("long"))
            .filter(F.col("_common") * 100 >= (F.col("_na") + F.col("_nb") - F.col("_common")) * percent).select("a", "b"))
        links = materialize(links, "confirmed")
        # links between components join them
        if not links.isEmpty():
            joined = links.join(label.select(F.col("node").alias("a"), F.col("label").alias("_la")), "a").join(
                label.select(F.col("node").alias("b"), F.col("label").alias("_lb")), "b").select("_la", "_lb").filter("_la != _lb")
            merged = connected_components(joined, "_la", "_lb").select(F.col("node").alias("label"), F.col("label").alias("_to"))
            label = materialize(label.join(merged, "label", "left").select("node", F.coalesce("_to", "label").alias("label")), "labels")
        # bands that still hold several components, with the number of each one's nodes there
        labelled = members.select("band", "node").join(label, "node")
        parts = labelled.groupBy("band", "label").agg(F.count("*").alias("part"))
        mixed = parts.groupBy("band").agg(F.count("*").alias("_parts")).filter("_parts > 1").select("band")
        parts = materialize(parts.join(mixed, "band"), "mixed")
        most = parts.agg(F.max("part")).first()[0]
        if most is None or all_met:          # one component a band, or no two uncompared
            break
        all_met = reach > most and not best_only
        left = materialize(labelled.join(parts, ["band", "label"]).join(sketches, "node"), "apart")
        # some nodes of each component by a hash, in the end all; those of the larger component meet all of the smaller one
        rank = F.pmod(F.xxhash64("node", "band"), F.lit(1 << 30)) * F.col("part") / float(1 << 30)
        heads = left.filter(rank < reach).select(
            F.col("band").alias("_band"), F.col("node").alias("a"), F.col("label").alias("_la"), F.col("part").alias("_pa"), *carried("a"))
        others = left.select("band", F.col("node").alias("b"), F.col("label").alias("_lb"), F.col("part").alias("_pb"), *carried("b"))
        larger = (F.col("_pa") > F.col("_pb")) | ((F.col("_pa") == F.col("_pb")) & (F.col("_la") < F.col("_lb")))
        met = others.join(heads, (F.col("band") == F.col("_band")) & larger & alike)
        if best_only:        # first the closest head of each component, as most of its other pairs are then joined already
            closest = F.min_by(F.struct("a", "_na", "_nb"), F.struct(differ, F.col("a")))
            met = met.groupBy("b", "_la").agg(closest.alias("_best")).select("b", "_best.*")
        near = materialize(met.select(*pair).distinct().join(checked, ["a", "b"], "left_anti"), "near")
        checked, reach, best_only = checked.unionByName(near.select("a", "b")), reach * MORE, False
    classes = nodes.select("node", "least_id").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_node = classes.join(least, "label").select("node", "component_id")
    return signed.select("doc_id", "n_shingles", "node", "text_key").join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(False)).alias("kept"), "text_key")


def _node_sets(docs: DataFrame, needed: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(node, shingles) of the nodes that share a band, each from the text of one row (or of rows that repeat it). Texts are shuffled once, at every size."""
    rows = _keyed(docs, id_column, text_column)
    found = rows.alias("r").join(needed.hint("merge").alias("k"), (F.col("r.row_id") == F.col("k.pick.row_id")) & (F.col("r.text_key") == F.col("k.pick.text_key")))
    return materialize(_sets(found.select("k.node", "r.text")), "sets")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate group at 85 %."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85).drop("text_key")
