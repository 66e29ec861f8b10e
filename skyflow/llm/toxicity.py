"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from .arrow import map_rows, texts_of
from .vocab import batches

ORDERS = (3, 4, 5, 6)        # bytes of an n-gram
BUCKET_BITS = 20             # n-grams are hashed into this many buckets of bits
ROWS_PER_CLASS = 10_000      # the bound of the sample that is fitted on
FEATURES = 8_192             # buckets kept at most, those whose log-count ratio is furthest from chance
MIN_STRENGTH = 3.5           # standard errors that a kept ratio lies from chance at least
THRESHOLD = 0.7
_SMOOTH = 1.0
_BASE, _MIX = np.uint32(0x01000193), np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class ToxicityModel:
    buckets: np.ndarray      # the kept buckets
    weights: np.ndarray      # of each, with its log-count ratio multiplied in
    bias: float


def _grams(texts: list[str], wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the n-grams that each lower-cased text has, each once, in order. `wanted` gives the feature of
    each bucket, -1 for none; without it the bucket itself is the feature."""
    raw = [t.lower().encode("utf-8", "replace") for t in texts]
    stops = np.cumsum([len(r) for r in raw])
    b = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    found = []
    h = np.zeros(len(b), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(b) < n:
            break
        h = h[: len(b) - n + 1] * _BASE + b[n - 1:]
        if n not in ORDERS:
            continue
        bucket = ((h ^ (h >> np.uint32(15))) * (_MIX + np.uint32(2 * n))) >> np.uint32(32 - BUCKET_BITS)
        if wanted is None:
            at, feature = np.arange(len(bucket)), bucket.astype(np.int64)
        else:
            feature = wanted[bucket]
            at = np.flatnonzero(feature >= 0)
            feature = feature[at].astype(np.int64)
        text = np.searchsorted(stops, at, side="right")
        inside = at + n <= stops[text] if len(at) else np.zeros(0, bool)
        found.append((text[inside].astype(np.int64) << 32) | feature[inside])
    both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return both >> 32, both & 0xFFFFFFFF


def _slots(buckets: np.ndarray) -> np.ndarray:
    out = np.full(1 << BUCKET_BITS, -1, np.int32)
    out[buckets] = np.arange(len(buckets))
    return out


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> ToxicityModel:
    """
    Learn from the labelled documents: `labels` has `id_column` and `label_column` (0 or 1; other values and nulls are left
    out; an id labelled twice is toxic if any label says so). At most `rows_per_class` documents of each class are
    fitted on, chosen by a hash of their id; classes are weighted back to their shares among all labels.

    Spark counts in how many documents of each class every hashed n-gram occurs and turns the counts into log-count ratios;
    the rows of the bounded sample, reduced to the kept n-grams, are then fitted by logistic regression on the
    driver. Without labelled documents of both classes the model scores every text by the share of label 1 (0.5 without labels).
    """
    spark = docs.sparkSession
    classes = labels.filter(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(
        F.col(id_column).alias("_id")).agg(F.max(label_column).cast("int").alias("_label"))
    share = {r["_label"]: r["n"] for r in classes.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    prior = (share.get(1, 0) + 0.5) / (sum(share.values()) + 1)
    constant = ToxicityModel(np.empty(0, np.int64), np.empty(0, np.float32), float(np.log(prior / (1 - prior))))
    if len(share) < 2:
        return constant
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = None
    for label in (0, 1):
        part = classes.filter(F.col("_label") == label).orderBy(*order).limit(rows_per_class)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * rows_per_class ids and labels: bounded, so broadcast
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(sample), "_id").select("_label", "_text")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        n = np.zeros(2, np.int64)
        for part in parts:
            texts, label = texts_of(part.column(1)), np.array(part.column(0).to_pylist(), np.int64)
            n += np.bincount(label, minlength=2)
            for a, b in batches([len(t) for t in texts]):
                text, bucket = _grams(texts[a:b], None)
                for c in (0, 1):
                    seen[c] += np.bincount(bucket[label[a:b][text] == c], minlength=seen.shape[1]).astype(np.int32)
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[0][used], n[0])), pa.array(np.append(seen[1][used], n[1]))],
            names=["bucket", "n0", "n1"])

    counts = map_rows(rows, count, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    totals = counts.filter("bucket = -1").select("n0", "n1").first()
    if not totals or not min(totals):
        return constant
    n0, n1 = totals
    ratio = F.log((F.col("n1") + _SMOOTH) / (n1 + 2 * _SMOOTH)) - F.log((F.col("n0") + _SMOOTH) / (n0 + 2 * _SMOOTH))
    strength = F.abs("ratio") / F.sqrt(1 / (F.col("n1") + _SMOOTH) + 1 / (F.col("n0") + _SMOOTH))
    best = (
        counts.filter("bucket >= 0").withColumn("ratio", ratio).withColumn("strength", strength).filter(F.col("strength") >= MIN_STRENGTH)
        .orderBy(F.desc("strength"), "bucket").limit(FEATURES).select("bucket", "ratio").collect())
    buckets = np.array([r["bucket"] for r in best], np.int64)
    ratios = np.array([r["ratio"] for r in best], np.float64)

    def reduce_(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _slots(buckets)
        for part in parts:
            texts = texts_of(part.column(1))
            for a, b in batches([len(t) for t in texts]):
                text, feature = _grams(texts[a:b], wanted)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(b - a + 1)), pa.int32()), pa.array(feature.astype(np.int16)))
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), lists], names=["_label", "features"])

    fitted = map_rows(rows, reduce_, "_label int, features array<smallint>").toArrow()     # bounded by the sample
    label = np.asarray(fitted.column("_label").combine_chunks()).astype(np.float64)
    lists = fitted.column("features").combine_chunks()
    feature = np.asarray(lists.values).astype(np.int64)
    row = np.repeat(np.arange(len(label)), np.diff(np.asarray(lists.offsets)))
    total = sum(share.values())
    weight = np.where(label == 1, share[1] / max(n1, 1), share[0] / max(n0, 1)) / total
    weights, bias = _logistic(row, feature, ratios, label, weight)
    return ToxicityModel(buckets, (weights * ratios).astype(np.float32), bias)


def _logistic(
    row: np.ndarray, feature: np.ndarray, ratios: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 300, l2: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on sparse binary rows whose columns are scaled by `ratios`, by Adam on all rows."""
    prior = float(weight @ label / weight.sum())
    params = np.zeros(len(ratios) + 1)
    params[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    weight = weight / weight.sum()
    for t in range(1, rounds + 1):
        z = np.bincount(row, (params[:-1] * ratios)[feature], minlength=len(label)) + params[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label)
        gradient = np.append(np.bincount(feature, error[row], minlength=len(ratios)) * ratios + l2 * params[:-1], error.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params -= 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-12)
    return params[:-1], float(params[-1])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_column: str = "text", score_column: str = "score", predicted_column: str = "predicted",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """
    All columns of `docs` plus the score (0 to 1) of the whole text and whether it reaches `threshold` (1 or 0). Input
    columns of those two names are replaced. Null and empty texts get the score of a text without n-grams; repeated rows
    get equal scores; an empty table gives an empty table. Nothing is shuffled; the model (at most FEATURES numbers)
    travels with the tasks.
    """
    docs = docs.drop(score_column, predicted_column)
    at = docs.columns.index(text_column)
    out = StructType(list(docs.schema.fields)).add(score_column, DoubleType(), False).add(predicted_column, IntegerType(), False)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _slots(model.buckets)
        for part in parts:
            texts, scores = texts_of(part.column(at)), [np.empty(0)]
            for a, b in batches([len(t) for t in texts]):
                text, feature = _grams(texts[a:b], wanted)
                z = np.bincount(text, model.weights[feature], minlength=b - a) + model.bias
                scores.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
            score = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*part.schema.names, score_column, predicted_column])

    return map_rows(docs, score, out)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document's label is not learned from: crc32 of its id as text leaves 1 when divided by 3 (null id: no)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that saw the labels of two thirds of the ids at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
