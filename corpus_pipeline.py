"""A corpus made ready for training: toxic documents go, one document of each near-duplicate group stays, recurring
passages are removed, sources are mixed to their weights, and what is left is packed into training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the columns of `documents`. `run` writes
each stage's rows to the shared folder and reads them again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyflow.llm.mixing import mixed_documents
from skyflow.llm.names import free_names
from skyflow.llm.near_dedup import near_duplicates
from skyflow.llm.packing import pack, token_pieces
from skyflow.llm.substring_dedup import drop_repeated_passages
from skyflow.llm.toxicity import fit_toxicity, held_out, score_toxicity
from skyflow.operators.lineage import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents that a classifier fitted on the labels (of ids that are not held out) doesn't call toxic. Null and empty texts score as a text without
    n-grams, repeated rows alike; other columns are carried along, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    score, toxic = free_names(docs, "_score", "_toxic")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), score_column=score, predicted_column=toxic)
    return scored.filter(F.col(toxic) == 0).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8): the one with the smallest id; repeated rows once. Rows
    without an id stay, each text once, unless they are near one with an id."""
    found = near_duplicates(docs)
    stays = found.filter("kept OR component_id IS NULL").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    own = free_names(docs, "_text_key")[0]
    keyed = docs.withColumn(own, F.xxhash64("text")).dropDuplicates(["doc_id", own]).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("s._id")) & (F.col(f"d.{own}") == F.col("s._key"))
    return keyed.join(stays.alias("s"), same, "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    Documents without the passages that recur; n_chars follows the text. Null and empty texts stay as they are; a repeated row's passages recur; other
    columns are carried along.
    """
    return drop_repeated_passages(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """
    The documents that the mix takes, as often as it takes them, with the words that it takes. Rows without words are in no mix; null sources are
    one source; other columns are carried along.
    """
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens. Null and empty texts are one piece, the end id; other columns are left out."""
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False))


STAGES = [
    ("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("mixing", mixing), ("packing", packing),
]

#: Classifier, pseudorandom mix and tokenizer have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
