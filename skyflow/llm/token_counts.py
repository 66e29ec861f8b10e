"""Token counts by a compiled finite-state tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrow import map_rows, texts_of
from .vocab import batches, piece_bpe

TOKEN_LIMIT = 4096


def token_counts(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    `id_column`, n_bytes (UTF-8) and n_tokens of every whole text, as the sentencepiece model at `vocabulary` counts them.

    The model is compiled to a deterministic transducer whose transitions carry by how much each character changes the
    number of tokens (`transducer`). A batch of texts is cut into chunks of equal length whose state maps are found side by
    side and composed from left to right; the maps are constant from the first word start on, so composition is a scan.

    Null and empty texts have no tokens; null ids and repeated rows each keep their row; other columns are not read, so
    their names cannot clash; an empty table gives an empty table. Nothing is shuffled.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_bpe(vocabulary)
        for part in parts:
            texts = texts_of(part.column(1))
            tokens = [model.counts(texts[a:b]) for a, b in batches([len(t) for t in texts])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(np.concatenate([np.empty(0, np.int64), *tokens]))],
                names=[id_column, "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_column), F.col(text_column))
    return map_rows(rows, count, f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by piece_bpe_32k.model, and whether they pass the limit."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
