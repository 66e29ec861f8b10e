from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use for themselves
    T.StructField("size", T.StringType()), T.StructField("node", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("block", T.StringType()), T.StructField("length", T.StringType()),
])


def _odd_texts() -> list[str | None]:
    passage = " ".join(f"shared{i}" for i in range(40))
    words = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"long{i % 977}" for i in range(20_000))
    return [
        None, "", "   \n\t ", "one", "two words", words, words, words.upper(), words.replace("w7 ", "x7 "), f"a b c {passage} d e",
        f"{passage} f g", f"h {passage}", "same " * 80, long, "Ünïcödé straße 漢字 😀 it's I'D we'll", "<|endoftext|> <s>",
        "Licensed under the Apache License, Version 2.0.\nplain text here", "a" * 5000, "x\x00y\x1cz", "para one.\n\npara two.\nline.",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(i, t, "en", [None, "b", "a"][i % 3], len(t or "")) for i, t in enumerate(_odd_texts())]
    rows += [rows[5], rows[9], (None, _odd_texts()[5], None, None, None), (None, None, None, None, None), (3, "another text on one id", None, "b", None)]
    return spark.createDataFrame([r + ("1", "2", "3", "4", "5") for r in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
