"""Equi-joins whose left side may have a few very hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .lineage import materialize

ROWS_PER_TASK = 1_000_000   # a key with more left rows than this is split


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, _salts) of every key that holds more than `rows_per_task` rows: at most one for as many rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows_per_task)
    return counts.select(key, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    condition: Column,
    left_id: str,
    known_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """
    Inner join on `key` and `condition`. The rows of a hot left key are spread over several tasks
    by a hash of `left_id`, and the right rows of just those keys are repeated once per task, so
    every pair is still met exactly once. Without a hot key (found by one count per key, or known from
    the number of left rows) it is the plain join. All non-key column names of the two sides must differ.
    """
    salted = None
    if known_rows is None or known_rows > rows_per_task:     # fewer rows can't hold a hot key
        salted = materialize(hot_keys(left, key, rows_per_task), "hot-keys")
    same_key = F.col(f"l.{key}") == F.col(f"r.{key}")
    if salted is None or salted.isEmpty():
        return left.alias("l").join(right.alias("r"), same_key & condition).drop(F.col(f"r.{key}"))

    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = left.join(salted, key, "left").withColumn("_salt", F.pmod(F.hash(left_id), salts)).drop("_salts")
    repeated = (
        right.join(salted, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    )
    joined = spread.alias("l").join(
        repeated.alias("r"), same_key & (F.col("l._salt") == F.col("r._salt")) & condition
    )
    return joined.drop(F.col("r." + key), F.col("l._salt"), F.col("r._salt"))
