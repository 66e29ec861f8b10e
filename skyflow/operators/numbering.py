"""Dense row numbers over a total order, without sending all rows through one task (a counted few excepted)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lineage import materialize

ONE_TASK_ROWS = 500_000   # up to this many (counted) rows a single sorted task is cheaper
_ROWS_BITS = 33           # monotonically_increasing_id keeps the row in the low 33 bits


def with_row_index(
    df: DataFrame, order: list[Column], name: str, known_rows: int | None = None, start: int = 0
) -> DataFrame:
    """`df` plus `name` = start, start+1, ... in the given total order."""
    if known_rows is not None and known_rows <= ONE_TASK_ROWS:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1 + F.lit(start).cast("long"))
    return write_row_index(df, order, name, start)[0]


def write_row_index(df: DataFrame, order: list[Column], name: str, start: int = 0) -> tuple[DataFrame, int]:
    """
    The numbered rows, already written out, and how many there are. The rows are range-partitioned and
    sorted, written once, and numbered by the offset of their partition plus their place in it. Only
    the per-partition counts (one row per partition) meet in one place.
    """
    columns = df.columns
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_placed", F.monotonically_increasing_id()),
        "row-index",
    )
    part = F.shiftright("_placed", _ROWS_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).collect()   # one row per partition
    offsets, total = [], 0
    for row in sorted(counts):
        offsets.append((row["_part"], start + total))
        total += row["_n"]
    first = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    numbered = placed.withColumn("_part", part).join(F.broadcast(first), "_part")
    place = F.col("_placed").bitwiseAND((1 << _ROWS_BITS) - 1)
    return numbered.select(*columns, (F.col("_offset") + place).alias(name)), total
