"""Column names that a table doesn't have yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, with underscores added until `df` has no column of the name, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
