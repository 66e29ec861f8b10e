"""Compare registered queries with their check SQL: python tests/check.py sf0.01 [names...]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else int(value) if value.is_integer() else value
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return int(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, query, sql, sf_dir, look=None):
    """(problem or None, n_rows)."""
    df = query(spark, sf_dir)
    if look is not None:
        look(df)
    got_cols, got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns: only spark {set(got_cols) - set(want_cols)}, only sql {set(want_cols) - set(got_cols)}", len(got)
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return f"rows {len(got)} vs {len(want)}\n   cols  {got_cols}\n   spark {extra}\n   sql   {missing}", len(got)
    return None, len(got)


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sys.argv[1]}"
    con = duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or list(queries):
        start = time.time()
        if name not in sqls:
            print(f"no sql {name}: {queries[name](spark, sf_dir).count()} rows")
            continue
        try:
            problem, n = compare(spark, con, name, queries[name], sqls[name], sf_dir)
        except Exception as error:
            problem, n = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += problem is not None
        print(f"\n{'OK ' if problem is None else 'BAD'} {name} {n} rows {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"\n{bad} bad of {len(queries)}; without sql: {sorted(set(queries) - set(sqls))}; sql only: {sorted(set(sqls) - set(queries))}")


if __name__ == "__main__":
    main()
