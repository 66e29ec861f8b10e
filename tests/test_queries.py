"""Every registered query against its check SQL at the smallest scale, and the joins in every plan it runs."""

from __future__ import annotations

import check
import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as entry
from skyflow.plans import catalogue

QUERIES = {name: entry.queries()[name] for name in catalogue.QUERIES}
SQLS = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con():
    return check.duck("/root/testdata/sf0.001")


def _no_pairwise_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in PAIRWISE if word in plan], plan


@pytest.fixture
def written_plans(monkeypatch):
    """Look at the plan of everything that is written on the way, too."""
    write = DataFrameWriter.parquet

    def checked(self, *args, **kwargs):
        _no_pairwise_join(self._df)
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)


def test_every_query_has_its_sql():
    assert set(SQLS) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name, written_plans):
    problem, _ = check.compare(spark, con, name, QUERIES[name], SQLS[name], sf_dir, _no_pairwise_join)
    assert problem is None
