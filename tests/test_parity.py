"""Layer 1: every query with an oracle equals DuckDB on the same parquet tables.

Runs at sf0.001 to stay quick (the driver checks sf0.01); every registered
query without an oracle must at least run.
"""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = oracle_sql()
# many boosted trees: one job per tree level on a local master, minutes; the driver runs them
SLOW = {"model_compare", "gbt_fit", "batch_score"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


LLM = {n for n in queries() if n == "pipeline" or n.startswith("op")}  # tested in tests/llm


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LLM))
def test_oracle(spark, con, name):
    ok, msg, _ = compare(spark, con, name, queries()[name], ORACLE[name], SF)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLE) - SLOW - LLM))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() >= 0


def test_entry_schema(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["Store", "Date", "Sales"]


def test_every_query_has_a_name_match():
    assert set(ORACLE) <= set(queries())
