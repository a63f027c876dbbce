"""Registered queries against their SQL, and the operators' habits that all share."""

import pytest
from oracle_check import assert_same, connect

import __spark_entry__ as entry_points
from cabtally.llm.queries import ORACLE, QUERIES


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, small, tmp_path, name):
    for table in ("documents", "pages", "labels", "embeddings", "conversations"):
        spark.read.parquet(f"{small}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
