"""Every registered query against its DuckDB statement on the smallest data."""

import duckdb
import pytest

from __spark_entry__ import entry, queries
from checks.compare import differences
from checks.oracles import oracle_statements
from checks.queries import QUERIES
from checks.views import BASE_TABLES
from conftest import SMALL

ORACLES = oracle_statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    ours = queries()[name](spark, SMALL).toPandas()
    assert differences(ours, duck.execute(ORACLES[name]).df()) == ""


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["d1_trade_star", "a3_add_cap_spikes", "e12_settle_book", "r9_sample_rank"])
def test_same_rows_for_any_partition_count(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(queries()[name](spark, SMALL).toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert differences(*results) == ""
