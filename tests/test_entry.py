"""Every registered query against its reference SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tools.compare import TABLES, check

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    verdict, _ = check(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "avg_temp_c" in df.columns


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
