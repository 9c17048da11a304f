"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest
from cubes import SF, normal

from gridspark.suite import QUERIES, SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def tables():
    made = duckdb.connect()
    made.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        made.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return made


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    ours, theirs = normal(QUERIES[name](spark, SF).toPandas()), normal(tables.sql(SQL[name]).df())
    pd.testing.assert_frame_equal(ours, theirs)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
