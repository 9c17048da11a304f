"""Queries over a table's whole span, wherever it lies."""

import datetime

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cubes import normal

from gridspark.suite import QUERIES, SQL


@pytest.mark.parametrize("first", ["2023-11-20 05:00:00", "2024-02-20 00:00:00"])
@pytest.mark.parametrize("name", ["J7_block_checks_whole", "C16_output_coverage_whole"])
def test_from_the_first_stamp_to_the_last(spark, tmp_path, name, first):
    """18 days beyond January 2024; J7's table has days without events."""
    start = datetime.datetime.fromisoformat(first)
    hours = [h for h in range(18 * 24) if not (name.startswith("J7") and 120 <= h < 170)]
    stamps = [start + datetime.timedelta(hours=h, minutes=h % 60) for h in hours]
    n = len(stamps)
    events = {"event_id": range(n), "ts": pa.array(stamps, pa.timestamp("us")), "user_id": [i * 7 % 64 for i in range(n)]}
    pq.write_table(pa.table(events | {"value": [float(i % 9) for i in range(n)]}), tmp_path / "events.parquet")
    made = duckdb.connect()
    made.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    ours = QUERIES[name](spark, str(tmp_path)).toPandas()
    pd.testing.assert_frame_equal(normal(ours), normal(made.sql(SQL[name]).df()))
    times = ours["text"].dropna() if name.startswith("C16") else ours["time"].astype(str)
    assert min(times)[:10] == first[:10] and max(t[:10] for t in times if t[0] != "P") == str(stamps[-1])[:10]
