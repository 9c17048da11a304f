"""The registered queries: against SQL on the smallest tables, or against the rules of their results."""

import os
import zlib

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from gridspark.llm import decontaminate
from gridspark.llm.shared import table
from gridspark.llm.suite import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def tables():
    made = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark", "conversations"):
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return made


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_and_sql(spark, tables, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), tables.sql(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    keys = [c for c in ("doc_id", "page_id", "word", "conv_id", "depth") if c in ours]
    ours, theirs = (d[ours.columns].sort_values(keys).reset_index(drop=True) for d in (ours, theirs))
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_quality_of_held_out_rows(spark, tables):
    rows = QUERIES["op6_quality"](spark, SF).toPandas().merge(tables.sql("SELECT doc_id, quality FROM labels").df(), on="doc_id")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.itertuples())
    held = rows[rows.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert all((held.score >= 0.5) == (held.predicted == 1))
    assert len(bad) == 0 or (good.to_numpy()[:, None] > bad.to_numpy()).mean() > 0.9


def test_pipeline(spark, tables):
    docs = table(spark, SF, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        ids = [r["doc_id"] for r in rows]
        if name != "shards":
            assert out.columns == docs.columns and all(r == before[r["doc_id"]] for r in rows)
        if name in ("quality", "near duplicates", "decontamination"):
            assert len(ids) == len(set(ids)) and 0 < len(ids) <= len(before)
        if name == "decontamination":
            bench = table(spark, SF, "benchmark")
            gone = {r["doc_id"] for r in decontaminate.contaminations(docs, bench).collect()}
            assert set(ids) == set(before) - gone
        before = {r["doc_id"]: r for r in rows}
        docs = spark.createDataFrame(rows, out.schema)
    assert {r["shard"] for r in rows} <= set(range(corpus_pipeline.SHARDS))
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
