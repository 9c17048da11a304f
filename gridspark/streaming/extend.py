"""Extending an output with what arrives: each new block is processed and published once."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridspark.cube import Cube
from gridspark.functions.times import seconds
from gridspark.operators.blocks import assign_block, blocks
from gridspark.plans.steps import process
from gridspark.sources.layout import Layout
from gridspark.sources.store import Output, intervals_of

_FAR = "9999-01-01"  # no end
_LEDGER = "block bigint, rows bigint, latest timestamp, batch int"


def consecutive(intervals: Sequence[tuple]) -> list[list[tuple]]:
    """Intervals in order, in runs that follow one another without a gap."""
    out: list[list[tuple]] = []
    for interval in intervals:
        if out and out[-1][-1][1] == interval[0]:
            out[-1].append(interval)
        else:
            out.append([interval])
    return out


def dirty_blocks(spark: SparkSession, ledger: str, output: Output, start: str, step: str) -> list[tuple]:
    """The complete blocks with rows that the output's current version has not read, in order.

    The ledger has a row per batch and block, whatever the number of staged rows.
    """
    seen = spark.read.schema(_LEDGER).parquet(ledger)
    latest = seen.agg(F.date_format(F.max("latest"), "yyyy-MM-dd HH:mm:ss")).first()[0]
    if latest is None or latest <= start:
        return []
    newest = seen.groupBy("block").agg(F.max("batch").alias("newest"))
    whole = (F.unix_seconds("block_end") - F.unix_seconds("block_start")) == seconds(step)
    planned = blocks(spark, start, latest, step).where(whole).join(newest, "block", "left")
    if output.current() is None:
        return intervals_of(planned)
    read = output.committed().select("block_start", "block_end", F.col("note").cast("int").alias("read"))
    joined = planned.join(read, ["block_start", "block_end"], "left")
    return intervals_of(joined.where(F.col("read").isNull() | (F.col("newest") > F.col("read"))))


def staged_rows(spark: SparkSession, staged: str, ledger: str, schema: T.StructType, numbers: Sequence[int]) -> DataFrame:
    """What is staged for some blocks; only the folders of those that have rows are listed."""
    known = spark.read.schema(_LEDGER).parquet(ledger).where(F.col("block").isin(list(numbers))).select("block").distinct()
    folders = [f"{staged}/block={r['block']}" for r in known.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", staged).parquet(*folders)


def stream_extend(
    source: DataFrame,
    output: Output,
    cube_of: Callable[[DataFrame], Cube],
    start: str,
    step: str,
    steps: Sequence[Mapping[str, Any]] = (),
    recipe_id: str = "",
    checks: Mapping[str, Mapping[str, Any]] | None = None,
    layout: Layout | None = None,
    time_dim: str = "time",
    checkpoint: str | None = None,
    staging: str | None = None,
) -> StreamingQuery:
    """Start a query that takes what is available of a stream and publishes its complete blocks.

    Every micro-batch is added to a staged table partitioned by block, and to a ledger with one row per batch and block: how
    many rows it brought and up to when. A block is complete when any batch has reached its end, and *dirty* while the ledger
    has a batch for it that its published version has not read; the version keeps the last batch it has read with each block.
    All complete blocks that are new or dirty are made from everything staged for them (``cube_of``, then ``steps``) and
    published together as one extension. So late rows count whatever batch brings them, also alone; and a batch run again
    rewrites its own partitions, so nothing is taken twice or lost.
    """
    spark = source.sparkSession
    staged = staging or f"{output.path}/staged"
    ledger = f"{staged}-ledger"
    output.create()

    def take(batch: DataFrame, number: int) -> None:
        rows = assign_block(batch, start, _FAR, step, time_dim).drop("block_start", "block_end")
        rows = rows.where(F.col("block") >= 0).withColumn("batch", F.lit(number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block", "batch").parquet(staged)
        brought = spark.read.schema(rows.schema).parquet(staged).where(F.col("batch") == number)
        brought = brought.groupBy("block").agg(F.count(F.lit(1)).alias("rows"), F.max(time_dim).alias("latest"))
        brought.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/batch={number}")
        todo = dirty_blocks(spark, ledger, output, start, step)
        if not todo:
            return
        run = output.start(recipe_id, "new" if output.current() is None else "extend", layout)
        origin, length = datetime.datetime.fromisoformat(start), seconds(step)
        for intervals in consecutive(todo):
            numbers = [int((left - origin).total_seconds() // length) for left, _ in intervals]
            inside = staged_rows(spark, staged, ledger, rows.schema, numbers).where(F.col("batch") <= number).drop("block", "batch")
            run.write_blocks(process(cube_of(inside), steps), intervals, checks, note=str(number))
        run.publish()

    return (
        source.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{output.path}/stream")
        .foreachBatch(take)
        .start()
    )

