"""Time blocks: tiling, assignment, resuming, extending and retention.

A manifest is a table with one row per committed block: ``seq`` (order of commits), ``block_start``,
``block_end``, ``recipe_id``. A version table has one row per published version: ``output``, ``seq``,
``written_at``.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridspark.functions.times import floor_to, plus, seconds, stamp

Instant = str | datetime.datetime


def blocks(spark: SparkSession, start: Instant, end: Instant, step: str | datetime.timedelta) -> DataFrame:
    """``(block, block_start, block_end)``: ``[start, end)`` tiled by ``step``, the last cut at the end."""
    by = seconds(step)
    if by <= 0:
        raise ValueError("the step of blocks is positive")
    low, high = stamp(start), stamp(end)
    span = F.unix_seconds(high) - F.unix_seconds(low)
    many = F.ceil(span / by).cast("int")
    numbers = spark.range(1).where(low < high).select(F.explode(F.sequence(F.lit(0), many - 1)).alias("block"))
    left = plus(low, F.col("block").cast("bigint") * by)
    return numbers.select("block", left.alias("block_start"), F.least(plus(left, by), high).alias("block_end"))


def assign_block(
    rows: DataFrame, start: Instant, end: Instant, step: str | datetime.timedelta, time_dim: str = "time"
) -> DataFrame:
    """The rows in ``[start, end)`` with ``block`` and ``block_start``: arithmetic, no join."""
    by = seconds(step)
    t = F.col(time_dim)
    inside = rows.where((t >= stamp(start)) & (t < stamp(end)))
    left = floor_to(t, stamp(start), by)
    number = ((F.unix_seconds(left) - F.unix_seconds(stamp(start))) / by).cast("int")
    return inside.withColumns({"block": number, "block_start": left})


def pending_blocks(planned: DataFrame, manifest: DataFrame) -> DataFrame:
    """The planned blocks that are not committed."""
    return planned.join(manifest.select("block_start", "block_end"), ["block_start", "block_end"], "left_anti")


def not_a_prefix(planned: DataFrame, manifest: DataFrame, recipe_id: str | None = None) -> DataFrame:
    """``(problem, block_start)``: committed blocks that do not let a run resume: not planned, after
    one that is pending, or written with another recipe."""
    keys = ["block_start", "block_end"]
    foreign = manifest.join(planned, keys, "left_anti").select(F.lit("not planned").alias("problem"), "block_start")
    first = pending_blocks(planned, manifest).agg(F.min("block_start")).scalar()
    late = manifest.join(planned, keys, "left_semi").where(F.col("block_start") > first)
    out = foreign.unionByName(late.select(F.lit("after a pending block").alias("problem"), "block_start"))
    if recipe_id is not None:
        other = manifest.where(F.col("recipe_id") != recipe_id)
        out = out.unionByName(other.select(F.lit("another recipe").alias("problem"), "block_start"))
    return out


def extension_start(manifest: DataFrame) -> DataFrame:
    """One row: where an extension starts, the end of the last committed block."""
    return manifest.agg(F.max_by("block_end", "seq").alias("start"))


def already_committed(manifest: DataFrame, block_start: Instant) -> DataFrame:
    """The manifest's row of a block if it is the last one committed: it is not appended again."""
    last = manifest.agg(F.max("seq")).scalar()
    return manifest.where((F.col("seq") == last) & (F.col("block_start") == stamp(block_start)))


_SALTS = 64


def top_of_groups(rows: DataFrame, group: str, order: str, keep: int) -> DataFrame:
    """The ``keep`` rows with the largest ``order`` of each group.

    Ranked twice: within salted parts of a group, then among the few that remain, so that a group
    with a third of all rows is not sorted by one task.
    """
    salt = F.pmod(F.xxhash64(order), F.lit(_SALTS)).alias("__salt")
    part = Window.partitionBy(group, "__salt").orderBy(F.col(order).desc())
    first = rows.select("*", salt).withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= keep)
    whole = Window.partitionBy(group).orderBy(F.col(order).desc())
    ranked = first.withColumn("__r", F.row_number().over(whole)).where(F.col("__r") <= keep)
    return ranked.drop("__r", "__salt")


def expired_versions(
    versions: DataFrame,
    now: Instant | None = None,
    keep_history: str | datetime.timedelta | None = None,
    keep_versions: int | None = None,
    output: str = "output",
) -> DataFrame:
    """The versions to expire: beyond the last ``keep_versions``, or replaced (by the version after
    them) more than ``keep_history`` ago; never the current one.

    By age, the versions before the last one written by the limit were all replaced before it: one
    aggregation and an equi-join, no ordering of a whole history.
    """
    if (keep_history is None) == (keep_versions is None):
        raise ValueError("give exactly one of keep_history and keep_versions")
    if keep_versions is not None:
        if keep_versions < 1:
            raise ValueError("keep_versions is at least 1")
        kept = top_of_groups(versions.select(output, "seq"), output, "seq", keep_versions)
        return versions.join(kept, [output, "seq"], "left_anti").select(versions.columns)
    age = seconds(keep_history)
    if age < 0:
        raise ValueError("keep_history is not negative")
    limit = plus(stamp(now) if now is not None else F.current_timestamp(), -age)
    oldest = (
        versions.where(F.col("written_at") < limit).groupBy(output).agg(F.max("seq").alias("__last"))
    )
    return versions.join(oldest, output).where(F.col("seq") < F.col("__last")).select(versions.columns)
