"""Shards by jump consistent hashing: no ring table, and growing moves only what the new shard takes.

A key walks through buckets: from bucket b it jumps to ``floor((b + 1) * 2^31 / (r + 1))``, where r are the upper 31
bits of the next state of a 64 bit linear congruential generator seeded by the key. The last bucket below the number of
shards is its shard. With one shard more, a key either stays or moves to the new shard.

Everything is a Column expression. Spark's integers raise on overflow, so the generator's state is kept as two halves of
32 bits and multiplied in parts of 16.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.shared import id_text, table

#: Fixed values of the generator: multiplier, in halves of 32 bits. Its increment is 1.
_MULTIPLIER = 2862933555777941757
_HIGH, _LOW = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_32 = 0xFFFFFFFF

#: Leading hexadecimal digits of the MD5 of id and ties by which rows of a shard are numbered piece by piece.
PIECE_DIGITS = 3


def _product32(x: Column, factor: int) -> Column:
    """The lower 32 bits (and some above) of x * factor, x below 2^32."""
    low, high = x.bitwiseAND(F.lit(0xFFFF)), F.shiftright(x, 16)
    return low * F.lit(factor) + F.shiftleft(high * F.lit(factor & 0xFFFF), 16)


def _jump(state: Column) -> Column:
    """The state after one more number of the generator: halves of the key, bucket, and the bucket to jump to."""
    high, low = state["high"], state["low"]
    first = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(_LOW) + F.lit(1)
    second = F.shiftright(low, 16) * F.lit(_LOW)
    sum_low = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(sum_low, 32) + F.shiftright(second, 16)
    new_low = sum_low.bitwiseAND(F.lit(_32))
    new_high = (_product32(high, _LOW) + _product32(low, _HIGH) + carry).bitwiseAND(F.lit(_32))
    target = (state["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(new_high, 1) + 1).cast("double"))
    return F.struct(
        new_high.alias("high"), new_low.alias("low"), state["next"].alias("bucket"), target.cast("long").alias("next")
    )


def _walk(state: Column, shards: int, steps: int) -> Column:
    """Up to ``steps`` jumps, none once the next bucket lies beyond the last shard."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        state,
        lambda seen, _: F.when(seen["next"] >= shards, seen).otherwise(_jump(seen)),
    )


def jumped(key: Column, shards: int) -> Column:
    """A struct with the ``bucket`` of a long key among ``shards``, and the ``next`` bucket it would jump to.

    A null key counts as -1. Keys need ln(shards) jumps in the mean; a short walk does for nearly all and the rest go on,
    as far as there are shards.
    """
    key = F.coalesce(key.cast("long"), F.lit(-1).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(F.lit(_32)).alias("low"),
        F.lit(-1).cast("long").alias("bucket"),
        F.lit(0).cast("long").alias("next"),
    )
    short = 4 * math.ceil(math.log2(shards + 1)) + 8
    if short >= shards:
        return _walk(start, shards, shards)
    begun = _walk(start, shards, short)
    return F.when(begun["next"] >= shards, begun).otherwise(_walk(begun, shards, shards))


def shard_of(key: Column, shards: int) -> Column:
    return jumped(key, shards)["bucket"].cast("int")


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard``, the shard among one more; columns of these names are replaced.

    Every row gets a shard, a null key that of -1; equal keys share a shard; text plays no part. An empty table stays
    empty.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    walked = df.drop("shard", "grown_shard").withColumn("__jump", jumped(F.col(key), shards))
    return walked.select(
        *[F.col(f"`{c}`") for c in walked.columns if c != "__jump"],
        F.col("__jump.bucket").cast("int").alias("shard"),
        F.when(F.col("__jump.next") == shards, shards).otherwise(F.col("__jump.bucket")).cast("int").alias("grown_shard"),
    )


def number_slots(sharded: DataFrame, key: str = "doc_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """``slot``: positions from 0 without a gap within each shard, by the MD5 of the key and the columns ``ties``.

    A shard is numbered in pieces by the first digits of the MD5: the counts of the pieces before (at most 16 to the
    power of ``PIECE_DIGITS`` of them in a shard) plus the position within the piece. No task needs a whole shard; rows
    that share a key, or have none, are spread over the pieces by their ties, so these should tell them apart. Nulls in key
    and ties count as empty here. Rows equal in all of them are numbered in any order; an empty table gives none.
    """
    parts = [id_text(F.col(c)) for c in (key, *ties)]
    rows = sharded.withColumn("__order", F.md5(F.concat_ws(":", *parts).cast("binary"))).withColumn(
        "__piece", F.substring("__order", 1, PIECE_DIGITS)
    )
    before = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "__piece")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("shard", "__piece", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    within = Window.partitionBy("shard", "__piece").orderBy("__order", key, *ties)
    return (
        rows.join(offsets, ["shard", "__piece"])
        .withColumn("slot", (F.col("__offset") + F.row_number().over(within) - 1).cast("long"))
        .drop("__order", "__piece", "__offset")
    )


def op2_jump_shards(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    """All documents in 40 shards by id, with sizes, checksums and slots."""
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    numbered = number_slots(assign_shards(thin, shards), ties=("size", "text_crc32"))
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: CRC-32 byte by byte over a table made from its polynomial; jumps in 128 bit integers.
OP2_SQL = """
WITH RECURSIVE
bits AS (
  SELECT i AS byte, 0 AS step, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
),
crc AS (SELECT list(c ORDER BY byte) AS entries FROM bits WHERE step = 8),
bytes AS (
  SELECT doc_id, rowid AS row, hex(encode(coalesce(text, ''))) AS hexed, strlen(coalesce(text, '')) AS n
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)
),
checks AS (
  SELECT b.row, b.doc_id, b.n,
    CASE WHEN b.n = 0 THEN 0 ELSE xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(b.n), lambda i: ('0x' || substr(b.hexed, 2 * i + 1, 2))::BIGINT)),
      lambda acc, x: xor(acc >> 8, crc.entries[(xor(acc, x) & 255) + 1])), 4294967295) END AS text_crc32
  FROM bytes b, crc
),
jumps AS (
  SELECT row, CASE WHEN doc_id IS NULL THEN 18446744073709551615::HUGEINT
    WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END AS k,
    -1::BIGINT AS b, 0::BIGINT AS j
  FROM checks
  UNION ALL
  SELECT row, k2, j, floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT row, j, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jumps WHERE j < 40)
),
ends AS (SELECT row, max(b) AS shard, CASE WHEN max(j) = 40 THEN 40 ELSE max(b) END AS grown FROM jumps GROUP BY row)
SELECT c.doc_id, (c.n + 16)::BIGINT AS size, c.text_crc32::BIGINT AS text_crc32, 'key' AS law, e.shard::INT AS shard,
  (row_number() OVER (PARTITION BY e.shard ORDER BY
    md5(coalesce(c.doc_id::VARCHAR, '') || ':' || (c.n + 16) || ':' || c.text_crc32), c.doc_id, c.n, c.text_crc32) - 1)::BIGINT AS slot,
  e.grown::INT AS grown_shard
FROM checks c JOIN ends e USING (row)
"""
