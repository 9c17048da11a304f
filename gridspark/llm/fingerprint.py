"""Document fingerprints of closed syncmers.

A run of K words is an anchor if the smallest of its word hashes stands at one of its ends. Whether a run is chosen
depends on its own words only, so that the same passage gives the same anchors in any text, about one for every two
words, and never leaves a long gap. Everything is built from array functions of Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.shared import table, written

#: Words of a run; the inner parts whose hashes are compared are single words.
K = 4
_SPACES = "[\\x20\\x09-\\x0D]+"
#: Stands for a null id.
_NO_ID = -(1 << 63)


def word_hashes(text: Column) -> Column:
    """The hash of every word of a text, in order; none for null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _short(hashed: Column) -> Column:
    return F.shiftright(hashed, 32).cast("int")


def anchors(hashes: Column) -> Column:
    """The anchors of word hashes, in order: an array of ``at`` (word from 0) and ``anchor`` (32 bits).

    A text of fewer than K words has each of them as an anchor.
    """
    last = f"h{K - 1}"
    rows = F.arrays_zip(*[F.slice(hashes, j + 1, F.greatest(F.size(hashes), F.lit(1))).alias(f"h{j}") for j in range(K)])
    placed = F.transform(rows, lambda r, i: F.struct(i.alias("at"), r.alias("r")))
    closed = F.filter(
        placed,
        lambda p: p["r"][last].isNotNull()
        & (F.least(p["r"]["h0"], p["r"][last]) <= F.least(*[p["r"][f"h{j}"] for j in range(1, K - 1)])),
    )
    runs = F.transform(
        closed,
        lambda p: F.struct(p["at"].alias("at"), _short(F.xxhash64(*[p["r"][f"h{j}"] for j in range(K)])).alias("anchor")),
    )
    words = F.transform(hashes, lambda h, i: F.struct(i.alias("at"), _short(h).alias("anchor")))
    return F.when(F.size(hashes) < K, words).otherwise(runs)


def anchor_values(hashes: Column) -> Column:
    """As :func:`anchors`, without the places."""
    n = F.greatest(F.size(hashes), F.lit(1))
    last = f"h{K - 1}"
    rows = F.arrays_zip(*[F.slice(hashes, j + 1, n).alias(f"h{j}") for j in range(K)])
    closed = F.filter(
        rows,
        lambda r: r[last].isNotNull() & (F.least(r["h0"], r[last]) <= F.least(*[r[f"h{j}"] for j in range(1, K - 1)])),
    )
    runs = F.transform(closed, lambda r: _short(F.xxhash64(*[r[f"h{j}"] for j in range(K)])))
    return F.when(F.size(hashes) < K, F.transform(hashes, _short)).otherwise(runs)


def as_text(values: Column) -> Column:
    """Anchors as eight hexadecimal digits each."""
    digits = F.transform(values, lambda v: F.lpad(F.lower(F.hex(v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


def likeness(one: Column, other: Column) -> Column:
    """Anchors that two sets share, over the size of the larger; 1 for two empty ones."""
    larger = F.greatest(F.size(one), F.size(other))
    return F.when(larger == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / larger)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``anchors``: the places and values of a text's anchors; a column of that name is replaced.

    Null and empty texts have none; equal texts have equal ones, whatever the other columns hold.
    """
    return (
        docs.drop("anchors")
        .withColumn("__hashes", word_hashes(F.col(text)))
        .withColumn("anchors", anchors(F.col("__hashes")))
        .drop("__hashes")
    )


def following(keys: DataFrame) -> DataFrame:
    """Each distinct key with ``next``: the key after it in descending order, after the last the first.

    Keys are sorted over all tasks and written with their place; what comes before a part is summed from the parts'
    sizes, of which there are as many as shuffle partitions.
    """
    place = F.monotonically_increasing_id()
    placed = written(keys.orderBy(F.col("key").desc()).withColumn("__place", place), "order")
    placed = placed.withColumn("__part", F.shiftright("__place", 33))
    all_parts = Window.partitionBy(F.lit(0))
    before = all_parts.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .withColumn("__all", F.sum("__rows").over(all_parts))
    )
    ranked = placed.join(F.broadcast(parts), "__part").withColumn(
        "__rank", F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    after = ranked.select(
        F.col("key").alias("next"), F.when(F.col("__rank") == 0, F.col("__all") - 1).otherwise(F.col("__rank") - 1).alias("__rank")
    )
    return ranked.join(after, "__rank").select(*keys.columns, "next")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how near they and the next texts are.

    A row per row of ``docs`` (doc_id, text; other columns are ignored). Null texts count as empty. Null ids come last in
    the order. Where rows share an id, the next text is the least of that id's texts.
    """
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text")
    )
    counts = base.groupBy("key").agg(
        F.max(F.floor(F.char_length("text") / 3)).cast("int").alias("need"), F.count(F.lit(1)).alias("rows")
    )
    chain = written(following(counts), "chain")
    single = base
    if chain.filter("rows > 1").limit(1).count():
        single = base.groupBy("key").agg(F.min("text").alias("text"))
    heads = (
        chain.select(F.col("key").alias("own"), F.col("next").alias("key"), "need")
        .join(single, "key")
        .withColumn("__hashes", word_hashes(F.col("text")))
        .select(
            F.col("own").alias("key"),
            F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head"),
            F.array_distinct(anchor_values(F.col("__hashes"))).alias("next_set"),
        )
    )
    n = F.col("n_chars")
    return (
        base.join(heads, "key")
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .withColumn("cut", F.floor(n / 3).cast("int"))
        .withColumn(
            "edited",
            F.concat(
                F.substring(F.col("text"), F.lit(1), (n - F.col("cut")).cast("int")),
                F.substring(F.col("head"), F.lit(1), F.col("cut")),
            ),
        )
        .withColumn("__hashes", word_hashes(F.col("text")))
        .withColumn("__edited", word_hashes(F.col("edited")))
        .withColumn("values", anchor_values(F.col("__hashes")))
        .withColumn("edited_values", anchor_values(F.col("__edited")))
        .withColumn("own_set", F.array_distinct("values"))
        .select(
            F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"),
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            as_text(F.col("values")).alias("fingerprint"),
            as_text(F.col("edited_values")).alias("edited_fingerprint"),
            likeness(F.col("own_set"), F.array_distinct("edited_values")).alias("near_edited"),
            likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
        )
    )


def op9_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))
