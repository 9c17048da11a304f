"""Mixing sources to target weights: whole copies at a source's repetition rate, and one more by a seeded draw.

The sizes of a source are summed once (partial sums before the shuffle, so a hot source costs nothing more). Its target
follows from all sources' sums: weights are shared out until every target is within its stop. A document is then taken
``floor(rate)`` times, and once more if a number drawn from its id, its text and the seed lies below the rest of the
rate. No document needs another, so reruns agree and lost tasks are repeated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.shared import id_text, table, words_in, written

#: Sources are sent to all executors if their names and figures take at most so many bytes; else they are joined.
BROADCAST_BYTES = 16 << 20
#: Parts into which the rows of a source are dealt in that join.
SALTS = 64


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, stop: float = 2.0) -> DataFrame:
    """A row per source with ``source_size``, ``target`` and ``rate``, from rows of ``source`` and ``size``.

    Sources by code point, null last, take the weights in turn. Together they get ``share`` times all sizes; a source
    gets at most ``stop`` times its size, what is above goes to the others by weight. With L the level at which the
    targets ``min(stop * size, L * weight)`` add up, sources stop in the order of ``size / weight``: L is what is left
    after the stopped ones, over the weights of the rest. Stopping a source raises that quotient as long as the source
    lies below it and lowers it afterwards, so L is the largest. The windows run over one row per source. A source
    without words has the target 0 and the rate 0.
    """
    everything = Window.partitionBy(F.lit(0))
    by_stop = everything.orderBy("__reach", F.asc_nulls_last("source"))
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    sums = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = (F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weighed = (
        sums.withColumn("__weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("__stop", F.col("source_size") * F.lit(float(stop)))
        .withColumn("__reach", F.col("__stop") / F.col("__weight"))
    )
    levels = weighed.withColumn(
        "__level",
        (
            F.sum("source_size").over(everything) * F.lit(float(share))
            - F.coalesce(F.sum("__stop").over(earlier), F.lit(0.0))
        )
        / (F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(earlier), F.lit(0.0))),
    )
    target = F.least(F.col("__stop"), F.max("__level").over(everything) * F.col("__weight"))
    return levels.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def drawn(key: Column, text: Column, seed: int) -> Column:
    """A number from 0 up to 1 drawn from a key, a text and a seed: the first 52 bits of their MD5. Null counts as empty."""
    of_text = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_text(key), F.lit(":"), of_text).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_sources(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """``docs`` with the figures of their source; null is a source too.

    ``sources`` is broadcast if it is small enough. Otherwise each source is repeated for every salt, and a source's
    documents are dealt out over the salts by their text, so that no task gets all rows of one source.
    """
    size = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64)).first()[0] or 0
    renamed = sources.withColumnRenamed("source", "__source")
    same = F.col("source").eqNullSafe(F.col("__source"))
    if size <= BROADCAST_BYTES:
        return docs.join(F.broadcast(renamed), same).drop("__source")
    salted = renamed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = docs.withColumn("__dealt", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("__dealt") == F.col("__salt"))).drop("__source", "__salt", "__dealt")


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    stop: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """``docs`` (doc_id, text, source and any other columns) with how often the mix takes each.

    Adds ``size`` (words, 0 for null), ``source_size``, ``target`` and ``copies``; columns of these names are replaced.
    Rows are kept as they are: rows of one id, or without one, are drawn apart by their texts; only rows equal in both are
    drawn alike. A null id or text draws like an empty one, an empty table gives none.
    """
    sized = docs.drop("size", "source_size", "target", "copies").withColumn("size", words_in(F.col("text")))
    sources = written(targets(sized.select("source", "size"), weights, share, stop), "sources")
    rated = with_sources(sized, sources.withColumnRenamed("rate", "__rate"))
    whole = F.floor("__rate")
    extra = F.when(drawn(F.col("doc_id"), F.col("text"), seed) < F.col("__rate") - whole, 1).otherwise(0)
    return rated.withColumn("copies", (whole + extra).cast("long")).drop("__rate")


def emit(planned: DataFrame) -> DataFrame:
    """Each row ``copies`` times, in full; rows with no copies go."""
    return (
        planned.filter(F.col("copies") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .drop("__copy")
    )


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents, with the columns of ``docs``; see :func:`plan_mix`."""
    return emit(plan_mix(docs, **settings)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their source's target and the words that the mix takes of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS of_text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS stop
  FROM sums
),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(stop) OVER earlier, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
rates AS (SELECT source, source_size, least(stop, max(level) OVER () * weight)::DOUBLE AS target FROM levels)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || of_text), 1, 13))::BIGINT
    / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM (
  SELECT s.doc_id, s.size, s.of_text, r.source_size, r.target,
    CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0 END::DOUBLE AS rate
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
"""
