"""Exact repeated passages, found by full-text indexes over shards of the corpus.

A passage is a window of ``window`` words. Its anchor is the smallest hash of five words within it (the first, if equal),
so equal windows have equal anchors, wherever they stand; neighbouring windows mostly share theirs. The run of words under
the windows of one anchor is a segment. Only anchors that occur in two documents matter, and of equal segments one copy.
Those segments are dealt out by anchor to shards of bounded size. Each shard builds an FM-index of its segments and
streams them through it by backward search; where the matching statistics reach the window, the range of suffixes tells
the least document in which that window starts. The reported runs go back to every document that has the segment.

A line that very many documents share can be the anchor of as many different segments. The windows of such an anchor are
keyed by their own hash instead, and go the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.fm_index import FmIndex
from gridspark.llm.shared import table, written
from gridspark.llm.words import Chunk, chunks, mixed, run_hashes, word_hashes

#: Words whose hash may be an anchor.
GRAM = 5
#: Words of a shard's segments, in the mean at most.
SHARD_WORDS = 200_000
#: Different segments of one anchor from which its windows are keyed one by one.
HOT_SEGMENTS = 5_000
SAMPLED = 16
#: Of those anchors, so many are sent to all tasks at most (eight bytes each).
HOT_ANCHORS = 2_000_000
#: An anchor with more runs than ``HEAVY_RUNS``, and more than all runs by ``HEAVY_SHARE``, is dealt out when joined.
HEAVY_RUNS, HEAVY_SHARE = 20_000, 100_000
#: Stands for a null id, which comes after all others.
_NO_ID = (1 << 63) - 1

_RUNS = "anchor long, segment long, doc long, tag long, more int, at int, size int"
#: What names a row: its id, and 96 bits of its text for rows that share one.
_ROW = ["doc", "tag", "more"]


def _least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For each place, that of the first smallest value among it and the ``span - 1`` after it."""
    places, width = np.arange(len(values)), 1
    while width * 2 <= span:
        a, b = places[:-width], places[width:]
        places = np.where(values[a] <= values[b], a, b)
        width *= 2
    if width < span:
        by = span - width
        a, b = places[:-by], places[by:]
        places = np.where(values[a] <= values[b], a, b)
    return places


def _run_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = 0x9E3779B97F4A7C15
    powers = np.full(len(hashes) + 1, step, np.uint64)
    inverse = np.full(len(hashes) + 1, pow(step, -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * np.multiply.accumulate(powers)[:-1], out=sums[1:])
    return sums, np.multiply.accumulate(inverse)


def _windows(chunk: Chunk, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: word hashes, its windows' first words, their anchors' places, and the hashes there."""
    hashes = word_hashes(chunk)
    left = np.repeat(chunk.first[1:], np.diff(chunk.first)) - np.arange(len(hashes))
    starts = np.flatnonzero(left >= window)
    grams = run_hashes(hashes, GRAM)
    if not len(starts):
        return hashes, starts, starts, grams
    return hashes, starts, _least_places(grams, window - GRAM + 1)[starts], grams


def _hashed(hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    sums, inverse = _run_sums(hashes)
    return mixed(mixed((sums[start + size] - sums[start]) * inverse[start]) + size.astype(np.uint64)).view(np.int64)


def _run_batch(batch: pa.RecordBatch, chunk: Chunk, anchor, segment, start, size) -> pa.RecordBatch:
    of = np.searchsorted(chunk.first, start, side="right") - 1
    rows = pa.array(of + chunk.at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor),
            pa.array(segment),
            batch.column("doc").take(rows),
            batch.column("tag").take(rows),
            batch.column("more").take(rows),
            pa.array((start - chunk.first[of]).astype(np.int32)),
            pa.array(size.astype(np.int32)),
        ],
        ["anchor", "segment", *_ROW, "at", "size"],
    )


def _segment_runs(window: int, hot: np.ndarray):
    """Each text's segments; windows with one of the ``hot`` anchors (sorted) stand alone, under their own hash."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                hashes, starts, places, grams = _windows(chunk, window)
                if not len(starts):
                    continue
                if len(hot):
                    anchors = grams[places].view(np.int64)
                    alone = hot[np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)] == anchors
                    single = starts[alone]
                    size = np.full(len(single), window)
                    own = _hashed(hashes, single, size)
                    yield _run_batch(batch, chunk, mixed(own.view(np.uint64), 9).view(np.int64), own, single, size)
                    starts, places = starts[~alone], places[~alone]
                    if not len(starts):
                        continue
                fresh = np.flatnonzero(np.append(True, (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)))
                begin, last = starts[fresh], starts[np.append(fresh[1:], len(starts)) - 1]
                size = last + window - begin
                anchor = grams[places[fresh]].view(np.int64)
                yield _run_batch(batch, chunk, anchor, _hashed(hashes, begin, size), begin, size)

    return runs


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of segments, from the texts that have them."""
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for text, segments in zip(batch.column("text").cast(pa.binary()), batch.column("segments"), strict=True):
            words = text.as_py().split()
            for s in segments.as_py():
                rows.append((s["shard"], s["anchor"], s["segment"], s["least"], s["most"], b" ".join(words[s["at"] : s["at"] + s["size"]])))
                held += len(rows[-1][-1])
            if held > 8 << 20:
                yield _segments(rows)
                rows, held = [], 0
        yield _segments(rows)


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["shard", "anchor", "segment", "least", "most", "words"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repeated_windows(segments: list[bytes], least: np.ndarray, window: int) -> np.ndarray:
    """For each segment (words joined by spaces) and window of it, the least number among the segments that have it."""
    numbers: dict[bytes, int] = {}
    coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in s.split(b" ")], np.int64) for s in segments]
    sizes = np.array([len(c) for c in coded])
    text = np.concatenate([np.append(c, 0) for c in coded])
    index = FmIndex(text, np.repeat(least, sizes + 1))
    group, begins = index.groups(window)
    least_of = np.minimum.reduceat(index.owner, begins[:-1])
    out = np.full((len(segments), int(sizes.max()) - window + 1), _NO_ID, np.int64)
    for streams, places, lengths, lows, _ in index.statistics(coded, window):
        whole = np.flatnonzero(lengths >= window)
        out[streams[whole], places[whole]] = least_of[group[lows[whole]]]
    return out


def _reported(window: int):
    """Rows sorted by shard to the runs of windows of each segment that start in an earlier document."""

    def of_shard(rows: list[tuple]) -> list[tuple]:
        _, anchor, segment, least, most, words = zip(*rows, strict=True)
        found = repeated_windows(list(words), np.array(least, np.int64), window)
        earlier = found < np.array(most, np.int64)[:, None]
        out = []
        for i in np.flatnonzero(earlier.any(axis=1)).tolist():
            values = np.where(earlier[i], found[i], _NO_ID)
            edges = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            ends = np.append(edges[1:], len(values))
            some = values[edges] != _NO_ID
            out.append((anchor[i], segment[i], edges[some].tolist(), ends[some].tolist(), values[edges][some].tolist()))
        return out

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def done() -> pa.RecordBatch:
            found = of_shard(rows) if rows else []
            rows.clear()
            columns = list(zip(*found, strict=True)) or [[]] * 5
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            kinds = [pa.int64(), pa.int64(), ints, ints, longs]
            names = ["anchor", "segment", "starts", "ends", "earliest"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "anchor", "segment", "least", "most", "words"))
            for row in zip(*columns, strict=True):
                if rows and rows[-1][0] != row[0]:
                    yield done()
                rows.append(row)
        yield done()

    return report


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, spans in zip(batch.column("text").cast(pa.binary()), batch.column("spans").to_pylist(), strict=True):
            words = text.as_py().split()
            n_words.append(len(words))
            if spans:
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["from"]] += 1
                    gone[s["to"]] -= 1
                stays = np.cumsum(gone)[:-1] == 0
                words = [words[i] for i in np.flatnonzero(stays).tolist()]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc", "n_words", "n_removed", "kept"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.xxhash64("text").alias("tag"),
        F.hash("text").alias("more"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _runs(texts: DataFrame, window: int, hot: np.ndarray) -> DataFrame:
    return texts.mapInArrow(_segment_runs(window, hot), _RUNS)


def _anchors(runs: DataFrame) -> DataFrame:
    """The anchors that occur in two documents, with how often and whether their segments differ."""
    counted = runs.groupBy("anchor").agg(
        F.min("doc").alias("first"),
        F.max("doc").alias("last"),
        F.count(F.lit(1)).alias("n"),
        (F.min("segment") != F.max("segment")).alias("differ"),
    )
    return written(counted.filter("first < last").select("anchor", "n", "differ"), "anchors")


def _hot_anchors(runs: DataFrame, shared: DataFrame) -> np.ndarray:
    """The anchors with more than about ``HOT_SEGMENTS`` different segments; the most frequent, up to ``HOT_ANCHORS``.

    Different segments are counted among one in ``SAMPLED`` hashes: the limit says how the work is dealt out, not what is
    found.
    """
    often = shared.filter((F.col("n") > HOT_SEGMENTS) & F.col("differ")).orderBy(F.desc("n"), "anchor").limit(HOT_ANCHORS)
    often = written(often.select("anchor"), "often")
    if not often.limit(1).count():
        return np.zeros(0, np.int64)
    sampled = runs.filter(F.pmod("segment", F.lit(SAMPLED)) == 0).select("anchor", "segment")
    different = sampled.join(F.broadcast(often), "anchor", "left_semi").distinct().groupBy("anchor").count()
    rows = different.filter(F.col("count") > HOT_SEGMENTS / SAMPLED).select("anchor").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64))


def _of_shared(runs: DataFrame, shared: DataFrame, total: int) -> DataFrame:
    """The runs of shared anchors. Anchors with many runs are dealt out by document; there are at most ``HEAVY_SHARE``."""
    many = max(HEAVY_RUNS, total // HEAVY_SHARE)
    parts = F.ceil(F.col("n") / F.lit(many)).cast("int")
    heavy = shared.filter(F.col("n") > many).select("anchor", parts.alias("parts"))
    salted = runs.join(F.broadcast(heavy), "anchor", "left").withColumn(
        "salt", F.pmod(F.hash("doc"), F.coalesce("parts", F.lit(1)))
    )
    salts = shared.select("anchor", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt"))
    return salted.drop("parts").join(salts, ["anchor", "salt"], "left_semi").drop("salt")


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc, tag, more, spans) for the texts in which windows start that also start in a document with a smaller id: the word
    ranges ``from`` - ``to`` that those windows cover, which may overlap. A null id is after all others; ``tag``
    and ``more`` are hashes of the text and tell rows with equal ids apart."""
    if not GRAM < window <= 64:
        raise ValueError(f"a window has {GRAM + 1} to 64 words")
    texts = _texts(docs)
    runs = _runs(texts, window, np.zeros(0, np.int64))
    shared = _anchors(runs)
    hot = _hot_anchors(runs, shared)
    if len(hot):
        runs = _runs(texts, window, hot)
        shared = _anchors(runs)
    total = shared.agg(F.sum("n")).first()[0] or 0
    runs = _of_shared(runs, shared, total)
    shards = max(1, total * (window + 20) // SHARD_WORDS)
    wanted = (
        runs.groupBy("anchor", "segment")
        .agg(F.min(F.struct(*_ROW, "at", "size")).alias("one"), F.max("doc").alias("most"))
        .select(
            F.col("one.doc").alias("doc"),
            F.col("one.tag").alias("tag"),
            F.col("one.more").alias("more"),
            F.struct(
                F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"),
                "anchor",
                "segment",
                F.col("one.at").alias("at"),
                F.col("one.size").alias("size"),
                F.col("one.doc").alias("least"),
                "most",
            ).alias("s"),
        )
    )
    wanted = wanted.groupBy(*_ROW).agg(F.collect_list("s").alias("segments"))
    kind = "shard int, anchor long, segment long, least long, most long, words binary"
    segments = texts.join(wanted, _ROW).select("text", "segments").mapInArrow(_cut, kind)
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reported = (
        segments.repartition(partitions, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(
            _reported(window), "anchor long, segment long, starts array<int>, ends array<int>, earliest array<long>"
        )
    )
    found = runs.join(reported, ["anchor", "segment"])
    spans = F.transform(
        F.filter(F.arrays_zip("starts", "ends", "earliest"), lambda r: r["earliest"] < F.col("doc")),
        lambda r: F.struct(
            (F.col("at") + r["starts"]).alias("from"), (F.col("at") + r["ends"] + F.lit(window - 1)).alias("to")
        ),
    )
    return (
        found.select(*_ROW, spans.alias("spans"))
        .filter(F.size("spans") > 0)
        .groupBy(*_ROW)
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text; others are ignored): doc_id, ``n_words``, ``n_removed`` and ``kept``, the
    words that stay, joined by single spaces.

    A word goes if it lies in a window of ``window`` words that also starts in a document with a smaller id; windows are
    those of the input. Words are unchanged runs of anything but spaces and controls 9 to 13. Null and empty texts have
    no words; texts shorter than a window stay. A null id is after all others. Rows with equal ids don't take words from
    each other; repeated rows get equal results.
    """
    texts = _texts(docs)
    joined = texts.join(repeated_spans(docs, window), _ROW, "left").select("doc", "text", "spans")
    out = joined.mapInArrow(_kept, "doc long, n_words long, n_removed long, kept string")
    return out.select(F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM worded WHERE len(words) >= 50)
),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (h) WHERE least < doc_id
),
lists AS (SELECT doc_id, list(place) AS gone FROM gone GROUP BY doc_id),
places AS (
  SELECT doc_id, words, coalesce(gone, []) AS gone FROM worded LEFT JOIN lists USING (doc_id)
),
kept AS (
  SELECT doc_id, len(words) AS n, len(gone) AS removed,
    list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone, i)), lambda i: words[i]) AS words
  FROM places
)
SELECT doc_id, n::BIGINT AS n_words, removed::BIGINT AS n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""
