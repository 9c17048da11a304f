"""Near duplicates by b-bit MinHash: band candidates, similarity estimated from packed low bits, links confirmed.

Each text has 96 minima over its distinct word shingles. Bands of minima give the candidates: of four each from a similarity
of 0.79 on (a pair of 0.8 shares none with a chance of 3e-6, one of 0.85 with 8e-8), of fewer below. Of every minimum the lower four bits are packed; two signatures
agree by chance in a sixteenth of the places, for which the estimate is corrected. Only a pair estimated far below the
threshold (by more than five standard deviations) is left without a look at its full sets; every link is confirmed on
them.

Texts with equal sets are one class from the start. Classes that share a band, directly or through others, are a family,
and a family's texts come to one task. A family beyond ``FAMILY_SHINGLES`` is taken bucket by bucket instead, and a
bucket beyond it in blocks, every pair of blocks in a task of its own. Tasks give back a link per class that joins it to
its component; pairs are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.components import components
from gridspark.llm.shared import WORD, table, written
from gridspark.llm.words import chunks, mixed, run_hashes, word_hashes

MINIMA, BITS = 96, 4
#: How likely a pair at the threshold may be to share no band.
MISSED = 1e-5
#: Shingles whose texts may come to one task.
FAMILY_SHINGLES = 1_000_000
#: A set counts as this many shingles at least when work is dealt out, since a task compares sets with each other.
SET_SHINGLES = 200

_RANDOM = np.random.default_rng(7)
_FACTORS = _RANDOM.integers(1, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(1, 1 << 63, MINIMA, dtype=np.uint64)

_SIGNED = "doc_id long, tag long, more long, n_shingles long, key binary, bands array<long>, packed binary"


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For chunks of a text column, the index of the first text and each text's sorted distinct shingle hashes."""
    for chunk in chunks(column, lower=True):
        words = word_hashes(chunk)
        runs = run_hashes(words, k)
        out = []
        for a, b in zip(chunk.first[:-1].tolist(), chunk.first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(runs[a : b - k + 1]))
            else:
                out.append(run_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        yield chunk.at, out


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    sums = np.array([mixed(shingles, 1).sum(), mixed(shingles, 2).sum() ^ np.uint64(len(shingles))], ">u8")
    return sums.tobytes()


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima per set; all sets have members."""
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), MINIMA), np.uint32)
    for i in range(MINIMA):
        out[:, i] = np.minimum.reduceat(((flat * _FACTORS[i] + _SHIFTS[i]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    low = (minima & 15).astype(np.uint8)
    return (low[:, 0::2] << 4) | low[:, 1::2]


def rows_of_band(percent: int) -> int:
    """As many minima to a band as leave a pair at the threshold without a common band with a chance of ``MISSED`` at most."""
    for rows in (4, 3, 2, 1):
        if (1 - (percent / 100) ** rows) ** (MINIMA // rows) <= MISSED:
            return rows
    raise ValueError(f"{MINIMA} minima are too few for a similarity of {percent} in a hundred")


def _band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    bands = MINIMA // rows
    out = np.zeros((len(minima), bands), np.uint64)
    for r in range(rows):
        out = mixed(out + minima[:, r::rows].astype(np.uint64), 11 + r)
    return mixed(out + np.arange(bands, dtype=np.uint64)[None, :], 5).view(np.int64)


def _signatures(k: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in shingle_sets(batch.column("text"), k):
                full = [i for i, s in enumerate(sets) if len(s)]
                bands, packed = [None] * len(sets), [None] * len(sets)
                if full:
                    minima = _minima([sets[i] for i in full])
                    for i, keys, low in zip(full, _band_keys(minima, rows), _packed(minima), strict=True):
                        bands[i], packed[i] = keys, low.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(sets)),
                        batch.column("tag").slice(at, len(sets)),
                        batch.column("more").slice(at, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(packed, pa.binary()),
                    ],
                    ["doc_id", "tag", "more", "n_shingles", "key", "bands", "packed"],
                )

    return sign


def agreeing(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many of the 96 places a packed signature agrees with each of others (as rows of six 64 bit numbers)."""
    x = others ^ one
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return MINIMA - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def estimate(agree: np.ndarray) -> np.ndarray:
    """The similarity, corrected for places that agree by chance."""
    chance = 0.5**BITS
    return np.maximum(0.0, (agree / MINIMA - chance) / (1 - chance))


def least_agreeing(percent: int) -> int:
    """In how many places two signatures agree at least if the sets may be linked: what is expected at the threshold, which
    :func:`estimate` takes back to the similarity, less five standard deviations."""
    chance = 0.5**BITS
    each = chance + (1 - chance) * percent / 100
    return max(0, math.floor(MINIMA * each - 5 * math.sqrt(MINIMA * each * (1 - each))))


def linked_roots(sets: list[np.ndarray], packed: np.ndarray, percent: int) -> list[int]:
    """For each set, the root of its component among the given sets.

    A pass over one set compares it with all others at once. The sets with most candidates pass first; then all that
    aren't in the component of the first. Of two linked sets one has passed, or both are in that component.
    """
    n = len(sets)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    places = None
    least = estimate(np.array(least_agreeing(percent)))

    def candidates(i: int) -> np.ndarray:
        return estimate(agreeing(packed[i], packed)) >= least

    degree = np.array([candidates(i).sum() for i in range(n)])
    order = np.argsort(-degree, kind="stable").tolist()
    for turn, i in enumerate(order):
        if degree[i] < 2 or turn >= 8 and find(i) == find(order[0]):
            continue
        near = np.flatnonzero(candidates(i))
        low, high = np.minimum(sizes[near], sizes[i]), np.maximum(sizes[near], sizes[i])
        near = near[100 * low >= percent * high]
        root = find(i)
        near = [j for j in near.tolist() if find(j) != root]
        if not near:
            continue
        if len(near) * 3000 < len(flat):
            common = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in near])
        else:
            if places is None:
                values, places = np.unique(flat, return_inverse=True)
                marks = np.zeros(len(values), np.int32)
            own = places[at[i] : at[i] + sizes[i]]
            marks[own] = 1
            common = np.add.reduceat(marks[places], at)[near]
            marks[own] = 0
        for j, both in zip(near, common.tolist(), strict=True):
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                parent[find(j)] = find(i)
    return [find(i) for i in range(n)]


def _confirm(k: int, percent: int):
    """Rows of (task, key, packed, text), sorted by task, to links (a, b) of keys."""

    def of_task(rows: list[tuple]) -> tuple[list, list]:
        keys, packed, sets = [], [], []
        _, own_keys, own_packed, texts = zip(*rows, strict=True)
        got = [s for _, part in shingle_sets(pa.array(texts, pa.string()), k) for s in part]
        for key, low, shingles in zip(own_keys, own_packed, got, strict=True):
            if set_key(shingles) == key and (not keys or key != keys[-1]):
                keys.append(key)
                packed.append(low)
                sets.append(shingles)
        if len(keys) < 2:
            return [], []
        roots = linked_roots(sets, np.frombuffer(b"".join(packed), np.uint64).reshape(len(keys), -1), percent)
        pairs = [(keys[i], keys[r]) for i, r in enumerate(roots) if i != r]
        return [a for a, _ in pairs], [b for _, b in pairs]

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        a: list[bytes] = []
        b: list[bytes] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
            a.clear()
            b.clear()
            return out

        def end_task() -> None:
            if rows:
                more_a, more_b = of_task(rows)
                a.extend(more_a)
                b.extend(more_b)
                rows.clear()

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("task", "key", "packed", "text"))
            for row in zip(*columns, strict=True):
                if rows and rows[-1][0] != row[0]:
                    end_task()
                rows.append(row)
            if len(a) > 10_000:
                yield flush()
        end_task()
        yield flush()

    return confirm


def _cost() -> Column:
    return F.greatest(F.col("n_shingles"), F.lit(SET_SHINGLES))


def _tasks(classes: DataFrame) -> DataFrame:
    """(task, key, packed, doc_id, tag, more) for all classes that have candidates."""
    members = written(classes.select("key", "n_shingles", F.explode("bands").alias("bucket")), "members")
    least = members.groupBy("bucket").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    least = least.filter(F.col("least") < F.col("most")).drop("most")
    edges = members.join(least, "bucket").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    families = written(components(edges), "families")
    sized = families.join(classes.select(F.col("key").alias("node"), _cost().alias("cost")), "node")
    large = written(
        sized.groupBy("root").agg(F.sum("cost").alias("cost")).filter(F.col("cost") > FAMILY_SHINGLES), "large"
    )
    small = families.join(large, "root", "left_anti").select(F.col("node").alias("key"), F.hex("root").alias("task"))
    tasks = small
    if large.limit(1).count():
        inside = families.join(large, "root", "left_semi").select(F.col("node").alias("key"))
        inside = members.join(inside, "key", "left_semi").join(least.select("bucket"), "bucket", "left_semi")
        blocks = inside.groupBy("bucket").agg(
            F.ceil(F.sum(_cost()) / F.lit(FAMILY_SHINGLES // 2)).cast("int").alias("blocks")
        )
        dealt = (
            inside.join(blocks, "bucket")
            .withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        )
        pair = F.concat_ws("-", F.col("bucket"), F.least("own", "other"), F.greatest("own", "other"))
        tasks = small.union(dealt.select("key", pair.alias("task")))
    return tasks.join(classes.select("key", "packed", "one.doc_id", "one.tag", "one.more"), "key")


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, tag, n_shingles, root, component_id) for every row; root and component_id are null without shingles."""
    more = F.xxhash64(F.lit("more"), F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), more.alias("more"), "text")
    signed = written(rows.mapInArrow(_signatures(words, rows_of_band(percent)), _SIGNED), "signed")
    classes = written(
        signed.filter("n_shingles > 0")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("doc"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "more")).alias("one"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("packed").alias("packed"),
        ),
        "classes",
    )
    tasks = _tasks(classes)
    same = reduce(and_, [tasks[c].eqNullSafe(rows[c]) for c in ("doc_id", "tag", "more")])
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (
        tasks.join(rows, same)
        .select("task", "key", "packed", "text")
        .repartition(partitions, "task")
        .sortWithinPartitions("task", "key")
        .mapInArrow(_confirm(words, percent), "a binary, b binary")
    )
    roots = components(links).withColumnRenamed("node", "key")
    joined = classes.select("key", "doc").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = joined.groupBy("root").agg(F.min("doc").alias("component_id"))
    component = joined.join(smallest, "root").select("key", "root", "component_id")
    return signed.select("doc_id", "tag", "n_shingles", "key").join(component, "key", "left").drop("key")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 85) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text; others are ignored) with its component.

    Texts are lower-cased (A-Z); a text's set has its distinct runs of ``words`` words, or the whole text if it has
    fewer. Texts are linked if the intersection is at least ``percent`` hundredths of the union; ``component_id`` is the
    smallest doc_id reachable, its own included, and ``kept`` tells that it is the row's own. Null and empty texts have
    no shingles and stand alone. Rows without an id count towards their component; one of such rows alone has a null
    component and is kept. Repeated rows are in one component.
    """
    out = _components(docs, words, percent)
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: that with the smallest id; see
    :func:`near_duplicates`.

    A null id is after all others. Of rows with that id, one of the text with the least hash stays, so repeated rows leave
    one. Rows without words all stay.
    """
    found = _components(docs, words, percent).filter("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")).alias("one")
    keep = found.groupBy("root").agg(least).select(F.col("one.doc_id").alias("__id"), F.col("one.tag").alias("__hash"))
    rows = docs.withColumn("__tag", F.xxhash64("text"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__tag") == F.col("__hash"))
    kept = rows.filter(worded).join(keep, same, "left_semi").dropDuplicates(["doc_id", "__tag"])
    return kept.union(rows.filter(~worded)).drop("__tag")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
