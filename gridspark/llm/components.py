"""Connected components of links between keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.shared import written

#: Links that a task connects by itself before they are shuffled.
TASK_LINKS = 200_000


def least_reached(a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Every key of the links ``a`` to ``b``, and the least key that it reaches by them, which may be itself."""
    both = pa.concat_arrays([a, b]).dictionary_encode()
    order = pc.sort_indices(both.dictionary)
    places = np.empty(len(order), np.int64)
    places[order.to_numpy()] = np.arange(len(order))
    one, other = np.split(places[both.indices.to_numpy()], 2)
    root = np.arange(len(order))
    while (root[one] != root[other]).any():
        low, high = np.minimum(root[one], root[other]), np.maximum(root[one], root[other])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    keys = both.dictionary.take(order)
    return keys, keys.take(pa.array(root))


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links to a link of each of their keys with the least it reaches, by up to ``TASK_LINKS`` links at a time."""

    def connected(links: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = (pa.concat_arrays([part.column(c) for part in links]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([*least_reached(*ends)], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(part.num_rows for part in held) + batch.num_rows > TASK_LINKS:
            yield connected(held)
            held.clear()
        held.append(batch)
    if held:
        yield connected(held)


def _stars(links: DataFrame, smaller: bool) -> DataFrame:
    """Each key's neighbours (the larger ones, or the smaller ones and itself) linked to the least of all.

    The least neighbours are written before they are joined, so that both sides of the join are plain shuffles, of which
    adaptive execution splits a key with very many neighbours.
    """
    if smaller:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        near = near.union(near.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    ends = near.union(least.select("u", F.col("u").alias("v"))) if smaller else near.filter(F.col("v") > F.col("u"))
    found = ends.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return written(found.filter(F.col("a") != F.col("b")).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least key reachable) for every key in ``links`` (columns a, b).

    Each task first connects the links it reads, ``TASK_LINKS`` at a time, so that few rounds are left, and none where these
    are all. Then alternating stars: neighbours are linked to the least key seen, to larger ones and then to smaller ones, until
    nothing changes; that takes about log n rounds. Links are written after each step, so that the lineage stays short. No
    large component comes together in one place, and a key with many links is split by the skewed join.
    """
    seen = None
    links = written(links.filter(F.col("a") != F.col("b")).select("a", "b"), "links")
    tasks = -(-links.count() // TASK_LINKS)
    links = written(links.coalesce(max(1, tasks)).mapInArrow(_connected, links.schema), "connected")
    if tasks <= 1:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    links = links.filter(F.col("a") != F.col("b"))
    while True:
        links = _stars(_stars(links, smaller=False), smaller=True)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
