"""Size-aware join by Jaccard similarity: subsets of light sets, inverted lists for heavy ones.

Two sets linked at a threshold share at least a number of members that follows from their sizes. **Light** sets are up to a boundary
size: they give a key for every subset of such a number, so that a shared key proves a link; each key links its sets to the
smallest of them, which keeps them connected. **Heavy** sets enter inverted lists of their parts: they are cut by the hashes of
their members into more parts than linked sets may differ in, so that a whole part is equal in both. Texts that only share passages
hardly ever meet in one. The boundary is where subsets of all light sets and list entries of all heavy ones cost least, by the
sizes of all sets.

Sets that meet in a list, directly or through others, are a family, which comes to one task that compares whole sets. In one beyond
``FAMILY_MEMBERS`` a few pivots are compared with all in blocks, and then the sets outside the pivots' largest component with all. Of
two linked sets one is compared with the other, or both are in one component. If pivots leave too many, the family is narrowed
first: its sets meet again in the lists of their rarest members. Of two linked sets each has one of the other's among its first few in
any order that all share. Rare comes first, by counters of all members in a table of fixed size, so that what very many texts share
hardly ever brings two together. Pairs are never written out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.components import components
from gridspark.llm.minhash import set_key, shingle_sets
from gridspark.llm.shared import table, written
from gridspark.llm.words import mixed

#: Counters of members, in the table by which rare ones are told; 2 to this power.
COUNTER_BITS = 18
_COUNTER_PARTS = 64
#: Light sets have up to this many members, wherever the cost is least.
MOST_LIGHT = 64
#: Members of the sets that may come to one task together.
FAMILY_MEMBERS = 300_000
#: Sets of a family that are compared with all of it first.
PIVOTS = 8
#: Parts that a set is cut into beyond those that linked sets must have.
SPARE_PARTS = 2
#: A part with fewer members is equal by chance too often.
STRONG_PART = 2
#: Tasks in which the sets of a large family that pivots leave are compared with all of it.
REST_TASKS = 16
#: Sets that a task remembers.
SEEN_SETS = 500_000


def least_shared(one: int, other: int, percent: int) -> int:
    """How many members two sets of these sizes share at least, if they are linked."""
    return -(-percent * (one + other) // (100 + percent))


def subset_sizes(size: int, percent: int) -> list[int]:
    """The numbers of members that a set of this size shares at least with any it is linked to."""
    partners = range(-(-percent * size // 100), size * 100 // percent + 1)
    return sorted({c for t in partners if (c := least_shared(size, t, percent)) <= min(size, t)})


def light_cost(size: int, percent: int) -> int:
    return sum(math.comb(size, c) for c in subset_sizes(size, percent))


def entries_of(size: int, percent: int) -> tuple[int, int]:
    """Of a set's members in the common order, how many enter lists as the smaller set of a pair, and as either."""
    return size - least_shared(size, size, percent) + 1, size - -(-percent * size // 100) + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The size up to which sets are light, where the whole cost is least.

    A light set costs its subsets; a heavy one its list entries, and its members once for the comparison.
    """
    gained, best, at = 0, 0, 0
    for size in range(1, MOST_LIGHT + 1):
        gained += sizes.get(size, 0) * (entries_of(size, percent)[1] + size - light_cost(size, percent))
        if gained > best:
            best, at = gained, size
    return at


def _statistics(k: int):
    """Texts to rows (part, counters) of all shingles and (size, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTER_BITS, np.int64)
        sizes = np.zeros(MOST_LIGHT + 1, np.int64)
        for batch in batches:
            for _, sets in shingle_sets(batch.column("text"), k):
                if sets:
                    slots = np.concatenate(sets) >> np.uint64(64 - COUNTER_BITS)
                    counters += np.bincount(slots.astype(np.int64), minlength=len(counters))
                    own = np.array([len(s) for s in sets])
                    sizes += np.bincount(own[own <= MOST_LIGHT], minlength=len(sizes))
        parts = [p.astype("<u4").tobytes() for p in np.split(counters, _COUNTER_PARTS)] if counters.any() else []
        few = np.flatnonzero(sizes).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*range(len(parts)), *few], pa.int32()),
                pa.array([*parts, *[None] * len(few)], pa.binary()),
                pa.array([*[None] * len(parts), *sizes[few].tolist()], pa.int64()),
            ],
            ["slot", "counters", "n"],
        )

    return count


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of one part after the other to the sum of each part, as powers of the square root of two."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, part in zip(batch.column("slot").to_pylist(), batch.column("counters").to_pylist(), strict=True):
            found = np.frombuffer(part, "<u4").astype(np.int64)
            sums[slot] = sums[slot] + found if slot in sums else found
    ranks = [np.round(2 * np.log2(np.maximum(s, 1))).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(ranks, pa.binary())], ["slot", "ranks"])


def commonness(docs: DataFrame, words: int) -> tuple[np.ndarray, dict[int, int]]:
    """How common shingles of each counter are (a byte each), and the numbers of small sets by size. Both are of fixed size."""
    found = written(docs.select("text").mapInArrow(_statistics(words), "slot int, counters binary, n long"), "statistics")
    ranks = np.zeros((_COUNTER_PARTS, (1 << COUNTER_BITS) // _COUNTER_PARTS), np.uint8)
    parts = found.filter("counters IS NOT NULL").select("slot", "counters").repartition(_COUNTER_PARTS, "slot")
    for slot, part in parts.mapInArrow(_summed, "slot int, ranks binary").collect():
        ranks[slot] = np.frombuffer(part, np.uint8)
    sizes = found.filter("n IS NOT NULL").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    return ranks.ravel(), {r["slot"]: r["n"] for r in sizes}


def subset_keys(shingles: np.ndarray, percent: int) -> list[tuple[int, bytes]]:
    """(members, 128 bits) of every subset that proves a link."""
    n, out = len(shingles), []
    first, second = mixed(shingles, 1), mixed(shingles, 2)
    for c in subset_sizes(n, percent):
        gone = np.array(list(combinations(range(n), n - c)), np.int64).reshape(math.comb(n, c), n - c)
        sums = np.stack([first.sum() - first[gone].sum(axis=1), (second.sum() - second[gone].sum(axis=1)) ^ np.uint64(c)], 1)
        out.extend((c, row.tobytes()) for row in np.ascontiguousarray(sums.astype(">u8")))
    return out


def list_keys(shingles: np.ndarray, ranks: np.ndarray, percent: int, light: int) -> np.ndarray:
    """The lists that a set enters: its rarest members, each with a power of two about its size.

    A set is in the lists of its own power, and as the larger of a pair in those of the power below if the smaller may lie there.
    A light set is only ever the smaller one.
    """
    n = len(shingles)
    as_smaller, as_either = entries_of(n, percent)
    common = ranks[(shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]
    order = np.lexsort((shingles, common))[: as_smaller if n <= light else as_either]
    first, power = shingles[order], n.bit_length()
    keys = [mixed(first, power)]
    if n > light and (-(-percent * n // 100)).bit_length() < power:
        keys.append(mixed(first, power - 1))
    return np.concatenate(keys)


_SIGNED = "doc_id long, t1 long, t2 long, n_shingles long, key binary, lists array<long>, subsets array<struct<c:int,subset:binary>>"


def _signatures(k: int, percent: int, light: int):
    smallest = max(1, -(-percent * (light + 1) // 100))  # that a heavy set may be linked to

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies give their keys about once a task
        for batch in batches:
            for at, sets in shingle_sets(batch.column("text"), k):
                lists, keys = [], [set_key(s) if len(s) else None for s in sets]
                if len(seen) > SEEN_SETS:
                    seen.clear()
                for s, key in zip(sets, keys, strict=True):
                    lists.append(part_keys(s, percent, light).view(np.int64) if len(s) >= smallest and key not in seen else None)
                    seen.add(key)
                subsets = [
                    [{"c": c, "subset": key} for c, key in subset_keys(s, percent)] if 0 < len(s) <= light else None for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(at, len(sets)) for c in ("doc_id", "t1", "t2")],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(lists, pa.list_(pa.int64())),
                        pa.array(subsets, pa.list_(pa.struct([("c", pa.int32()), ("subset", pa.binary())]))),
                    ],
                    ["doc_id", "t1", "t2", "n_shingles", "key", "lists", "subsets"],
                )

    return sign


def _light_links(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of light sets that share a subset: each set of a subset with the smallest one."""
    rows = classes.select("key", "n_shingles", F.explode("subsets").alias("s")).select("key", "n_shingles", "s.c", "s.subset")
    least = rows.groupBy("c", "subset").agg(F.min(F.struct("n_shingles", "key")).alias("least"), F.count(F.lit(1)).alias("sets"))
    met = rows.join(least.filter("sets > 1").drop("sets"), ["c", "subset"]).filter(F.col("key") != F.col("least.key"))
    linked = (100 + percent) * F.col("c") >= percent * (F.col("n_shingles") + F.col("least.n_shingles"))
    return met.filter(linked).select(F.col("key").alias("a"), F.col("least.key").alias("b"))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (list, key) to links of each key with the smallest it meets in the part's lists, directly or through others.

    And the first rows of the part's first and last list.
    """
    part = TaskContext.get().partitionId()
    first = last = None
    parent: dict[bytes, bytes] = {}

    def find(key: bytes) -> bytes:
        while (up := parent.setdefault(key, key)) != key:
            parent[key] = key = parent[up]
        return key

    kinds = {"a": pa.binary(), "b": pa.binary(), "part": pa.int32(), "end": pa.int64()}

    def rows(a: list, b: list, parts: list, ends: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((a, b, parts, ends), kinds.values(), strict=True)], list(kinds))

    for batch in batches:
        lists, keys = batch.column("list").to_numpy(), batch.column("key")
        if not len(lists):
            continue
        new = np.flatnonzero(np.append(True, lists[1:] != lists[:-1]))
        heads = np.repeat(new, np.diff(np.append(new, len(lists))))
        later = np.flatnonzero(heads != np.arange(len(lists)))
        a, b = keys.take(pa.array(later)).to_pylist(), keys.take(pa.array(heads[later])).to_pylist()
        goes_on = last is not None and last[0] == lists[0]
        if goes_on:
            a.append(keys[0].as_py())
            b.append(last[1])
        for one, other in set(zip(a, b, strict=True)):
            low, high = sorted((find(one), find(other)))
            parent[high] = low
        first = first or (int(lists[0]), keys[0].as_py())
        if len(new) > 1 or not goes_on:
            last = (int(lists[-1]), keys[int(new[-1])].as_py())
    met = [key for key in parent if find(key) != key]
    for at in range(0, len(met), 10_000):
        some = met[at : at + 10_000]
        yield rows(some, [find(key) for key in some], [None] * len(some), [None] * len(some))
    if first:
        yield rows([first[1], None], [None, last[1]], [part, part], [first[0], last[0]])


def _candidates(lists: DataFrame) -> DataFrame:
    """(a, b): enough links between sets of each list to connect them, for rows (key, lists).

    Lists are sorted over all tasks, so that one of very many sets lies in several parts; where a list goes on in the next part,
    the rows at the seam are linked, of which there are two a part.
    """
    partitions = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = lists.select(F.explode("lists").alias("list"), "key")
    dealt = rows.repartitionByRange(partitions, "list", "key").sortWithinPartitions("list", "key")
    found = written(dealt.mapInArrow(_neighbours, "a binary, b binary, part int, end long"), "neighbours")
    ends = found.filter("part IS NOT NULL").groupBy("part").agg(
        F.max(F.when(F.col("a").isNotNull(), F.struct("end", "a"))).alias("first"),
        F.max(F.when(F.col("b").isNotNull(), F.struct("end", "b"))).alias("last"),
    )
    seams = ends.select("first", F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("part")).alias("last"))
    seams = seams.filter(F.col("first.end") == F.col("last.end")).select("first.a", "last.b")
    inside = found.filter("part IS NULL").select("a", "b")
    return inside.union(seams).filter(F.col("a") != F.col("b")).distinct()


def linked(sets: list[np.ndarray], percent: int, asking: list[int] | None = None) -> list[int]:
    """For each set one of its component, by the links of ``asking`` sets with all, or of all.

    A pass compares one set with all at once. After ``PIVOTS`` passes, the sets of the largest component make none: of two linked
    sets one has passed, or both are in that component.
    """
    n = len(sets)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, places, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.add.reduceat((often > 1)[places].astype(np.int64), at)
    able = 100 * shared >= percent * sizes
    order = [i for i in (range(n) if asking is None else asking) if able[i]]
    marks, main = np.zeros(len(often), np.int64), None
    for turn, i in enumerate(order):
        if asking is None and turn >= PIVOTS:
            if main is None:
                found = [find(j) for j in order]
                main = max(set(found), key=found.count)
            if find(i) == find(main):
                continue
        own = places[at[i] : at[i] + sizes[i]]
        marks[own] = 1
        both = np.add.reduceat(marks[places], at)
        marks[own] = 0
        for j in np.flatnonzero(100 * both >= percent * (sizes + sizes[i] - both)).tolist():
            parent[find(j)] = find(i)
    return [find(i) for i in range(n)]


def _compared(k: int, percent: int):
    """Rows (task, asks, key, text), sorted by task, to links (a, b) of each set with the smallest of its component.

    Components are by the links of the sets that ask with all of the task, or of all if none does.
    """

    def links_in(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        keys: list[bytes] = []
        sets: list[np.ndarray] = []
        asking: list[int] = []
        seen: dict[bytes, int] = {}
        got = (s for _, part in shingle_sets(pa.array([r[3] for r in rows], pa.string()), k) for s in part)
        for (_, asks, key, _), shingles in zip(rows, got, strict=True):
            if key not in seen:
                seen[key] = len(keys)
                keys.append(key)
                sets.append(shingles)
            if asks and seen[key] not in asking[-1:]:
                asking.append(seen[key])
        if len(keys) < 2:
            return []
        roots = linked(sets, percent, asking or None)
        least: dict[int, bytes] = {}
        for root, key in zip(roots, keys, strict=True):
            least[root] = min(key, least.get(root, key))
        return [(key, least[root]) for root, key in zip(roots, keys, strict=True) if key != least[root]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        out: list[tuple[bytes, bytes]] = []

        def flush() -> pa.RecordBatch:
            made = [pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, ["a", "b"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("task", "asks", "key", "text"))
            for row in zip(*columns, strict=True):
                if rows and rows[-1][0] != row[0]:
                    out.extend(links_in(rows))
                    rows.clear()
                if not rows or rows[-1][:3] != row[:3]:  # repeated rows bring a text several times
                    rows.append(row)
            if len(out) > 10_000:
                yield flush()
        if rows:
            out.extend(links_in(rows))
        yield flush()

    return compare


def _links_of_tasks(tasks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links found in ``tasks`` (task, asks, key, text)."""
    partitions = int(tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tasks.select("task", "asks", "key", "text").repartition(partitions, "task")
    dealt = dealt.sortWithinPartitions("task", F.desc("asks"), "key")
    return written(dealt.mapInArrow(_compared(words, percent), "a binary, b binary"), "links")


def size_class(size: int, percent: int) -> tuple[int, int]:
    """The class of a set's size, and the largest size in the class after the next. Sizes of linked sets lie at most a class apart."""
    at, low = 0, 1
    while True:
        next_low = max(low + 1, low * 100 // percent + 1)
        if size < next_low:
            return at, max(next_low + 1, next_low * 100 // percent + 1) - 1
        at, low = at + 1, next_low


@lru_cache(1 << 16)
def _parts_of(size: int, percent: int) -> list[tuple[int, np.ndarray]]:
    """The number of parts of a set of this size and a salt for each: as the smaller set of a pair, then as the larger if it can be."""
    own, top = size_class(size, percent)
    lower = max((s for s in range(max(1, size * percent // 100 - 2), size) if size_class(s, percent)[0] == own - 1), default=None)
    out = []
    for number, most in ((own, top), (own - 1, None if lower is None else size_class(lower, percent)[1])):
        if most is not None:
            parts = (100 - percent) * 2 * most // (100 + percent) + 1 + SPARE_PARTS
            out.append((parts, mixed(np.arange(parts, dtype=np.uint64) + (np.uint64(number) << np.uint64(40)), 23)))
    return out


def part_keys(shingles: np.ndarray, percent: int, light: int = 0) -> np.ndarray:
    """Keys of a set's parts, of which linked sets have one in common.

    Members are dealt by their hashes to more parts than two linked sets of these size classes differ in, so that at least one part
    and ``SPARE_PARTS`` others have the same members in both. Weak parts, of fewer than ``STRONG_PART`` members, give no key unless
    a set has more than ``SPARE_PARTS`` of them: else one of those that are the same is a strong one. A set takes part as the
    smaller and as the larger of a pair; a light set is only ever the smaller one.
    """
    deals = _parts_of(len(shingles), percent)
    dealt, values, out = mixed(shingles, 21), mixed(shingles, 22), []
    low, high = (values & np.uint64(0xFFFFFFFF)).astype(np.float64), (values >> np.uint64(32)).astype(np.float64)
    for parts, salts in deals[:1] if len(shingles) <= light else deals:
        at = (dealt % np.uint64(parts)).astype(np.int64)
        strong = np.bincount(at, minlength=parts) >= STRONG_PART
        sums = np.bincount(at, high, parts).astype(np.uint64) << np.uint64(32)  # halves of up to two million members add exactly
        keys = mixed(sums + np.bincount(at, low, parts).astype(np.uint64) + salts, 24)
        out.append(keys[strong] if parts - strong.sum() <= SPARE_PARTS else keys)
    return np.concatenate(out)


def _listed(k: int, percent: int, ranks: np.ndarray, light: int):
    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in shingle_sets(batch.column("text"), k):
                keys = [list_keys(s, ranks, percent, light).view(np.int64) for s in sets]
                columns = [batch.column(c).slice(at, len(sets)) for c in ("family", "key")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.list_(pa.int64()))], ["family", "key", "lists"])

    return rarest


def _with_families(held: DataFrame, lists: DataFrame, classes: DataFrame) -> DataFrame:
    """``held`` with ``family`` and its ``cost``: sets that meet in ``lists`` (key, lists). Sets that meet none are left out."""
    found = components(_candidates(lists)).select(F.col("node").alias("key"), F.col("root").alias("family"))
    found = written(found.join(classes.select("key", "n_shingles"), "key"), "families")
    costs = found.groupBy("family").agg(F.sum("n_shingles").alias("cost"))
    return held.join(found.join(costs, "family"), "key")


def _heavy_links(classes: DataFrame, signed: DataFrame, rows: DataFrame, ranks: np.ndarray, words: int, percent: int, light: int) -> DataFrame:
    """(a, b) of sets of which one is heavy at least.

    Texts of the sets that meet in lists of parts are fetched once. Families too large for a task are compared with pivots. Where what
    these leave would take more than ``REST_TASKS``, sets are dealt to narrower families by the lists of their rarest members.
    """
    wanted = classes.select("key", "doc", F.col("t1").alias("u1"), F.col("t2").alias("u2"))
    met = _with_families(wanted, signed.filter("lists IS NOT NULL").select("key", "lists"), classes)
    same = F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("u1") == F.col("t1")) & (F.col("u2") == F.col("t2"))
    held = written(met.join(rows, same).select("family", "cost", "n_shingles", "key", "text"), "held")
    small, large = F.col("cost") <= FAMILY_MEMBERS, F.col("cost") > FAMILY_MEMBERS
    task = F.hex("family")
    links = _links_of_tasks(held.filter(small).withColumn("task", task).withColumn("asks", F.lit(0)), words, percent)
    if not held.filter(large).limit(1).count():
        return links
    near, rest = _links_of_pivots(held.filter(large), words, percent)
    size = FAMILY_MEMBERS // 2
    left = rest.groupBy("family").agg((F.ceil(F.sum("n_shingles") / size) * F.ceil(F.max("cost") / size)).alias("tasks"))
    left = written(left, "left")
    few, many = left.filter(F.col("tasks") <= REST_TASKS), left.filter(F.col("tasks") > REST_TASKS)
    links = links.union(near).union(_links_of_rest(held.join(few, "family", "left_semi"), rest.join(few, "family", "left_semi"), words, percent))
    if not many.limit(1).count():
        return links
    texts = held.join(many, "family", "left_semi").select("family", "key", "text")
    lists = texts.mapInArrow(_listed(words, percent, ranks, light), "family binary, key binary, lists array<long>")
    lists = lists.select("key", F.transform("lists", lambda one: F.xxhash64(one, "family")).alias("lists"))
    narrow = written(_with_families(texts.drop("family"), written(lists, "lists"), classes), "narrow")
    found = _links_of_tasks(narrow.filter(small).withColumn("task", task).withColumn("asks", F.lit(0)), words, percent)
    links = links.union(found)
    if narrow.filter(large).limit(1).count():
        near, rest = _links_of_pivots(narrow.filter(large), words, percent)
        links = links.union(near).union(_links_of_rest(narrow, rest, words, percent))
    return links


def _blocks() -> tuple[Column, Column]:
    """The block of a set of a large family, and a row for every block."""
    parts = F.ceil(F.col("cost") / (FAMILY_MEMBERS // 2)).cast("int")
    return F.pmod(F.xxhash64("key"), parts).cast("int"), F.explode(F.sequence(F.lit(0), parts - 1))


def _links_of_pivots(held: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links in families (family, cost, n_shingles, key, text) of pivots with all, and the sets (family, cost, key, n_shingles)
    outside the largest component that these make."""
    part, every = _blocks()
    first = [F.min(F.struct(F.xxhash64(F.lit(i), "key").alias("draw"), "key")).alias(f"p{i}") for i in range(PIVOTS)]
    keys = F.array(*[F.col(f"p{i}.key") for i in range(PIVOTS)])
    pivots = held.groupBy("family").agg(*first).select(F.explode(keys).alias("key")).distinct()
    columns = ["family", "part", "asks", "key", "text"]
    asking = held.join(pivots, "key", "left_semi").withColumn("part", every).withColumn("asks", F.lit(1))
    others = held.withColumn("part", part).withColumn("asks", F.lit(0))
    tasks = asking.select(columns).unionByName(others.select(columns))
    near = _links_of_tasks(tasks.withColumn("task", F.concat_ws("-", F.hex("family"), "part")), words, percent)

    sets = held.select("family", "cost", "key", "n_shingles").distinct()
    found = sets.join(components(near).withColumnRenamed("node", "key"), "key", "left")
    found = written(found.withColumn("root", F.coalesce("root", "key")), "parted")
    counts = found.groupBy("family", "root").agg(F.count(F.lit(1)).alias("sets"))
    main = counts.groupBy("family").agg(F.max_by("root", F.struct("sets", "root")).alias("main"))
    rest = found.join(main, "family").filter(F.col("root") != F.col("main")).select("family", "cost", "key", "n_shingles")
    return near, written(rest, "rest")


def _links_of_rest(held: DataFrame, rest: DataFrame, words: int, percent: int) -> DataFrame:
    """Links in families (family, cost, n_shingles, key, text) of the sets ``rest`` with all, in blocks."""
    size = FAMILY_MEMBERS // 2
    part, every = _blocks()
    groups = rest.groupBy("family").agg(F.ceil(F.sum("n_shingles") / size).cast("int").alias("groups"))
    groups = written(groups, "groups")
    group = F.pmod(F.xxhash64(F.lit("rest"), "key"), F.col("groups")).cast("int")
    columns = ["family", "part", "group", "asks", "key", "text"]
    asking = held.join(rest.select("key"), "key", "left_semi").join(groups, "family").withColumn("group", group)
    asking = asking.withColumn("part", every).withColumn("asks", F.lit(1))
    turns = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    others = held.join(groups, "family").withColumn("group", turns).withColumn("part", part).withColumn("asks", F.lit(0))
    tasks = asking.select(columns).unionByName(others.select(columns))
    named = F.concat_ws("-", F.hex("family"), "part", "group")
    return _links_of_tasks(tasks.withColumn("task", named), words, percent)


def jaccard_components(docs: DataFrame, words: int = 3, percent: int = 90, light: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are lower-cased (A-Z). A text's set has its distinct runs of ``words`` words, or the whole text if it has fewer. Sets are
    linked if they share at least ``percent`` hundredths of their union; ``component_id`` is the smallest doc_id reachable, the
    row's own included. Null and empty texts have no set and are linked with nothing. Rows without an id count towards their
    component, whose id is null if none of its rows has one. Repeated rows are in one component. ``light`` sets the boundary
    of light sets, which otherwise follows from the cost.
    """
    t1, t2 = F.xxhash64("text"), F.xxhash64(F.lit("second"), F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2"), "text")
    ranks, sizes = commonness(docs, words)
    at = boundary(sizes, percent) if light is None else light
    signed = written(rows.mapInArrow(_signatures(words, percent, at), _SIGNED), "signed")
    one = F.min(F.struct("doc_id", "t1", "t2")).alias("one")
    kept = [F.first(c).alias(c) for c in ("n_shingles", "subsets")]
    classes = signed.filter("n_shingles > 0").groupBy("key").agg(F.min("doc_id").alias("least"), one, *kept)
    classes = classes.select("key", "least", "n_shingles", "subsets", F.col("one.doc_id").alias("doc"), "one.t1", "one.t2")
    classes = written(classes, "classes")
    links = _light_links(classes, percent).union(_heavy_links(classes, signed, rows, ranks, words, percent, at))
    joined = classes.select("key", "least").join(components(links).withColumnRenamed("node", "key"), "key", "left")
    joined = joined.withColumn("root", F.coalesce("root", "key"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    component = joined.join(smallest, "root").select("key", "component_id")
    out = signed.select("doc_id", "n_shingles", "key").join(component, "key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


#: All pairs of different sets that share a shingle, then what is reachable; for small tables.
OP11_SQL = r"""
WITH RECURSIVE
worded AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s
  FROM worded
),
classes AS (SELECT s, min(doc_id) AS least, row_number() OVER () AS c, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
members AS (SELECT c, n, unnest(s) AS e FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM members a JOIN members b ON a.e = b.e AND a.c < b.c AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT reach.a AS c, min(classes.least) AS component_id FROM reach JOIN classes ON classes.c = reach.b GROUP BY reach.a)
SELECT sets.doc_id, coalesce(len(sets.s), 0)::BIGINT AS n_shingles, CASE WHEN len(sets.s) > 0 THEN least.component_id ELSE sets.doc_id END AS component_id
FROM sets LEFT JOIN classes USING (s) LEFT JOIN least USING (c)
"""
