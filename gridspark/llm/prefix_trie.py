"""The trie of conversation prefixes, by digests of fixed-length blocks of turns.

Conversations are cut into blocks of ``BLOCK`` turns. They are grouped by the digest of a whole block and of all blocks
before it: a group is a *variant*, one way to go on from a block boundary. Where all that go on from a boundary share
one variant, the turns inside it are nodes as they stand. Only where siblings diverge are the variants, not the
conversations, taken apart turn by turn and grouped again.

A node is named by 128 bits: the XOR over its blocks of a hash of (block number, turns in it, their digests). XOR needs no
order, so a conversation of any length is numbered in pieces and no task needs it whole.

Sums over subtrees take no loop over depths. Each node belongs to its smallest member, whose own nodes lie at the end of its
path. What lies below a node is then a sum over its members of what each owns, from that node on for the smallest
member, all of it for the others; so the same grouping, weighted, gives every subtree's sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.shared import table, words_in, written

#: Turns of a block.
BLOCK = 4
#: Blocks of a conversation that are numbered together.
PIECE_BLOCKS = 1024
#: Ids that are joined to one string before they are hashed.
CHUNK_IDS = 4096
#: First conversations of twenty lend their first turns to the others; a conversation takes up to three.
FAMILY, HEADS = 20, 4

_KEY = ["n1", "n2"]


def numbered(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``: the position from 0 among the rows of the same key.

    All rows are sorted over all tasks and written with their place, so that the rows of a key may lie in several parts. Each
    part numbers its own; keys that run over parts (two for each part at most) start at the sum of the counts before.
    """
    place = F.monotonically_increasing_id()
    placed = written(rows.orderBy(key, *order).withColumn("__place", place), "turns")
    placed = placed.withColumn("__part", F.shiftright("__place", 33))
    parts = placed.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__place").alias("__least"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    pos = F.col("__place") - F.col("__least") + F.col("__before")
    return placed.join(starts, [key, "__part"]).withColumn("pos", pos).drop("__place", "__part", "__least", "__before")


def with_turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words): what is needed of each turn. Null roles and texts are empty.

    The digest is the MD5 of the role's length, the role and the text. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(told.cast("binary"))).alias("digest"),
        words_in(text).alias("words"),
    )


def ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): turns by number, null first; equal numbers by their digests."""
    return numbered(with_turn_digests(turns), "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")])


def rebuilt(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their family's first: (conv_id, pos, digest, words), and (conv_id) of all.

    With h the CRC-32 of the id modulo 4, conversation c has the first h turns of conversation c - c % 20 (as many as there are),
    then its own after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = written(sequences.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", h), "conversations")
    first = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    lent = (
        convs.withColumn("base", base)
        .join(first, "base", "left")
        .select("conv_id", "base", "h", F.least(F.col("h"), F.coalesce("base_n", F.lit(0))).alias("lent"))
    )
    lent = written(lent, "lent")
    heads = sequences.filter(F.col("pos") < HEADS - 1).withColumnRenamed("conv_id", "base")
    taken = lent.join(heads, "base").filter(F.col("pos") < F.col("lent")).select("conv_id", "pos", "digest", "words")
    own = sequences.join(lent, "conv_id").filter(F.col("pos") >= F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "words")
    return taken.unionByName(own), convs.select("conv_id")


def _step(k: Column, digests: Column) -> tuple[Column, Column]:
    """Two hashes of a block's first turns."""
    size = F.size(digests)
    return F.xxhash64(k, size, digests), F.xxhash64(F.lit("second"), k, size, digests)


def blocks_of(sequences: DataFrame) -> DataFrame:
    """(conv_id, k, turns, p1, p2, n1, n2, last): a conversation's blocks, the node before each and that at its end.

    Blocks before a piece are folded first (a row for each piece of the few conversations that have several); within a piece,
    they are folded in order.
    """
    blocks = (
        sequences.withColumn("k", F.floor(F.col("pos") / BLOCK).cast("long"))
        .groupBy("conv_id", "k")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"))
        .withColumn("piece", F.floor(F.col("k") / PIECE_BLOCKS).cast("long"))
    )
    h1, h2 = _step(F.col("k"), F.col("turns.digest"))
    blocks = written(blocks.withColumn("h1", h1).withColumn("h2", h2), "blocks")
    pieces = blocks.groupBy("conv_id", "piece").agg(
        F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.max("k").alias("top")
    )
    along = Window.partitionBy("conv_id").orderBy("piece")
    earlier, ever = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id")
    pieces = pieces.select(
        "conv_id",
        "piece",
        *[F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0).cast("long")).alias(f"b{i}") for i in (1, 2)],
        F.max("top").over(ever).alias("top"),
    )
    inside = Window.partitionBy("conv_id", "piece").orderBy("k")
    folded = blocks.join(pieces, ["conv_id", "piece"])
    for i in (1, 2):
        folded = folded.withColumn(f"n{i}", F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"h{i}").over(inside)))
        folded = folded.withColumn(f"p{i}", F.col(f"n{i}").bitwiseXOR(F.col(f"h{i}")))
    return folded.select("conv_id", "k", "turns", "p1", "p2", *_KEY, (F.col("k") == F.col("top")).alias("last"))


def variants_of(blocks: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Conversations grouped by the block they have gone through; a variant is named by the node at its end."""
    return blocks.groupBy("k", *_KEY).agg(
        F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("turns").alias("turns"), *[c.alias(n) for n, c in sums.items()]
    )


def with_siblings(variants: DataFrame) -> DataFrame:
    """Variants with ``ways``: how many go on from the same boundary."""
    ways = variants.groupBy("k", "p1", "p2").agg(F.count(F.lit(1)).alias("ways"))
    return variants.join(ways, ["k", "p1", "p2"])


def turn_nodes(variants: DataFrame, sums: dict[str, str]) -> DataFrame:
    """A row for each node within the variants: its name and its parent's, depth, words, and ``sums`` by name and function.

    Variants without a sibling give their turns as nodes; the turns of the others are grouped.
    """

    def at(j: Column) -> Column:
        digests = F.slice(F.col("turns.digest"), F.lit(1), j)
        h1, h2 = _step(F.col("k"), digests)
        return F.struct(
            (F.col("k") * BLOCK + j).alias("depth"),
            F.col("p1").bitwiseXOR(h1).alias("n1"),
            F.col("p2").bitwiseXOR(h2).alias("n2"),
            F.element_at("turns", j)["words"].alias("words"),
        )

    inner = F.transform(F.sequence(F.lit(1), F.size("turns")), at)
    names = ("depth", *_KEY, "words")
    placed = variants.select("ways", "p1", "p2", *sums, inner.alias("inner")).select(
        "ways", "p1", "p2", *sums, "inner", F.posexplode("inner").alias("j", "node")
    )
    above = F.get("inner", F.col("j") - 1)
    rows = placed.select(
        "ways",
        *[F.col(f"node.{n}").alias(n) for n in names],
        F.coalesce(above["n1"], F.col("p1")).alias("up1"),
        F.coalesce(above["n2"], F.col("p2")).alias("up2"),
        *sums,
    )
    alone = rows.filter("ways = 1").drop("ways")
    parted = rows.filter("ways > 1").groupBy(*names, "up1", "up2").agg(*[getattr(F, f)(n).alias(n) for n, f in sums.items()])
    return alone.unionByName(parted)


def _streamed_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's chunks, comma-joined, in the order in which they come."""
    node, digest, out = None, None, []

    def flush() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else ([], [], [])
        a, b, c = (list(x) for x in columns)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], [*_KEY, "ends_sha256"])

    for batch in batches:
        for n1, n2, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids")), strict=True):
            if node != (n1, n2):
                if digest:
                    out.append((*node, digest.hexdigest()))
                node, digest = (n1, n2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) > 10_000:
            yield flush()
    if digest:
        out.append((*node, digest.hexdigest()))
    yield flush()


def end_hashes(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256): the hash of the ids that end at a node, ascending and comma-joined.

    Ids are distinct, so a chunk of ``CHUNK_IDS`` successive numbers bounds what is gathered; the chunks of a node then pass
    through one hash in order, without being held.
    """
    chunk = F.floor(F.col("conv_id") / CHUNK_IDS).cast("long")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    packed = ends.groupBy(*_KEY, chunk.alias("chunk")).agg(ids.alias("ids"))
    partitions = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartition(partitions, *_KEY).sortWithinPartitions(*_KEY, "chunk")
    return dealt.mapInArrow(_streamed_hashes, "n1 long, n2 long, ends_sha256 string")


def trie(sequences: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of ``sequences`` (conv_id, pos from 0, digest, words); ``conversations`` has every conv_id.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's; ``n_convs`` members, ``n_children``, ``n_leaves`` childless
    nodes below (or the node itself), ``saved_tokens`` the words that members but the first repeat, summed below, and
    ``ends_sha256`` of the ids that end here. Conversations without turns end at the root. Without conversations there
    are no nodes.
    """
    blocks = written(blocks_of(sequences), "folded")
    variants = written(
        with_siblings(variants_of(blocks, {"n_convs": F.count(F.lit(1)), "conv_id": F.min("conv_id")})), "variants"
    )
    below = turn_nodes(variants, {"n_convs": "sum", "conv_id": "min"})
    zero = F.lit(0).cast("long")
    root = conversations.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = root.select(
        *[zero.alias(c) for c in ("depth", *_KEY, "words")], *[F.lit(None).cast("long").alias(c) for c in ("up1", "up2")], "n_convs", "conv_id"
    )
    found = written(below.unionByName(root), "nodes")
    children = found.filter("depth > 0").groupBy(F.col("up1").alias("n1"), F.col("up2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = found.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")

    owned = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("tokens"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves")
    )
    weighted = blocks.join(owned.filter("tokens > 0 OR leaves > 0"), "conv_id")
    summed = variants_of(weighted, {"tokens": F.sum("tokens"), "leaves": F.sum("leaves")}).drop("turns", "p1", "p2")
    again = variants.drop("n_convs", "conv_id").join(summed, ["k", *_KEY])
    totals = turn_nodes(again, {"tokens": "sum", "leaves": "sum"}).select(*_KEY, "tokens", "leaves")
    whole = owned.agg(F.sum("tokens").alias("tokens"), F.sum("leaves").alias("leaves")).filter("leaves > 0")
    totals = totals.union(whole.select(zero, zero, "tokens", "leaves"))

    above = _owned_above(nodes)
    ends = blocks.filter("last").select("conv_id", *_KEY)
    turnless = conversations.join(ends.select("conv_id"), "conv_id", "left_anti").select("conv_id", *[zero.alias(c) for c in _KEY])
    ended = end_hashes(ends.unionByName(turnless))
    parents = nodes.select(F.col("n1").alias("up1"), F.col("n2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(above, ["conv_id", "depth"], "left")
        .join(totals, _KEY)
        .join(ended, _KEY, "left")
        .join(parents, ["up1", "up2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            (F.col("tokens") - F.coalesce("above", zero)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _owned_above(nodes: DataFrame) -> DataFrame:
    """(conv_id, depth, above): what a node's smallest member owns above it.

    Long paths are summed in pieces, as blocks are folded.
    """
    size = BLOCK * PIECE_BLOCKS
    paths = nodes.select("conv_id", "depth", "saved", F.floor(F.col("depth") / size).cast("long").alias("piece"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = paths.groupBy("conv_id", "piece").agg(F.sum("saved").alias("all"))
    pieces = pieces.select("conv_id", "piece", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return paths.join(pieces, ["conv_id", "piece"]).select(
        "conv_id", "depth", (F.col("before") + F.coalesce(F.sum("saved").over(inside), F.lit(0))).alias("above")
    )


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text; other columns are ignored) as they stand.

    Turns go by number, null first, equal ones by a digest of role and text; null roles and texts are empty, repeated rows are
    turns of their own, and rows without a conv_id belong to no conversation.
    """
    sequences = ordered(turns)
    return trie(sequences, sequences.select("conv_id").distinct())


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt with the first turns of their families."""
    return trie(*rebuilt(ordered(table(spark, sf_dir, "conversations"))))


#: CRC-32 as for op2; a node's name is the chained MD5 of its turns.
OP13_SQL = r"""
WITH RECURSIVE
bits AS (
  SELECT i AS byte, 0 AS step, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
),
crc AS (SELECT list(c ORDER BY byte) AS entries FROM bits WHERE step = 8),
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos, digest, words
  FROM (SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
  SELECT conv_id, n, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(strlen(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
      lambda acc, x: xor(acc >> 8, crc.entries[(xor(acc, x) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id), crc
),
lent AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 20 AS base, c.h, least(c.h, coalesce(b.n, 0)) AS lent
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
),
turns AS (
  SELECT l.conv_id, o.pos, o.digest, o.words FROM lent l JOIN own o ON o.conv_id = l.base AND o.pos < l.lent
  UNION ALL
  SELECT l.conv_id, o.pos - l.h + l.lent, o.digest, o.words FROM lent l JOIN own o ON o.conv_id = l.conv_id AND o.pos >= l.h
),
paths AS (
  SELECT conv_id, 0::BIGINT AS depth, ''::VARCHAR AS node, NULL::VARCHAR AS up, 0::BIGINT AS words FROM convs
  UNION ALL
  SELECT t.conv_id, p.depth + 1, md5(p.node || t.digest), p.node, t.words FROM paths p JOIN turns t ON t.conv_id = p.conv_id AND t.pos = p.depth
),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT p.node, any_value(p.up) AS up, p.depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.words) AS words,
    string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (p.depth = l.depth) AS ended
  FROM paths p JOIN lengths l USING (conv_id) GROUP BY p.node, p.depth
),
children AS (SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT a.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.words) AS saved_tokens
  FROM nodes d JOIN paths a ON a.conv_id = d.conv_id AND a.depth <= d.depth LEFT JOIN children c ON c.node = d.node GROUP BY a.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, b.n_leaves,
  b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes u ON u.node = n.up
"""
