"""Benchmark decontamination by spaced-seed hashing.

A mask looks at some of the words under it and ignores the others; two texts that agree in the words it looks at share a
seed even where an ignored word was substituted. All seeds of the benchmark go to the tasks; each text's seeds are looked
up there, and every hit is verified along its diagonal: the words of text and item are compared one to one, and each
window of ``WINDOW`` words (or the whole item, if that is shorter) in which at most a fifth is substituted is an overlap.
The masks are chosen so that no such overlap is without a hit. Only texts' own rows are read, once for each block of the
benchmark. Items of equal text are looked for once, long ones in pieces that share ``WINDOW - 1`` words, so that every
window lies in one piece; a block therefore has a bounded number of words, however long or often repeated items are, and
what a task is sent doesn't grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import WORD, table
from gridspark.llm.words import Chunk, chunks, mixed, run_hashes, word_hashes

#: Any 13 aligned words with up to two substitutions (12 to 10: two; 9 and 8: one) agree under one of these.
MASKS = ("11111", "111011", "11010011")
WINDOW = 13
#: Items with fewer words are looked for as they are.
SHORT = 8
#: Words of the benchmark that a task gets at once, in the mean (some 100 bytes each, with their seeds).
BLOCK_WORDS = 300_000
#: Words of a piece of an item; blocks are even as pieces are much shorter.
PIECE_WORDS = 20_000

#: ``doc`` and ``item`` name texts by a digest.
_FOUND = "doc_id long, doc binary, item string, piece int, start long, matched long, n_windows long"


def _masked(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each word under a mask, across texts too."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, look in enumerate(mask):
        if look == "1":
            out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : n + j]
    return mixed(out, int(mask, 2))


def _inside(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of the first n words have ``length`` words of their text from there on."""
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    return left >= length


class Seeds:
    """The words and seeds of some items, or pieces of them, each with a name."""

    def __init__(self, names: list[tuple[str, int]], texts: list[str]):
        self.names = names
        self.words: list[np.ndarray] = []
        for chunk in chunks(pa.array(texts, pa.string()), lower=True, most=1 << 62):
            hashes = word_hashes(chunk)
            self.words = [hashes[a:b] for a, b in zip(chunk.first[:-1], chunk.first[1:], strict=True)]
        self.tables = []
        for mask in MASKS:
            self.tables.append((len(mask), lambda h, m=mask: _masked(h, m), *self._table(mask)))
        for n in sorted({len(w) for w in self.words if 0 < len(w) < SHORT}):
            whole = [(run_hashes(w, n)[0], i, 0) for i, w in enumerate(self.words) if len(w) == n]
            self.tables.append((n, lambda h, n=n: run_hashes(h, n), *self._sorted(whole)))

    def _table(self, mask: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._sorted(
            [(h, i, p) for i, w in enumerate(self.words) if len(w) >= SHORT for p, h in enumerate(_masked(w, mask).tolist())]
        )

    @staticmethod
    def _sorted(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.array([r[0] for r in rows], np.uint64)
        order = np.argsort(keys, kind="stable")
        item = np.array([r[1] for r in rows], np.int64)
        place = np.array([r[2] for r in rows], np.int64)
        return keys[order], item[order], place[order]

    def diagonals(self, chunk: Chunk, hashes: np.ndarray) -> np.ndarray:
        """Distinct rows (text of the chunk, item, word of the text that the item's first word would be) with a hit."""
        found = []
        of_word = np.repeat(np.arange(chunk.n), np.diff(chunk.first))
        for length, seeds_of, keys, item, place in self.tables:
            if not len(keys):
                continue
            seeds = seeds_of(hashes)
            low = np.searchsorted(keys, seeds)
            hit = keys[np.minimum(low, len(keys) - 1)] == seeds
            hit &= _inside(chunk.first, length, len(seeds))
            at = np.flatnonzero(hit)
            low = low[at]
            high = np.searchsorted(keys, seeds[at], side="right")
            times = high - low
            which = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            words = np.repeat(at, times)
            found.append(np.stack([of_word[words], item[which], words - place[which]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def overlaps(self, column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, words that agree) of every overlapping window of the texts of a column."""
        for chunk in chunks(column, lower=True):
            hashes = word_hashes(chunk)
            for text, item, diagonal in self.diagonals(chunk, hashes).tolist():
                words = self.words[item]
                window = min(WINDOW, len(words))
                a, b = max(diagonal, int(chunk.first[text])), min(diagonal + len(words), int(chunk.first[text + 1]))
                if b - a < window:
                    continue
                same = hashes[a:b] == words[a - diagonal : b - diagonal]
                sums = np.concatenate([[0], np.cumsum(same)])
                agree = sums[window:] - sums[:-window]
                need = window - (window // 5 if window >= SHORT else 0)
                for at in np.flatnonzero(agree >= need).tolist():
                    yield chunk.at + text, item, a + at - int(chunk.first[text]), int(agree[at])


def _named(text: Column) -> Column:
    """The name of an item's text."""
    return F.md5(text.cast("binary"))


def _pieces(benchmark: DataFrame) -> DataFrame:
    """``(item, piece, n, text)``: the different texts with words, in pieces of at most ``PIECE_WORDS`` words."""
    step = PIECE_WORDS - (WINDOW - 1)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    texts = benchmark.select("text").where(F.col("text").isNotNull()).distinct()
    split = texts.select(_named(F.col("text")).alias("item"), words.alias("words")).where(F.size("words") > 0)
    # The last piece starts where a window can still start.
    last = F.greatest(F.floor((F.size("words") - WINDOW) / step), F.lit(0)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("words", k * step + 1, PIECE_WORDS))
    return split.select("item", F.posexplode(cut).alias("piece", "part")).select(
        "item", "piece", F.size("part").alias("n"), F.array_join("part", " ").alias("text")
    )


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[tuple[str, int]], list[str]]]:
    """The pieces in blocks of about ``BLOCK_WORDS`` words, each of which the driver reads and sends out."""
    pieces = _pieces(benchmark)
    blocks = -(-(pieces.agg(F.sum("n")).first()[0] or 0) // BLOCK_WORDS)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "piece"), F.lit(max(blocks, 1))))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item", "piece", "text").collect()
        if rows:
            yield [(r["item"], r["piece"]) for r in rows], [r["text"] for r in rows]


def _finder(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(*sent.value)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            best: dict[tuple[int, int], list[int]] = {}
            for text, item, start, agree in seeds.overlaps(texts):
                seen = best.setdefault((text, item), [start, 0, 0])
                seen[0] = min(seen[0], start)
                seen[1] = max(seen[1], agree)
                seen[2] += 1
            digests = {t: hashlib.md5(texts[t].as_buffer()).digest() for t in {t for t, _ in best}}
            rows = [(ids[t].as_py(), digests[t], *seeds.names[i], *v) for (t, i), v in best.items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "doc", "item", "piece", "start", "matched", "n_windows"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return find


def _remover(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(*sent.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for text, *_ in seeds.overlaps(batch.column("text")):
                keep[text] = False
            yield batch.filter(pa.array(keep))

    return remove


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each text and item that overlap: doc_id, item_id, the first word of the first overlapping window,
    the most words that agree in a window, and the number of windows.

    Words are lower-cased (A-Z). Items without words, null or not, match nothing, and so do null and empty texts; an
    item of fewer than 8 words matches only as a whole. Ids may be null or repeated: every row of ``docs`` is judged by
    itself, and each row of ``benchmark`` is an item. Other columns are ignored. An empty benchmark gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = spark.createDataFrame([], _FOUND)
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)
        found = found.union(rows.mapInArrow(_finder(sent), _FOUND))
    # Rows equal in id and text have equal findings in every piece; they are counted, put together and told apart again.
    values = [F.first(c).alias(c) for c in ("start", "matched", "n_windows")]
    pieces = found.groupBy("doc_id", "doc", "item", "piece").agg(F.count(F.lit(1)).cast("int").alias("rows"), *values)
    whole = pieces.groupBy("doc_id", "doc", "item").agg(
        F.min("start").alias("start"),
        F.max("matched").alias("matched"),
        F.sum("n_windows").alias("n_windows"),
        F.first("rows").alias("rows"),
    )
    items = benchmark.select(F.col("item_id").cast("long"), _named(F.col("text")).alias("item"))
    return (
        whole.join(items, "item")
        .withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        .select("doc_id", "item_id", "start", "matched", "n_windows")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the texts that overlap an item; see :func:`contaminations`."""
    spark, out = docs.sparkSession, docs
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)
        out = out.mapInArrow(_remover(sent), docs.schema)
    return out


def op5_contaminations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all items."""
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
