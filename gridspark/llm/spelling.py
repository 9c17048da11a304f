"""Spelling variants: words within one edit of each other, by bit-sliced position indexes.

An index holds words as bits of large numbers: for each position and letter, the set of words with that letter there.
A query word goes through it letter by letter, for all words at once: one set of words matches so far without an error, three more
with one (a letter replaced, one that only the query has, one that only the word has), the latter two read at positions
shifted by one.

Of two words within one edit, the halves of one are whole in the other, the first or the last one. So each word goes to the
indexes of its halves, as the shorter or as the longer word of a pair, and all near words meet in one. A pair that shares both
halves counts in that of the first. An index beyond ``INDEX_WORDS`` is built in parts, and all its words go through every part; they pass as a stream, so a task holds
one part. Tasks give back a count and the best word for each word and part; pairs are never written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import table, written

#: Words of an index, or of a part of a large one.
INDEX_WORDS = 4096
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How many times as frequent a form is as its variant.
FORM_RATIO = 10
#: One run in so many loses a letter.
MISSPELT = 31

_SHORT = r"[A-Za-zÀ-ÿ]"


def _counted(length: int, misspelt: int):
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                own = f"{doc_id.as_py()}:".encode() if doc_id.is_valid else b":"
                start = zlib.crc32(own)
                for word, n in Counter(runs.findall(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if misspelt and h % misspelt == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < length:
                            continue
                    found[word] += n
                if len(found) > HELD_WORDS:
                    yield flush()
        yield flush()

    return count


def word_counts(docs: DataFrame, length: int = LEAST_LENGTH, least: int = LEAST_COUNT, misspelt: int = 0) -> DataFrame:
    """(word, n): runs of letters of ``docs`` (doc_id, text; other columns are ignored) with A-Z in lower case.

    Words have ``length`` code points and ``least`` occurrences at least. Null texts have none; repeated rows count again. With
    ``misspelt``, a run whose CRC-32 behind its document's id is a multiple of it loses one letter; a null id is empty.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    parts = rows.mapInArrow(_counted(length, misspelt), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


class BitIndex:
    """Sets of words, as bits, by position and letter and by length."""

    def __init__(self, words: list[str]):
        self.at: dict[tuple[int, str], int] = {}
        self.long: dict[int, int] = {}
        self.reach: list[int] = []  # words with a letter at a position
        for i, word in enumerate(words):
            bit = 1 << i
            for place in enumerate(word):
                self.at[place] = self.at.get(place, 0) | bit
            self.long[len(word)] = self.long.get(len(word), 0) | bit
        for n, found in self.long.items():
            self.reach.extend([0] * (n - len(self.reach)))
            for i in range(n):
                self.reach[i] |= found
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """The words that differ from ``word`` by exactly one letter inserted, deleted or replaced."""
        at, reach = self.at, self.reach
        exact, replaced, only_query, only_word = self.all, 0, 0, 0
        for i, letter in enumerate(word):
            here = at.get((i, letter), 0)
            before = at.get((i - 1, letter), 0)
            after = at.get((i + 1, letter), 0)
            there = reach[i] if i < len(reach) else 0
            replaced = (replaced & here) | (exact & there & ~here)
            only_word = (only_word | exact) & after
            only_query = (only_query & before) | exact
            exact &= here
            if not (exact | replaced | only_query | only_word):
                return 0
        n = len(word)
        return (
            (replaced & self.long.get(n, 0))
            | (only_query & self.long.get(n - 1, 0))
            | ((only_word | exact) & self.long.get(n + 1, 0))
        )


def _shares_head(a: str, b: str) -> bool:
    """Whether the first half, of the shorter word's, is whole in both."""
    half = min(len(a), len(b)) // 2
    return a[:half] == b[:half]


def _near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (index, part, asks, word, n, tail), words of a part first, to (word, n_near, form, form_n) for each asking word."""
    part: tuple | None = None
    held: list[tuple[int, str]] = []
    index: BitIndex | None = None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        out.clear()
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n_near", "form", "form_n"])

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("index", "part", "asks", "word", "n", "tail"))
        for key, number, asks, word, n, tail in zip(*columns, strict=True):
            if part != (key, number):
                part, held, index = (key, number), [], None
            if not asks:
                held.append((-n, word))
                continue
            if index is None:
                held.sort()
                index = BitIndex([w for _, w in held])
            near = index.near(word)
            short = int(key.partition(" ")[0])
            if len(word) > short:  # two of the longer words meet in an index of their own length
                near &= index.long.get(short, 0)
            if tail:
                rest = near
                while rest:
                    low = rest & -rest
                    rest ^= low
                    if _shares_head(word, held[low.bit_length() - 1][1]):
                        near ^= low
            if near:
                best_n, best = held[(near & -near).bit_length() - 1]
                out.append((word, near.bit_count(), best, -best_n))
        if len(out) > 10_000:
            yield flush()
    yield flush()


def _halves(word: Column) -> Column:
    """The indexes a word goes to: by its halves, as the shorter or as the longer word of a pair."""
    n = F.char_length(word)

    def pair(short: Column) -> list[Column]:
        half = F.floor(short / 2).cast("int")
        head = F.struct(F.concat_ws(" ", short.cast("string"), F.substring(word, F.lit(1), half), F.lit("-")).alias("index"), F.lit(False).alias("tail"))
        tail = F.struct(F.concat_ws(" ", short.cast("string"), F.lit("-"), F.right(word, short - half)).alias("index"), F.lit(True).alias("tail"))
        return [head, tail]

    return F.array(*pair(n), *pair(n - 1))


def near_counts(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for each of ``words`` (word, n) that has near words: how many, and the one of largest n.

    Of equal n, the first in the order of code points. Words are distinct and have two code points at least.
    """
    placed = words.select("word", "n", F.explode(_halves(F.col("word"))).alias("to"))
    placed = written(placed.select("word", "n", "to.index", "to.tail"), "halves")
    sizes = placed.groupBy("index").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    parts = sizes.select("index", F.ceil(F.col("size") / INDEX_WORDS).cast("int").alias("parts"))
    met = placed.join(parts, "index")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    kept = met.select("index", own.alias("part"), F.lit(0).alias("asks"), "word", "n", "tail")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asking = met.select("index", every.alias("part"), F.lit(1).alias("asks"), "word", "n", "tail")
    partitions = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept.unionByName(asking).repartition(partitions, "index", "part").sortWithinPartitions("index", "part", "asks")
    found = dealt.mapInArrow(_near_words, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    ranked = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return ranked.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for ``links`` (word, form): where a word's forms end.

    Each round doubles how far a word sees. A form has ten times its word's occurrences, so there are few rounds.
    """
    seen = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = seen.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(seen.join(further, "root", "left"), "roots")
        seen = step.select("word", F.coalesce("further", "root").alias("root"))
        if not step.filter(F.col("further").isNotNull()).limit(1).count():
            return seen


def spelling_forms(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``words`` (word, n) with ``n_near``, ``form``, ``form_n`` and ``root``.

    A word's form is its near word of largest n, if that is ``ratio`` times the word's own at least; its root is where its forms
    end, the word itself if it has none.
    """
    words = written(words.select("word", "n"), "words")
    near = words.join(near_counts(words), "word", "left")
    fits = F.col("form_n") >= F.col("n") * ratio
    near = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("form")).alias("form"),
        F.when(fits, F.col("form_n")).alias("form_n"),
    )
    near = written(near, "near")
    ends = roots(near.filter(F.col("form").isNotNull()))
    return near.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents, some of which have lost a letter, with their forms."""
    counts = word_counts(table(spark, sf_dir, "documents"), misspelt=MISSPELT)
    return spelling_forms(counts).select("word", "form", "root", "n", "n_near", "form_n")


#: CRC-32 as for op2; near words share what is left when one letter is taken out.
OP12_SQL = r"""
WITH RECURSIVE
bits AS (
  SELECT i AS byte, 0 AS step, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT byte, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
),
crc AS (SELECT list(c ORDER BY byte) AS entries FROM bits WHERE step = 8),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
),
hexed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
      lambda acc, b: xor(acc >> 8, crc.entries[(xor(acc, b) & 255) + 1])), 4294967295) AS h
  FROM hexed, crc
),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
  UNION
  SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM pairs GROUP BY word),
first AS (SELECT p.word, min(p.other) AS form FROM pairs p JOIN best b ON b.word = p.word AND p.n = b.top GROUP BY p.word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.top >= 10 * w.n THEN f.form END AS form, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word) LEFT JOIN first f USING (word)
),
chains AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chains c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
),
ends AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)
"""
