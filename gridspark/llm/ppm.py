"""Language-model scores by prediction by partial matching, learned from the whole corpus.

The model is a trie of byte contexts: for every context of up to five bytes, how often each byte (or the end of the text)
followed it in training texts. A byte is predicted from the longest context seen. If it never followed there, its code
pays an escape, as likely as the number of different bytes seen there against their count, and goes to the next shorter
context without the bytes that the longer one had (symbol exclusion); after the empty context all bytes left are equal.

The trie is never in one place. Texts are dealt out to buckets; a bucket gives its distinct grams (a context and a byte)
with their training counts. A gram's code length follows from contexts that end in the same two bytes, so grams meet in
shards by those two, where all contexts of two and more bytes are summed and the code length of each gram is worked out.
Counts of single bytes and of pairs, of which there are at most 258 by 258, are sent to all. Each bucket gets its grams
back with their code lengths. Words are counted the same way for the unigram base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import crc_of_id, table
from gridspark.llm.words import Chunk, chunks, mixed, word_hashes

#: Bytes of the longest context.
ORDER = 5
#: Symbols after the 256 bytes: the end of a text, and what stands before its beginning.
END, START = 256, 257
SYMBOLS = 258
#: Bytes of text in a bucket, and for which one shard is made.
BUCKET_BYTES, SHARD_BYTES = 16 << 20, 32 << 20
_CHUNK = 400_000
_BLOCK = 1 << 19

_COUNTED = "kind int, shard int, bucket int, keys binary, counts binary"
_VALUED = "bucket int, kind int, keys binary, numbers binary, different long, total long"
_SCORED = "bucket int, doc_id long, held_out boolean, n_tokens long, n_known long, known double, score double"


def grams(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (gram, its text in the chunk) for every byte and every end; nine bits a symbol."""
    size = np.diff(chunk.bounds)
    full = size + ORDER + 1
    symbols = np.full(int(full.sum()), START, np.int64)
    begins = np.cumsum(full) - full + ORDER
    of = np.repeat(np.arange(chunk.n), size)
    symbols[np.arange(len(chunk.data)) - chunk.bounds[of] + begins[of]] = chunk.data
    symbols[begins + size] = END
    of_symbol = np.repeat(np.arange(chunk.n), full)
    for at in range(0, len(symbols) - ORDER, _BLOCK):
        end = min(at + _BLOCK, len(symbols) - ORDER)
        code = np.zeros(end - at, np.int64)
        for j in range(ORDER + 1):
            code = (code << 9) | symbols[at + j : end + j]
        some = symbols[at + ORDER : end + ORDER] != START
        yield code[some], of_symbol[at + ORDER : end + ORDER][some]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[fresh], np.add.reduceat(counts, fresh) if len(fresh) else counts


def _packed(sorted_keys: np.ndarray) -> bytes:
    """Sorted keys as differences, which compress better."""
    return np.diff(sorted_keys, prepend=0).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


class _Counts:
    """Keys and counts of parts, summed now and then."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.held += len(keys)
        if self.held > 4_000_000:
            keys, counts = self.done()
            self.keys, self.counts, self.held = [keys], [counts], 0

    def add_marked(self, keys: np.ndarray, training: np.ndarray) -> None:
        self.add(*np.unique(keys[training], return_counts=True))
        rest = np.unique(keys[~training])
        self.add(rest, np.zeros(len(rest), np.int64))

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        return summed(self.keys, self.counts)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every byte after every byte, of a partition's texts."""
    counts = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for batch in batches:
        for chunk in chunks(batch.column("text"), lower=True, most=_CHUNK):
            for codes, _ in grams(chunk):
                pair = (codes >> 9 & 511) * SYMBOLS + (codes & 511)
                counts += np.bincount(pair, minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["pair", "n"])


def _gram_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed((keys >> 9 & 0x3FFFF).astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _word_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys.view(np.uint64) % np.uint64(shards)).astype(np.int64)


def _counter(shards: int):
    def count(rows: pa.Table) -> pa.Table:
        """A bucket's grams (kind 0) and words (1), by shard."""
        held = rows.column("held_out").to_numpy(zero_copy_only=False)
        seen_grams, seen_words = _Counts(), _Counts()
        for chunk in chunks(rows.column("text").combine_chunks(), lower=True, most=_CHUNK):
            training = ~held[chunk.at : chunk.at + chunk.n]
            for codes, of in grams(chunk):
                seen_grams.add_marked(codes, training[of])
            seen_words.add_marked(word_hashes(chunk).view(np.int64), np.repeat(training, np.diff(chunk.first)))
        out: list[tuple] = []
        bucket = rows.column("bucket")[0].as_py()
        for kind, seen, shard_of in ((0, seen_grams, _gram_shard), (1, seen_words, _word_shard)):
            keys, counts = seen.done()
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
            for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if b > a:
                    own = order[a:b]
                    out.append((kind, s, bucket, _packed(keys[own]), counts[own].tobytes()))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = [pa.int32()] * 3 + [pa.binary()] * 2
        names = ["kind", "shard", "bucket", "keys", "counts"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return count


class _Level:
    """Contexts of one length with what followed them; ``excluded`` and ``gone`` hold, for each context one longer, the
    counts here of what followed there, and how many those are."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, longer: _Level | None):
        self.keys, self.counts = keys, counts
        contexts = keys >> 9
        begins = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.contexts, self.begins = contexts[begins], begins
        self.totals = np.add.reduceat(counts, begins) if len(begins) else np.zeros(0, np.int64)
        self.different = np.diff(np.append(begins, len(keys)))
        self.longer = longer

    def excluded(self, mask: int) -> np.ndarray:
        longer = self.longer
        if longer is None or not len(longer.keys):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, longer.keys & mask)
        return np.add.reduceat(self.counts[at], longer.begins)


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def code_lengths(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The log10 probability of each gram.

    ``keys`` are sorted distinct grams, among them all seen ones whose contexts end in the same two symbols as any of
    them; ``counts`` their training counts, which may be 0. ``pairs`` has the counts of each symbol after each.
    """
    seen = counts > 0
    level = _Level(keys[seen], counts[seen], None)
    levels = [level]
    for order in range(ORDER - 1, 1, -1):
        shorter, sums = summed([level.keys & ((1 << 9 * (order + 1)) - 1)], [level.counts])
        level = _Level(shorter, sums, level)
        levels.append(level)
    some = np.flatnonzero(pairs)
    level = _Level((some // SYMBOLS << 9) | some % SYMBOLS, pairs[some], level)
    levels.append(level)
    single = pairs.reshape(SYMBOLS, SYMBOLS).sum(axis=0)
    levels.append(_Level(np.flatnonzero(single), single[single > 0], level))
    out = np.zeros(len(keys))
    open_ = np.arange(len(keys))
    for order, level in zip(range(ORDER, -1, -1), levels, strict=True):
        if not len(open_):
            break
        mask = (1 << 9 * (order + 1)) - 1
        own = keys[open_] & mask
        context, known = _found(level.contexts, own >> 9)
        if not known.any():
            continue
        total, different = level.totals[context], level.different[context]
        if level.longer is not None and len(level.longer.keys):
            excluded = level.excluded(mask)
            above, had = _found(level.longer.contexts, (keys[open_] & ((1 << 9 * (order + 2)) - 1)) >> 9)
            total = total - np.where(had, excluded[above], 0)
            different = different - np.where(had, level.longer.different[above], 0)
        at, hit = _found(level.keys, own)
        hit &= known
        some = known & (different > 0)
        weight = np.where(some, total + different, 1)
        gain = np.where(hit, level.counts[at] if len(level.counts) else 0, different)
        step = np.where(hit | some, np.log10(np.maximum(gain, 1) / np.maximum(weight, 1)), 0.0)
        out[open_] += step
        open_ = open_[~hit]
    left = SYMBOLS - 1 - len(levels[-1].keys)
    out[open_] -= np.log10(max(left, 1))
    return out


def _valuer(sent):
    def value(rows: pa.Table) -> pa.Table:
        """A shard's counts summed over all buckets; back to each bucket its keys with their numbers."""
        kind = rows.column("kind")[0].as_py()
        buckets = rows.column("bucket").to_pylist()
        parts = [_unpacked(k) for k in rows.column("keys").to_pylist()]
        counts = [np.frombuffer(c, np.int64) for c in rows.column("counts").to_pylist()]
        keys, sums = summed(parts, counts)
        numbers = code_lengths(keys, sums, sent.value) if kind == 0 else np.log10(sums + 1.0)
        back = [numbers[np.searchsorted(keys, p)].astype(np.float64 if kind else np.float32).tobytes() for p in parts]
        n, different = len(parts), int((sums > 0).sum()) if kind else 0
        total = int(sums.sum()) if kind else 0
        return pa.table(
            [
                pa.array([*buckets, -1], pa.int32()),
                pa.array([kind] * (n + 1), pa.int32()),
                pa.array([*rows.column("keys").to_pylist(), None], pa.binary()),
                pa.array([*back, None], pa.binary()),
                pa.array([None] * n + [different], pa.int64()),
                pa.array([None] * n + [total], pa.int64()),
            ],
            names=["bucket", "kind", "keys", "numbers", "different", "total"],
        )

    return value


def _dictionary(rows: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    some = [(k, v) for of, k, v in zip(*(rows.column(c).to_pylist() for c in ("kind", "keys", "numbers"))) if of == kind]
    if not some:
        return np.zeros(0, np.int64), np.zeros(0)
    keys = np.concatenate([_unpacked(k) for k, _ in some])
    numbers = np.concatenate([np.frombuffer(v, np.float64 if kind else np.float32) for _, v in some])
    order = np.argsort(keys)
    return keys[order], numbers[order].astype(np.float64)


def _scorer(ends: int):
    log_end = float(np.log10(ends + 1.0))

    def score(texts: pa.Table, values: pa.Table) -> pa.Table:
        n = texts.num_rows
        gram_keys, gram_numbers = _dictionary(values, 0)
        word_keys, word_numbers = _dictionary(values, 1)
        tokens, known, logs, scores = (np.zeros(n) for _ in range(4))
        column = texts.column("text").combine_chunks() if n else pa.array([], pa.string())
        for chunk in chunks(column, lower=True, most=_CHUNK):
            own = slice(chunk.at, chunk.at + chunk.n)
            for codes, of in grams(chunk):
                order = np.argsort(codes)
                at = np.searchsorted(gram_keys, codes[order])
                scores[own] += np.bincount(of[order], gram_numbers[at], minlength=chunk.n)
            count = np.diff(chunk.first)
            numbers = word_numbers[np.searchsorted(word_keys, word_hashes(chunk).view(np.int64))]
            of = np.repeat(np.arange(chunk.n), count)
            tokens[own] = count + 1
            known[own] = np.bincount(of, numbers > 0, minlength=chunk.n) + (ends > 0)
            logs[own] = np.bincount(of, numbers, minlength=chunk.n) + log_end
        return pa.table(
            [
                texts.column("bucket").cast(pa.int32()) if n else pa.array([], pa.int32()),
                texts.column("doc_id").cast(pa.int64()) if n else pa.array([], pa.int64()),
                texts.column("held_out").cast(pa.bool_()) if n else pa.array([], pa.bool_()),
                pa.array(tokens.astype(np.int64)),
                pa.array(known.astype(np.int64)),
                pa.array(logs),
                pa.array(scores),
            ],
            names=["bucket", "doc_id", "held_out", "n_tokens", "n_known", "known", "score"],
        )

    return score


def scored(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, held_out; others are ignored) with its scores.

    The model and the base learn from the rows that aren't ``held_out`` (null: not). Letters A-Z are lower-cased. Null
    texts count as empty, and have the end as their only token. ``score`` is the log10 probability of the text and its end;
    ``base_score`` that of its words and end as a bag with one added to every count. Rows with null or equal ids are
    scored by themselves. An empty table gives none; without training rows all bytes are alike.
    """
    sizes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    size = sizes[0] + 16 * sizes[1]
    buckets, shards = max(1, -(-size // BUCKET_BYTES)), max(1, -(-size // SHARD_BYTES))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("held_out", F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    training = rows.filter(~F.col("held_out")).select("text")
    pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for pair, n in training.mapInArrow(_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        pairs[pair] = n
    ends = int(pairs.reshape(SYMBOLS, SYMBOLS)[:, END].sum())
    sent = docs.sparkSession.sparkContext.broadcast(pairs)
    counted = rows.groupBy("bucket").applyInArrow(_counter(shards), _COUNTED)
    valued = counted.groupBy("kind", "shard").applyInArrow(_valuer(sent), _VALUED)
    base = valued.filter("bucket = -1").agg(
        F.coalesce(F.sum("different"), F.lit(0)).alias("different"), (F.coalesce(F.sum("total"), F.lit(0)) + ends).alias("train_tokens")
    )
    base = base.withColumn("different", F.col("different") + int(ends > 0)).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    )
    values = valued.filter("bucket >= 0").select("bucket", "kind", "keys", "numbers")
    out = rows.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(_scorer(ends), _SCORED)
    return out.join(base, "bucket").select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.col("train_tokens").cast("long").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("different") + 1)).alias("base_score"),
        "score",
    )


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from those whose id's CRC-32 doesn't leave 2 by 7."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs.withColumn("held_out", crc_of_id(F.col("doc_id")) % 7 == 2))
