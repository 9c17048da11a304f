"""A quality classifier learned from positives and unlabelled text.

Trusted positives are the rows marked good. Everything else is unlabelled: web text in which good and bad are mixed in
the proportion of the class prior. With loss l, the risk of positives taken for negatives is subtracted from that of all
unlabelled text taken for negatives, which leaves the negatives' risk; it is an estimate and is kept from falling below
zero (non-negative risk), or the model would fit its noise:

    prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])

The prior is estimated from the marks: the share of good rows among the marked ones of the training part. Features are
taken from the text alone: shares of kinds of characters, repetition of words and lines, lengths. Each feature is cut
into bins at its quantiles and every bin has a weight. The sample that is fitted is bounded; every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import crc_of_id, id_text, table
from gridspark.llm.words import Chunk, chunks, mixed, run_hashes, span_hashes, word_hashes

#: Rows that are fitted at most, in the mean: marked good, and unlabelled.
POSITIVES, UNLABELLED = 10_000, 30_000
BINS = 12

#: Kinds of bytes; all others are kind 0.
_KINDS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\x0b\x0c", b".", b",",
    b";:", b"!", b"?", b"'\"`", b"()[]", b"{}<>", b"|", b"#", b"*", b"$", b"%", b"&", b"@", b"/\\", b"-_", b"=+~^",
    bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)),
]
_KIND = np.zeros(256, np.int64)
for _i, _bytes in enumerate(_KINDS):
    _KIND[list(_bytes)] = _i + 1
_N_KINDS = len(_KINDS) + 1
FEATURES = _N_KINDS + 10


def features(chunk: Chunk) -> np.ndarray:
    """A row of figures per text; empty texts have zeros."""
    n = chunk.n
    size = np.diff(chunk.bounds)
    some = np.maximum(size, 1)
    of_byte = np.repeat(np.arange(n), size)
    kinds = np.bincount(of_byte * _N_KINDS + _KIND[chunk.data], minlength=n * _N_KINDS).reshape(n, _N_KINDS)
    count = np.diff(chunk.first)
    words = np.maximum(count, 1)
    of_word = np.repeat(np.arange(n), count)
    hashes = word_hashes(chunk)
    lengths = chunk.ends - chunk.starts

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, values, minlength=n)

    upper = np.concatenate([[0], np.cumsum((chunk.data >= 65) & (chunk.data <= 90))])
    shouted = upper[chunk.ends] - upper[chunk.starts]
    last = chunk.data[chunk.ends - 1]
    letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (last >= 128)
    runs = run_hashes(hashes, 3)
    run_of = of_word[: len(runs)]
    whole = run_of == of_word[2:] if len(runs) else np.zeros(0, bool)
    run_of, runs = run_of[whole], runs[whole]
    breaks = np.flatnonzero(chunk.data == 10)
    begins = np.union1d(breaks + 1, chunk.bounds[:-1])
    begins = begins[begins < len(chunk.data)]
    ends = np.append(begins[1:], len(chunk.data))
    line_of = np.searchsorted(chunk.bounds, begins, side="right") - 1
    lines = span_hashes(chunk.data, begins, ends)
    n_lines = np.maximum(np.bincount(line_of, minlength=n), 1)
    extra = [
        np.log1p(size),
        np.log1p(count),
        per_text(lengths) / words,
        np.sqrt(np.maximum(per_text(lengths.astype(float) ** 2) / words - (per_text(lengths) / words) ** 2, 0)),
        per_text(shouted > 1) / words,
        per_text(~letter) / words,
        _repeated(of_word, hashes, n) / words,
        _repeated(run_of, runs, n) / words,
        _repeated(line_of, lines, n) / n_lines,
        np.log1p(size / n_lines),
    ]
    return np.column_stack([kinds / some[:, None], *extra]).astype(np.float32)


def _repeated(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """How many of each text's values it had before."""
    keys = mixed(values ^ mixed(of.astype(np.uint64), 3))
    order = np.argsort(keys)
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return np.bincount(of[again], minlength=n)


@dataclass
class Model:
    edges: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    bias: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)])

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = self.bias + self.weights[np.arange(x.shape[1])[None, :], b].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.08, decay: float = 1e-4) -> Model:
    """Minimises the non-negative risk with the logistic loss, by Adam over all rows at once.

    While the negatives' risk is below zero, a step goes up that risk instead. Without positives or unlabelled rows the
    model scores everything with the prior.
    """
    prior = min(max(prior, 0.01), 0.99)
    count = positive.shape[1]
    flat = Model(np.zeros((count, BINS - 1)), np.zeros((count, BINS)), float(np.log(prior / (1 - prior))))
    if not len(positive) or not len(unlabelled):
        return flat
    both = np.concatenate([positive, unlabelled])
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model = Model(np.quantile(both, quantiles, axis=0).T, flat.weights, flat.bias)
    # a feature that is mostly one value gets its other edges from the rest
    for f in range(count):
        column = both[:, f]
        values, times = np.unique(column, return_counts=True)
        common = values[times.argmax()]
        if times.max() > len(column) / BINS:
            rest = column[column != common]
            edges = np.quantile(rest, np.linspace(0, 1, BINS - 2)[1:-1]) if len(rest) else []
            own = np.unique(np.concatenate([edges, [common, np.nextafter(common, np.inf)]]))
            model.edges[f] = np.concatenate([own, np.full(BINS - 1 - len(own), np.inf)])
    size = count * BINS
    offset = np.arange(count) * BINS
    p, u = model.bins(positive) + offset, model.bins(unlabelled) + offset
    w = np.zeros(size + 1)
    w[-1] = flat.bias
    m, v = np.zeros(size + 1), np.zeros(size + 1)

    def gradient(rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        out = np.zeros(size + 1)
        out[:size] = np.bincount(rows.ravel(), np.repeat(g, count), minlength=size)
        out[-1] = g.sum()
        return out

    for step in range(1, steps + 1):
        zp, zu = w[-1] + w[p].sum(axis=1), w[-1] + w[u].sum(axis=1)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        of_negative = gradient(u, su / len(u)) - prior * gradient(p, sp / len(p))
        if negative >= 0:
            g = of_negative + prior * gradient(p, (sp - 1) / len(p))
        else:
            g = -of_negative
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights, model.bias = w[:size].reshape(count, BINS), float(w[-1])
    return model


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        draws, done = batch.column("draw"), 0
        for chunk in chunks(batch.column("text")):
            x = pa.array(features(chunk).tolist(), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([draws.slice(done, len(x)), x], ["draw", "x"])
            done += len(x)


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(model.scores(features(chunk)) for chunk in chunks(texts))])


def _scorer(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(_scores(sent.value, batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return score


def _keeper(sent, least: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(sent.value, batch.column("text")) >= least))

    return keep


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the rows of ``docs`` (doc_id, text) outside the held-out third and their marks in ``labels``.

    At most ``POSITIVES`` and ``UNLABELLED`` rows are fitted on, drawn by the hash of id and text; what reaches the driver
    is their features. An id with contradictory marks counts as good; null marks are none; without marks the prior is a half.
    """
    marks = labels.filter(F.col("quality").isNotNull() & (crc_of_id(F.col("doc_id")) % 3 != 1))
    marks = marks.groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__quality"))
    good, marked = marks.agg(F.sum(F.when(F.col("__quality") == 1, 1).otherwise(0)), F.count(F.lit(1))).first()
    prior = (good or 0) / marked if marked else 0.5
    rows = docs.select("doc_id", "text").filter(crc_of_id(F.col("doc_id")) % 3 != 1)
    drawn = F.pmod(F.xxhash64(id_text(F.col("doc_id")), F.coalesce("text", F.lit(""))), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def sample(picked: DataFrame, of: int, most: int) -> np.ndarray:
        share = min(1.0, 1.1 * most / max(of, 1))
        found = picked.select("text", drawn.alias("draw")).filter(F.col("draw") < share)
        found = found.mapInArrow(_described, "draw double, x array<float>")
        got = found.orderBy("draw").limit(most).toPandas()["x"]
        return np.stack(got.to_numpy()) if len(got) else np.zeros((0, FEATURES), np.float32)

    trusted = rows.join(marks.filter("__quality = 1"), F.col("doc_id") == F.col("__id"), "left_semi")
    return fit(sample(trusted, good or 0, POSITIVES), sample(rows, rows.count(), UNLABELLED), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` for every row of ``docs``; null and empty texts are scored by their zeros."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_scorer(sent), "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_keeper(sent, least), docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learned from the marks outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    rows = scored(docs, train(docs, table(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        (crc_of_id(F.col("doc_id")) % 3 == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
