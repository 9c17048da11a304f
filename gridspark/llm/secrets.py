"""Secrets found by patterns and by a linear-chain conditional random field.

The field tags every token as beginning a secret, inside one, or outside. A tag's weight at a token is a sum over what is
seen there: the token's length, digits and case, the kinds of its neighbours, the words before and after it, and what the
whole file looks like; a weight for each pair of neighbouring tags is added, and the best sequence is found by Viterbi's
algorithm. It is trained here, on a bounded sample of texts, from the secrets that the patterns find; since it goes by
looks and surroundings, it also finds those that the patterns' wording misses.

Where the weight of "outside" exceeds the others by more than any change of two transitions can make good, every best
sequence is outside; only the stretches between such tokens are decoded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import id_text, table, written
from gridspark.llm.words import spans, span_hashes, text_bytes

#: Texts from which examples are taken, in the mean at most; and every how many plain stretches one is an example.
TRAINING_TEXTS, PLAIN_EVERY = 20_000, 50
#: Examples with and without a secret that are fitted at most.
SECRET_EXAMPLES, PLAIN_EXAMPLES = 1_500, 2_000
#: Tokens of an example at most; one with a secret begins half as many before it.
EXAMPLE_TOKENS = 48
#: Half the bytes of a stretch; an example with a secret has a stretch's half on either side too.
CONTEXT = 80
_CHUNK = 1 << 20
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

# The patterns, and the least characters of a match (of its second group where it has one).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "field"]

_ASSIGN = re.compile(ASSIGN.encode(), re.IGNORECASE)
_ACCESS = re.compile(ACCESS.encode())
# a run of 24 or more is a match of HEX that is long enough
_HEX = re.compile(rb"[0-9a-f]{%d,}" % LEAST["hex"])
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def base_spans(text: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the patterns' matches, in bytes."""
    out = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                out.append(("assign", m.start(), m.end(), m.start(2)))
    if b"AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                out.append(("access", m.start(), m.end(), m.start()))
    out.extend(("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text))
    return out


# ---- tokens and what is seen at them

_TYPE = np.full(256, 2, np.uint8)  # 0 space, 1 letters, digits and beyond ASCII, 2 anything else, each a token
_TYPE[[0x20, *range(0x09, 0x0E)]] = 0
_TYPE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARKS = b"=:\"'+/-_.,;!?()*"
_MARK = np.zeros(256, np.int64)
_MARK[list(_MARKS)] = np.arange(len(_MARKS)) + 1
_SHAPES, _LOOKS, _BUCKETS, _FILES = 48 + len(_MARKS) + 2, 7, 1 << 12, 8
#: Tables of weights: the token's shape and look, the shapes around it, the words around it, the file.
_TABLES = (_SHAPES, _LOOKS, _SHAPES, _SHAPES, _BUCKETS, _BUCKETS, _FILES)


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray  # the token's text
    seen: np.ndarray  # a row of places in the tables per token


def tokens_of(data: np.ndarray, bounds: np.ndarray, files: np.ndarray | None = None) -> Tokens:
    """The tokens of texts given as bytes and bounds; a text's ``files`` number is found from its bytes if not given."""
    kind = _TYPE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins, ends = kind > 0, kind > 0
    begins[1:] &= (kind[1:] == 2) | (kind[:-1] != 1) | edge[1:-1]
    ends[:-1] &= (kind[:-1] == 2) | (kind[1:] != 1) | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    n = len(bounds) - 1
    of = np.searchsorted(bounds, starts, side="right") - 1
    if not len(starts):
        return Tokens(starts, ends, of, np.zeros((0, len(_TABLES)), np.int64))

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[ends] - sums[starts]

    digit, upper = (data >= 48) & (data <= 57), (data >= 65) & (data <= 90)
    lowered = _LOWER[data]
    letter = (lowered >= 97) & (lowered <= 122)
    size, digits, uppers, letters = ends - starts, count(digit), count(upper), count(letter)
    hexes = digits + count((lowered >= 97) & (lowered <= 102))
    length = np.digitize(size, [2, 4, 6, 8, 12, 20, 32])
    mix = np.where(digits == 0, 0, np.where(digits == size, 2, 1))
    mark = kind[starts] == 2
    shape = np.where(mark, 48 + _MARK[data[starts]], (length * 3 + mix) * 2 + (digits + letters < size))
    case = np.where(letters == 0, 0, np.where((uppers == 0) | (uppers == letters), 1, 2))
    look = np.where(mark, 6, case * 2 + (hexes == size))
    words = (span_hashes(lowered, starts, ends) & np.uint64(_BUCKETS - 1)).astype(np.int64)
    place = np.arange(len(starts))
    first = np.searchsorted(starts, bounds[:-1])[of]
    last = np.searchsorted(starts, bounds[1:])[of] - 1
    before = np.concatenate([[-1], np.maximum.accumulate(np.where(mark, -1, place))[:-1]])
    after = np.concatenate([np.minimum.accumulate(np.where(mark, len(starts), place)[::-1])[::-1][1:], [len(starts)]])
    none = _SHAPES - 1
    if files is None:
        some = np.maximum(np.diff(bounds), 1)
        sums = np.concatenate([[0], np.cumsum(digit)])
        marks = np.concatenate([[0], np.cumsum(kind == 2)])
        files = np.digitize((sums[bounds[1:]] - sums[bounds[:-1]]) / some, [0.001, 0.01, 0.05]) * 2 + (
            (marks[bounds[1:]] - marks[bounds[:-1]]) / some > 0.08
        )
    seen = np.column_stack(
        [
            shape,
            look,
            np.where(place > first, shape[place - 1], none),
            np.where(place < last, shape[np.minimum(place + 1, len(shape) - 1)], none),
            np.where(before >= first, words[before], 0),
            np.where(after <= last, words[np.minimum(after, len(words) - 1)], 0),
            files[of],
        ]
    )
    return Tokens(starts, ends, of, seen)


# ---- the field


@dataclass
class Field:
    tables: list[np.ndarray]  # rows of three weights
    moves: np.ndarray  # from tag to tag

    def weights(self, seen: np.ndarray) -> np.ndarray:
        out = np.zeros((len(seen), 3))
        for i, t in enumerate(self.tables):
            out += t[seen[:, i]]
        return out

    def tags(self, seen: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The best tags of tokens, whose texts are numbered in ``of``; texts begin and end next to an outside."""
        weight = self.weights(seen)
        bound = 2 * (self.moves.max() - self.moves.min())
        open_ = weight[:, OUTSIDE] - weight[:, 1:].max(axis=1) <= bound
        tags = np.zeros(len(seen), np.int64)
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        fresh = np.flatnonzero(np.append(True, (np.diff(at) != 1) | (of[at[1:]] != of[at[:-1]])))
        starts = at[fresh]
        sizes = np.diff(np.append(fresh, len(at)))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        score = self.moves[OUTSIDE][None, :] + weight[starts]
        back = []
        final = np.empty(len(starts), np.int64)
        for step in range(1, int(sizes[0]) + 1):
            going = int(np.searchsorted(-sizes, -step, side="left"))
            ended = slice(going, len(score))
            final[ended] = (score[ended] + self.moves[:, OUTSIDE]).argmax(axis=1)
            if not going:
                break
            choices = score[:going, :, None] + self.moves[None]
            back.append(choices.argmax(axis=1))
            score = choices.max(axis=1) + weight[starts[:going] + step]
        for step in range(int(sizes[0]) - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -step, side="left"))
            tags[starts[:live] + step] = final[:live]
            if step:
                final[:live] = back[step - 1][np.arange(live), final[:live]]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], steps: int = 60, rate: float = 0.2, decay: float = 0.02) -> Field:
    """A field from (seen, tags) of sequences, by the gradient of the log likelihood (Adam, all sequences at once).

    Without sequences every weight is zero except that everything is outside.
    """
    model = Field([np.zeros((n, 3)) for n in _TABLES], np.zeros((3, 3)))
    model.tables[-1][:, OUTSIDE] = 20.0 if not sequences else 0.0
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return model
    longest, n = max(len(t) for _, t in sequences), len(sequences)
    seen = np.zeros((n, longest, len(_TABLES)), np.int64)
    tags = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for i, (s, t) in enumerate(sequences):
        seen[i, : len(t)], tags[i, : len(t)], real[i, : len(t)] = s, t, True
    flat = seen[real]
    truth = np.eye(3)[tags[real]]
    size = real.sum(axis=1)
    seen_moves = np.zeros((3, 3))
    for _, t in sequences:
        np.add.at(seen_moves, (np.append(OUTSIDE, t), np.append(t, OUTSIDE)), 1)
    state = [np.zeros_like(p) for p in [*model.tables, model.moves] * 2]
    for step in range(1, steps + 1):
        weight = np.zeros((n, longest, 3))
        weight[real] = model.weights(flat)
        ahead = np.zeros((n, longest, 3))
        behind = np.zeros((n, longest, 3))
        ahead[:, 0] = model.moves[OUTSIDE] + weight[:, 0]
        for t in range(1, longest):
            ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + model.moves[None], 1) + weight[:, t]
        last = np.arange(n), size - 1
        total = _log_sum(ahead[last] + model.moves[:, OUTSIDE], 1)
        for t in range(longest - 1, -1, -1):
            ending = size - 1 == t
            if t + 1 < longest:
                behind[:, t] = _log_sum(model.moves[None] + (weight[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[ending, t] = model.moves[:, OUTSIDE]
        marginal = np.exp(ahead + behind - total[:, None, None])
        expected = np.zeros((3, 3))
        pair = np.exp(
            ahead[:, :-1, :, None] + model.moves + (weight[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        expected += pair[real[:, 1:]].sum(axis=0)
        expected[OUTSIDE] += marginal[:, 0].sum(axis=0)
        expected[:, OUTSIDE] += marginal[last].sum(axis=0)
        gap = truth - marginal[real]
        gradients = []
        for i, t in enumerate(model.tables):
            g = np.column_stack([np.bincount(flat[:, i], gap[:, k], minlength=len(t)) for k in range(3)])
            gradients.append(g - decay * t)
        gradients.append(seen_moves - expected - decay * model.moves)
        for p, g, m, v in zip([*model.tables, model.moves], gradients, state[: len(gradients)], state[len(gradients) :]):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return model


# ---- over texts


def _tagged(starts: np.ndarray, ends: np.ndarray, values: list[tuple[int, int]]) -> np.ndarray:
    """Tags of tokens from the places of secrets."""
    tags = np.zeros(len(starts), np.int64)
    for a, b in values:
        own = np.flatnonzero((starts >= a) & (ends <= b))
        tags[own] = INSIDE
        tags[own[:1]] = BEGIN
    return tags


def _draw(key: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "big", signed=True)


def _example_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches around secrets, and some of the others, with what is seen at their first tokens and their tags.

    ``draw`` is a hash of the text, its id and the stretch's number.
    """
    for batch in batches:
        data, bounds = text_bytes(batch.column("text"))
        ids = batch.column("id").to_pylist()
        seen_rows, tag_rows, draws, secrets = [], [], [], []
        for i, j in spans(bounds, _CHUNK):
            part, own = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
            found = tokens_of(part, own)
            at = np.searchsorted(found.of, np.arange(j - i + 1))
            for t in range(j - i):
                tokens = slice(int(at[t]), int(at[t + 1]))
                starts, ends = found.starts[tokens] - own[t], found.ends[tokens] - own[t]
                text = part[own[t] : own[t + 1]].tobytes()
                key = hashlib.blake2b(ids[i + t].encode() + b"\0" + text, digest_size=16).digest()
                values = [(v, b) for _, _, b, v in base_spans(text)]
                tags = _tagged(starts, ends, values)
                stretch = starts // (2 * CONTEXT)
                secret = np.unique(stretch[tags > 0])
                for s in np.unique(stretch).tolist():
                    draw = _draw(key + b"%d" % s)
                    if s in secret or draw % PLAIN_EVERY == 0:
                        near = (starts >= (2 * s - 1) * CONTEXT) & (starts < (2 * s + 3) * CONTEXT)
                        near = near if s in secret else stretch == s
                        cut = np.flatnonzero(near)
                        first = max(0, int((tags[cut] > 0).argmax()) - EXAMPLE_TOKENS // 2)
                        cut = cut[first : first + EXAMPLE_TOKENS]
                        seen_rows.append(found.seen[tokens][cut].astype(np.int32).ravel())
                        tag_rows.append(tags[cut].astype(np.int32))
                        draws.append(draw)
                        secrets.append(bool(tags[cut].any()))
        kind = pa.list_(pa.int32())
        columns = [pa.array(seen_rows, kind), pa.array(tag_rows, kind), pa.array(draws, pa.int64()), pa.array(secrets, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["seen", "tags", "draw", "secret"])


def train(docs: DataFrame) -> Field:
    """A field from a sample of texts drawn by the hash of their ids, ``TRAINING_TEXTS`` in the mean at most.

    Of their stretches, ``SECRET_EXAMPLES`` and ``PLAIN_EXAMPLES`` at most are fitted: those of the least draws, wherever
    they lie in the table. Only these reach the driver.
    """
    rows = docs.select(id_text(F.col("doc_id")).alias("id"), "text")
    share = min(1.0, TRAINING_TEXTS / max(rows.count(), 1))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / F.lit(1e6)
    found = rows.filter(drawn < share).mapInArrow(_example_rows, "seen array<int>, tags array<int>, draw long, secret boolean")
    found = written(found, "secret-examples")
    examples = []
    for kind, most in ((F.col("secret"), SECRET_EXAMPLES), (~F.col("secret"), PLAIN_EXAMPLES)):
        got = found.filter(kind).orderBy("draw").limit(most).select("seen", "tags").toPandas()
        examples += [(np.asarray(seen).reshape(-1, len(_TABLES)), np.asarray(tags)) for seen, tags in got.itertuples(index=False)]
    return fit(examples)


def _points(text: bytes, places: list[int]) -> dict[int, int]:
    """Code points before byte places."""
    data = np.frombuffer(text, np.uint8)
    sums = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return {p: int(sums[p]) for p in places}


def _scanner(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            rows = []
            for i, j in spans(bounds, _CHUNK):
                part, own = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
                found = tokens_of(part, own)
                tags = model.tags(found.seen, found.of)
                some = np.flatnonzero(tags)
                fresh = np.append(True, (np.diff(some) != 1) | (tags[some[1:]] == BEGIN) | (found.of[some[1:]] != found.of[some[:-1]]))
                begins = np.flatnonzero(fresh[: len(some)])
                lasts = np.append(begins[1:], len(some)) - 1
                extra: dict[int, list[tuple[int, int]]] = {}
                for a, b in zip(some[begins].tolist(), some[lasts].tolist() if len(begins) else [], strict=True):
                    t = int(found.of[a])
                    extra.setdefault(t, []).append((int(found.starts[a] - own[t]), int(found.ends[b] - own[t])))
                for t in range(j - i):
                    text = part[own[t] : own[t + 1]].tobytes()
                    base = [(k, a, b) for k, a, b, _ in base_spans(text)]
                    added = [("field", a, b) for a, b in extra.get(t, ()) if all(b <= x or a >= y for _, x, y in base)]
                    every = sorted([*base, *added], key=lambda s: (s[1], KINDS.index(s[0])))
                    if every:
                        points = _points(text, [p for _, a, b in every for p in (a, b)])
                        every = [{"kind": k, "start": points[a], "end": points[b]} for k, a, b in every]
                    rows.append(every)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return scan


def secret_spans(docs: DataFrame, model: Field) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text; others are ignored): doc_id and ``spans``, an array of kind, start and end
    in code points, by start and then kind.

    Matches of the three patterns keep their kinds; what only the field finds, apart from them, is of the kind ``field``.
    Null and empty texts have none. Rows are scanned by themselves, so ids may be null or repeated.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scanner(sent), kind)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = secret_spans(docs, train(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(kind) for kind in KINDS[:3]],
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "field")).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
