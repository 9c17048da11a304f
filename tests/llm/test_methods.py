"""The operators' methods against brute force, round trips and held-out rows."""

import collections
import gzip
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridspark.llm import components as component_steps
from gridspark.llm import decontaminate, minhash, ppm, quality, secrets, sharding, substrings, warc
from gridspark.llm.components import components
from gridspark.llm.fm_index import FmIndex
from gridspark.llm.words import chunks, word_hashes

SF = "/root/testdata/sf0.001"


def test_words_of_chunks():
    texts = ["a b", None, "", " c\td e ", "b", "xyz" * 3]
    got = [(c.at, c.n, len(c.starts)) for c in chunks(pa.array(texts), most=4)]
    assert sum(n for _, n, _ in got) == len(texts) and sum(w for *_, w in got) == 6
    one = next(chunks(pa.array(["b", "a b"])))
    hashes = word_hashes(one)
    assert hashes[0] == hashes[2] != hashes[1]


def test_jump_hash_is_the_published_one(spark):
    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    keys = [0, 1, 2, 10, 256, 2**40 + 7, -1, -(2**63), 2**63 - 1, *range(1000, 1200)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 7, 40, 1000):
        for r in df.select("k", sharding.shard_of(df["k"], n).alias("s")).collect():
            assert r["s"] == jump(r["k"] % (1 << 64), n), (r["k"], n)


def test_components_of_random_links(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    of = {}
    for a, b in links:
        of.setdefault(a, {a}), of.setdefault(b, {b})
        both = of[a] | of[b]
        for x in both:
            of[x] = both
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: min(v) for k, v in of.items() if len(v) > 1}


@pytest.mark.parametrize("most,steps", [(200_000, 2), (60, None)])
def test_components_by_task_links(spark, monkeypatch, most, steps):
    """Links that a task can connect take no rounds of stars; more of them give the same."""
    of_key = [b"%c%d" % (200 * (k % 2), k) for k in range(400)]
    links = [(of_key[k], of_key[k - 1 - k % 3]) for k in range(3, 400) if k % 50 > 3] * 2 + [(of_key[7], of_key[7]), (None, of_key[0])]
    made, real = [], component_steps.written

    def written(df, name):
        made.append(name)
        return real(df, name)

    monkeypatch.setattr(component_steps, "TASK_LINKS", most)
    monkeypatch.setattr(component_steps, "written", written)
    df = spark.createDataFrame(links, "a binary, b binary").repartition(7)
    got = sorted((bytes(r["node"]), bytes(r["root"])) for r in components(df).collect())
    of = {}
    for a, b in links[:-2]:
        both = of.get(a, {a}) | of.get(b, {b})
        of.update((x, both) for x in both)
    assert got == sorted((k, min(v)) for k, v in of.items())
    assert len(made) == steps if steps else len(made) > 2


def test_matching_statistics():
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 5, n) for n in (40, 1, 90, 33)]
    texts.append(texts[2][10:60])
    flat = np.concatenate([np.append(t, 0) for t in texts])
    index = FmIndex(flat, np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts]))
    streams = [rng.integers(1, 6, 70), texts[2][5:50], np.zeros(0, np.int64), rng.integers(1, 4, 12)]
    inside = [t.tolist() for t in texts]
    for most in (8, 30):
        seen = 0
        for which, places, lengths, lows, highs in index.statistics(streams, most):
            for w, p, length, low, high in zip(which, places, lengths, lows, highs, strict=True):
                s = streams[w].tolist()
                found = {
                    n: sum(t[i : i + n] == s[p : p + n] for t in inside for i in range(len(t) - n + 1)) for n in range(1, most + 1)
                }
                best = max([n for n in found if p + n <= len(s) and found[n]], default=0)
                assert length == best and (not best or high - low == found[best])
                seen += 1
        assert seen == sum(map(len, streams))


def _texts(rng, n, size):
    return [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, size))] for _ in range(n)]


def _without(docs, window):
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in docs:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("hot", [5_000, 3])
def test_repeated_passages(spark, monkeypatch, hot):
    """With a low limit, a line that many texts share is keyed window by window, and anchors are dealt out."""
    monkeypatch.setattr(substrings, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(substrings, "HEAVY_RUNS", hot)
    monkeypatch.setattr(substrings, "HEAVY_SHARE", hot)
    rng = random.Random(2)
    texts = _texts(rng, 60, 200)
    line = [f"l{k}" for k in range(12)]
    for k in range(60):
        a, b = rng.choice(texts), rng.choice(texts)
        at = rng.randrange(len(a))
        texts[k] = texts[k] + (line if k % 2 else []) + a[at : at + rng.randrange(120)] + b[:3]
    docs = list(zip(rng.sample(range(1000), 60), texts, strict=True))
    df = spark.createDataFrame([(i, "  ".join(w)) for i, w in docs], "doc_id long, text string")
    for window in (20, 50):
        got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.without_repeats(df, window).collect()}
        assert got == _without(docs, window)


@pytest.mark.parametrize("most", [1_000_000, 400])
def test_near_duplicates(spark, monkeypatch, most):
    """With a small limit, families are taken bucket by bucket and in blocks."""
    monkeypatch.setattr(minhash, "FAMILY_SHINGLES", most)
    rng = random.Random(4)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rng.randrange(3000)}" for _ in range(120)]
        for _ in range(12):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(9999)}"
            rows.append((rng.randrange(10**6), w[rng.randrange(6) :]))
    rows += [(i, w) for i, w in enumerate(_texts(rng, 20, 60), 10**7)] + [(10**8, rows[0][1])]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in rows}
    of = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                both = of[a] | of[b]
                for x in both:
                    of[x] = both
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == {i: (len(s), min(of[i])) for i, s in sets.items()}


def test_estimate_of_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    minima = minhash._minima([both[:2600], both[400:]])
    packed = np.frombuffer(minhash._packed(minima).tobytes(), np.uint64).reshape(2, -1)
    assert minhash.estimate(minhash.agreeing(packed[0], packed[1:]))[0] == pytest.approx(2200 / 3000, abs=0.13)
    assert minhash.agreeing(packed[0], packed[:1])[0] == minhash.MINIMA


@pytest.mark.parametrize(("piece", "block"), [(20_000, 300_000), (20, 60)])
def test_contaminations(spark, monkeypatch, piece, block):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(6)
    items = {i: [f"b{rng.randrange(2000)}" for _ in range(n)] for i, n in enumerate([5, 7, 8, 9, 11, 13, 14, 30, 60, 1])}
    rows = []
    for i in range(300):
        w = [f"t{rng.randrange(2000)}" for _ in range(rng.randrange(80))]
        item = items[rng.randrange(10)]
        a = rng.randrange(len(item))
        part = list(item[a : a + rng.randrange(5, 40)] if rng.random() < 0.5 else item)
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = f"s{rng.randrange(99)}"
        at = rng.randrange(len(w) + 1)
        rows.append((i, w[:at] + part + w[at:]))

    def windows(w, item):
        n = min(13, len(item))
        need = n - (n // 5 if n >= 8 else 0)
        out = []
        for a in range(len(w) - n + 1):
            for b in range(len(item) - n + 1):
                same = sum(x == y for x, y in zip(w[a : a + n], item[b : b + n], strict=True))
                if same >= need:
                    out.append((a, same))
        return out

    expected = {}
    for i, w in rows:
        for k, item in items.items():
            if found := windows(w, item):
                expected[i, k] = (min(found)[0], max(s for _, s in found), len(found))
    docs = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["matched"], r["n_windows"]) for r in decontaminate.contaminations(docs, bench).collect()}
    assert got == expected and len({i for i, _ in expected}) > 100
    left = {r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in expected}


def test_contaminations_of_repeated_rows_and_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 20)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    text = " ".join(f"w{k}" for k in range(120))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text[:300]), (3, "else")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text), (7, text), (8, text), (None, text), (9, None)], "item_id long, text string")
    rows = [tuple(r) for r in decontaminate.contaminations(docs, bench).where("doc_id is null or doc_id = 1").collect()]
    expected = [(d, i, 0, 13, 108) for d in (1, 1, None) for i in (7, 7, 8, None)]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    assert [r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()] == [3]


def test_contaminations_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    items = [(i, " ".join(f"b{i}x{k}" for k in range(15))) for i in range(10)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminations(bench.withColumnRenamed("item_id", "doc_id"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(10)}


def test_scores_by_partial_matching(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 300)
    monkeypatch.setattr(ppm, "SHARD_BYTES", 500)
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["The", "cat", "ca", "é", "tac", "X1"]) for _ in range(rng.randrange(30)))) for i in range(60)]
    held = {i for i, _ in docs if i % 5 == 0}
    follows, words, total = collections.defaultdict(collections.Counter), collections.Counter(), 0
    low = lambda t: t.encode().lower()
    symbols = lambda t: [257] * ppm.ORDER + list(low(t)) + [256]
    for i, t in docs:
        if i not in held:
            s = symbols(t)
            for p in range(ppm.ORDER, len(s)):
                for k in range(ppm.ORDER + 1):
                    follows[tuple(s[p - k : p])][s[p]] += 1
            words.update([*low(t).split(), None])
            total += len(low(t).split()) + 1

    def score(t):
        out, s = 0.0, symbols(t)
        for p in range(ppm.ORDER, len(s)):
            gone = set()
            for k in range(ppm.ORDER, -1, -1):
                left = {a: n for a, n in follows.get(tuple(s[p - k : p]), {}).items() if a not in gone}
                if not left:
                    continue
                weight = sum(left.values()) + len(left)
                if s[p] in left:
                    out += math.log10(left[s[p]] / weight)
                    break
                out += math.log10(len(left) / weight)
                gone |= set(left)
            else:
                out -= math.log10(257 - len(gone))
        return out

    df = spark.createDataFrame([(i, t, i in held) for i, t in docs], "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r for r in ppm.scored(df).collect()}
    for i, t in docs:
        tokens = [*low(t).split(), None]
        base = sum(math.log10((words[x] + 1) / (total + len(words) + 1)) for x in tokens)
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(tokens), sum(words[x] > 0 for x in tokens))
        assert got[i]["train_tokens"] == total and got[i]["base_score"] == pytest.approx(base, rel=1e-9)
        assert got[i]["score"] == pytest.approx(score(t), rel=1e-5)


def test_probabilities_add_up():
    """Over all bytes and the end, after a context that was seen."""
    chunk = next(chunks(pa.array(["abracadabra", "abcab", "bra"])))
    codes = np.concatenate([c for c, _ in ppm.grams(chunk)])
    keys, counts = np.unique(codes, return_counts=True)
    pairs = np.bincount((codes >> 9 & 511) * ppm.SYMBOLS + (codes & 511), minlength=ppm.SYMBOLS**2)
    for context in np.unique(keys >> 9)[::3]:
        every = (context << 9) | np.arange(257)
        both, sums = ppm.summed([keys, every], [counts, np.zeros(257, np.int64)])
        values = ppm.code_lengths(both, sums, pairs)
        assert (10 ** values[np.searchsorted(both, every)]).sum() == pytest.approx(1, abs=1e-9)


def test_positives_and_unlabelled():
    """Held-out rows of two overlapping classes, with four fifths of the unlabelled rows good."""
    rng = np.random.default_rng(9)
    draw = lambda n, good: rng.normal(1.5 if good else -1.5, 1, (n, 3))
    model = quality.fit(draw(2000, True), np.concatenate([draw(4000, True), draw(1000, False)]), 0.8)
    good, bad = model.scores(draw(2000, True)), model.scores(draw(2000, False))
    assert (good >= 0.5).mean() > 0.97 and (bad >= 0.5).mean() < 0.2


def test_field_finds_what_patterns_miss(spark):
    rng = random.Random(11)
    plain = lambda n: " ".join(f"{rng.choice('abcde')}{rng.choice('lmnop')}er" for _ in range(n))
    code = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [f'{plain(30)} token = "{code()}" {plain(30)}' if k % 3 == 0 else plain(60) for k in range(300)]
    model = secrets.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    new = [f'{plain(20).upper()} TOKEN!! =!! "{code().upper()}"!! {plain(20)}', plain(80), f"é\n token: {code()}"]
    rows = secrets.secret_spans(spark.createDataFrame(list(enumerate(new)), "doc_id long, text string"), model).collect()
    found = {r["doc_id"]: [(s["kind"], new[r["doc_id"]][s["start"] : s["end"]]) for s in r["spans"]] for r in rows}
    assert [k for k, _ in found[0]] == ["field"] and found[0][0][1] in new[0] and len(found[0][0][1]) == 40
    assert found[1] == [] and [k for k, _ in found[2]] == ["assign", "hex"]


def test_examples_are_drawn_from_the_whole_table(spark, monkeypatch):
    """Ordinary text of the second half, which looks otherwise, is fitted in its share."""
    fitted = []
    monkeypatch.setattr(secrets, "fit", lambda examples: fitted.append(examples))
    monkeypatch.setattr(secrets, "PLAIN_EXAMPLES", 60)
    monkeypatch.setattr(secrets, "SECRET_EXAMPLES", 10)
    letters = [(i, "abcd efgh " * 400 + ' token = "qwertyuiop"') for i in range(150)]
    digits = [(i, "1234 5678 " * 400) for i in range(150, 300)]
    kind = "doc_id long, text string"
    secrets.train(spark.createDataFrame(letters, kind))
    secrets.train(spark.createDataFrame(letters + digits, kind))
    known = {tuple(row) for seen, _ in fitted[0] for row in seen.tolist()}
    plain = [seen.tolist() for seen, tags in fitted[1] if not tags.any()]
    other = sum(any(tuple(row) not in known for row in seen) for seen in plain)
    assert len(plain) == 60 and 15 <= other <= 45
    assert sum(bool(tags.any()) for _, tags in fitted[1]) == 10


def test_best_tags_are_best():
    """Decoding only the open stretches gives the same as all sequences tried."""
    import itertools

    rng = np.random.default_rng(12)
    model = secrets.Field([rng.normal(0, 2, (n, 3)) for n in secrets._TABLES], rng.normal(0, 0.5, (3, 3)))
    model.tables[0][:, 0] += 4
    for _ in range(20):
        seen = np.column_stack([rng.integers(0, n, 7) for n in secrets._TABLES])
        weight = model.weights(seen)

        def total(tags, weight=weight):
            path = [0, *tags, 0]
            return sum(weight[i, t] for i, t in enumerate(tags)) + sum(model.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(3), repeat=7), key=total)
        assert total(model.tags(seen, np.zeros(7, np.int64)).tolist()) == pytest.approx(total(best))


def _record(page, payload):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n%s" % (len(payload), payload)
    import base64
    import hashlib

    digest = base64.b32encode(hashlib.sha1(block).digest())
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nWARC-Block-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n"
    return head % (page, digest, len(block)) + block + b"\r\n\r\n"


def _ids(pieces):
    return [p.problem or int(p.headers["warc-record-id"][10:-1]) for p in pieces]


def test_salvage_plain():
    parts = [_record(i, b"<p>%d WARC/1.1\r\n</p>" % i * 20) for i in range(5)]
    whole = b"".join(parts)
    assert _ids(warc.salvage(whole)) == [0, 1, 2, 3, 4]
    flipped = bytearray(whole)
    flipped[len(parts[0]) + len(parts[1]) - 30] ^= 1
    pieces = list(warc.salvage(bytes(flipped)))
    assert _ids(pieces) == [0, "block digest differs", 2, 3, 4]
    assert (pieces[1].offset, pieces[1].length) == (len(parts[0]), len(parts[1]))
    cut = parts[0] + parts[1][:-40] + parts[2] + b"junk" + parts[3] + parts[4][:50]
    pieces = list(warc.salvage(cut))
    assert [i for i in _ids(pieces) if isinstance(i, int)] == [0, 2, 3]
    assert sum(p.length for p in pieces) == len(cut) and all(a.offset + a.length == b.offset for a, b in zip(pieces, pieces[1:]))
    assert list(warc.salvage(b"")) == [] and _ids(warc.salvage(b"nothing here")) == ["no version line"]


def test_salvage_members():
    parts = [gzip.compress(_record(i, b"x" * 50 * i), mtime=0) for i in range(5)]
    assert _ids(warc.salvage(b"".join(parts))) == [0, 1, 2, 3, 4]
    broken = bytearray(b"".join(parts))
    broken[len(parts[0]) + 20] ^= 255
    pieces = list(warc.salvage(bytes(broken)))
    assert [i for i in _ids(pieces) if isinstance(i, int)] == [0, 2, 3, 4]
    assert (pieces[1].offset, pieces[1].length) == (len(parts[0]), len(parts[1]))
    assert _ids(warc.salvage(b"zz" + parts[1] + parts[2][:-5]))[1] == 1


def test_salvage_inside_a_member():
    rng = random.Random(3)
    noise = [bytes(rng.randrange(32, 127) for _ in range(3000)) for _ in range(6)]
    one = gzip.compress(b"".join(_record(i, n) for i, n in enumerate(noise)), mtime=0)
    assert _ids(warc.salvage(one)) == list(range(6))
    broken = bytearray(one + gzip.compress(_record(9, b"after")))
    broken[len(one) * 2 // 3] ^= 255
    pieces = list(warc.salvage(bytes(broken)))
    ids = [i for i in _ids(pieces) if isinstance(i, int)]
    assert ids[:3] == [0, 1, 2] and ids[-1] == 9
    assert sum(p.length for p in pieces) == len(broken)


def _bare(page, payload):
    """A record without digests."""
    return b"WARC/1.0\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (page, len(payload), payload)


def test_salvage_keeps_records_without_digests():
    bad = _record(2, b"two").replace(b"two", b"too")
    inside = _bare(0, b"a") + _bare(1, b"b") + bad + _bare(3, b"d")
    data = gzip.compress(inside, mtime=0) + gzip.compress(_bare(4, b"e"), mtime=0)
    pieces = list(warc.salvage(data))
    assert [i for i in _ids(pieces) if isinstance(i, int)] == [0, 1, 3, 4]
    assert [p.problem for p in pieces if p.problem] == ["block digest differs"]
    assert sum(p.length for p in pieces) == len(data) and not any("salvaged" in (p.headers or {}) for p in pieces)
    broken = bytearray(gzip.compress(_bare(0, b"a") + _record(1, b"b") + _bare(2, b"c" * 50_000), mtime=0))
    broken[-6] ^= 1  # the checksum
    pieces = [p for p in warc.salvage(bytes(broken)) if not p.problem]
    assert [p.headers.get("salvaged") for p in pieces] == ["unverified", None, "unverified"] and _ids(pieces) == [0, 1, 2]


def test_salvage_up_to_the_fault():
    rng = random.Random(4)
    noise = [bytes(rng.randrange(256) for _ in range(400)) for _ in range(9)]
    packer = zlib.compressobj(wbits=31)
    parts = [packer.compress(_bare(i, n)) + packer.flush(zlib.Z_FULL_FLUSH) for i, n in enumerate(noise)]
    at = sum(map(len, parts[:7]))
    data = b"".join(parts)[:at] + b"\xff" + b"".join(parts)[at + 1 :] + packer.flush()  # a block of no kind
    assert [i for i in _ids(warc.salvage(data)) if isinstance(i, int)] == list(range(7))


def test_archives_lose_the_damaged_record_only(spark, tmp_path):
    pages = [(i, f"http://{i}", f"<p>{i}</p>" * (i % 7 + 1)) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.as_records(df).coalesce(1), str(tmp_path / "a"))
    (file,) = (tmp_path / "a").glob("part-*")
    data = bytearray(file.read_bytes())
    pieces = list(warc.salvage(bytes(data)))
    assert sorted(_ids(pieces)) == list(range(40)) and sum(p.length for p in pieces) == len(data)
    assert gzip.decompress(data) == b"".join(gzip.decompress(data[p.offset : p.offset + p.length]) for p in pieces)
    hit = pieces[11]
    data[hit.offset + 10] = 255  # a deflate block of no kind
    lost = set(range(40)) - set(_ids(warc.salvage(bytes(data))))
    assert lost == {int(hit.headers["warc-record-id"][10:-1])}


def test_archives_of_large_records(spark, tmp_path):
    pages = [(1, "u", "a" * (17 << 20)), (2, "u", "b")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archives(warc.as_records(df).coalesce(1).sortWithinPartitions("record"), str(tmp_path / "a"))
    rows = warc.read_archives(spark, str(tmp_path / "a"), blocks=False)
    assert rows.filter("problem is not null").count() == 0
    assert sorted((r["page_id"], r["payload_bytes"]) for r in warc.pages_of(rows).collect()) == [(1, 17 << 20), (2, 1)]


def test_read_damaged_files(spark, tmp_path):
    (tmp_path / "a").write_bytes(_record(1, b"one") + b"?" + _record(2, b"two"))
    (tmp_path / "b.gz").write_bytes(gzip.compress(_record(3, b"three")))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(len(r["block"]) for r in rows if r["problem"] is None) == [41, 41, 43]
    assert [(r["offset"], r["length"]) for r in rows if r["problem"]] == [(len(_record(1, b"one")), 1)]


def test_repeats_of_rows_without_an_id(spark):
    """Two texts of different lengths whose 32 bit hashes are equal, and a passage of each in a row with an id."""
    seen, pair = {}, None
    for n in range(0, 400_000, 20_000):
        df = spark.range(n, n + 20_000).selectExpr("id", "repeat(concat('w', id, ' '), 60 + cast(id % 50 as int)) AS text")
        for r in df.selectExpr("id", "hash(text) AS h", "text").toPandas().itertuples():
            if r.h in seen and len(seen[r.h].split()) != len(r.text.split()):
                pair = seen[r.h], r.text
            seen[r.h] = r.text
        if pair:
            break
    rows = [(1, pair[0]), (2, pair[1]), (None, pair[0]), (None, pair[1] + "end")] + [(None, t) for t in pair]
    got = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, len(t.split()), len(t.split())) for t in pair] * 2
    want[1] = (None, len(pair[1].split()) + 1, len(pair[1].split()))
    want += [(i + 1, len(t.split()), 0) for i, t in enumerate(pair)]
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == sorted((str(a), b, c) for a, b, c in want)


def test_near_duplicates_without_ids(spark):
    """5,000 rows without an id, every two of them near duplicates: time in proportion to rows."""
    rng = random.Random(5)
    rows = []
    for _ in range(2500):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        rows += [(None, " ".join(words)), (None, " ".join([*words, "more"]))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5000 and all(r["component_id"] is None and r["kept"] for r in got)
    assert minhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2500


@pytest.mark.parametrize("percent", [60, 50])
def test_near_duplicates_at_low_thresholds(spark, percent):
    rng = random.Random(percent)
    rows = []
    for n in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        rows.append((2 * n, " ".join(words)))
        rows.append((2 * n + 1, " ".join(words[: rng.randrange(20, 80)] + [f"x{n}"])))
    sets = [frozenset(zip(*(t.split()[i:] for i in range(5)), strict=False)) for _, t in rows]
    want = {2 * n + 1: 2 * n if 100 * len(a & b) >= percent * len(a | b) else 2 * n + 1 for n, (a, b) in enumerate(zip(sets[::2], sets[1::2], strict=True))}
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] % 2} == want and len(set(want.values()) & set(want)) not in (0, 60)


def test_bands_and_places_follow_the_threshold():
    assert [minhash.rows_of_band(p) for p in (85, 80, 60, 50, 30)] == [4, 4, 2, 2, 1]
    assert minhash.least_agreeing(80) == 58 < minhash.least_agreeing(85) and minhash.least_agreeing(50) < 40
    with pytest.raises(ValueError):
        minhash.rows_of_band(5)
