"""The Jaccard join, spelling forms and the prefix trie against brute force, on messy and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridspark.llm import jaccard, prefix_trie, spelling

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return (text or "").encode().lower().decode()


def shingle_set(text, k):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components_of(rows, k, percent):
    """By comparing all pairs."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return sorted(((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


@pytest.fixture(scope="module")
def texts():
    """Short and long texts, copies with a few changes, chains of copies of copies, shared passages, rows without an id."""
    rng = random.Random(11)
    rows, n = [], 0
    for size in (2, 3, 5, 9, 12, 15, 18, 21, 22, 25, 40, 60, 120, 300):
        for _ in range(3):
            text = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for _ in range(rng.randrange(2, 7)):
                rows.append((n if n % 9 else None, " ".join(text)))
                n += 1
                text = list(text)
                if rng.random() < 0.8:
                    text[rng.choice([0, -1, rng.randrange(len(text))])] = f"n{n}"
                if rng.random() < 0.3:
                    text = text[: max(1, len(text) - rng.randrange(3))]
    passage = [f"p{i}" for i in range(60)]
    for i in range(40):
        rows.append((1000 + i, " ".join(passage + [f"o{i}-{j}" for j in range(4 + i % 3)])))
        rows.append((2000 + i, " ".join(passage + [f"q{i}-{j}" for j in range(90)])))
    return rows + rows[:4]


@pytest.mark.parametrize("members,light", [(300, None), (2000, 25)])
def test_jaccard_components(spark, texts, monkeypatch, members, light):
    monkeypatch.setattr(jaccard, "FAMILY_MEMBERS", members)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = jaccard.jaccard_components(df, light=light).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components_of(texts, 3, 90)


def test_jaccard_at_another_threshold(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = jaccard.jaccard_components(df, words=2, percent=70).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components_of(texts, 2, 70)


def test_jaccard_on_messy_rows(messy, nothing, messy_rows):
    got = sorted((tuple(r) for r in jaccard.jaccard_components(messy).collect()), key=repr)
    assert got == components_of([r[:2] for r in messy_rows], 3, 90)
    assert jaccard.jaccard_components(nothing).count() == 0


def test_boundary_and_subsets():
    assert jaccard.subset_sizes(10, 90) == [9, 10] and jaccard.light_cost(10, 90) == 11
    assert 15 <= jaccard.boundary({n: 10 for n in range(1, 60)}, 90) < 25
    assert jaccard.boundary({}, 90) == 0
    rng = np.random.default_rng(2)
    for _ in range(400):
        size, percent = int(rng.integers(2, 260)), int(rng.choice([60, 80, 90]))
        pool = rng.integers(1, 1 << 63, size + 60, dtype=np.uint64)
        a = np.unique(pool[:size])
        b = np.unique(np.concatenate([a[int(rng.integers(0, size // 8 + 1)) :], pool[size : size + int(rng.integers(0, size // 8 + 1))]]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard.part_keys(a, percent), jaccard.part_keys(b, percent)))
            ranks = np.zeros(1 << jaccard.COUNTER_BITS, np.uint8)
            assert len(np.intersect1d(*(jaccard.list_keys(s, ranks, percent, 0) for s in (a, b))))


def test_shared_passages_make_no_families(spark, monkeypatch):
    """Texts made of passages that others have too; only near copies are fetched to be compared."""
    rng = random.Random(3)
    passages = [" ".join(f"p{i}-{j}" for j in range(25)) for i in range(320)]
    rows = [(i, " ".join(rng.sample(passages, 8))) for i in range(80)]
    rows += [(100 + i, rows[i][1] + " more") for i in range(3)]
    held, real = [], jaccard.written

    def written(df, name):
        out = real(df, name)
        if name == "held":
            held.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", written)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == components_of(rows, 3, 90)
    assert 6 <= held[0] < 12


def test_sets_without_a_common_member_share_no_part():
    rng = np.random.default_rng(4)
    keys = [jaccard.part_keys(np.unique(rng.integers(1, 1 << 63, 70, dtype=np.uint64)), 90) for _ in range(20_000)]
    _, often = np.unique(np.concatenate([np.unique(k) for k in keys]), return_counts=True)
    assert (often[often > 1]).sum() < 10


def test_large_families_by_every_path(spark, texts, monkeypatch):
    """Whatever pivots leave, at once or narrowed by lists first."""
    monkeypatch.setattr(jaccard, "FAMILY_MEMBERS", 300)
    want = components_of(texts, 3, 90)
    for tasks in (0, 10_000):
        monkeypatch.setattr(jaccard, "REST_TASKS", tasks)
        got = jaccard.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms_of(counts, ratio=10):
    out, form = {}, {}
    for word, n in counts.items():
        others = sorted((-m, w) for w, m in counts.items() if near(word, w))
        best = others[0] if others and -others[0][0] >= ratio * n else (None, None)
        form[word] = best[1]
        out[word] = [best[1], None, n, len(others), None if best[0] is None else -best[0]]
    for word in out:
        root = word
        while form[root]:
            root = form[root]
        out[word][1] = root
    return {w: tuple(v) for w, v in out.items()}


@pytest.mark.parametrize("part", [4096, 5])
def test_spelling_forms(spark, monkeypatch, part):
    monkeypatch.setattr(spelling, "INDEX_WORDS", part)
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(7, 11))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaaaa", "aaaaaaa"]
    counts = {}
    for word in base:
        counts[word] = rng.choice([3, 40, 500, 500, 6000])
        for _ in range(6):
            at, letter = rng.randrange(len(word) + 1), rng.choice("abcdé")
            made = rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])
            if len(made) >= 7:
                counts.setdefault(made, rng.choice([2, 3, 40]))
    counts |= {"bcdbcdb": 3, "bcdbcdbb": 60, "bcdbcdbbb": 900}  # a form of a form
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_forms(df).collect()}
    assert got == forms_of(counts) and any(v[0] and v[1] != v[0] for v in got.values())


def test_words_of_messy_rows(spark, messy, nothing, messy_rows):
    texts = [*messy_rows, (31, "Straße×École Ābcdefghij ENDLESSLY endlessly ENDLESSLy"), (None, "endlessly ")]
    df = messy.unionByName(spark.createDataFrame([t[:2] for t in texts[-2:]], "doc_id long, text string"), allowMissingColumns=True)
    want = Counter()
    for doc_id, text, *_ in texts:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 3 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    got = {r["word"]: r["n"] for r in spelling.word_counts(df, misspelt=3).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2} and got
    assert spelling.spelling_forms(spelling.word_counts(nothing)).count() == 0


def trie_of(sequences):
    """Members of every prefix, and all the rest from them. ``sequences``: turns by conversation."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * (len(WORD.findall(q[-1][1])) if q else 0) for q in below)
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p],
                    sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def sequences_of(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), told, (role, text)))
    return {c: [x[2] for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"turn {rng.randrange(2)}") for c in range(-3, 60) for t in range(rng.randrange(1, 12))]
    rows += [(90 + c, t, "user", f"same {t}" if t < 37 + c else f"other {t}") for c in range(3) for t in range(40)]
    rows += [(5, None, None, None), (5, 2, "user", "again  and again"), (5, 2, "user", "again  and again"), (None, 1, "user", "lost"), (101, 0, None, "")]
    rows += [(1000 + c, 0, "user", "lent by nobody") for c in range(1, 12)]  # some have no turns when rebuilt
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("pieces,chunk", [(1024, 4096), (2, 3)])
def test_trie(spark, monkeypatch, turns, pieces, chunk):
    monkeypatch.setattr(prefix_trie, "PIECE_BLOCKS", pieces)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", chunk)
    df = spark.createDataFrame([(*r, "x", 1) for r in turns], "conv_id long, turn long, role string, text string, digest string, pos int")
    got = sorted((tuple(r) for r in prefix_trie.conversation_trie(df).collect()), key=repr)
    assert got == trie_of(sequences_of(turns))
    assert prefix_trie.conversation_trie(df.limit(0)).count() == 0


def test_rebuilt_conversations(spark, turns):
    own, made = sequences_of(turns), {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = own.get(base, [])[:h] + t[h:]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.ordered(df))).collect()
    assert sorted((tuple(r) for r in got), key=repr) == trie_of(made) and not all(made.values())
