"""Every operator on a messy table with clashing columns, and on an empty one."""

import hashlib
import re
import zlib

import pytest

from gridspark.llm import decontaminate, fingerprint, minhash, mixing, ppm, quality, secrets, sharding, substrings, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def test_shards(messy, nothing, messy_rows):
    rows = sharding.number_slots(sharding.assign_shards(messy, 5)).collect()
    assert len(rows) == len(messy_rows) and rows[0]["size"] == 7
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    for shard in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    of = {}
    assert all(of.setdefault(r["doc_id"], r["shard"]) == r["shard"] for r in rows)
    assert sharding.number_slots(sharding.assign_shards(nothing, 5)).count() == 0


def test_mix(messy, nothing, messy_rows):
    planned = mixing.plan_mix(messy).collect()
    assert len(planned) == len(messy_rows)
    sources = {r["source"]: r for r in planned}
    assert set(sources) == {"a", "b", "ä", "", None}
    for name, r in sources.items():
        assert r["source_size"] == sum(len(words(t)) for _, t, _, s, *_ in messy_rows if s == name)
        assert r["target"] <= 2 * r["source_size"]
    total = sum(r["source_size"] for r in sources.values())
    assert sum(r["target"] for r in sources.values()) == pytest.approx(1.5 * total)
    assert all(0 <= r["copies"] <= 2 for r in planned)
    mixed = mixing.mix(messy)
    assert mixed.columns == messy.columns and mixed.count() == sum(r["copies"] for r in planned)
    assert mixing.plan_mix(nothing).count() == 0


def test_substrings(messy, nothing, messy_rows):
    rows = substrings.without_repeats(messy).collect()
    assert len(rows) == len(messy_rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] not in (8, None)}
    assert by_id[1]["n_removed"] == 0 and by_id[3]["n_removed"] == 160 and by_id[3]["kept"] == ""
    assert by_id[2]["n_removed"] == 159 and by_id[2]["kept"] == "changed"  # windows on either side of the change
    assert sorted(r["n_removed"] for r in rows if r["doc_id"] == 8) == [0, 70]
    assert by_id[9]["n_words"] == 20_000 and by_id[4]["kept"] == "" and by_id[6]["n_words"] == 0
    assert substrings.without_repeats(nothing).count() == 0


def test_near_duplicates(messy, nothing, messy_rows):
    rows = minhash.near_duplicates(messy).collect()
    assert len(rows) == len(messy_rows)
    of = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert of[2, 156] == of[3, 156] == 1 and of[4, 0] == 4 and of[None, 0] is None
    assert {r["component_id"] for r in rows if r["n_shingles"] == 1} == {7, 10, 11}  # the text without an id is that of 7
    kept = minhash.representatives(messy)
    assert kept.columns == messy.columns
    ids = sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect())
    assert ids == sorted([1, 4, 5, 6, 7, 0, 8, 8, 9, 10, -4, 11, 12])
    assert minhash.near_duplicates(nothing).count() == 0 and minhash.representatives(nothing).count() == 0


def test_contaminations(spark, messy, nothing, messy_rows):
    item = " ".join(words(messy_rows[0][1])[30:60]).upper()
    items = [(1, item), (1, None), (None, ""), (2, "short text"), (3, "not there at all, in any of the texts that are here now")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contaminations(messy, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in rows) == [(0, 2), (1, 1), (2, 1), (3, 1), (3, 1), (7, 2), (8, 1)]
    left = decontaminate.decontaminated(messy, bench)
    assert left.columns == messy.columns and left.count() == len(messy_rows) - 7
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminations(messy, empty).count() == 0
    assert decontaminate.decontaminated(nothing, bench).count() == 0


def test_quality(spark, messy, nothing, messy_rows):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(1, 9)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(messy, labels)
    rows = quality.scored(messy, model).collect()
    assert len(rows) == len(messy_rows) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1  # null as empty
    assert quality.accepted(messy, model).columns == messy.columns
    blank = quality.train(nothing, labels.limit(0))
    assert quality.scored(nothing, blank).count() == 0 and quality.scored(messy, blank).count() == len(messy_rows)


def test_scores(messy, nothing, messy_rows):
    rows = ppm.scored(messy).collect()
    assert len(rows) == len(messy_rows) and all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    assert rows[0]["train_tokens"] == sum(len(words(t)) + 1 for _, t, *_ in messy_rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == 1 and by_id[4]["score"] == by_id[5]["score"]
    assert ppm.scored(nothing).count() == 0


def test_secrets(messy, nothing, messy_rows):
    model = secrets.train(messy)
    rows = secrets.secret_spans(messy, model).collect()
    assert len(rows) == len(messy_rows)
    spans = {r["doc_id"]: [(s["kind"], s["end"] - s["start"]) for s in r["spans"]] for r in rows}
    assert ("assign", 50) in [(k, n + 1) for k, n in spans[12]] or spans[12][0][0] == "assign"
    assert ("hex", 40) in spans[12] and spans[4] == [] and spans[5] == []
    assert secrets.secret_spans(nothing, secrets.train(nothing)).count() == 0


def test_fingerprints(messy, nothing, messy_rows):
    rows = fingerprint.edited_pairs(messy).collect()
    assert len(rows) == len(messy_rows)
    texts = {}
    for i, t, *_ in messy_rows:
        texts[i] = min(t or "", texts.get(i, t or ""))
    ids = sorted((i for i in texts if i is not None), reverse=True) + [None]
    edits = set()
    for i, t, *_ in messy_rows:
        after, own = texts[ids[(ids.index(i) + 1) % len(ids)]], t or ""
        edited = own[: len(own) - len(own) // 3] + after[: len(own) // 3]
        edits.add((i, len(own), hashlib.sha256(edited.encode()).hexdigest()))
    assert {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows} == edits
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[3]["fingerprint"] and by_id[5]["fingerprint"] == ""
    assert by_id[1]["near_edited"] > 0.5 and by_id[9]["near_next"] == 0
    assert fingerprint.edited_pairs(nothing).count() == 0
    anchors = fingerprint.fingerprints(messy).filter("doc_id = 1").first()["anchors"]
    assert "".join(f"{a['anchor'] & 0xFFFFFFFF:08x}" for a in anchors) == by_id[1]["fingerprint"]


def test_archives(spark, tmp_path):
    pages = [(1, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "u", "<p>é</p>"), (3, "x\r\ny", None), (4, "z", ""), (None, "n", "WARC/1.1\r\n\r\n"), (None, None, None)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    warc.write_archives(warc.as_records(df), str(tmp_path / "a"))
    rows = warc.pages_of(warc.read_archives(spark, str(tmp_path / "a"), blocks=False)).collect()
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in rows)
    assert got == [(0, 0, "revisit", 4), (0, 12, "response", 0), (1, 9, "revisit", 2), (2, 9, "response", 0), (2, 9, "response", 0), (3, 0, "revisit", 4), (4, 0, "response", 0)]
    warc.write_archives(warc.as_records(df.limit(0)), str(tmp_path / "b"), "none")
    assert warc.pages_of(warc.read_archives(spark, str(tmp_path / "b"))).count() == 0


def test_crc_of_ids(messy):
    from gridspark.llm.shared import crc_of_id

    for r in messy.select("doc_id", crc_of_id(messy["doc_id"]).alias("c")).collect():
        assert r["c"] == zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode())


def test_rows_of_one_id_are_dealt_out_by_their_texts(spark):
    """Many rows without an id: no piece of a shard holds most of them, and the mix draws them one by one."""
    rows = spark.range(4000).selectExpr("CAST(NULL AS LONG) doc_id", "concat('word number ', id) text", "IF(id < 3000, 'a', 'b') source")
    numbered = sharding.number_slots(sharding.assign_shards(rows, 5), ties=("text",)).collect()
    assert len({r["shard"] for r in numbered}) == 1 and sorted(r["slot"] for r in numbered) == list(range(4000))
    first = {r["text"]: r["slot"] for r in numbered}
    again = sharding.number_slots(sharding.assign_shards(rows.repartition(7), 5), ties=("text",)).collect()
    assert {r["text"]: r["slot"] for r in again} == first
    planned = mixing.plan_mix(rows, weights=(1.0,), share=1.5).groupBy("source", "target").agg({"copies": "sum"}).collect()
    assert all(abs(3 * r["sum(copies)"] - r["target"]) < 0.1 * r["target"] for r in planned)


def test_quality_sample_is_bounded(spark, monkeypatch):
    """Rows that share one id do not come to the driver beyond the bound."""
    monkeypatch.setattr(quality, "POSITIVES", 40)
    monkeypatch.setattr(quality, "UNLABELLED", 60)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u, prior: seen.append((len(p), len(u), prior)))
    docs = spark.range(1000).selectExpr("IF(id % 3 = 0, 1, id) doc_id", "concat('text ', id) text")
    labels = spark.range(1000).selectExpr("id doc_id", "CAST(id % 2 AS INT) quality")
    quality.train(docs, labels)
    assert seen[0][0] <= 40 and 30 <= seen[0][1] <= 60 and 0 < seen[0][2] < 1
