"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import struct
import tracemalloc
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import bpe, chat, langid, lines, media, mixing, quality, simhash, substring, topk
from parley.llm.common import connected_components, scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string, rate string, score string, fp string, row string, __source int"
LONG = " ".join(f"w{i}" for i in range(3000))
ROWS = [
    (1, "one two three four five. Six", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "de", "b", 4),
    (5, LONG, "en", "b", 9),
    (5, LONG, "en", "b", 9),
    (None, "no id at all here", "de", None, 7),
    (6, "Ünïcödé \U0001f600 text\x00 here's 12", "de", "c", 3),
    (7, "one two three four five. Six", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "f", "r", 1) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_lines(docs, none):
    out = lines.deduplicate(docs).collect()
    assert len(out) == len(ROWS) and lines.deduplicate(docs).columns == docs.columns
    by = {(r["doc_id"], r["source"]): r["text"] for r in out}
    assert by[(1, "a")] == ROWS[0][1] and by[(7, "a")] == "" and by[(2, None)] is None and by[(4, "b")] == " \n\t "
    assert [r["text"] for r in out if r["doc_id"] == 5] == [LONG, LONG]
    assert lines.deduplicate(none).count() == 0


def test_media(spark, docs, none):
    path = scratch_path(spark, "test-media")
    media.store(docs, path)
    out = media.describe(media.load(spark, path)).collect()
    want = sorted((hashlib.sha256(media.pad((r[1] or "").encode())).hexdigest(), len((r[1] or "").encode())) for r in ROWS)
    assert sorted((r["payload_sha256"], r["n_bytes"]) for r in out) == want
    assert {r["payload_bytes"] % 192 for r in out} == {0} and min(r["payload_bytes"] for r in out) == 192
    again = scratch_path(spark, "test-media")
    media.store(none, again)
    assert media.load(spark, again).count() == 0


def test_media_retries_members_alone(spark, docs, tmp_path, monkeypatch):
    media.store(docs.where("doc_id = 1 or doc_id = 6").coalesce(1), str(tmp_path))
    (archive,) = tmp_path.glob("*.zip")
    raw = bytearray(archive.read_bytes())
    raw[raw.find(b"IDAT")] ^= 1  # the first member is damaged
    archive.write_bytes(raw)
    out = media.load(spark, str(tmp_path), on_error="row").collect()
    assert [r["error"] is None for r in sorted(out, key=lambda r: r["offset"])] == [False, True]
    with pytest.raises(Exception, match="checksum"):
        media.load(spark, str(tmp_path)).collect()
    ranges = media.ArchiveSource(str(tmp_path), 100, "row").partitions()
    assert len(ranges) > 2
    monkeypatch.setattr(media, "WAIT_S", 0)
    reader = media.ArchiveSource(str(tmp_path), 100, "row")
    assert sum(b.num_rows for p in ranges for b in reader.read(p)) == 2


def test_chat(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (3, 5, "user", "q"), (3, 6, "assistant", "a"), (4, 0, None, None), (None, 0, "user", "x"), (1, 1, "assistant", "a"), (5, 0, "user", "qassistant")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, body string")
    out = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert sorted(out) == [1, 4, 5]  # 2 is a prefix of 1, and 3 equals it
    assert out[1]["rendered"] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n" and out[1]["n_turns"] == 2
    assert chat.format_chats(df.limit(0)).count() == 0
    assert chat.format_chats(df, add_prompt=True).where("conv_id = 1").first()["rendered"].endswith("<|im_start|>assistant\n")


def test_langid(spark, docs, none):
    model = langid.fit(docs)
    assert set(model) == {"en", "de"}
    out = langid.predict(docs, model).collect()
    assert len(out) == len(ROWS)
    for r in out:
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert langid.fit(none) == {}
    assert {r["lang_pred"] for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(none, model).count() == 0


def test_quality(spark, docs, none):
    found = quality.features(docs)
    assert quality.fit(found.limit(0).withColumn("label", F.lit(1))).means == []
    model = quality.fit(found.withColumn("label", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(2))))
    out = quality.score(found, model).collect()
    assert len(out) == len(ROWS) and all(0 < r["score"] < 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 7)}) == 1
    assert quality.score(quality.features(none), model).count() == 0


def test_simhash(docs, none):
    out = simhash.components(docs).collect()
    assert len(out) == len(ROWS)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["component_id"] == by[7]["component_id"] == 1
    assert {by[i]["fingerprint"] for i in (2, 3, 4)} == {"0" * 16} and {by[i]["component_id"] for i in (2, 3, 4)} == {2}
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "5", "6", "None"]
    assert simhash.components(none).count() == 0


def test_substring(docs, none):
    out = substring.deduplicate(docs).collect()
    assert len(out) == len(ROWS) and all(r["n_removed"] == 0 for r in out)  # rows of one id don't count against each other
    assert {r["doc_id"]: r["n_words"] for r in out}[5] == 3000 and {r["doc_id"]: r["n_words"] for r in out}[2] == 0
    assert substring.deduplicate(none).count() == 0


def test_topk(spark):
    v = [1.0, 0.5]
    rows = [(0, v), (1, v), (2, v), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [-1.0, 0.0]), (None, v), (1, v), (7, []), (8, [1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    out = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert out == [(0, 1, 1, 81920), (0, 2, 1, 81920), (0, 3, 2, 81920), (0, 4, 6, -65536)]  # each row is a candidate
    again = [(r["query_id"], r["rank"], r["vec_id"]) for r in topk.search(df, df.where("vec_id in (1, 7, 8)")).collect()]
    assert sorted(again) == sorted(2 * [(1, 1, 0), (1, 2, 2), (1, 3, 6)])  # each row of an id is a query
    empty = spark.createDataFrame([(1, []), (2, []), (3, None)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.search(empty, empty.where("vec_id = 1")).collect()] == [(1, 1, 2, 0)]
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0


def test_mixing(docs, none):
    out = mixing.mix(docs)
    assert set(out.columns) == set(docs.columns)  # copy and rate are replaced
    assert mixing.mix(none).count() == 0
    only = mixing.mix(docs, weights={"a": 1.0}, default_weight=0.0)
    assert {r["source"] for r in only.collect()} <= {"a"}
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix(docs).collect()))
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": -1.0})


def test_bpe_cache_without_objects():
    n = 20_000
    words, ids = pa.array([f"w{i}".encode() for i in range(n)], pa.binary()), pa.array([[i, i + 1] for i in range(n)], pa.list_(pa.int32()))
    bpe.Cache(words.slice(0, 10), ids.slice(0, 10))
    tracemalloc.start()
    cache = bpe.Cache(words.slice(5), ids.slice(5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * n
    assert cache.find([b"w4", b"w5", b"w19999", b"x"]) == [None, struct.pack("<2I", 5, 6), struct.pack("<2I", 19999, 20000), None]
    assert bpe.Cache().find([b"x"]) == [None]


def test_bpe(docs, none):
    t = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = bpe.encode(docs, t)
    back = {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode(out, t).collect()}
    assert back == {r[0]: (r[1] or "").encode() for r in ROWS}
    assert out.count() == len(ROWS) and bpe.encode(none, t).count() == 0
    assert bpe.round_trip(docs, t, with_ids=True, cache_words=0).where("n_tokens <> size(ids)").count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (100, 100), (None, 3), (200, 201), (202, 201)]
    out = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_png_and_tail():
    for n in (0, 1, 192, 193, 50_000):
        payload = media.pad((b"x\xff\x00" * n)[:n])
        assert media.decode_png(media.encode_png(payload)) == payload and len(payload) % 192 == 0 and zlib.crc32(payload[-16:]) >= 0
