"""Operators whose results SQL can't express, against plain versions written apart from them; and names that clash."""

from __future__ import annotations

import hashlib
import io
import math
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from parley.llm import bpe, chat, langid, lines, media, mixing, quality, queries, simhash, substring, topk
from parley.llm.common import connected_components, scratch_path


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def unsigned(samples: bytes, width: int, height: int) -> bytes:
    """The pixels of unfiltered rows."""
    lines_ = [samples[i * (width + 1) : (i + 1) * (width + 1)] for i in range(height)]
    assert all(x[0] == 0 for x in lines_)
    return b"".join(x[1:] for x in lines_)


def test_stored_form(spark, data, rows):
    """The stored images are read by the PNG layout alone, and give size, digest and payload back."""
    path = scratch_path(spark, "test-stored")
    media.store(spark.read.parquet(f"{data}/documents.parquet"), path)
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.load(spark, path).collect()}
    out = {r["doc_id"]: r for r in queries.op2_media_columns(spark, data).collect()}
    assert len(stored) == len(out) == len(rows)
    for r in rows:
        image, one = io.BytesIO(stored[r["doc_id"]]), out[r["doc_id"]]
        assert image.read(8) == b"\x89PNG\r\n\x1a\n"
        found, body = None, b""
        while found != b"IEND":
            n, found = struct.unpack(">I4s", image.read(8))
            part = image.read(n)
            assert struct.unpack(">I", image.read(4))[0] == zlib.crc32(found + part)
            if found == b"IHDR":
                width, height, depth, colour = struct.unpack(">IIBB", part[:10])
                assert (depth, colour) == (8, 0)
            body += part if found == b"IDAT" else b""
        payload = unsigned(zlib.decompress(body), width, height)
        raw = (r["text"] or "").encode()
        assert payload[: len(raw)] == raw and set(payload[len(raw) :]) <= {32} and len(payload) % 192 == 0
        image = stored[r["doc_id"]]
        assert (one["media_bytes"], one["media_sha256"]) == (len(image), hashlib.sha256(image).hexdigest())
        assert one["payload_sha256"] == hashlib.sha256(payload).hexdigest()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", out[r["doc_id"]]["feature"]) == out[r["doc_id"]]["feature"]
    assert len(set(by_text.values())) > len(by_text) / 2


def test_language_by_plain_compression(docs, rows):
    """A plain loop over blocks and dictionaries, with the dictionary given anew for each block."""
    model = langid.fit(docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2))
    out = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    raw = {lang: zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for lang, d in model.items()}
    for d in raw.values():
        d.precompute_compress(level=langid.LEVEL)
    own = {lang: zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False) for lang, d in raw.items()}
    for r in rows:
        text = (r["text"] or "").lower().encode()
        got = out[r["doc_id"]]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (got["lang_pred"], got["score"], got["accepted"]) == ("und", 0.0, False)
            continue
        sizes = {lang: 0 for lang in model}
        for at in range(0, len(text), 512):
            for lang, coder in own.items():
                sizes[lang] += len(coder.compress(text[at : at + 512]))
        least = min(sizes.values())
        names = [lang for lang in model if sizes[lang] == least]
        assert got["lang_pred"] == names[0]  # ties go to the first
        second = sorted(sizes.values())[1]
        assert got["margin"] == pytest.approx((second - least) / second) and got["accepted"] == (got["margin"] >= 0.01)
        assert got["score"] == pytest.approx(1 / sum(math.exp((least - s) / 8) for s in sizes.values()))


def test_language_ties():
    assert langid.decide(["b", "a", "c"], [5, 5, 9])[0] == "b" and langid.decide(["b", "a"], [5, 5])[2] == 0.0
    assert langid.decide(["b"], [5]) == ("b", 1.0, 1.0)


def plain_statistics(text: str) -> list[float]:
    raw = text.encode()
    words, parts = raw.split(), raw.split(b"\n")
    count, n, w = Counter(raw), max(len(raw), 1), max(len(words), 1)
    sizes = [len(x) for x in words]
    mean = sum(sizes) / w if words else 0.0
    spread = math.sqrt(sum((s - mean) ** 2 for s in sizes) / w) if words else 0.0
    of = lambda chars: math.log(sum(count[c] for c in chars) / n + 1e-3)
    per_word = lambda x: math.log(x / w + 1e-3)
    marks = b"*#$%&!|~^=<>@"
    return [
        math.log(1 + len(raw)), math.log(1 + len(words)), math.log(1 + len(parts)), math.log(1 + mean), math.log(1 + spread),
        per_word(len(set(words))), per_word(max(Counter(words).values(), default=0)), per_word(sum(words[i] == words[i - 1] for i in range(1, len(words)))),
        of(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), of(b"0123456789"), of(b".,;:'\"()-?"), of(marks + b"_+/\\[]{}`"), of(b" \t\n\r\x0b\x0c"), of(range(128, 256)),
        per_word(sum(len(x) > 1 and x.isupper() for x in words)), per_word(sum(x[-1:] in [bytes([m]) for m in marks] for x in words)),
        -sum(c / n * math.log2(c / n) for c in count.values()), math.log(sum(len(x) < 40 for x in parts) / len(parts) + 1e-3),
    ]


def test_quality_by_plain_discriminant(spark, data, rows):
    """Densities by solving and by determinants, from statistics written apart; and the order of held-out labels."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    x = {r["doc_id"]: np.array(plain_statistics(r["text"] or "")) for r in rows}
    held = {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in x}
    classes = [np.array([x[d] for d in sorted(x) if not held[d] and labels.get(d) == c]) for c in (0, 1)]
    total = sum(map(len, classes))
    own = [np.cov(c.T, bias=True) for c in classes]
    pooled = sum(len(c) * s for c, s in zip(classes, own, strict=True)) / total

    def density(v, c):
        s = 0.85 * own[c] + 0.10 * pooled + 0.05 * np.diag(np.diag(own[c])) + 1e-3 * np.eye(18)
        gap = v - classes[c].mean(0)
        return math.log(len(classes[c]) / total) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * gap @ np.linalg.solve(s, gap)

    out = queries.op5_quality_classifier(spark, data).collect()
    assert len(out) == len(rows)
    for r in out:
        v = x[r["doc_id"]]
        want = 1 / (1 + math.exp(-max(-36.0, min(36.0, (density(v, 1) - density(v, 0)) / 6))))
        assert r["score"] == pytest.approx(want, rel=1e-6, abs=1e-9) and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == held[r["doc_id"]]
    good, bad = ([r["score"] for r in out if held[r["doc_id"]] and labels.get(r["doc_id"]) == c] for c in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) >= 0.9


CLASHING = ("gone", "__row", "row", "__rate", "__cdf", "__source", "__bytes", "__text", "__id", "fp", "doc", "id", "key", "order", "of", "packed", "spans", "bytes", "h1")


@pytest.fixture(scope="module")
def clashing(docs):
    few = docs.orderBy("doc_id").limit(30)
    return few.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])


OPERATORS = {
    "lines": lines.deduplicate,
    "langid": lambda d: langid.predict(d, langid.fit(d)),
    "quality": lambda d: quality.score(quality.features(d), quality.fit(quality.features(d).withColumn("label", F.pmod("doc_id", F.lit(2))))),
    "simhash": simhash.deduplicate,
    "mixing": mixing.mix,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_columns(clashing, name):
    """Operators that keep other columns keep their values, and give what they give without them."""
    out = OPERATORS[name](clashing)
    plain = OPERATORS[name](clashing.drop(*CLASHING))
    found = out.collect()
    assert found and set(CLASHING) <= set(out.columns)
    for r in found:
        assert all(r[c] == f"{c} of {r['doc_id']}" for c in CLASHING)
    assert sorted(map(str, out.drop(*CLASHING).collect())) == sorted(map(str, plain.collect()))


def test_clashing_columns_unused(spark, clashing, data):
    """Operators with columns of their own give the same whatever else there is."""
    tokenizer = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for f in (substring.deduplicate, lambda d: bpe.encode(d, tokenizer), simhash.components):
        assert sorted(map(str, f(clashing).collect())) == sorted(map(str, f(clashing.drop(*CLASHING)).collect()))
    paths = [scratch_path(spark, "test-clash") for _ in range(2)]
    media.store(clashing, paths[0]), media.store(clashing.drop(*CLASHING), paths[1])
    one, two = (sorted(map(str, media.describe(media.load(spark, p)).collect())) for p in paths)
    assert one == two
    turns = spark.read.parquet(f"{data}/conversations.parquet").where("conv_id < 20")
    other = turns.select("*", *[F.lit("x").alias(c) for c in ("body", "chain", "last", "rendered", "n_turns", "one")])
    assert sorted(map(str, chat.format_chats(other).collect())) == sorted(map(str, chat.format_chats(turns).collect()))
    vectors = spark.read.parquet(f"{data}/embeddings.parquet").limit(60)
    other = vectors.select("*", *[F.lit("x").alias(c) for c in ("id", "vec", "slot", "rank", "score", "block", "at", "query_id")])
    assert sorted(map(str, topk.search(other, other).collect())) == sorted(map(str, topk.search(vectors, vectors).collect()))


def test_long_line_and_words(spark):
    """A line of megabytes, with a copy that differs little; and one word of many bytes through the encoder."""
    rng = np.random.default_rng(3)
    long = " ".join(map(str, rng.integers(0, 10**6, 150_000).tolist()))
    df = spark.createDataFrame([(1, long), (2, long[:500] + "x" + long[500:]), (3, "short")], "doc_id long, text string")
    assert {r["doc_id"]: bool(r["text"]) for r in lines.deduplicate(df).collect()} == {1: True, 2: False, 3: True}
    word = "".join(rng.choice(list("abcdefgh"), 3000))
    tokenizer = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    df = spark.createDataFrame([(1, word), (2, long)], "doc_id long, text string")
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(bpe.encode(df, tokenizer), tokenizer).collect()} == {1: word, 2: long}


def test_long_text_in_pieces(spark, monkeypatch):
    """Small pieces give the same removals as whole texts."""
    rng = np.random.default_rng(4)
    shared = [f"s{i}" for i in range(300)]
    texts = []
    for i in range(6):
        words = [f"w{x}" for x in rng.integers(0, 50_000, 2000).tolist()]
        at = int(rng.integers(0, 1500))
        texts.append(" ".join(words[:at] + shared[: 300 - 40 * i] + words[at:]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, substring.deduplicate(df).collect()))
    assert sum(r[2] for r in whole) == sum(300 - 40 * i for i in range(1, 6))
    for size in (200, 3000):
        found = []
        for text in texts:
            words, out = text.encode().split(), {}
            for start, part in substring.pieces(text.encode(), 49, size):
                for j in range(len(part) - 49):
                    assert out.setdefault(start + j, part[j : j + 50]) == words[start + j : start + j + 50]
            found.append(len(out))
            assert len(out) == len(words) - 49
            assert [w for _, part in substring.pieces(text.encode(), 0, size) for w in part] == words


def test_pipeline_by_hand(spark, data, rows):
    """The stages' decisions from plain versions: what each keeps of what the one before left."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data)
        done[name] = docs.collect()
        docs = spark.createDataFrame(done[name], docs.schema)
    accepted = {r["doc_id"] for r in langid.predict(spark.read.parquet(f"{data}/documents.parquet"), langid.fit(spark.read.parquet(f"{data}/documents.parquet").where("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2"))).collect() if r["accepted"]}
    assert {r["doc_id"] for r in done["language_id"]} == accepted
    # line dedup keeps all documents, and only lines that were there, in order
    was = {r["doc_id"]: (r["text"] or "").split("\n") for r in done["language_id"]}
    now = {r["doc_id"]: (r["text"] or "").split("\n") if r["text"] else [] for r in done["line_dedup"]}
    assert set(now) == set(was)
    for d, left in now.items():
        rest = iter(was[d])
        assert all(x in rest for x in left)
    # one document, the smallest, of each group of fingerprints at distance 4
    from test_brute_force import Sets, fingerprint

    prints = {r["doc_id"]: fingerprint(r["text"] or "") for r in done["line_dedup"]}
    groups, ids = Sets(sorted(prints)), sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                groups.join(a, b)
    assert {r["doc_id"] for r in done["near_dedup"]} == {groups.find(d) for d in ids}
    # as many copies of each as the inverted distribution says
    per = Counter(r["source"] or "" for r in done["near_dedup"])
    copies = Counter(r["doc_id"] for r in done["mixing"])
    for r in done["near_dedup"]:
        rate = len(done["near_dedup"]) / len(per) / per[r["source"] or ""]
        draw = (int(hashlib.md5(f"42:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, total = 0, math.exp(-rate)
        while total <= draw:
            k += 1
            total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        assert copies[r["doc_id"]] == k
    # and the ids of the last stage are those of the texts
    text = {r["doc_id"]: r["text"] or "" for r in done["mixing"]}
    assert Counter(r["doc_id"] for r in done["byte_bpe"]) == copies
    for r in done["byte_bpe"]:
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()


def test_components_of_structs(spark):
    """Nodes of any comparable type, and a hub of very many links."""
    hub = spark.range(1, 5000).selectExpr("id as u", "0L as v")
    out = connected_components(hub)
    assert out.count() == 5000 and out.where("component <> 0").count() == 0
