"""Queries that SQL can't express against brute-force versions on the smallest tables."""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from parley.llm import bpe, lines, mixing, queries, simhash, topk


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            self.up[n] = self.up[self.up[n]]
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def folded(line):
    left = "".join(c for c in line.lower() if unicodedata.category(c)[0] not in "ZPS" and c not in " \t\x0b\f\r")
    return left or line


def alike_lines(texts):
    """By own 5-grams, all pairs that share one: the places of all lines, their sets, and the components at similarity 0.8."""
    places = defaultdict(list)
    for d in sorted(texts):
        for at, line in enumerate(texts[d].split("\n")):
            if line.strip(" "):
                places[folded(line)].append((d, at))
    sets = {x: frozenset(x[i : i + 5] for i in range(max(1, len(x) - 4))) for x in places}
    groups, where, pairs = Sets(sets), defaultdict(list), []
    for x in sets:
        for g in sets[x]:
            where[g].append(x)
    for x in sets:
        for y, k in Counter(y for g in sets[x] for y in where[g] if y > x).items():
            if k >= 0.8 * (len(sets[x]) + len(sets[y]) - k):
                groups.join(x, y)
                pairs.append((x, y))
    return places, groups, pairs


@pytest.mark.parametrize("part", [None, 3000])
def test_op1(spark, data, texts, part):
    if part:  # of the larger table, as many lines as a comparison of all takes in a minute
        rows = spark.read.parquet(data.replace("0.001", "0.01") + "/documents.parquet").collect()
        texts, n = {}, 0
        for r in sorted(rows, key=lambda r: r["doc_id"]):
            n += (r["text"] or "").count("\n") + 1
            if n <= part:
                texts[r["doc_id"]] = r["text"] or ""
    places, groups, pairs = alike_lines(texts)
    first = {}
    for x, where in places.items():
        root = groups.find(x)
        first[root] = min(first.get(root, where[0]), *where)
    gone = {p for x, where in places.items() for p in where if p != first[groups.find(x)]}
    out = {r["doc_id"]: r["text"] for r in lines.deduplicate(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert set(out) == set(texts)
    missed = 0
    for d, text in texts.items():
        every, left = text.split("\n"), Counter(out[d].split("\n"))
        must = Counter(x for i, x in enumerate(every) if (d, i) not in gone)
        assert not must - left, d  # nothing goes that resembles no earlier line
        missed += sum((left - must).values()) - (out[d] == "" and not must)
    assert pairs and missed <= 0.03 * len(gone)


def test_op2(spark, data, texts):
    for r in queries.op2_media_columns(spark, data).collect():
        raw = texts[r["doc_id"]].encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])


def test_op4(spark, data):
    rows = queries.op4_language_id(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)


def test_op5(spark, data):
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality")
    rows = queries.op5_quality_classifier(spark, data).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["predicted"] == r["quality"] for r in held) >= 0.85 * len(held)


def fingerprint(text: str) -> int:
    words = [w for w in re.split("[ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_op6(spark, data, texts, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = {d: fingerprint(t) for d, t in texts.items()}
    groups, ids = Sets(sorted(prints)), sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                groups.join(a, b)
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash_near_dedup(spark, data).collect()}
    assert out == {d: (f"{prints[d]:016x}", groups.find(d)) for d in ids}


def test_simhash_dense_region(spark, monkeypatch):
    """Random words around a few centres: whole buckets and tiles of blocks give the same components as all pairs."""
    rng = np.random.default_rng(1)
    found = set()
    for c in rng.integers(0, 2**63, 5).tolist():
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 5), replace=False).tolist()
            x = c
            for f in flips:
                x ^= 1 << f
            found.add(x)
    words = sorted(found)
    groups = Sets(words)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                groups.join(a, b)
    want = Counter(groups.find(w) for w in words)
    df = spark.createDataFrame([(w - (1 << 64) if w >> 63 else w,) for w in words], "fp long")
    for block in (1000, 3):
        monkeypatch.setattr(simhash, "BLOCK", block)
        out = simhash.connected_components(simhash.link_fingerprints(df)).collect()
        sizes = Counter(r["component"] for r in out)
        assert sorted(sizes.values()) == sorted(n for n in want.values() if n > 1)


def test_op7(spark, data, texts):
    words = {d: t.encode().split() for d, t in texts.items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 49):
            first.setdefault(tuple(words[d][i : i + 50]), d)
    for r in queries.op7_substring_dedup(spark, data).collect():
        w = words[r["doc_id"]]
        gone = bytearray(len(w))
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < r["doc_id"]:
                gone[i : i + 50] = b"\1" * 50
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())


def test_topk_lists():
    """Shards in turn, with the bounds carried over, against all products; ties are common at the smaller spread, and some ids repeat."""
    rng = np.random.default_rng(0)
    for spread, dims in ((3, 16), (1000, 16), (2, 3), (1000, 1)):
        vecs, ids = rng.integers(-spread, spread, (700, dims)), rng.permutation(700) // 2 * 2
        own, queries = ids[::35], vecs[::35]
        known, best, entries = np.full(len(own), -np.inf), [[] for _ in own], 0
        for at in (0, 100, 300, 303):
            lists = topk.Lists(ids[at : {0: 100, 100: 300, 300: 303, 303: 700}[at]], vecs[at : {0: 100, 100: 300, 300: 303, 303: 700}[at]])
            for rows, found in zip(best, lists.search(own, queries, 5, known), strict=True):
                rows += found
            entries += lists.entries
        for one, query, rows in zip(own, queries, best, strict=True):
            want = sorted(((int(s), int(i)) for i, s in zip(ids, vecs @ query, strict=True) if i != one), key=lambda x: (-x[0], x[1]))[:5]
            assert sorted(rows, key=lambda x: (-x[0], x[1]))[:5] == want
        assert entries <= 700 * dims * len(own)
    huge = topk.Lists(np.arange(3), np.array([[2**40, 1], [2**40, 2], [5, 5]]))
    assert huge.search(np.array([0]), np.array([[2**20, 1]]), 2, np.full(1, -np.inf)) == [[(2**60 + 2, 1), (5 * 2**20 + 5, 2)]]


def test_topk_stops_early():
    """Reading ends before the lists do on vectors with and without structure."""
    rng = np.random.default_rng(1)
    for vecs in (rng.integers(-100, 100, (4000, 32)), rng.integers(-100, 100, (4000, 1)) * rng.integers(1, 5, (1, 32))):
        lists, known = topk.Lists(np.arange(4000), vecs), np.full(40, -np.inf)
        lists.search(np.arange(40), vecs[:40], 5, known)
        assert lists.entries < 0.8 * 40 * 4000 * 32


def test_topk_known_scores_bound_later_shards():
    """A shard gives no candidate below what is known, and all that reach it; queries look first where their reading ended before."""
    rng = np.random.default_rng(2)
    vecs = rng.integers(-100, 100, (6000, 32))
    own, queries = np.arange(30), vecs[:30]
    products = queries @ vecs.T
    known = np.sort(products[:, 30:3000], axis=1)[:, -5].astype(float)
    held, since = known.copy(), np.zeros(30, np.int64)
    lists = topk.Lists(np.arange(3000, 6000), vecs[3000:])
    found = lists.search(own, queries, 5, held)
    for q, rows in enumerate(found):
        want = sorted(((int(s), i) for i, s in enumerate(products[q]) if i >= 3000 and s >= known[q]), key=lambda x: (-x[0], x[1]))[:5]
        assert rows == want
    assert lists.search(own, queries, 5, known.copy(), since) == found and lists.search(own, queries, 5, known.copy(), since) == found


def test_topk_matrices():
    """Whole numbers of vectors by length, without those that are null or hold a null or no number; what 64 bits don't hold is their end."""
    vectors = pa.array([[1.0, -0.5], None, [0.001], [None, 1.0], [float("nan")], [1e300, -1e300], [], [float("inf"), 0.0], [2.0]], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(9), pa.int64()), vectors], ["id", "v"])
    for one in (batch, pa.concat_batches([batch, batch]).slice(9)):
        found = {vecs.shape[1]: (ids.tolist(), vecs.tolist()) for ids, vecs in topk.matrices(one, 256)}
        assert found == {0: ([6], [[]]), 1: ([2, 8], [[0], [512]]), 2: ([0, 5], [[256, -128], [2**63 - 1, -(2**63)]])}


def test_mixing_counts(docs):
    """Mean repetition near the rate, and large rates don't underflow."""
    out = mixing.mix(docs, weights={"src1": 5.0}).groupBy("source").count()
    total = docs.count()
    by = {r["source"]: r["count"] for r in out.collect()}
    share = 5.0 / (docs.select("source").distinct().count() + 4)
    assert abs(by["src1"] - share * total) < 5 * (share * total) ** 0.5
    big = docs.sparkSession.range(200).selectExpr("id as doc_id", "if(id = 0, 'x', 'y') as source")
    n = mixing.mix(big, weights={"x": 1e6}).where("source = 'x'").count()
    assert 100 < n < 300


def test_op10(spark, data, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in queries.op10_byte_bpe(spark, data).collect():
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_long_words_and_pattern():
    t = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=t.ranks, special_tokens={})
    rng = np.random.default_rng(0)
    cut = bpe.splitter(t.pattern)
    for _ in range(200):
        text = "".join(rng.choice(list("abéß1²¼ \n\t\x85\xa0\x1c'strelvdm.,!　Ωж٣\U0001f600"), 40))
        assert [i for w in cut(text) for i in bpe.heap_merge(w.encode(), t.ranks)] == own.encode_ordinary(text)
    word = "".join(rng.choice(list("abcde"), 5000))
    assert bpe.heap_merge(word.encode(), t.ranks) == own.encode_ordinary(word)


def test_large_vocabulary(spark, tmp_path):
    """Ranks beyond 16 bits: all pairs and triples of some letters after the bytes."""
    letters = [bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP"]
    tokens = [bytes([b]) for b in range(256)] + [a + b for a in letters for b in letters] + [a + b + c for a in letters for b in letters for c in letters]
    path = tmp_path / "large.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + f" {i}".encode() for i, t in enumerate(tokens)))
    t = bpe.Tokenizer(str(path), public_tokenizers.PATTERN)
    assert max(t.ranks.values()) >= 1 << 16 and t.pairs[0][2] == 17
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=t.ranks, special_tokens={})
    rng = np.random.default_rng(2)
    texts = {i: " ".join("".join(chr(c) for c in rng.choice(list(b"abcxyzABCQ7"), rng.integers(1, 70))) for _ in range(20)) for i in range(6)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for cached in (0, 1000):
        out = {r["doc_id"]: r["ids"] for r in bpe.encode(df, t, cached).collect()}
        assert out == {i: own.encode_ordinary(x) for i, x in texts.items()}
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(bpe.encode(df, t), t).collect()} == texts
