"""Byte-level BPE encoding and decoding.

Texts are cut by the tokenizer's pattern in blocks of documents. The distinct words of a block that
are no token themselves go to Spark as byte arrays, where higher-order functions fold the ranked
merges over them: the pair of least rank is merged, leftmost first, until none is left. Ranks are
looked up in a literal hash map of (left token, right token) to the merged token, which is its rank.
The words' ids go back to their places in the block's documents. Blocks never meet, so nothing is
shuffled and memory is bounded by a block. Decoding concatenates the tokens' binary pieces.

A cache of frequent words, folded once in the same way, saves folding them for each block; it is
filled from a bounded sample and changes no result.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: Words of the cache, documents in its sample, and bytes of a word it may hold: together they bound what is broadcast.
CACHE_WORDS, SAMPLE_DOCS, CACHE_BYTES = 500_000, 32_768, 32
#: A longer word is merged by a heap in Python: folding takes time in the square of the length.
FOLD_BYTES = 64
#: Bits of a rank, at least and at most: three ranks must fit in a long.
LEAST_BITS, MOST_BITS = 16, 20
#: Sizes of the hash map's two halves in multiples of the entries, tried in turn.
ROOM = ((0.75, 1.0), (1.0, 0.7), (1.1, 0.95), (2.0, 1.6), (4.0, 3.2))
#: Ids in blocks and in the cache.
IDS = "<u4"
# Fixed value: the Unicode White_Space characters, which \\s stands for in the tokenizer's pattern.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def vocabulary(path: str) -> dict[bytes, int]:
    """Ranks by token from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def rank_bits(ranks: dict[bytes, int]) -> int:
    """Bits that hold each rank, and one more value that stands for none."""
    bits = max(LEAST_BITS, (max(ranks.values(), default=0) + 1).bit_length())
    if bits > MOST_BITS:
        raise ValueError(f"ranks must fit in {MOST_BITS} bits")
    return bits


def next_prime(n: int) -> int:
    n = max(n, 3) | 1
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def pair_table(ranks: dict[bytes, int]) -> tuple[tuple[int, int, int], list[int]]:
    """The map of token pairs to merged tokens, as sizes and bits of a rank, and entries of the two halves of a cuckoo hash table.

    A pair is left and right rank in one number, and lies at its remainder by the first size in the first half or
    by the second size in the second. An entry is the pair and the merged token in one number, or -1.
    """
    bits, entries = rank_bits(ranks), []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                entries.append(((left << bits | right) << bits) | rank)
    for one, two in ROOM:
        sizes = (next_prime(int(one * len(entries))), next_prime(int(two * len(entries)) + 2))
        table = [-1] * sum(sizes)
        if all(_insert(table, sizes, e, bits) for e in entries):
            return (*sizes, bits), table
    raise ValueError("no table holds the vocabulary's pairs")


def _insert(table: list[int], sizes: tuple[int, int], entry: int, bits: int) -> bool:
    half = 0
    for _ in range(500):
        at = (entry >> bits) % sizes[half] + half * sizes[0]
        entry, table[at] = table[at], entry
        if entry < 0:
            return True
        half = 1 - half
    return False


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lookup(table: Column, sizes: tuple[int, int, int], left: Column, right: Column) -> Column:
    """Rank of a pair of tokens, as a long; the value beyond all ranks if it is no token or the right side is missing."""
    one, two, bits = sizes
    # written out rather than bound to variables: arithmetic costs less here than a lambda
    key = F.shiftleft(left, bits).bitwiseOR(right)
    first = F.get(table, (key % F.lit(one)).cast("int"))
    second = F.get(table, (key % F.lit(two)).cast("int") + F.lit(one))
    low = F.lit((1 << bits) - 1).cast("long")
    found = F.when(F.shiftright(first, bits) == key, first.bitwiseAND(low))
    found = found.when(F.shiftright(second, bits) == key, second.bitwiseAND(low))
    return found.otherwise(F.lit(1 << bits).cast("long"))


def fold(table: Column, sizes: tuple[int, int, int], word: Column) -> Column:
    """Token ids of a word of at most 256 bytes given as the ids of its bytes.

    Each token is one long: the rank of the pair that it begins, its offset and its id. The least of
    them is the pair to merge, leftmost among equals.
    """
    bits = sizes[2]
    rank_of = lambda x: F.shiftright(x, bits + 8)
    id_of = lambda x: x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
    offset_of = lambda x: x.bitwiseAND(F.lit(0xFF << bits).cast("long"))

    def token(left: Column, right: Column, offset: Column) -> Column:
        return F.shiftleft(lookup(table, sizes, left, right), bits + 8).bitwiseOR(offset).bitwiseOR(left)

    start = F.transform(word, lambda x, i: token(x.cast("long"), F.get(word, i + 1).cast("long"), F.shiftleft(i.cast("long"), bits)))

    def merge(acc: Column, least: Column) -> Column:
        def at(p: Column) -> Column:  # p: where the pair begins, from 1
            before = F.get(acc, p - 2)
            merged = token(rank_of(least), id_of(F.get(acc, p + 1)), offset_of(least))
            rest = F.slice(acc, p + 2, F.lit(FOLD_BYTES))
            ahead = F.concat(F.slice(acc, F.lit(1), p - 2), F.array(token(id_of(before), rank_of(least), offset_of(before)), merged), rest)
            return F.when(p > 1, ahead).otherwise(F.concat(F.array(merged), rest))

        return let(F.array_position(acc, least).cast("int"), at)

    def step(acc: Column, _: Column) -> Column:
        return let(F.array_min(acc), lambda least: F.when(rank_of(least) < F.lit(1 << bits), merge(acc, least)).otherwise(acc))

    return F.aggregate(F.slice(word, F.lit(2), F.lit(FOLD_BYTES)), start, step, lambda acc: F.transform(acc, lambda x: id_of(x).cast("int")))


def literal(spark: SparkSession, table: list[int]) -> Column:
    """The table as a literal: a relation of one row, so that plans name it and do not spell it out each time they are shown or logged."""
    array = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), pa.array(table, pa.int64()))
    return spark.createDataFrame(pa.table({"entries": array})).scalar()


def fold_words(rows: DataFrame, tokenizer: Tokenizer, words: str) -> DataFrame:
    """``rows`` with the token ids of each of an array column of words, in its place and named ``ids``."""
    sizes, table = tokenizer.pairs
    rows = rows.withColumn("table", literal(rows.sparkSession, table))
    kept = [c for c in rows.columns if c not in (words, "table")]
    return rows.select(*kept, let(F.col("table"), lambda t: F.transform(words, lambda w: fold(t, sizes, w))).alias("ids"))


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for one long word, in time n log n."""
    import heapq

    n = len(word)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if i >= 0 and j < n:
            rank = ranks.get(word[i : ends[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ends[i], ends[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, mid, end = heapq.heappop(heap)
        if not alive[i] or ends[i] != mid or after[i] >= n or ends[after[i]] != end:
            continue
        j = after[i]
        alive[j], ends[i], after[i] = False, end, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = after[i]
    return out


def splitter(pattern: str):
    """Cuts a text into the pattern's matches. Texts of Latin-1 characters alone take the standard library's engine, which is faster."""
    import re
    import unicodedata

    import regex

    outer = regex.compile(pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))
    # the classes spelt out for the first 256 characters
    low = [chr(i) for i in range(256)]
    spelt = {kind: "".join(re.escape(c) for c in low if unicodedata.category(c)[0] == kind) for kind in "LN"}
    white = "\t-\r \x85\xa0"
    inner = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{spelt['L']}{spelt['N']}]").replace(r"\p{L}", f"[{spelt['L']}]").replace(r"\p{N}", f"[{spelt['N']}]")
    inner = re.compile(inner.replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]"))
    beyond = re.compile("[^\x00-\xff]").search
    return lambda text: (outer if beyond(text) else inner).findall(text)


class Cache:
    """Ids of words, held in a few flat arrays: sorted hashes, and the words and ids that they stand for."""

    def __init__(self, words: pa.BinaryArray | None = None, ids: pa.ListArray | None = None) -> None:
        """Words and their ids; all is moved in flat arrays, so the driver never holds an object for each word."""
        import numpy as np
        from xxhash import xxh3_64_intdigest as h64

        words = pa.array([], pa.binary()) if words is None else words
        ids = pa.array([], pa.list_(pa.int32())) if ids is None else ids
        hashes = np.fromiter((h64(w.as_buffer()) for w in words), np.uint64, len(words))
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        words, ids = words.take(pa.array(order)), ids.take(pa.array(order))
        self.words, self.word_ends = b"", np.zeros(1, np.int32)
        if len(words):
            # the array's own buffers: the place of each word's start and of the last one's end, and the bytes
            _, places, held = words.buffers()
            places = np.frombuffer(places, np.int32)[words.offset : words.offset + len(words) + 1]
            self.words, self.word_ends = held[int(places[0]) : int(places[-1])].to_pybytes(), places - places[0]
        self.ids = ids.flatten().to_numpy(zero_copy_only=False).astype(IDS).tobytes()
        self.id_ends = np.r_[0, np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64) * 4].astype(np.int64)

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word, or None."""
        import numpy as np
        from xxhash import xxh3_64_intdigest as h64

        if not len(self.hashes):
            return [None] * len(words)
        hashes = np.fromiter(map(h64, words), np.uint64, len(words))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out: list[bytes | None] = [None] * len(words)
        for i in np.flatnonzero(self.hashes[at] == hashes).tolist():
            k = at[i]
            if self.words[self.word_ends[k] : self.word_ends[k + 1]] == words[i]:
                out[i] = self.ids[self.id_ends[k] : self.id_ends[k + 1]]
        return out


class Tokenizer:
    """Vocabulary and pattern of a byte-level BPE tokenizer."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks, self.pattern = vocabulary(path), pattern
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        self.pairs = pair_table(self.ranks)

    def pieces(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


def frequent_words(docs: DataFrame, tokenizer: Tokenizer, words: int = CACHE_WORDS, sample: int = SAMPLE_DOCS) -> Cache:
    """The most frequent words of a sample of texts, of about ``sample`` documents at most, with their ids."""
    share = min(1.0, sample / max(1, docs.count()))
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "text"), 11).cast("double") / F.lit(float(2**53))
    ranks, pattern = tokenizer.ranks, tokenizer.pattern
    picked = docs.where(F.col("text").isNotNull() & (unit < share)).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        cut, tally = splitter(pattern), Counter()

        def close() -> pa.RecordBatch:
            found = [(w, n) for w, n in ((w.encode(), n) for w, n in tally.items()) if len(w) <= CACHE_BYTES and w not in ranks]
            tally.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                tally.update(cut(text.as_py()))
                if len(tally) > 100_000:
                    yield close()
        yield close()

    counted = picked.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(words).select("word")
    first = [ranks[bytes([b])] for b in range(256)]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.column(0).slice(at, 2000)
                spelt = [[first[b] for b in w.as_py()] for w in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.to_pylist()], pa.list_(pa.binary())), pa.array([spelt], pa.list_(pa.list_(pa.int32())))], ["words", "spelt"]
                )

    spelt = top.mapInArrow(spell, "words array<binary>, spelt array<array<int>>").repartition(32)
    found = fold_words(spelt, tokenizer, "spelt").toArrow()
    words, ids = found["words"].combine_chunks(), found["ids"].combine_chunks()
    cache = Cache(words.flatten(), ids.flatten()) if len(words) else Cache()
    # what Arrow took for them would stay with the driver's Python otherwise
    del found, words, ids
    pa.default_memory_pool().release_unused()
    return cache


class Index(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def encode_blocks(docs: DataFrame, tokenizer: Tokenizer, cache: Cache) -> DataFrame:
    """Blocks of rows: ``keys`` (doc ids), ``counts`` (of each row's words), ``codes`` (which of the block's words), and the words' ids.

    ``lengths`` holds the number of ids of each word, and ``known`` those ids; where the length is -1,
    the ids are the next element of ``ids``, which the fold has made. Binary columns are compressed.
    """
    ranks, pattern = tokenizer.ranks, tokenizer.pattern
    first = [ranks[bytes([b])] for b in range(256)]
    held = docs.sparkSession.sparkContext.broadcast(cache)
    names = ["keys", "counts", "codes", "lengths", "known", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        import zstandard as zstd

        cut, cached, pack = splitter(pattern), held.value, zstd.ZstdCompressor(level=1).compress
        keys: list = []
        codes: list = []
        index = Index()

        def close() -> pa.RecordBatch:
            lengths, known, words = np.empty(len(index), "<i4"), [], []
            spelt = [word.encode() for word in index]
            for i, (raw, ids) in enumerate(zip(spelt, cached.find(spelt), strict=True)):
                rank = ranks.get(raw)
                if rank is not None:
                    ids = struct.pack("<I", rank)
                if ids is None and len(raw) > FOLD_BYTES:
                    long = heap_merge(raw, ranks)
                    ids = struct.pack(f"<{len(long)}I", *long)
                if ids is None:
                    words.append([first[b] for b in raw])
                    lengths[i] = -1
                else:
                    known.append(ids)
                    lengths[i] = len(ids) // 4
            counts = np.array([len(c) for c in codes], "<i4")
            binary = [pa.array([x], pa.binary()) for x in map(pack, (counts.tobytes(), np.concatenate(codes).tobytes(), lengths.tobytes(), b"".join(known)))]
            arrays = [pa.array([keys], pa.list_(pa.int64())), *binary, pa.array([words], pa.list_(pa.list_(pa.int32())))]
            for x in (keys, codes, index):
                x.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        size = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                found = cut(text)
                codes.append(np.fromiter(map(index.__getitem__, found), "<i4", len(found)))
                keys.append(key)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield close()
                    size = 0
        if keys:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = rows.mapInArrow(run, "keys array<bigint>, counts binary, codes binary, lengths binary, known binary, words array<array<int>>")
    return fold_words(blocks, tokenizer, "words")


def resolve(counts: bytes, codes: bytes, lengths: bytes, known: bytes, folded_ids: pa.ListArray) -> Iterator:
    """The id array of each of a block's rows."""
    import numpy as np

    counts, codes, lengths = np.frombuffer(counts, "<i4"), np.frombuffer(codes, "<i4"), np.frombuffer(lengths, "<i4").astype(np.int64)
    fresh = lengths < 0
    flat = folded_ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    own = folded_ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lengths.copy()
    sizes[fresh] = own
    starts = np.zeros(len(sizes), np.int64)
    starts[~fresh] = np.cumsum(sizes[~fresh]) - sizes[~fresh]
    pool = np.concatenate([np.frombuffer(known, IDS).astype(np.int64), flat])
    starts[fresh] = np.cumsum(own) - own + len(known) // 4
    at = 0
    for count in counts.tolist():
        these = codes[at : at + count]
        at += count
        width = sizes[these]
        before = np.cumsum(width) - width
        yield pool[np.repeat(starts[these] - before, width) + np.arange(int(width.sum()))].astype("<u4")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, ids) of the rows of blocks."""
    import zstandard as zstd

    unpack = zstd.ZstdDecompressor().decompress
    for batch in batches:
        for i in range(batch.num_rows):
            binary = [unpack(batch.column(c)[i].as_py()) for c in range(1, 5)]
            yield from zip(batch.column(0)[i].values.to_pylist(), resolve(*binary, batch.column(5)[i].values), strict=True)


def encode(docs: DataFrame, tokenizer: Tokenizer, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row of ``docs``: the ids of the whole text, without special tokens.

    A null or empty text has none. Rows that repeat an id are encoded each; null ids are kept; other
    columns play no part; an empty table gives an empty result.
    """
    return _encoded(docs, tokenizer, cache_words, lambda key, ids: (key, ids.astype("int32")), ["doc_id", "ids"], "doc_id long, ids array<int>")


def _encoded(docs: DataFrame, tokenizer: Tokenizer, cache_words: int, row, names: list[str], schema: str) -> DataFrame:
    cache = frequent_words(docs, tokenizer, cache_words) if cache_words else Cache()
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for key, ids in _rows(batches):
            held.append(row(key, ids))
            size += len(ids)
            if size > 1 << 19 or len(held) >= 4096:
                yield close()
                size = 0
        if held:
            yield close()

    return encode_blocks(docs, tokenizer, cache).mapInArrow(run, schema)


class Decoder:
    """Turns ids back into bytes: the pieces lie one after another, and are gathered by their places."""

    def __init__(self, pieces: list[bytes]) -> None:
        import numpy as np

        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.fromiter(map(len, pieces), np.int32, len(pieces))
        self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes

    def joined(self, ids) -> bytes:
        """The pieces of an array of ids, one after another; an id without a piece raises."""
        import numpy as np

        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id stands for no token")
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)
        return self.bytes[places].tobytes()


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``doc_id, bytes``: the concatenated pieces of the ``ids`` of each row; null ids decode to null, an id out of range raises."""
    decoder = Decoder(tokenizer.pieces())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, ids = batch.column(0).slice(at, 256), batch.column(1).slice(at, 256)
                raw = [decoder.joined(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in ids]
                yield pa.RecordBatch.from_arrays([keys, pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, tokenizer: Tokenizer, with_ids: bool = False, cache_words: int = CACHE_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and the ids if asked for: every row encoded, and the ids decoded again.

    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes. Rows
    are as in ``encode``; ids and bytes stay in the task that made them.
    """
    import hashlib

    decoder = Decoder(tokenizer.pieces())
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def row(key: int | None, ids) -> tuple:
        digests = (hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoder.joined(ids)).hexdigest())
        return (key, len(ids), *digests, *[ids.astype("int32")] * with_ids)

    return _encoded(docs, tokenizer, cache_words, row, names, schema)
