"""Substring dedup: passages of 50 or more words that an earlier document has too.

Seeds are winnowed anchors: of all k-word grams in a window of 50 words the one with the least hash,
so equal windows have equal anchors at equal places. Documents are joined on anchors. From an anchor
a match is extended both ways, as far as any window around it reaches: first the whole surrounding
span at once, then, only where documents that share the anchor have different spans, window by
window. Adjoining matched windows make up the maximal repeats. A match is an equal 128-bit hash of
the words; groups of equal spans or windows are reduced to their smallest document id before they
are shuffled, so a passage in very many documents costs a row for each of them and never a pair.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import joined, materialize, remove

WINDOW, GRAM = 50, 8
#: Bytes of text whose words are held at once, and rows that are sent on at once.
PIECE_BYTES, ROWS_OUT = 1 << 20, 10_000
BLANK = re.compile(rb"[\t-\r ]")


def pieces(text: bytes, overlap: int, size: int = PIECE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Of one text: its words (maximal runs without the six ASCII blanks) in pieces of about ``size`` bytes, each with the number of its first word.

    The last ``overlap`` words of a piece come again at the start of the next, so a window of one
    word more lies in exactly one piece, and no more than a piece's words are held at once.
    """
    at, first, carried = 0, 0, []
    while True:
        end = min(at + size, len(text))
        cut = BLANK.search(text, end)
        end = cut.start() if cut else len(text)
        words = carried + text[at:end].split()
        yield first, words
        at = end
        if at >= len(text):
            return
        carried = words[-overlap:] if overlap else []
        first += len(words) - len(carried)


def anchored(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """Of one text: its anchors as (hash, first window, last window), in order. Each window has exactly one anchor."""
    import numpy as np
    from xxhash import xxh3_64_intdigest as h64

    n = len(words)
    if n < window:
        return []
    known: dict[bytes, int] = {}
    for w in words:
        if w not in known:
            known[w] = h64(w)
    each = np.array([known[w] for w in words], np.uint64)
    grams = np.zeros(n - gram + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(gram):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(grams)]
            grams ^= grams >> np.uint64(29)
    # least hash of each window, the leftmost of equal ones: by views of doubling length, on (hash, place) in one number
    width = window - gram + 1
    place = np.arange(len(grams), dtype=np.uint64)
    shift = np.uint64(max(1, int(len(grams)).bit_length()))
    packed = ((grams >> shift) << shift) | place
    least, span = packed, 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    at = (least & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    firsts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    lasts = np.r_[firsts[1:] - 1, len(at) - 1]
    return list(zip(grams[at[firsts]].view(np.int64).tolist(), firsts.tolist(), lasts.tolist(), strict=True))


def digest(words: list[bytes], at: int, count: int) -> tuple[int, int]:
    """Two signed 64-bit halves of a hash of ``count`` words; words hold no blank, so the joined text is theirs alone."""
    return struct.unpack("<qq", hashlib.blake2b(b" ".join(words[at : at + count]), digest_size=16).digest())


def _emit(out: list[list], names: list[str], kinds: list) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
    for column in out:
        column.clear()
    return batch


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row`` (names a row by id and text, for rows that repeat an id) and the text as bytes."""
    key, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("row"), text.cast("binary").alias("text"))


def packed(rows: DataFrame) -> DataFrame:
    """``keyed`` rows with compressed texts: a shuffle moves and holds far fewer bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd

        coder = zstd.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([coder.compress(t.as_py()) for t in batch.column(2)], pa.binary())],
                ["doc_id", "row", "packed"],
            )

    return rows.mapInArrow(run, "doc_id long, row long, packed binary")


def unpack(data: bytes) -> bytes:
    import zstandard as zstd

    return zstd.ZstdDecompressor().decompress(data)


def anchor_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Every anchor of every text: where, and the hash ``s1, s2`` of all words that its windows ``first`` to ``last`` cover."""
    names = ["doc_id", "row", "anchor", "s1", "s2", "first", "last"]
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]
        for batch in batches:
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for start, words in pieces(text.as_py(), window - 1):
                    for anchor, first, last in anchored(words, window, gram):
                        one = (doc, row, anchor, *digest(words, first, last - first + window), start + first, start + last)
                        for column, x in zip(out, one, strict=True):
                            column.append(x)
                    if len(out[0]) > ROWS_OUT:
                        yield _emit(out, names, kinds)
            yield _emit(out, names, kinds)

    return rows.mapInArrow(run, "doc_id long, row long, anchor long, s1 long, s2 long, first int, last int")


def ranges(spans: pa.ListScalar, widen: int = 0) -> list[tuple[int, int]]:
    """Of a row's ``spans`` of first and last numbers: the ranges from the first to before last + 1 + ``widen``, merged and in order."""
    import numpy as np

    if not spans.is_valid or not len(spans.values):
        return []
    first, last = (spans.values.field(i).to_numpy().astype(np.int64) for i in range(2))
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + 1 + widen)
    starts = np.r_[0, np.flatnonzero(first[1:] > end[:-1]) + 1]
    return list(zip(first[starts].tolist(), end[np.r_[starts[1:] - 1, len(end) - 1]].tolist(), strict=True))


def window_rows(texts: DataFrame, window: int) -> DataFrame:
    """Every window of the ``spans`` of every text, with the hash ``w1, w2`` of its words."""
    names, kinds = ["doc_id", "row", "at", "w1", "w2"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]
        for batch in batches:
            for doc, row, data, spans in zip(*(batch.column(i) for i in range(4)), strict=True):
                wanted, doc, row = ranges(spans), doc.as_py(), row.as_py()
                for start, words in pieces(unpack(data.as_py()), window - 1):
                    while wanted and wanted[0][1] <= start:
                        wanted.pop(0)
                    for first, end in wanted:
                        if first > start + len(words) - window:
                            break
                        for i in range(max(first, start), min(end, start + len(words) - window + 1)):
                            for column, x in zip(out, (doc, row, i, *digest(words, i - start, window)), strict=True):
                                column.append(x)
                            if len(out[0]) > ROWS_OUT:
                                yield _emit(out, names, kinds)
            yield _emit(out, names, kinds)

    return texts.mapInArrow(run, "doc_id long, row long, at int, w1 long, w2 long")


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``row, first, last``: windows of a row whose words also start in a document with a smaller id. Rows are named as in ``keyed``."""
    rows = keyed(docs)
    seeds, seeds_at = materialize(anchor_rows(rows, window, gram), "substring-seeds")
    either = F.xxhash64("s1", "s2")
    shared = (
        seeds.groupBy("anchor")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.min(either).alias("a"), F.max(either).alias("b"))
        .where("least < most")
        .select("anchor", "least", (F.col("a") != F.col("b")).alias("differ"))
    )
    met, _ = materialize(joined(seeds, shared, ["anchor"]), "substring-met")
    remove(docs.sparkSession, seeds_at)
    # whole spans: where all documents at an anchor agree, the smallest of them decides
    whole = met.where("not differ and doc_id > least").select("row", "first", "last")
    unlike = met.where("differ").drop("least", "differ")
    spans = unlike.groupBy("anchor", "s1", "s2").agg(F.min("doc_id").alias("least"))
    spanned = joined(unlike, spans, ["anchor", "s1", "s2"])
    whole = whole.union(spanned.where("doc_id > least").select("row", "first", "last"))
    # window by window: the smallest document of each differing span stands for the others
    own = (
        spanned.where("doc_id = least")
        .groupBy("row")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    texts = packed(rows).join(own, "row").select("doc_id", "row", "packed", "spans")
    windows, _ = materialize(window_rows(texts, window), "substring-windows")
    first = windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    later = joined(windows, first.drop("most"), ["w1", "w2"]).where("doc_id > least")
    return whole.union(later.select("row", F.col("at").alias("first"), F.col("at").alias("last")))


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row: the words left when repeated passages are taken out, joined by one space.

    A word goes if some window of ``window`` consecutive words that covers it also starts in a
    document with a smaller id; windows are judged on the input. A null text has no words. Texts
    shorter than a window lose nothing. A null id is neither smaller nor larger than any other. Rows
    that repeat an id are judged each by their own text, and don't count against each other. An empty
    table gives an empty result; other columns play no part.
    """
    found = repeats(docs, window, gram).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    texts = packed(keyed(docs)).join(found, "row", "left").select("doc_id", "packed", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            for doc, data, spans in zip(*(batch.column(i) for i in range(3)), strict=True):
                gone, parts, count, removed = ranges(spans, window - 1), [], 0, 0
                for start, words in pieces(unpack(data.as_py()), 0):
                    count, at, left = start + len(words), 0, []
                    while gone and gone[0][0] < count:
                        first, end = max(gone[0][0] - start, 0), min(gone[0][1] - start, len(words))
                        left += words[at:first]
                        removed += end - first
                        at = end
                        if gone[0][1] > count:
                            break
                        gone.pop(0)
                    left += words[at:]
                    if left:
                        parts.append(b" ".join(left))
                kept = b" ".join(parts)
                for column, x in zip(out, (doc.as_py(), count, removed, kept.decode("utf-8", "replace")), strict=True):
                    column.append(x)
                size += len(kept)
                if size > 4 << 20:
                    yield _emit(out, names, kinds)
                    size = 0
            yield _emit(out, names, kinds)

    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
