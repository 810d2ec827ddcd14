"""Language ID by compression: each text is encoded with one zstandard raw-content dictionary per language.

The dictionary that gives the fewest bytes names the language; a text whose two best sizes lie too
close together is rejected. Texts are cut into blocks that are encoded one by one, because a long
text soon becomes its own dictionary and the languages' dictionaries would no longer tell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import held, unpacked

#: Slices of text in a language's dictionary, and characters in a slice: the bound of the fitting sample.
SLICES, SLICE_CHARS = 96, 1024
BLOCK_BYTES = 512
LEVEL = 9
#: Rows that are sent back at once.
SLICE_ROWS = 512
#: Least relative difference of the two best sizes.
MIN_MARGIN = 0.01
#: Bytes saved per e-fold of the score's odds.
SCORE_BYTES = 8.0
ADDED = ("lang_pred", "score", "margin", "accepted")


def fit(train: DataFrame, slices: int = SLICES, slice_chars: int = SLICE_CHARS) -> dict[str, bytes]:
    """A raw-content dictionary for each non-null ``lang`` of ``train``.

    The sample of a language is the ``slices`` distinct texts with the lowest hashes, one slice of
    ``slice_chars`` characters of each, at an offset given by its hash. Counts cover all rows; the
    threshold from them keeps the candidates few before they are ranked. Letter case is dropped, here
    as in ``predict``. Languages come in the order of their distinct texts, most first: ties go to
    the first.
    """
    rows = train.select("lang", "text", F.xxhash64("text").alias("__h")).where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02)).collect()}
    if not counts:
        return {}
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 4.0 * slices / max(n, 1)))).otherwise(share)
    unit = (F.shiftrightunsigned("__h", 11).cast("double")) / F.lit(float(2**53))
    start = F.pmod(F.shiftrightunsigned("__h", 20), F.greatest(F.length("text") - F.lit(slice_chars), F.lit(0)).cast("long") + 1)
    picked = (
        rows.where(unit < share)
        .select("lang", "__h", F.lower(F.substring("text", start.cast("int") + 1, F.lit(slice_chars))).alias("__slice"))
        .groupBy("lang", "__h")
        .agg(F.min("__slice").alias("__slice"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("__h", 11), "__h"))
    found = picked.withColumn("__r", rank).where(F.col("__r") <= slices).orderBy("lang", "__r").collect()
    out: dict[str, list[bytes]] = {}
    for r in found:
        out.setdefault(r["lang"], []).append(r["__slice"].encode("utf-8", "replace"))
    order = sorted(out, key=lambda lang: (-counts[lang], lang))
    return {lang: b"\n".join(out[lang]) for lang in order}


def sizes(text: bytes, coders: list, block: int = BLOCK_BYTES) -> list[int]:
    """Bytes that the whole text takes with each coder, block by block."""
    view = memoryview(text)
    parts = [view[i : i + block] for i in range(0, len(text), block)]
    return [sum(len(c.compress(p)) for p in parts) for c in coders]


def coders_of(dictionaries: list[bytes], level: int) -> list:
    """A compressor for each dictionary, which is digested once; frames carry no more than they must."""
    import zstandard as zstd

    out = []
    for raw in dictionaries:
        own = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=level)
        out.append(zstd.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def decide(langs: list[str], found: list[int]) -> tuple[str, float, float]:
    """Language, score and margin. Ties go to the first name; a single language is sure of itself."""
    best = min(range(len(langs)), key=lambda i: (found[i], i))
    odds = sum(math.exp(-min(700.0, (s - found[best]) / SCORE_BYTES)) for s in found)
    rest = [s for i, s in enumerate(found) if i != best]
    margin = (min(rest) - found[best]) / min(rest) if rest else 1.0
    return langs[best], 1.0 / odds, margin


def predict(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN, level: int = LEVEL, with_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``accepted``; columns of these names are replaced.

    Only ``text`` is looked at, and all of it. A null text, one without a letter, and every text when
    no language was learned get ``und``, score 0, margin 0 and are not accepted. Equal texts get
    equal values. ``with_text`` false leaves the text out of the result, and so out of what Python
    sends back.
    """
    langs, dictionaries = list(model), list(model.values())
    kept = [c for c in docs.columns if c.lower() not in ADDED and (with_text or c.lower() != "text")]
    lettered = F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}")
    framed = docs.select(F.when(lettered, F.lower("text").cast("binary")).alias("bytes"), held(docs, kept).alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = coders_of(dictionaries, level)
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            lang, score, margin = [], [], []
            for value in batch.column(0):
                raw = value.as_py()
                one = ("und", 0.0, 0.0) if raw is None or not langs else decide(langs, sizes(raw, coders))
                lang.append(one[0]), score.append(one[1]), margin.append(one[2])
            ok = [p != "und" and m >= min_margin for p, m in zip(lang, margin, strict=True)]
            arrays = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(ok, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], ["doc", *ADDED])

    schema = framed.select("doc").schema.add("lang_pred", "string").add("score", "double").add("margin", "double").add("accepted", "boolean")
    return framed.mapInArrow(run, schema).select(*unpacked("doc", kept), *ADDED)
