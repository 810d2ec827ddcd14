"""A corpus pipeline of the training-data operators: each stage works on all that the one before kept.

All stages take rows with the columns of ``documents`` and any others, whatever their names. Nulls may be
in any column, texts may be empty or very long, rows may repeat, and an empty table goes through all
stages to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, langid, lines, mixing, simhash
from parley.llm.common import crc32_of, materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; columns as given.

    The model learns from ``lang`` of three quarters of the documents. Null texts, texts without a letter and
    those whose two best languages lie too close go, and all go if nothing can be learned. Equal texts
    share their fate, rows that repeat stay as often as they come; ties between languages go to the more frequent one and,
    their margin being 0, out.
    """
    model = langid.fit(docs.where(F.pmod(crc32_of("doc_id"), F.lit(4)) != 2))
    return langid.predict(docs, model).where("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines whose like comes earlier in the corpus, by doc_id, then place; columns as given, ``n_chars`` counted anew.

    No document goes: one whose lines all come earlier keeps an empty text. A null text stays null, a null
    id comes first, and rows that repeat id and text keep the same lines.
    """
    return lines.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; columns as given.

    Null and blank texts are one group, as they have one fingerprint. Rows that repeat a kept id all stay.
    Null ids stay only where their group has no other.
    """
    return simhash.deduplicate(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that all sources weigh the same, in a random but repeatable order; columns as given.

    Rows that repeat an id get the same number of copies each; a null source is one of its own; a null id draws as the empty text.
    """
    return mixing.mix(docs).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and token ids of every text, with digests of them and of what they decode to.

    A null or empty text has no ids. Rows that repeat are encoded each; null ids are kept; other columns go.
    """
    import public_tokenizers

    tokenizer = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, tokenizer, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing_sources),
    ("byte_bpe", byte_bpe),
]

#: Compressed sizes, MinHash and merges are no SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
