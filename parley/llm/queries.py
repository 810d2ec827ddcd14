"""The training-data operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, chat, langid, lines, media, mixing, quality, simhash, substring, topk
from parley.llm.common import crc32_of, materialize, scratch_path, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose like comes earlier."""
    return lines.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored as images in archives, read back and described."""
    path = scratch_path(spark, "media")
    media.store(table(spark, sf_dir, "documents"), path)
    return media.describe(media.load(spark, path))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations of the log, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned where crc32 of the id leaves a remainder other than 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc32_of("doc_id"), F.lit(4)) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, with_text=False)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned where crc32 of the id leaves a remainder other than 1."""
    held_out = F.pmod(crc32_of("doc_id"), F.lit(3)) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    found, _ = materialize(quality.features(docs), "quality-features")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(found.where("not held_out").join(labels, "doc_id"))
    return quality.score(found, model)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.components(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document and how many of them an earlier document's passages cover."""
    found = substring.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for each of every fiftieth."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated so that all sources weigh the same."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("rate")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    import public_tokenizers

    tokenizer = bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_media_columns": op2_media_columns,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_language_id": op4_language_id,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_topk_search": op8_topk_search,
    "op9_mixing_sources": op9_mixing_sources,
    "op10_byte_bpe": op10_byte_bpe,
}

SQL: dict[str, str] = {
    "op3_chat_formatting": chat.CHAT_SQL,
    "op8_topk_search": topk.TOPK_SQL.format(vectors="embeddings"),
    "op9_mixing_sources": mixing.MIX_SQL.format(docs="documents") + "select * from mixed",
}
