"""The queries over the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    chat,
    exact_dedup,
    importance,
    jaccard_join,
    line_dedup,
    mixing,
    quality_rules,
    sentencepiece,
    toxicity,
    warc,
)
from quarry.llm.base import read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), count_links=True).select(
        "doc_id", "n_shingles", "component_id", "class_id", "n_links"
    )


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return importance.resample(docs, importance.good_texts(docs, read(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("masks", lambda m: F.concat_ws("+", m["start"], m["length"]))
    return chat.rotate_perspectives(read(spark, sf_dir, "conversations")).withColumn(
        "masks", F.array_join(spans, ",")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_importance": op2_importance,
        "op3_mixing": op3_mixing,
        "op4_quality_rules": op4_quality_rules,
        "op5_line_dedup": op5_line_dedup,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_warc": op7_warc,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_toxicity": op9_toxicity,
        "op10_chat": op10_chat,
    }


EXACT_SQL = r"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
), g as (select norm, min(doc_id) as keep_id, count(*)::bigint as group_size from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g using (norm)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_SQL,
        "op3_mixing": mixing.SQL,
        "op4_quality_rules": quality_rules.sql(),
        "op5_line_dedup": line_dedup.SQL,
        "op7_warc": warc.SQL,
        "op8_jaccard_join": jaccard_join.SQL,
        "op10_chat": chat.SQL,
    }
