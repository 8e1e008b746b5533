"""The corpus pipeline: toxicity, line dedup, near-duplicate removal, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import jaccard_join, line_dedup, mixing, sentencepiece, toxicity
from quarry.llm.base import Table, as_row, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go.

    Null and empty texts have no evidence and stay; rows alike go or stay
    together; without labels of both classes nothing goes; an empty table stays
    empty.  Columns of any name travel as one struct, here and in each stage."""
    scored = toxicity.toxicity(docs, read(spark, sf_dir, "labels"), whole=True)
    return scored.where("predicted = 0").select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, and n_chars follows the text.

    A null text becomes an empty one; rows without id lose shared lines and hold
    none; rows of one id are one document for the count, each with its own text;
    no row goes."""
    kept = line_dedup.line_dedup(docs.select("doc_id", "text", as_row(docs)), carry=("_row",))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(kinds.get("n_chars", "long"))}
    return kept.select(*(new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of links the document with the smallest id stays.

    Rows without id, words or text link with nothing and stay; rows of one id are
    one document and go or stay together; texts stay as they are, whatever their
    length."""
    linked = jaccard_join.near_duplicates(docs.select("doc_id", "text")).where("component_id <> doc_id")
    gone = linked.select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.select(F.col("doc_id").alias("_id"), as_row(docs))
    return rows.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Texts without words have size 0 and are taken as their source is; null
    sources are one source; rows of one id are documents of their own."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left: ``doc_id, n_tokens, token_ids, lossless, source``.

    Equal rows are the copies that mixing made; they are numbered, so that each is
    segmented anew.  Null and empty texts have no tokens; a null id has a key like
    any other."""
    copies = docs.select(as_row(docs)).groupBy("_row").agg(F.count("*").cast("int").alias("_copies"))
    numbered = copies.select(
        *(F.col("_row").getField(c).alias(c) for c in ("doc_id", "text", "source")),
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_number"),
    )
    return sentencepiece.encode(numbered, carry=("source",), copy="_number")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("SentencePiece encoding", encode),
]

#: Models, similarity components and tokens aren't SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Table(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return docs
