"""Quality classifier by importance resampling over hashed n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.base import Table, small_batches
from quarry.llm.shingles import batch_word_hashes, mixed, normal

#: Buckets of hashed words and word pairs; the models have one count for each.
BUCKETS = 1 << 16
#: Labelled documents that ``good_texts`` gives at most, so that their ids can be broadcast.
TARGET = 20_000
SHARE, SEED = 0.5, 42
_STEP = np.uint64(0x9FB21C651E98DF25)


def _grams(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the words and pairs of one document."""
    pairs = mixed(h[:-1] * _STEP + h[1:])
    return (np.concatenate((h, pairs)) >> np.uint64(8)).astype(np.int64) % buckets


def _documents(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    for at in range(0, batch.num_rows, 512):
        yield from batch_word_hashes([normal(t) for t in batch.column(column).slice(at, 512).to_pylist()])


def _counts(buckets: int) -> Callable:
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for h in _documents(batch, 0):
                if len(h):
                    total += np.bincount(_grams(h, buckets), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    return counts


def _model(texts: DataFrame, buckets: int) -> np.ndarray:
    """Log probability of each bucket, with one added to each count."""
    rows = (
        texts.mapInArrow(_counts(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    n = np.ones(buckets)
    n[rows["bucket"].to_numpy(np.int64)] += rows["n"].to_numpy(float)
    return np.log(n) - np.log(n.sum())


def _weigh(ratio, buckets: int) -> Callable:
    """Rows (doc_id, row, log_weight, gumbel_key, order) of (doc_id, row, text, uniform);
    ``order`` has the key's bits as an integer in the order of the keys."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            for i, h in enumerate(_documents(batch, 2)):
                if len(h):
                    weights[i] = ratio.value[_grams(h, buckets)].sum()
            key = weights - np.log(-np.log(batch.column(3).to_numpy())) + 0.0
            bits = key.view(np.int64)
            order = np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(weights), pa.array(key), pa.array(order)],
                ["doc_id", "row", "log_weight", "gumbel_key", "order"],
            )

    return weigh


def _kth(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th largest of a column of integers, and how many rows of that value are
    among the k largest.  It is found 16 bits at a time from counts per prefix, so
    that no stage sorts rows: each pass is a partial aggregation into 65536 groups
    at most."""
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        some = rows if shift == 48 else rows.where(F.shiftright(column, shift + 16) == prefix)
        groups = some.groupBy(F.shiftright(column, shift).alias("p")).count().orderBy(F.desc("p")).toPandas()
        upto = groups["count"].cumsum().to_numpy()
        at = int(np.searchsorted(upto, left))
        left -= int(upto[at - 1]) if at else 0
        prefix = int(groups["p"][at])
    return prefix, left


def _top(rows: DataFrame, k: int, columns: tuple[str, ...]) -> DataFrame:
    """Flag the k largest by the columns in turn as ``selected``."""
    chosen, tied, among = F.lit(False), F.lit(True), rows
    for column in columns:
        value, k = _kth(among, column, k)
        chosen = chosen | (tied & (F.col(column) > value))
        tied = tied & (F.col(column) == value)
        among = among.where(F.col(column) == value)
        if among.count() == k:
            break
    return rows.withColumn("selected", chosen | tied)


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: float = SHARE,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id, log_weight, gumbel_key, selected`` per document.

    Two bag-of-hashed-n-grams models (words and word pairs), one of the
    ``target`` texts, one of all of ``docs``, give each document the log of its
    importance weight.  Adding Gumbel noise keyed by seed and id and taking the
    largest ``share`` of all documents draws without replacement in proportion
    to the weights.

    Counts are summed in each task and leave it as ``buckets`` rows at most;
    the driver holds two vectors of that length, whatever the input.  Both models
    count all the texts that they are given.

    Defined cases: null and empty texts weigh 0 (as likely in either); a very long
    text is hashed in pieces cut between words; a null id draws noise by its text;
    equal keys are taken in order of id, and rows alike in both one by one, any of
    them; without target rows the target model is uniform; an empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = target.select(F.col("text").cast("string").alias("text"))
    ratio = _model(wanted, buckets) - _model(rows.select("text"), buckets)
    held = spark.sparkContext.broadcast(ratio)
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce("text", F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), name)), 1, 13), 16, 10).cast("double")
    uniform = (bits + 0.5) / F.lit(float(1 << 52))
    drawn = Table(
        rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "text", uniform.alias("uniform"))
        .mapInArrow(_weigh(held, buckets), "doc_id long, row long, log_weight double, gumbel_key double, order long")
        .withColumn("early", F.bitwise_not(F.coalesce("doc_id", F.lit(2**63 - 1)))),  # a smaller id is larger
        "weights",
    ).df
    k = int(drawn.count() * share)
    picked = _top(drawn, k, ("order", "early", "row")) if k else drawn.withColumn("selected", F.lit(False))
    return picked.select("doc_id", "log_weight", "gumbel_key", "selected")


def good_texts(docs: DataFrame, labels: DataFrame, most: int = TARGET) -> DataFrame:
    """The target: at most ``most`` texts labelled to be of good quality."""
    ids = (
        labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(most)
    )
    # ``most`` ids of 8 bytes: small enough to broadcast
    return docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")
