"""Splits, strides and spaced picks."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def train_size(n: Column, ratio: float) -> Column:
    """The product cut to an integer, at least 1, and less than n where n > 1."""
    cut = F.floor(n * F.lit(ratio)).cast("long")
    return F.when(n <= 1, n).otherwise(F.greatest(F.lit(1), F.least(cut, n - 1)))


def stratified_split(df: DataFrame, by: str, name, ratio: float = 0.8, seed=24) -> DataFrame:
    """``split`` train or val: in each stratum the first names in order of a seeded
    hash train.  Ranks of a hot stratum come from 256 hash ranges and their running
    counts, so that it isn't one task."""
    name = F.col(name) if isinstance(name, str) else name
    keyed = df.withColumn("_h", F.sha1(F.concat(F.lit(str(seed)), name.cast("string")))).withColumn(
        "_b", F.substring("_h", 1, 2)
    )
    counts = keyed.groupBy(by, "_b").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(by).orderBy("_b")
    starts = counts.select(
        F.col(by).alias("_by"), F.col("_b").alias("_at"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(by)).alias("_all"),
    )
    inside = keyed.withColumn("_k", F.row_number().over(Window.partitionBy(by, "_b").orderBy("_h")))
    return (
        inside.join(starts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_b") == F.col("_at")))
        .withColumn("split", F.when(F.col("_before") + F.col("_k") <= train_size(F.col("_all"), ratio), "train").otherwise("val"))
        .select(*df.columns, "split")
    )


def shuffled_split(datasets: dict[str, list[str]], ratio: float = 0.8, seed: int = 24) -> tuple[list[str], list[str]]:
    """The driver's split of small listings by one seeded generator: each dataset
    shuffled in turn, then both results."""
    draw, train, val = random.Random(seed), [], []
    for key in sorted(datasets):
        names = sorted(datasets[key])
        draw.shuffle(names)
        n = len(names)
        cut = n if n <= 1 else max(1, min(int(n * ratio), n - 1))
        train += names[:cut]
        val += names[cut:]
    draw.shuffle(train)
    draw.shuffle(val)
    return train, val


def stride(df: DataFrame, index: str, step) -> DataFrame:
    return df.where(F.pmod(F.col(index), F.lit(step)) == 0)


def step_of_seconds(fps: Column, seconds: float) -> Column:
    return F.greatest(F.lit(1), F.bround(fps * seconds).cast("int"))


def spaced(df: DataFrame, by: str, time: str, gap: float) -> DataFrame:
    """The first row of each group, then each that is at least ``gap`` after the
    last one taken.  Different times come in a shuffle sorted by group and time and
    are read as a stream: what is held is one batch and the last time taken."""
    times = df.select(F.col(by), F.col(time).cast("double").alias(time)).where(F.col(time).isNotNull()).distinct()
    ordered = times.repartition(by).sortWithinPartitions(by, time)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, None
        for batch in batches:
            names, t = batch.column(0), batch.column(1).to_numpy()
            runs = pc.run_end_encode(names)
            taken, start = [], 0
            for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                if last is None or name != group:
                    group, last = name, -np.inf
                at = start + int(np.searchsorted(t[start:end], last + gap))
                # sums round: the difference itself decides
                at = max(at - 1, start) if at > start and t[at - 1] - last >= gap else at
                while at < end:
                    if t[at] - last >= gap:
                        taken.append(at)
                        last = t[at]
                        at = max(at + 1, start + int(np.searchsorted(t[start:end], last + gap)) - 1)
                    else:
                        at += 1
                start = end
            yield batch.take(pa.array(taken, pa.int64()))

    return ordered.mapInArrow(pick, times.schema)
