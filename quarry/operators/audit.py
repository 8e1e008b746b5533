"""Consistency of images, labels and lists: joins, set guards, relocation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.tables import Table


def missing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of left without a partner: images without labels, orphan labels, list
    rows whose image is gone."""
    return left.join(right.select(*on), on, "left_anti")


def present(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on), on, "left_semi")


def flag_present(left: DataFrame, right: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Left rows, each once, with whether right has their key."""
    keys = right.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(keys, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def leakage(train: DataFrame, val: DataFrame, on: list[str]) -> DataFrame:
    """Keys in both splits, each once."""
    return train.select(*on).intersect(val.select(*on))


def guard(leaks: DataFrame) -> None:
    """Raise if a split leaks into the other, before anything is written."""
    some = leaks.limit(5).collect()
    if some:
        raise ValueError(f"in both splits: {[tuple(r) for r in some]}")


def relocation(wanted: DataFrame, known: DataFrame, on: str) -> DataFrame:
    """Each wanted key with how many files it may be: missing, move or ambiguous."""
    counts = known.groupBy(on).agg(F.count("*").alias("candidates"))
    return wanted.join(counts, on, "left").withColumn(
        "candidates", F.coalesce("candidates", F.lit(0))
    ).withColumn(
        "status",
        F.when(F.col("candidates") == 0, "missing").when(F.col("candidates") == 1, "move").otherwise("ambiguous"),
    )


def locate(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Where an entry's file is now: in its split, else in the other one."""
    at = files.select("dataset", "relative", F.col("split").alias("at"), "path")
    found = entries.join(at, ["dataset", "relative"], "left")
    choice = F.max_by("path", F.col("at") == F.col("split"))
    return found.groupBy(*entries.columns).agg(choice.alias("path"))


def attach_predictions(images: DataFrame, pred: DataFrame) -> DataFrame:
    """Predictions by path, else by a file name that only one image has."""
    by_path = pred.join(images.select(F.col("path").alias("image")), "image", "left_semi")
    names = images.groupBy("name").agg(F.min("path").alias("path"), F.count("*").alias("n")).where("n = 1")
    rest = missing(pred, images.select(F.col("path").alias("image")), ["image"])
    by_name = rest.withColumn("name", F.regexp_extract("image", "([^/]*)$", 1)).join(names, "name").drop("image", "name", "n")
    return by_path.unionByName(by_name.withColumnRenamed("path", "image"))


def free_indices(occupied: DataFrame, column: str, first: int, count: int) -> DataFrame:
    """The ``count`` smallest integers from first that aren't taken, from the gaps
    between taken ones: gaps are sorted by range, their sizes summed up over ranges,
    and only the integers wanted are listed."""
    k = F.col(column).cast("long")
    taken = occupied.select(k.alias("k")).where(F.col("k") >= first).distinct()
    ends = taken.unionByName(occupied.sparkSession.range(first - 1, first).toDF("k"))
    ends = ends.repartitionByRange("k").sortWithinPartitions("k").withColumn("_part", F.spark_partition_id())
    ends = Table(ends, "taken").df
    # what follows the last of a range is the first of the next
    heads = ends.groupBy("_part").agg(F.min("k").alias("head"))
    heads = heads.withColumn("after", F.lead("head").over(Window.orderBy("_part"))).drop("head")  # one row a range
    inside = F.lead("k").over(Window.partitionBy("_part").orderBy("k"))
    gaps = ends.withColumn("next", inside).join(F.broadcast(heads), "_part").select(
        "_part", "k", F.coalesce("next", "after").alias("next")
    )
    # behind the largest, as many as may be wanted
    gaps = gaps.withColumn("n", F.coalesce(F.col("next") - F.col("k") - 1, F.lit(count))).where("n > 0")
    upto = Window.partitionBy("_part").orderBy("k")
    sums = gaps.groupBy("_part").agg(F.sum("n").alias("all"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    placed = gaps.withColumn("upto", F.sum("n").over(upto)).join(F.broadcast(sums), "_part")
    left = F.least("n", F.lit(count) - F.col("before") - F.col("upto") + F.col("n"))
    return placed.withColumn("left", left).where("left > 0").select(
        F.explode(F.sequence(F.col("k") + 1, F.col("k") + F.col("left"))).alias("k")
    )


def stem_groups(files: DataFrame) -> DataFrame:
    """``stem, paths``: the files of each stem, in order."""
    return files.groupBy("stem").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def all_stems(*frames: DataFrame) -> DataFrame:
    """Stems of any of the tables, each once."""
    return reduce(DataFrame.unionByName, (f.select("stem") for f in frames)).distinct()


def in_turn(*frames: DataFrame) -> DataFrame:
    """All rows of tables one after another: ``source`` numbers the table, and with its
    own order gives the order of all."""
    return reduce(DataFrame.unionByName, (f.withColumn("source", F.lit(i)) for i, f in enumerate(frames)))


def samples(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first rows in order, to show."""
    return df.orderBy(*order).limit(n)


def of_datasets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the datasets named, whatever their case."""
    names = wanted.select(F.lower("dataset").alias("_d")).distinct()
    return rows.join(names, F.lower("dataset") == F.col("_d"), "left_semi")


def check_arguments(alpha: float, quality: int, start: int, width: int, source: str, output: str, recursive: bool) -> None:
    """Raise if a batch of images can't be worked on like this."""
    same, inside = source.rstrip("/") == output.rstrip("/"), output.startswith(source.rstrip("/") + "/")
    for wrong, why in (
        (not 0.0 <= alpha <= 1.0, "alpha must be from 0 to 1"), (not 0 <= quality <= 100, "quality must be from 0 to 100"),
        (start < 0, "the first index must not be negative"), (width <= 0, "names need a width above 0"),
        (same, "input and output must differ"), (recursive and inside, "the output must not be inside of the input"),
    ):
        if wrong:
            raise ValueError(why)
