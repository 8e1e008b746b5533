"""Distributions, classes, counters, timing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labels of the classes.
COUNT_CLASSES = ("无目标", "单件包裹", "2-3件包裹", "4-6件包裹", "多件复杂场景")
SIZE_CLASSES = ("小尺寸", "中等尺寸", "大尺寸")


def count_class(n) -> Column:
    n = F.col(n)
    names = [F.lit(x) for x in COUNT_CLASSES]
    return F.when(n == 0, names[0]).when(n == 1, names[1]).when(n <= 3, names[2]).when(n <= 6, names[3]).otherwise(names[4])


def size_class(ratio) -> Column:
    r = F.col(ratio)
    return F.when(r < 0.03, SIZE_CLASSES[0]).when(r < 0.10, SIZE_CLASSES[1]).otherwise(SIZE_CLASSES[2])


def shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).withColumn(
        "share", F.col("n") / F.sum("n").over(Window.partitionBy())
    )


def counted_per(parents: DataFrame, children: DataFrame, on: str) -> DataFrame:
    """Children per parent, 0 included."""
    n = children.groupBy(on).agg(F.count("*").alias("n"))
    return parents.select(on).join(n, on, "left").fillna(0, ["n"])


def binned(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """``bin, n`` for every bin, empty ones too; bins are closed on the left."""
    counts = df.groupBy(F.width_bucket(column, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(counts, "bin", "left").fillna(0, ["n"])


def in_order(df: DataFrame, column: str, values: list) -> DataFrame:
    """Counts of a fixed list of values, in its order, 0 where there are none."""
    every = df.sparkSession.createDataFrame(list(enumerate(values)), f"place int, `{column}` string")
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    return every.join(n, column, "left").fillna(0, ["n"]).orderBy("place")


def flag_counts(df: DataFrame, flags: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How often each condition holds."""
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("total"), *(F.count_if(c).alias(n) for n, c in flags.items())
    )


def speeds(df: DataFrame, by: str, ms: str) -> DataFrame:
    return df.groupBy(by).agg(
        F.count("*").alias("images"), F.sum(ms).alias("total_ms"), F.avg(ms).alias("mean_ms")
    ).withColumn("fps", F.try_divide(F.lit(1000.0), F.col("mean_ms")))


def pattern_counts(df: DataFrame, column: str, patterns: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Occurrences of each pattern, whatever its case."""
    return df.groupBy(*(by or [])).agg(
        *(F.sum(F.regexp_count(column, F.lit(f"(?i){p}"))).alias(n) for n, p in patterns.items())
    )


def numbered(df: DataFrame, by: list[str], order: list, name: str = "no") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
