"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.tables import Table


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for each end of ``edges(a, b)``; component is the
    smallest id reachable.

    Each round re-hangs neighbours on the smallest one they know (Kiveris et
    al., 2014), O(log^2 n) rounds, and is written to the shared folder.  Minima
    are partial aggregations and every join is on a node, so a hub's edges can
    be split; nothing is collected.
    """
    links = Table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u > v")
        .distinct(),
        "links",
    )
    mark = _mark(links.df)
    while mark[0]:
        both = links.df.union(links.df.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        star = Table(large, "large-star")
        least = star.df.groupBy("u").agg(F.min("v").alias("m"))
        hung = star.df.join(least, "u")
        small = (
            hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(hung.select("u", "m"))
            .distinct()
        )
        after = Table(small, "links")
        star.drop()
        links.drop()
        links, before = after, mark
        mark = _mark(links.df)
        if mark == before:
            break
    roots = links.df.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return links.df.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    return tuple(
        links.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )
