"""Near-duplicate images: perceptual hash join, verification, groups, ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import correlation, geometry
from quarry.operators.components import components
from quarry.tables import Table


def _parts(bits: str, radius: int, width: int) -> list:
    """The hash in so many blocks that hashes ``radius`` bits apart differ by one bit
    at most in one of them, as Columns."""
    blocks = radius // 2 + 1
    cuts = [width * i // blocks for i in range(blocks + 1)]
    return [
        F.shiftrightunsigned(bits, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])
    ]


def _probes(bits: str, radius: int, width: int):
    """(block, value) of each block's value and of all values one bit from it: joined
    with the blocks as they are, they find every pair in reach.  Blocks are wide
    (21 bits for 64 and a radius of 5), so that few strangers meet in one."""
    blocks = radius // 2 + 1
    cuts = [width * i // blocks for i in range(blocks + 1)]
    return F.flatten(F.array(*(
        F.array(*(
            F.struct(F.lit(i).alias("block"), part.bitwiseXOR(F.lit(flip)).alias("value"))
            for flip in [0] + [1 << k for k in range(cuts[i + 1] - cuts[i]) if radius]
        ))
        for i, part in enumerate(_parts(bits, radius, width))
    )))


def _blocks(bits: str, radius: int, width: int):
    """(block, value) of each block."""
    parts = enumerate(_parts(bits, radius, width))
    return F.array(*(F.struct(F.lit(i).alias("block"), part.alias("value")) for i, part in parts))


def _first_block(a: str, b: str, radius: int, width: int):
    """The first block in which two hashes differ by one bit at most: a pair comes up
    in each such block, and counts in the first."""
    both = zip(_parts(a, radius, width), _parts(b, radius, width))
    return F.coalesce(*(F.when(F.bit_count(x.bitwiseXOR(y)) <= min(radius, 1), F.lit(i)) for i, (x, y) in enumerate(both)))


def hamming_pairs(df: DataFrame, key: str, bits: str, radius: int = 5, width: int = 64) -> DataFrame:
    """``a, b, distance`` for ids with hashes at most ``radius`` bits apart, a < b.

    Two such hashes differ by one bit at most in one of radius // 2 + 1 blocks, so an
    equi-join of blocks with blocks and their one-bit neighbours finds them all.
    Equal hashes join as one: a group of n copies gives n - 1 pairs with its
    smallest id, which is all that grouping needs."""
    df = Table(df.select(key, bits), "hashed").df
    groups = Table(df.groupBy(F.col(bits).alias("_h")).agg(F.min(key).alias("first")), "hashes").df
    copies = (
        df.join(groups, F.col(bits) == F.col("_h")).where(F.col(key) > F.col("first"))
        .select(F.col("first").alias("a"), F.col(key).alias("b"), F.lit(0).alias("distance"))
    )
    probing = groups.select("_h", "first", F.inline(_probes("_h", radius, width)))
    other = groups.select(F.col("_h").alias("_h2"), F.col("first").alias("second"), F.inline(_blocks("_h", radius, width)))
    near = (
        probing.join(other, ["block", "value"])
        .where(F.col("first") < F.col("second"))
        .withColumn("distance", geometry.hamming("_h", "_h2"))
        .where((F.col("distance") <= radius) & (F.col("block") == _first_block("_h", "_h2", radius, width)))
        .select(F.col("first").alias("a"), F.col("second").alias("b"), "distance")
    )
    return copies.unionByName(near)


def verified(pairs: DataFrame, features: DataFrame, key: str, vector: str, least: float = 0.95) -> DataFrame:
    """Pairs whose feature vectors correlate well enough.  Pairs of ``hamming_pairs``
    are too few for this: its equal hashes may have vectors of many kinds."""
    side = lambda n: features.select(F.col(key).alias(n), F.col(vector).alias(f"v_{n}"))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .withColumn("correlation", geometry.correlation("v_a", "v_b"))
        .where(F.col("correlation") >= least).drop("v_a", "v_b")
    )


#: Rows of one hash, and hashes of one (block, value), that a task compares with
#: others; more are split.
CROWD = 4096


def similar_pairs(
    df: DataFrame, key: str, bits: str, vector: str, radius: int = 5, width: int = 64, least: float = 0.95
) -> DataFrame:
    """``a, b, distance, correlation``: links that group all ids whose hashes are
    at most ``radius`` bits apart and whose vectors correlate well enough.

    Only rows equal in hash and vector join as one, by pairs with their smallest
    id.  Hashes with few rows give every link.  Those with many are cut into blocks:
    each is searched from row to row, and then against every block of a near hash,
    and a link counts if it joins what others of these two blocks don't.  Rows
    without hash or vector link with nothing."""
    rows = df.where(F.col(bits).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).alias("_key"), F.col(bits).alias("_h"), F.col(vector).alias("_v")
    )
    alike = Table(rows.groupBy("_h", "_v").agg(F.min("_key").alias("first")), "alike").df
    copies = (
        rows.join(alike, ["_h", "_v"]).where("_key > first")
        .select(F.col("first").alias("a"), F.col("_key").alias("b"), F.lit(0).alias("distance"), F.lit(1.0).alias("correlation"))
    )
    hashes = Table(alike.groupBy("_h").agg(F.count("*").alias("n")), "hashes").df
    near = Table(_near_hashes(hashes, radius, width), "near-hashes").df
    few = F.greatest("n", "n2") <= CROWD // 256
    plain = near.where(few).select("_h", "_h2", "distance")
    plain = (
        plain.join(alike.withColumnRenamed("first", "a").withColumnRenamed("_v", "v_a"), "_h")
        .join(alike.toDF("_h2", "v_b", "b"), "_h2")
        .where("_h <> _h2 or a < b")
        .withColumn("correlation", geometry.correlation("v_a", "v_b")).where(F.col("correlation") >= least)
    )
    found = plain.select("a", "b", "distance", "correlation")
    crowded = near.where(~few)
    if crowded.head(1):
        found = found.unionByName(_crowded_links(alike, crowded, least))
    ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance", "correlation")
    return copies.unionByName(ordered)


def _near_hashes(hashes: DataFrame, radius: int, width: int) -> DataFrame:
    """``_h, n, _h2, n2, distance``, each pair once and each hash with itself.  A
    crowded block is split over tasks."""
    banded = Table(hashes.select("_h", "n", F.inline(_blocks("_h", radius, width))), "blocks").df
    crowds = banded.groupBy("block", "value").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("_tasks"))
    crowds = Table(crowds, "crowds").df
    placed = banded.withColumnsRenamed({"_h": "_h2", "n": "n2"}).join(crowds, ["block", "value"])
    right = placed.withColumn("_salt", F.pmod(F.xxhash64("_h2"), F.col("_tasks")).cast("int")).drop("_tasks")
    # a probe goes to every part of a crowded block
    left = (
        hashes.select("_h", "n", F.inline(_probes("_h", radius, width))).join(crowds, ["block", "value"])
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1))).drop("_tasks")
    )
    return (
        left.join(right, ["block", "value", "_salt"]).where("_h <= _h2")
        .where(F.col("block") == _first_block("_h", "_h2", radius, width))
        .withColumn("distance", geometry.hamming("_h", "_h2")).where(F.col("distance") <= radius)
        .select("_h", "n", "_h2", "n2", "distance")
    )


def _crowded_links(alike: DataFrame, near: DataFrame, least: float) -> DataFrame:
    """Links between rows of near hashes, enough to group what all links would."""
    wanted = near.select("_h", "n").union(near.select("_h2", "n2")).distinct()
    rows = alike.join(wanted, "_h").withColumn(
        "_p", F.pmod(F.xxhash64("first"), F.ceil(F.col("n") / CROWD)).cast("int")
    ).select("_h", "_p", "first", "_v", "n")
    kind = alike.schema["first"].dataType.simpleString()
    added = f"label int, other {kind}, correlation double"
    many = F.col("n") > CROWD // 256
    plain = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("_h", "_p", "first", "_v"))
    inner = rows.where(many).drop("n").groupBy("_h", "_p").applyInArrow(_inside(least), f"{plain}, {added}")
    by_itself = (F.lit(-1).alias("label"), F.lit(None).cast(kind).alias("other"), F.lit(None).cast("double").alias("correlation"))
    inner = Table(inner.unionByName(rows.where(~many).drop("n").select("*", *by_itself)), "searched").df
    upto = lambda n: F.sequence(F.lit(0), F.ceil(F.col(n) / CROWD).cast("int") - 1)
    tasks = (
        near.withColumn("p1", F.explode(upto("n"))).withColumn("p2", F.explode(upto("n2")))
        .where("_h < _h2 or p1 < p2").select("_h", "p1", "_h2", "p2", "distance")
    )
    tasks = Table(tasks.withColumn("task", F.monotonically_increasing_id()), "tasks").df
    side = lambda n, h, p: (
        tasks.select("task", "distance", F.col(h).alias("_h"), F.col(p).alias("_p"))
        .join(inner, ["_h", "_p"]).select("task", "distance", F.lit(n).alias("side"), "first", "_v", "label")
    )
    # at most some pairs of blocks in a task, however few bytes they are
    spread = min(max(tasks.count() // 4, 1), 20000)
    met = side(0, "_h", "p1").unionByName(side(1, "_h2", "p2")).repartition(spread, "task")
    across = met.groupBy("task").applyInArrow(_across(least), f"a {kind}, b {kind}, distance int, correlation double")
    inner = inner.where("other is not null").select(
        F.col("other").alias("a"), F.col("first").alias("b"), F.lit(0).alias("distance"), "correlation"
    )
    return inner.unionByName(across)


def _inside(least: float):
    """Rows of a block with a ``label`` per group and, but for the first of a group,
    a row (``other``) that they correlate with."""

    def search(table: pa.Table) -> pa.Table:
        rows = correlation.Rows(table.column("_v"))
        label, other, value = correlation.forest(rows, least)
        first = table.column("first").combine_chunks()
        other = pa.array(other, mask=other < 0)
        return table.append_column("label", pa.array(label, pa.int32())).append_column("other", first.take(other)).append_column(
            "correlation", pa.array(value, pa.float64(), mask=other.is_null().to_numpy(zero_copy_only=False))
        )

    return search


def _across(least: float):
    """Links between the two blocks of a task that join groups of theirs."""

    def search(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        rows = correlation.Rows(table.column("_v"))
        i, j, value = correlation.joining(rows, side, table.column("label").to_numpy(), least)
        first = table.column("first").combine_chunks()
        distance = pa.array(np.full(len(i), table.column("distance")[0].as_py()), pa.int32())
        return pa.table([first.take(pa.array(i)), first.take(pa.array(j)), distance, pa.array(value, pa.float64())], ["a", "b", "distance", "correlation"])

    return search


def nearest(pairs: DataFrame, most: int) -> DataFrame:
    """Optionally the nearest partners of each later row only."""
    w = Window.partitionBy("b").orderBy("distance", "a")
    return pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def groups(rows: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Rows in groups of two and more with ``component`` (their smallest id)."""
    return rows.join(components(pairs), F.col(key) == F.col("id")).drop("id")


def rank(rows: DataFrame, key: str, keep: int = 2) -> DataFrame:
    """``duplicate_rank`` (usable, better, larger, earlier first) and what is surplus."""
    pixels = F.col("width").cast("long") * F.col("height")
    w = Window.partitionBy("component").orderBy("fatal_quality", F.desc("quality_score"), pixels.desc(), key)
    return rows.withColumn("duplicate_rank", F.row_number().over(w)).withColumn(
        "is_duplicate_drop", F.col("duplicate_rank") > keep
    )


def number_groups(rows: DataFrame) -> DataFrame:
    """``duplicate_group`` 1..G in order of the smallest member.  One row a group is
    numbered, in ranges of the order whose counts alone meet in one place."""
    names = rows.select("component").distinct().repartitionByRange("component").sortWithinPartitions("component")
    names = Table(names.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "groups").df
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = names.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before")
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    names = names.join(F.broadcast(before), "_part").select(  # one row a partition
        "component", (F.col("_before") + inside + 1).cast("int").alias("duplicate_group")
    )
    return rows.join(names, "component")


def token_simhash(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, simhash``: sign of each of 63 bits summed over a text's distinct
    tokens; bits travel as one array, summed by element."""
    tokens = df.select(
        key, F.explode(F.array_distinct(F.split(F.btrim(text, F.lit(" \t\n\r")), r"[ \t\n\r]+"))).alias("t")
    ).withColumn("m", F.md5("t"))
    half = lambda at: F.conv(F.substring("m", at, 8), 16, 10).cast("long")
    tokens = tokens.select(key, half(1).alias("hi"), half(9).alias("lo"))
    bit = lambda k: F.shiftright("lo" if k < 32 else "hi", k % 32).bitwiseAND(F.lit(1))
    sums = tokens.groupBy(key).agg(
        F.count("*").alias("n"), *(F.sum(bit(k)).alias(f"b{k}") for k in range(63))
    )
    value = F.lit(0).cast("long")
    for k in range(63):
        value = value + F.when(2 * F.col(f"b{k}") > F.col("n"), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return sums.select(key, value.alias("simhash"))
