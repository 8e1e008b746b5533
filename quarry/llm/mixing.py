"""Mixing sources to target weights by systematic sampling (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.base import Table, as_row, text_or_empty, words_pattern

#: Weights of the sources in code-point order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MAX_REPEAT = 3
#: Documents of one size class are dealt over so many blocks by id.
BLOCKS = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Water filling: a source's share is its weight times a level, capped at
    ``max_repeat`` times its size.  With sources ordered by cap per weight the
    capped ones are a prefix, so the level has a closed form.  One row a source.
    """
    every = Window.partitionBy()
    turn = F.expr(f"array({','.join(map(str, weights))})")
    before = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("no")
    ).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", F.get(turn, (F.col("no") - 1) % len(weights)).cast("long"))
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "level",
            (F.col("all_size") - F.col("cap_before")).cast("double")
            / (F.col("all_weight") - F.col("weight_before")),
        )
    )
    # the level is that of the first source, by cap per weight, whose cap it doesn't reach
    fits = F.when(
        F.col("cap") >= F.col("level") * F.col("weight"),
        F.struct((F.col("cap") / F.col("weight")).alias("by"), "no", "level"),
    )
    return ranked.withColumn("level", F.min(fits).over(every)["level"]).select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def _measured(docs: DataFrame, blocks: int, *more: Column) -> Table:
    """Sizes and the place of each row in its source: written once, so that a row's
    number ``rid`` stays its own."""
    text = text_or_empty()
    return Table(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text, F.lit(words_pattern())).cast("long").alias("size"),
            F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("ident"),
            *more,
        )
        .withColumn("bits", F.length(F.bin("size")))
        .withColumn(
            "class", F.col("bits") * 8 + F.expr("shiftright(size, greatest(bits - 3, 0))")
        )
        .withColumn("block", F.pmod("ident", F.lit(blocks)))
        .withColumn("rid", F.monotonically_increasing_id())
        .drop("bits"),
        "mix-sizes",
    )


def _copies(sizes: DataFrame, weights, max_repeat: int, seed: int) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, rid`` of measured rows."""
    cell = ["source", "class", "block"]
    targets = source_targets(sizes, weights, max_repeat)
    upto = Window.partitionBy("source").orderBy("class", "block")
    cells = (
        sizes.groupBy(*cell)
        .agg(F.count("*").alias("n"))
        .withColumn("n_before", F.sum("n").over(upto) - F.col("n"))
        .drop("n")
    )
    unit = F.conv(
        F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("source"))), 1, 8), 16, 10
    ).cast("double") / F.lit(4294967296.0)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    by_source = targets.withColumnRenamed("source", "t_source")
    starts = cells.join(by_source, F.col("source").eqNullSafe(F.col("t_source"))).select(
        *cell, "n_before", "source_size", "target",
        expected.alias("expected"), unit.alias("offset"),
    )
    inside = Window.partitionBy(*cell).orderBy("ident", "doc_id", "rid")
    ranked = sizes.select(*cell, "doc_id", "size", "rid", F.row_number().over(inside).alias("k")).alias("r")
    at = lambda k: F.floor(k * F.col("expected") + F.col("offset"))
    k = F.col("n_before") + F.col("k")
    return (
        ranked.join(
            starts.alias("s"),
            F.col("r.source").eqNullSafe(F.col("s.source"))
            & (F.col("r.class") == F.col("s.class"))
            & (F.col("r.block") == F.col("s.block")),
        )
        .withColumn("copies", (at(k) - at(k - 1)).cast("long"))
        .select("doc_id", "r.source", "size", "source_size", "target", "copies", "rid")
    )


def mix_plan(
    docs: DataFrame,
    weights=WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: int = 42,
    blocks: int = BLOCKS,
) -> DataFrame:
    """How often the mix takes each document: ``doc_id, source, size,
    source_size, target, copies``.

    Systematic sampling: within a source every document expects
    target / source_size copies.  Their prefix sum, moved by one random offset
    of the source (from ``seed`` and its name), crosses an integer ``copies``
    times at the document.  Documents stand in order of size class, so the words
    taken stay near the target whatever the sizes.

    The prefix sum is taken in two steps, so that a source with a third of all
    rows isn't one task: row numbers inside (source, size class, id modulo
    ``blocks``), then a running sum over those blocks' counts, of which a source
    has a bounded number.  The targets take one row a source in one task.  Sizes
    are counted once and kept in the shared folder; texts don't move.

    Defined cases: a null text has size 0; a null source is a source, last in
    order; a source of size 0 has target 0 and no copies; rows without id stand
    in order of a hash of their text; repeated rows are separate documents, rows
    of one id and text alike in all but the order in which they are met; a very
    long text is counted whole; an empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    sizes = _measured(docs, blocks).df
    return _copies(sizes, weights, max_repeat, seed).drop("rid")


def mix(
    docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 42, blocks: int = BLOCKS
) -> DataFrame:
    """The mixed documents themselves: each row as often as the plan takes it.

    Same columns as ``docs``, whatever their names: a row travels as one struct.
    It is written with its sizes and meets the number of its copies in one join;
    what is sorted to find that number has no texts.  Defined cases as for
    ``mix_plan``.
    """
    rows = _measured(docs, blocks, as_row(docs)).df
    plan = Table(_copies(rows, weights, max_repeat, seed).where("copies > 0").select("rid", "copies"), "mix-copies").df
    return (
        rows.select("rid", "_row").join(plan, "rid")
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
        .select("_row.*")
    )


SQL = """
with s as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size
  from documents
), c as (
  select *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)) as class, doc_id % 1024 as block from s
), t as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as no
  from s group by source
), w as (
  select *, case (no - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, source_size * 3 as cap from t
), l as (
  select *, (sum(source_size) over ()
      - coalesce(sum(cap) over (order by cap / weight, no rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over ()
      - coalesce(sum(weight) over (order by cap / weight, no rows between unbounded preceding and 1 preceding), 0)) as level
  from w
), g as (
  select source, source_size,
    least(cap::double, (select level from l where cap >= level * weight order by cap / weight, no limit 1) * weight) as target
  from l
), e as (
  select *, case when source_size > 0 then target / source_size else 0.0 end as expected,
    ('0x' || substr(md5(concat_ws('|', '42', source)), 1, 8))::bigint / 4294967296.0::double as offs
  from g
), r as (
  select c.doc_id, c.size, e.source_size, e.target, e.expected, e.offs,
    row_number() over (partition by c.source order by c.class, c.block, c.doc_id) as k
  from c join e on c.source is not distinct from e.source
)
select doc_id, size, source_size, target,
  ((floor(k * expected + offs) - floor((k - 1) * expected + offs)) * size)::bigint as taken
from r
"""
