"""Exact dedup by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.base import WS, Table


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    head_chars: int = 64,
    width: int = 4096,
    growth: int = 16,
) -> DataFrame:
    """Group documents with equal texts; of each group the smallest id stays.

    Texts are compared after each run of ASCII white space became one space.
    The text is read as a string of digits, most significant first: the first
    digit is the first ``head_chars`` characters, the next ones are ``width``
    bytes, ``growth`` times more in each round, so that a text of n bytes has about
    log n rounds and moves little more than n bytes in them all.  A round
    splits every open group by its next digit.  A document alone in its group
    is done, and so is a group whose texts have ended; what remains goes on with
    the bytes after the digit.  Groups are equal because all their bytes were
    compared: no digest decides.

    Groups are counted by a partial aggregation, so a hot group reaches the
    shuffle as one row a task; the counts return to the documents by a sort-merge
    join, the same plan at every size, whose skewed partitions Spark can split.  Each round is written to the
    shared folder, and a round moves only documents that still have a twin.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  Defined cases: a null text is an empty one; null ids sort
    last and match the group they are in, with ``keep_id`` null only if the whole
    group has no id; rows repeated under one id are one document, each counted
    in ``group_size`` and all with that document's verdict; a text is compared
    whole, however long; an empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    source = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # an id that compares null ones last
    ident = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").cast("long").alias("value"))
    head = F.regexp_extract(source, rf"^(?:[^{WS}]|[{WS}]++){{0,{head_chars}}}+", 0)
    squeeze = lambda c: F.regexp_replace(c, f"[{WS}]+", " ")
    keyed = docs.select(
        ident.alias("id"),
        source.alias("source"),
        head.alias("head"),
    ).select(
        "id",
        "source",
        squeeze(F.col("head")).alias("digit"),
        (F.octet_length("head") == F.octet_length("source")).alias("ended"),
    )
    groups = Table(
        keyed.groupBy("digit", "ended")
        .agg(F.count("*").alias("n"), F.min("id").alias("first"))
        .where("n > 1")
        .withColumn("node", F.monotonically_increasing_id()),
        "radix-heads",
    )
    texts = keyed.select(
        "id", "digit", "ended", squeeze(F.col("source")).alias("norm")
    ).withColumn("sha", F.sha2(F.col("norm"), 256))
    open_text = F.expr(
        "case when n is not null and not ended "
        "then substring(cast(norm as binary), octet_length(digit) + 1) end"
    )
    keep = F.expr("case when n is null then id when ended then first end")
    level = Table(
        texts.join(groups.df.hint("merge"), ["digit", "ended"], "left").select(
            "id",
            "sha",
            F.monotonically_increasing_id().alias("rid"),
            "node",
            keep.alias("keep"),
            F.coalesce("n", F.lit(1)).alias("n"),
            open_text.alias("rest"),
        ),
        "radix-level",
    )
    groups.drop()
    done = []
    while True:
        done.append(level.df.where("rest is null").select("id", "sha", "keep", "n"))
        still = level.df.where("rest is not null")
        if still.isEmpty():
            break
        digits = still.select(
            "id",
            "sha",
            "rid",
            "node",
            F.expr(f"substring(rest, 1, {width})").alias("digit"),
            (F.octet_length("rest") <= width).alias("ended"),
            F.expr(f"substring(rest, {width + 1})").alias("tail"),
        )
        split = digits.groupBy("node", "digit", "ended").agg(
            F.count("*").alias("n"), F.min("id").alias("first"), F.min("rid").alias("next")
        )
        counted = Table(split, "radix-split")
        level = Table(
            digits.join(counted.df.hint("merge"), ["node", "digit", "ended"]).select(
                "id",
                "sha",
                "rid",
                F.col("next").alias("node"),
                F.expr("case when n = 1 then id when ended then first end").alias("keep"),
                "n",
                F.expr("case when n > 1 and not ended then tail end").alias("rest"),
            ),
            "radix-level",
        )
        counted.drop()
        width *= growth
    rows = reduce(DataFrame.unionByName, done)
    return rows.select(
        F.col("id.value").alias("doc_id"),
        F.col("keep.value").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("id") == F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
