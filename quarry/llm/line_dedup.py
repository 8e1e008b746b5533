"""Line dedup across documents (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.base import WS_CHARS, Table, carried, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case.

    ``lower`` maps exactly A-Z in a line of ASCII characters and is much faster
    than ``translate``, which does the others.
    """
    bare = F.btrim(line, F.lit(WS_CHARS))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, UPPER, LOWER)
    )


def line_dedup(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Drop lines that many documents share, but for one document's copy.

    Lines are exploded with their position; a normalised line of at least
    ``min_chars`` code points is hashed to 128 bits.  Keys found in at least
    ``min_docs`` documents lose all their lines, except in the largest doc_id
    that holds them.  What stays is joined by ``\\n`` in its old order.

    Only (key, row, position) move to count a key, by a partial aggregation; a
    text moves once, to meet the positions it loses, which are taken out by a hash
    set: the work grows with a text's lines, not with their square.  The join that
    brings a hot key's verdict to its lines is one whose skewed partitions Spark
    can split.

    Returns ``doc_id, n_lines, n_dropped, kept_text`` and ``carry`` per input row.
    Defined cases: a null or empty text is one empty line; a document holding a
    key in several lines, or in several rows of its id, counts once; rows without
    id count for no key and hold none, but lose their shared lines; rows repeated
    under one id are each returned, with the lines of its own text; of equal
    lines the largest id decides, so there are no ties; an array holds the lines
    of one text, so a very long text needs memory for itself a few times; an empty
    table gives no rows; other columns, whatever their names, are read only as
    ``carry``.
    """
    there, back = carried(carry)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("body"), *there)
    at = F.xxhash64("doc_id", "body")  # with doc_id, names the row
    lines = (
        rows.select("doc_id", at.alias("row"), F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            "doc_id", "row", "pos",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"),
        )
    )
    table = Table(lines, "lines")
    shared = (
        table.df.groupBy("h1", "h2")
        .agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("holder"))
        .where(F.col("n") >= min_docs)
    )
    keys = Table(shared, "shared-keys")
    hits = Table(
        table.df.join(keys.df, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("holder")))
        .select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row"), "pos"),
        "shared-lines",
    )
    table.drop()
    keys.drop()
    gone = hits.df.groupBy("gone_id", "gone_row").agg(F.collect_set("pos").alias("gone"))
    kept = F.expr("transform(array_except(sequence(0, size(lines) - 1), gone), p -> lines[p])")
    return (
        rows.withColumn("row", at)
        .join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row")), "left")
        .withColumn("lines", F.split("body", "\n", -1))
        .select(
            "doc_id",
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.col("body"))
            .otherwise(F.array_join(kept, "\n"))
            .alias("kept_text"),
            *back,
        )
    )


SQL = """
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), k as (
  select doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l
), s as (
  select key, max(doc_id) as holder from k where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), m as (
  select k.doc_id, k.pos, k.line, s.key is not null and k.doc_id <> s.holder as gone
  from k left join s on k.key = s.key
)
select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""
