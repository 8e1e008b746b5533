"""Chat formatting by perspective rotation (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.base import Table

#: Turns rendered in one row at most: a longer dialogue goes on in further blocks.
BLOCK = 256
#: Roles that give instructions and never speak as the assistant.
FIXED = ("system",)
END = "<|end|>\n"


def safe_role(role: Column) -> Column:
    """The role without characters that could end a marker, in percent code."""
    for c in "%<|>\n\r":
        role = F.replace(role, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return role


def safe_text(text: Column) -> Column:
    """The text with one more backslash in what could begin a marker: no text forges
    a turn, and one backslash less gives it back."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def rotate_perspectives(
    turns: DataFrame, block: int = BLOCK, fixed: tuple[str, ...] = FIXED
) -> DataFrame:
    """Render every dialogue once for each of its participants.

    ``conv_id, perspective, block, offset, n_turns, rendered, masks``: in the
    rendering for a participant, their turns are the assistant's, those of others
    are the user's under their name, and turns of ``fixed`` roles keep their role.
    ``masks`` has the (start, length) in characters of what the assistant says,
    the part to train on; everything else is masked.  Markers in texts and names
    are escaped (``safe_text``, ``safe_role``).

    A dialogue is rendered in blocks of ``block`` turns at most, so that one with a
    third of all rows is many rows for many tasks: first by turn number, then by
    place among turns of near numbers.  Blocks in order concatenate to the whole
    dialogue; masks count from the start of their block, and ``offset`` says where
    it stands in the whole.  Offsets come from lengths alone, without texts.

    Defined cases: a null role is the participant "unknown"; a null text is
    empty; null turns stand before all others; equal turn numbers stand in order
    of role and text; repeated rows are rendered each time; a dialogue of fixed
    roles only has no participants and no rows; a null conv_id is one dialogue; a
    very long text is one turn of its block; an empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        safe_text(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"),
    ).withColumn("span", F.coalesce(F.floor(F.col("turn") / block), F.lit(-1)).cast("long"))
    near = Window.partitionBy("conv_id", "span").orderBy("turn", "role", "text")
    rows = Table(
        rows.withColumn("part", F.floor((F.row_number().over(near) - 1) / block).cast("long"))
        .withColumn("size", F.length("text") + len(END)),
        "chat-turns",
    ).df
    at = ["conv_id", "span", "part"]
    marker = lambda r: F.concat(F.lit("user name="), safe_role(r))
    other = F.when(F.col("role").isin(*fixed), F.col("role")).otherwise(marker(F.col("role")))
    said = rows.groupBy(*at, "role").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    said = said.withColumn("head", F.length(other) + 5)
    sizes = said.groupBy(*at).agg(F.sum(F.col("size") + F.col("n") * F.col("head")).alias("plain"))
    people = (
        said.where(~F.col("role").isin(*fixed))
        .select(F.col("conv_id").alias("p_conv"), F.col("role").alias("perspective"), "head").distinct()
    )
    own = said.select(*(F.col(c).alias(f"o_{c}") for c in (*at, "role", "n")))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    spoken = F.col("plain") + F.coalesce("o_n", F.lit(0)) * (len("assistant") + 5 - F.col("head"))
    upto = Window.partitionBy("conv_id", "perspective").orderBy("span", "part")
    seats = (
        sizes.join(people, same("conv_id", "p_conv"))
        .join(
            own,
            same("conv_id", "o_conv_id") & (F.col("span") == F.col("o_span")) & (F.col("part") == F.col("o_part"))
            & (F.col("perspective") == F.col("o_role")),
            "left",
        )
        .select(
            F.col("conv_id").alias("s_conv"), F.col("span").alias("s_span"), F.col("part").alias("s_part"), "perspective",
            (F.row_number().over(upto) - 1).cast("long").alias("block"),
            (F.sum(spoken).over(upto) - spoken).alias("offset"),
        )
    )
    blocks = rows.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    named = F.transform(
        "turns",
        lambda t: F.struct(
            t["role"].alias("role"), t["text"].alias("text"),
            F.when(t["role"].isin(*fixed), t["role"]).otherwise(marker(t["role"])).alias("name"),
        ),
    )
    return (
        blocks.withColumn("turns", named)
        .join(seats, same("conv_id", "s_conv") & (F.col("span") == F.col("s_span")) & (F.col("part") == F.col("s_part")))
        .withColumn(
            "parts",
            F.expr(
                "transform(turns, t -> struct(concat('<|', if(t.role = perspective, 'assistant', t.name), '|>\\n') as head, "
                "concat(t.text, '<|end|>\\n') as body, t.role = perspective as own))"
            ),
        )
        .withColumn("ends", F.expr("transform(parts, p -> length(p.head) + length(p.body))"))
        .withColumn(
            "starts",
            F.expr(
                "aggregate(ends, struct(0 as at, cast(array() as array<int>) as starts), "
                "(s, n) -> struct(s.at + n as at, concat(s.starts, array(s.at)) as starts), s -> s.starts)"
            ),
        )
        .select(
            "conv_id", "perspective", "block", "offset",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.expr("transform(parts, p -> concat(p.head, p.body))"), "").alias("rendered"),
            F.expr(
                "filter(zip_with(parts, starts, (p, s) -> if(p.own, named_struct('start', s + length(p.head), "
                "'length', length(p.body)), null)), x -> x is not null)"
            ).alias("masks"),
        )
    )


SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, 'unknown') as role, regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\1\\|', 'g') as text,
    coalesce(floor(turn / 256), -1)::bigint as span from conversations
), n as (
  select *, (row_number() over (partition by conv_id, span order by turn nulls first, role, text) - 1) // 256 as part from t
), p as (select distinct conv_id, role as perspective from t where role <> 'system'),
r as (
  select n.*, perspective, role = perspective as own,
    dense_rank() over (partition by n.conv_id, perspective order by span, part) - 1 as block,
    '<|' || case when role = perspective then 'assistant' when role = 'system' then role
      else 'user name=' || replace(replace(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '|', '%7C'), '>', '%3E'), chr(10), '%0A'), chr(13), '%0D') end
      || '|>' || chr(10) as head, text || '<|end|>' || chr(10) as body
  from n join p on n.conv_id is not distinct from p.conv_id
), a as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, perspective
    order by span, part, turn nulls first, role, text rows between unbounded preceding and current row)
    - length(body) - length(head) as start
  from r
), b as (select *, min(start) over (partition by conv_id, perspective, block) as first from a)
select conv_id, perspective, block::bigint as block, first::bigint as "offset", count(*)::bigint as n_turns,
  string_agg(head || body, '' order by turn nulls first, role, text) as rendered,
  coalesce(string_agg((start - first + length(head))::varchar || '+' || length(body), ',' order by turn nulls first, role, text) filter (own), '') as masks
from b group by conv_id, perspective, block, first
"""
