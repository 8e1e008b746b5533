"""Quality rules by distribution divergence (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.base import WS, WS_CHARS, Table, text_or_empty

#: Frequent function words per language.
COMMON = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "on", "it", "for", "was"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
#: Character classes by regex; white space is counted by difference, the rest is one more class.
CLASSES = {
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "point": r"""[.,;:!?'"()\-]""",
    "symbol": "[#*$%&|<>]",
    "accent": "[À-ɏ]",
}
WINDOW = 8
#: Words below which a histogram says too little, and the largest distances kept.
MIN_WORDS, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 40, 0.17, 0.4


def _features(docs: DataFrame) -> DataFrame:
    """Counts per document.  Each step is a projection of its own, so that the
    array of words is built once."""
    body = F.col("body")
    bare = F.btrim(body, F.lit(WS_CHARS))
    # hashes of 8 words from those of 4, 2 and 1; each is an array of its own
    twice = lambda c, by: F.expr(f"zip_with({c}, slice({c}, {by + 1}, n_words), (a, b) -> xxhash64(a, b))")
    phrases = F.expr(
        f"transform(sequence(1, n_words - {WINDOW - 1}), "
        f"i -> struct(array_join(slice(words, i, {WINDOW}), ' ') as w, i as i))"
    )
    table = F.create_map(
        *(x for k, v in COMMON.items() for x in (F.lit(k), F.array(*(F.xxhash64(F.lit(w)) for w in v))))
    )
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise(F.lit("other")).alias("lang"),
            text_or_empty().alias("body"),
        )
        .withColumn(
            "words", F.when(bare != "", F.split(bare, f"[{WS}]+", -1)).otherwise(F.expr("cast(array() as array<string>)"))
        )
        .withColumn("lines", F.filter(F.split(body, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{WS}]"))))
        .withColumn("n_words", F.size("words"))
        .withColumn("word_chars", F.length(F.array_join("words", "")))
        # what is left without the most frequent classes is short
        .withColumn("odd", F.regexp_replace(body, f"[a-z{WS}]+", ""))
        .withColumn("h1", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn("h2", F.when(F.col("n_words") > WINDOW, twice("h1", 1)))
        .withColumn("h4", twice("h2", 2))
        # without an equal pair of 4 words there is none of 8
        .withColumn("h8", F.when(F.size(F.array_distinct("h4")) < F.size("h4"), twice("h4", 4)))
        .withColumn("windows", F.expr(f"slice(h8, 1, n_words - {WINDOW - 1})"))
    )
    counted = rows.select(
        "doc_id", "lang", "n_words", "word_chars", "words", "h1",
        F.length("body").alias("n_chars"),
        *(F.regexp_count("odd", F.lit(p)).alias(f"c_{c}") for c, p in CLASSES.items()),
        (F.col("word_chars") - F.length("odd")).alias("c_lower"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(
            (F.col("n_words") > WINDOW) & (F.size(F.array_distinct("windows")) < F.size("windows")),
            F.sort_array(phrases),
        ).alias("sorted"),
        table[F.col("lang")].alias("common"),
    )
    # windows equal to a neighbour in order; their places; the words they cover
    return (
        counted.withColumn(
            "same", F.expr("zip_with(sorted, slice(sorted, 2, size(sorted)), (a, b) -> coalesce(a.w = b.w, false))")
        )
        .withColumn(
            "places",
            F.expr(
                "sort_array(filter(zip_with(sorted, zip_with(same, concat(array(false), same), (a, b) -> "
                "coalesce(a, false) or coalesce(b, false)), (x, y) -> if(y, x.i, null)), x -> x is not null))"
            ),
        )
        .withColumn(
            "n_repeat_words",
            F.expr(
                f"coalesce(aggregate(zip_with(places, slice(places, 2, size(places)), "
                f"(x, y) -> if(x is null, 0, least({WINDOW}, coalesce(y - x, {WINDOW})))), 0, (s, x) -> s + x), 0)"
            ),
        )
        .withColumn("hits", F.expr("transform(common, c -> n_words - size(array_remove(h1, c)))"))
        .select(
            "doc_id", "lang",
            *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars")),
            F.col("c_symbol").cast("long").alias("n_symbols"),
            *(F.col(c).cast("long").alias(c) for c in ("n_dup_lines", "n_repeat_words")),
            _shares([F.col(f"c_{c}") for c in ("lower", *CLASSES)] + [F.col("n_chars") - F.col("word_chars")], "n_chars").alias("char_shares"),
            F.when(F.col("common").isNotNull(), _shares([F.get("hits", F.lit(i)) for i in range(12)], "n_words")).alias("word_shares"),
        )
    )


def _shares(counts: list[Column], total: str) -> Column:
    """Each count over the total, and the rest of it."""
    rest = F.col(total)
    for c in counts:
        rest = rest - c
    whole = F.greatest(F.col(total), F.lit(1))
    return F.array(*((F.greatest(c, F.lit(0)) / whole).cast("double") for c in [*counts, rest]))


def jensen_shannon(p: str, q: str) -> Column:
    """Jensen-Shannon distance, in bits, of two columns of shares (0 to 1)."""
    part = "if({0} > 0, {0} * log2(2 * {0} / (x + y)), 0D)"
    return F.expr(
        f"sqrt(greatest(0D, aggregate(zip_with({p}, {q}, (x, y) -> "
        f"({part.format('x')} + {part.format('y')}) / 2), 0D, (s, z) -> s + z)))"
    )


def quality_rules(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Base counts and a verdict per document: ``doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance,
    word_distance``.

    A document's shares of character classes and of its language's frequent
    words are compared with the language's reference by Jensen-Shannon distance;
    beyond either limit it isn't kept.  References are the mean shares over all
    documents of the language that pass the base rules, taken twice: the second
    time over those that the first references keep.  Documents of other
    languages share one reference, for characters only.  Under ``min_words``
    words the histograms say too little, and only the base rules decide.

    One pass writes the counts (some hundred bytes a document, whatever its
    length) to the shared folder; references are a partial aggregation of five
    rows at most, which makes them safe to broadcast.  Nothing moves texts.

    Defined cases: a null text has no words and fails the base rules; a null or
    unknown language is "other"; repeated rows are judged alike; an empty table
    gives no rows; other columns are not read.
    """
    base = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    rows = Table(_features(docs).withColumn("base_failed", base), "quality-counts").df
    sizes = {"char_shares": len(CLASSES) + 3, "word_shares": 13}
    means = [F.avg(F.get(c, F.lit(i))).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > max_word_distance
    )

    def judged(among: DataFrame) -> DataFrame:
        references = (
            among.where(~F.col("base_failed") & (F.col("n_words") >= min_words)).groupBy("lang").agg(*means)
            .select("lang", *(F.array(*(F.col(f"{c}_{i}") for i in range(n))).alias(f"mean_{c}") for c, n in sizes.items()))
        )
        return (
            rows.join(F.broadcast(references), "lang", "left")
            .withColumn("char_distance", jensen_shannon("char_shares", "mean_char_shares"))
            .withColumn("word_distance", jensen_shannon("word_shares", "mean_word_shares"))
            .withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") < min_words) | ~far))
        )

    # what the first references reject has no part in the second
    first = judged(rows).where("kept").select(*rows.columns)
    return (
        judged(first)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept", "char_distance", "word_distance",
        )
    )


def sql() -> str:
    """The contract's columns in DuckDB SQL, with the default limits."""
    classes = {**CLASSES, "accent": "[À-ɏ]"}
    counts = ", ".join(f"len(regexp_extract_all(body, '{p.replace(chr(39), chr(39) * 2)}')) as c_{c}" for c, p in classes.items())
    common = " ".join(
        f"when '{k}' then [{', '.join(repr(w) for w in v)}]" for k, v in sorted(COMMON.items())
    )
    sizes = {"chars": len(CLASSES) + 3, "words": 13}
    means = ", ".join(
        f"[{', '.join(f'avg({c}_shares[{i + 1}])' for i in range(n))}] as {c}_mean" for c, n in sizes.items()
    )
    part = "case when {0} > 0 then {0} * log2(2 * {0} / (x + y)) else 0 end"
    distance = lambda c: (
        f"(select sqrt(greatest(0, sum(({part.format('x')} + {part.format('y')}) / 2))) "
        f"from (select unnest({c}_shares) as x, unnest({c}_mean) as y))"
    )
    shares = ", ".join(f"c_{c}" for c in ("lower", *CLASSES))
    judge = lambda source: (
        f"select s.*, not base_failed and (n_words < {MIN_WORDS} or not (coalesce({distance('chars')}, 0) > {MAX_CHAR_DISTANCE} "
        f"or coalesce({distance('words')}, 0) > {MAX_WORD_DISTANCE})) as kept from s left join {source} using (lang)"
    )
    reference = lambda source: (
        f"select lang, {means} from {source} where not base_failed and n_words >= {MIN_WORDS} group by lang"
    )
    return rf"""
with d as (
  select doc_id, case when lang in ({', '.join(repr(k) for k in COMMON)}) then lang else 'other' end as lang,
    coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[^{WS}]+') as words from documents
), l as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(body, chr(10))) as line from d)
  where regexp_matches(line, '[^{WS}]') group by doc_id
), w as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as phrase
  from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from d where len(words) > 8)
), r as (
  select doc_id, i from w qualify count(*) over (partition by doc_id, phrase) > 1
), n as (
  select doc_id, sum(least(8, coalesce(after - i, 8))) as n_repeat_words
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as after from r) group by doc_id
), c as (
  select doc_id, lang, words, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    length(body) as n_chars, {counts}, len(regexp_extract_all(body, '[a-z]')) as c_lower,
    case lang {common} end as common from d
), s as (
  select c.*, coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    n_words < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * n_words as base_failed,
    list_transform(list_concat([{shares}, n_chars - word_chars],
      [n_chars - list_sum([{shares}, n_chars - word_chars])]), lambda x: greatest(x, 0) / greatest(n_chars, 1)) as chars_shares,
    case when common is not null then list_transform(list_concat(
      list_transform(common, lambda x: len(list_filter(words, lambda y: y = x))),
      [n_words - len(list_filter(words, lambda y: list_contains(common, y)))]), lambda x: x / greatest(n_words, 1)) end as words_shares
  from c left join l using (doc_id) left join n using (doc_id)
), m1 as ({reference('s')}), k1 as ({judge('m1')}),
m2 as ({reference('k1 where kept').replace('where kept where', 'where kept and')}), k2 as ({judge('m2')})
select doc_id, n_words, word_chars, c_symbol::bigint as n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from k2
"""
