"""N-gram Jaccard self-join by adaptive multi-match prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.base import Table, give_back, small_batches
from quarry.operators.components import components
from quarry.llm.shingles import batch_word_hashes, normal, shingle_hashes, shingle_set

#: A list of frequent shingles with their estimated number of documents is
#: broadcast to order prefixes; it has so many entries at most (2 MB).  It
#: decides only which shingles stand last in a prefix, never what is found.
FREQUENT = 1 << 17
#: Shingles counted together when frequent ones are looked for, and how many of
#: them such a chunk reports at most.
CHUNK, REPORT = 1 << 22, 1 << 13
#: Postings of a frequent shingle are spread over so many tasks.
SALT = 64
#: ell is 1 + size // ELL[i], the first whose prefix costs less than COSTLY
#: estimated candidates, or else 1.
ELL, COSTLY = (32, 128), 64
#: Texts of one component, and their bytes, that are compared with each other at a
#: time; a larger component is compared block by block.
BLOCK, BLOCK_BYTES = 512, 1 << 22
#: Shingles whose columns are multiplied at a time.
COLUMNS = 4096


def unmatched(n: int, num: int, den: int) -> int:
    """How many of n shingles a partner may lack: n - ceil(n * num / den)."""
    return n - (n * num + den - 1) // den


def shingles_of(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[list, list, list]]:
    """Per Arrow batch: ids, normalised texts, sorted distinct shingle hashes."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at in range(0, len(ids), 1024):
            bodies = [normal(t) for t in batch.column(1).slice(at, 1024).to_pylist()]
            yield ids[at : at + 1024], bodies, [
                np.unique(shingle_hashes(w, k)) for w in batch_word_hashes(bodies)
            ]


def _describe(k: int) -> Callable:
    """Rows (id, size, d1, d2) of documents, and (shingle, documents) with a null
    d1 of the shingles frequent in a chunk."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[np.ndarray] = []
        seen: set[bytes] = set()
        held = 0

        def frequent() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(chunk), return_counts=True)
            often = np.flatnonzero(counts >= 3)
            often = often[np.argsort(-counts[often], kind="stable")[:REPORT]]
            none = pa.nulls(len(often), pa.int64())
            return pa.record_batch(
                [pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64)), none, none],
                ["id", "size", "d1", "d2"],
            )

        for ids, bodies, sets in shingles_of(batches, k):
            digests = [hashlib.md5(b).digest() for b in bodies]
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                ],
                ["id", "size", "d1", "d2"],
            )
            for d, s in zip(digests, sets):
                if len(s) and d not in seen:
                    seen.add(d)
                    chunk.append(s)
                    held += len(s)
            if held >= CHUNK:
                yield frequent()
                chunk, held = [], 0
                seen.clear()
        if chunk:
            yield frequent()

    return lambda batches: give_back(describe(batches))


def _post(k: int, num: int, den: int, frequent) -> Callable:
    """Rows (token, id, size, ell, pos, often) of each document's prefix."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, weights = frequent.value
        seen: set[bytes] = set()
        for ids, bodies, sets in shingles_of(batches, k):
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for i, body, s in zip(ids, bodies, sets):
                if i is None or not len(s):
                    continue
                digest = hashlib.md5(body).digest()
                if digest in seen:  # its class is found by digest
                    continue
                if len(seen) > 1 << 18:
                    seen.clear()
                seen.add(digest)
                n = len(s)
                weight = np.zeros(n, dtype=np.int64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                    weight = np.where(tokens[at] == s, weights[at], 0)
                    if weight.any():
                        order = np.lexsort((s, weight))
                        s, weight = s[order], weight[order]
                spare = unmatched(n, num, den)
                ell = 1
                for step in ELL:
                    longer = min(1 + n // step, n - spare)
                    if weight[: spare + longer].sum() < COSTLY:
                        ell = longer
                        break
                p = spare + ell
                for column, x in zip(
                    out,
                    (s[:p].view(np.int64), np.full(p, i), np.full(p, n), np.full(p, ell), np.arange(1, p + 1), weight[:p] > 0),
                ):
                    column.append(x)
            if out[0]:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(c).astype(t))
                        for c, t in zip(out, ("i8", "i8", "i4", "i4", "i4", "?"))
                    ],
                    ["token", "id", "size", "ell", "pos", "often"],
                )

    return lambda batches: give_back(post(batches))


POSTING = "token long, id long, size int, ell int, pos int, often boolean"


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by token, those whose token another posting has, and
    all of frequent tokens (they are spread over tasks).  Holds one batch and
    one row, whatever the length of a list."""
    held: pa.RecordBatch | None = None
    before = None

    def kept(batch: pa.RecordBatch, after) -> pa.RecordBatch:
        t = batch.column(0).to_numpy()
        same = t[1:] == t[:-1]
        first = np.concatenate(([before is not None and t[0] == before], same))
        last = np.concatenate((same, [after is not None and t[-1] == after]))
        often = batch.column(5).to_numpy(zero_copy_only=False)
        return batch.filter(pa.array(first | last | often))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield kept(held, batch.column(0)[0].as_py())
            before = held.column(0)[-1].as_py()
        held = batch
    if held is not None:
        yield kept(held, None)


def _verified(k: int, num: int, den: int) -> Callable:
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for i in range(len(a)):
                if last != (a[i], len(x[i])):
                    last, own = (a[i], len(x[i])), shingle_set(x[i], k)
                other = shingle_set(y[i], k)
                both = len(own & other)
                keep.append(den * both >= num * (len(own) + len(other) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(
                pa.array(keep, pa.bool_())
            )

    return lambda batches: give_back(verified(batches))


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch(
            [batch.column(0), pa.array([normal(t) for t in batch.column(1).to_pylist()], pa.binary())],
            ["id", "body"],
        )


def links_between(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which of these sorted sets of hashes link with which: products of 0/1 columns,
    some shingles at a time."""
    sizes = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate(sets)
    shingles, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = np.flatnonzero(times > 1)  # others are common to no two
    place = np.full(len(shingles), -1, np.int64)
    place[often] = np.arange(len(often))
    row, column = np.repeat(np.arange(len(sets)), sizes), place[column]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.int64)
    cuts = np.searchsorted(column, np.arange(0, len(often) + COLUMNS, COLUMNS))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - i * COLUMNS] = 1
        common += (part @ part.T).astype(np.int64)
    whole = sizes[:, None] + sizes - common
    linked = (den * common >= num * whole) & (whole > 0)
    np.fill_diagonal(linked, False)
    return linked


def _degrees(k: int, num: int, den: int) -> Callable:
    """Rows (id, n) of sorted rows (component, p, q, block, id, weight, body): how many
    documents of the other block (of the same, where p is q) each one links with."""

    def count(rows: list[tuple]) -> pa.RecordBatch:
        _, p, q, *_ = rows[0]
        sets = [np.unique(shingle_hashes(w, k)) for w in batch_word_hashes([r[6] for r in rows])]
        linked = links_between(sets, num, den)
        if p != q:
            block = np.array([r[3] for r in rows])
            linked &= block[:, None] != block
        n = linked @ np.array([r[5] for r in rows], np.int64)
        return pa.record_batch([pa.array([r[4] for r in rows], pa.int64()), pa.array(n)], ["id", "n"])

    def degrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    yield count(held)
                    held = []
                held.append(row)
        if held:
            yield count(held)

    return lambda batches: give_back(degrees(batches))


def count_degrees(members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``id, n`` from ``id, component, weight, body``: how many documents of other
    classes each class links with.  All links lie inside of components, and there
    every two classes are compared, block by block: what comes out is a number per
    class and block, never a pair.  The blocks of a large component are many tasks."""
    sizes = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("body")) / BLOCK_BYTES)).cast("int").alias("blocks"),
        F.count("*").alias("m"),
    )
    sizes = Table(sizes.where("m > 1").drop("m"), "component-sizes").df
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "weight", "body"
    )
    keys = ["component", "p", "q"]
    return (
        pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_degrees(k, num, den), "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n"))
    )


def _check(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> Table:
    """The pairs (a, b) that do link, by their shingles themselves."""
    left = texts.select(F.col("id").alias("a"), F.col("body").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("body").alias("y"))
    return Table(
        pairs.select("a", "b").join(right, "b").join(left, "a")
        .select("a", "b", "x", "y")
        .mapInArrow(_verified(k, num, den), "a long, b long"),
        "jaccard-links",
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    num: int = 80,
    den: int = 100,
    count_links: bool = False,
) -> DataFrame:
    """Link documents with Jaccard similarity of at least num / den over their
    distinct ``k``-word shingles; one row per document: ``doc_id, n_shingles,
    class_id, component_id`` and, with ``count_links``, ``n_links``: how many
    other documents it links with.

    All documents order their shingles alike: those not known to be frequent by
    hash, then the frequent ones by estimated number of documents.  A document
    indexes a prefix of (size - ceil(threshold * size)) + ell shingles; two
    documents that link share the first min(ell_a, ell_b) of their common ones
    inside both prefixes.  The prefix is lengthened as far as its estimated
    candidates stay few, and with it the number of shared prefix shingles that a
    pair needs before it is verified; where it would reach into frequent
    shingles, it stays as short as it can.

    Work follows links, not pairs.  Equal word sequences form classes by a
    128-bit digest and join as one.  Every list of a prefix shingle first offers
    only pairs with its most central document (the one whose prefix is most
    shared); after those are verified and joined into components, all pairs
    that share enough prefix shingles, near enough to the front for both sizes,
    but lie in different components are verified too, each list against its
    largest component.  So a large group of
    near copies costs about its size, and no link between components is lost.
    ``count_links`` then compares all classes inside of each component, where all
    links lie, by blocks that give numbers and no pairs (``count_degrees``).

    Lists live in sorted shuffles and are read as streams; frequent shingles are
    spread over tasks; texts meet the ids of candidates in a shuffle, and
    only candidates' texts go on.

    Defined cases: a null or empty text has no shingles and links with nothing;
    null ids link with nothing and have a null component; rows repeated under
    one id and text are one document; one id with different texts links by any of
    them; equal texts are one class, named by its smallest id; very long texts are
    hashed in pieces cut between words and compared whole; an empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    described = Table(rows.mapInArrow(_describe(k), "id long, size long, d1 long, d2 long"), "described").df
    info = described.where("d1 is not null")
    frequent = (
        described.where("d1 is null").groupBy("id").agg(F.sum("size").alias("n"))
        .orderBy(F.desc("n"), "id").limit(FREQUENT).toPandas()
    )
    frequent["id"] = frequent["id"].to_numpy(np.int64).view(np.uint64)
    frequent = frequent.sort_values("id")
    ordered = spark.sparkContext.broadcast((frequent["id"].to_numpy(np.uint64), frequent["n"].to_numpy(np.int64)))

    # classes of equal word sequences; only those of two and more are moved
    classes = (
        info.where("size > 0 and id is not null").groupBy("d1", "d2")
        .agg(F.min("id").alias("class_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    classes = Table(classes, "classes").df  # joins with it can split a hot class
    copies = Table(
        info.where("size > 0").join(classes, ["d1", "d2"]).where("id <> class_id").select("id", "class_id").distinct(),
        "copies",
    ).df

    postings = (
        rows.mapInArrow(_post(k, num, den, ordered), POSTING)
        .withColumn("salt", F.when(F.col("often"), F.pmod("id", F.lit(SALT))).otherwise(0))
        .repartition("token", "salt")
        .sortWithinPartitions("token")
        .drop("salt")
    )
    lists = Table(postings.mapInArrow(_shared_only, POSTING), "lists")
    # copies stand for their class; the more of its prefix a document shares, the
    # more central it is
    own = lists.df.join(copies, "id", "left").select(
        "token", F.coalesce("class_id", "id").alias("id"), "size", "ell", "pos"
    ).distinct()
    prefix = F.col("size") - F.floor((F.col("size") * num + den - 1) / den) + F.col("ell")
    scores = own.groupBy("id").agg((F.count("*") / F.first(prefix)).alias("score"))
    live = Table(own.join(Table(scores, "scores").df, "id"), "live").df
    lists.drop()

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = Table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidates").df
        return Table(
            rows.join(ids, "id", "left_semi").mapInArrow(_normal, "id long, body binary"), "candidate-texts"
        ).df

    fits = lambda x, y: (F.col(x) * den >= F.col(y) * num) & (F.col(y) * den >= F.col(x) * num)
    # a pair that links shares o shingles, so that the ell-th common one stands at
    # size - o + ell at the latest, in either document
    least_common = f"cast(ceil({num} * (size + a_size) / {num + den}) as int)"
    near_front = " and ".join(
        f"{x}pos <= {x}size - {least_common} + least(ell, a_ell)" for x in ("", "a_")
    )

    def by_centres() -> tuple[DataFrame, DataFrame]:
        """Components, from as few verified pairs as that takes, and the texts of all
        that were tried, so of all that link."""
        # pairs with the centre of each list
        centres = (
            live.groupBy("token").agg(F.max(F.struct("score", (-F.col("id")).alias("minus"), "size", "ell")).alias("c"), F.count("*").alias("n"))
            .where("n > 1").select("token", (-F.col("c.minus")).alias("hub"), F.col("c.size").alias("hub_size"), F.col("c.ell").alias("hub_ell"))
        )
        stars = Table(
            live.join(Table(centres, "centres").df, "token").where(F.col("id") != F.col("hub")).where(fits("size", "hub_size"))
            .groupBy(F.col("hub").alias("a"), F.col("id").alias("b"))
            .agg(F.count("*").alias("shared"), F.min(F.least("ell", "hub_ell")).alias("need"))
            .where("shared >= need"),
            "stars",
        ).df
        texts = texts_of(stars)
        near = _check(stars, texts, k, num, den).df
        first = Table(components(near), "components").df

        # what still lies in different components
        placed = live.join(first, "id", "left").select(
            "token", "id", "size", "ell", "pos", F.coalesce("component", "id").alias("component")
        )
        placed = Table(placed, "placed").df
        crowds = (
            placed.groupBy("token", "component").agg(F.count("*").alias("n"))
            .groupBy("token").agg(F.max(F.struct("n", "component")).alias("m"), F.count("*").alias("parts"))
            .where("parts > 1").select("token", F.col("m.component").alias("main"))
        )
        mixed_lists = Table(placed.join(Table(crowds, "crowds").df, "token"), "mixed-lists").df
        few = mixed_lists.where("component <> main").select(
            "token", *(F.col(c).alias(f"a_{c}") for c in ("id", "size", "ell", "pos", "component"))
        )
        cross = (
            few.join(mixed_lists, "token")
            .where("a_component <> component and (component = main or a_id < id)")
            .where(fits("size", "a_size")).where(near_front)
            .groupBy(F.least("a_id", "id").alias("a"), F.greatest("a_id", "id").alias("b"))
            .agg(F.count("*").alias("shared"), F.min(F.least("ell", "a_ell")).alias("need"))
            .where("shared >= need")
            .join(
                stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"
            )
        )
        crossed = Table(cross.select("a", "b"), "cross").df
        linked = first
        if not crossed.isEmpty():
            others = texts_of(crossed)
            more = _check(crossed, others, k, num, den).df
            if not more.isEmpty():
                linked = Table(components(near.union(more)), "components").df
                texts = texts.unionByName(others.join(texts.select("id"), "id", "left_anti"))
        return linked, texts

    linked, texts = by_centres()
    member = F.coalesce("class_id", "doc_id")
    found = (
        info.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "d1", "d2")
        .join(classes, ["d1", "d2"], "left")
        .withColumn("class_id", F.when(F.col("n_shingles") > 0, member).otherwise(F.col("doc_id")))
        .withColumn("class_id", F.when(F.col("doc_id").isNull(), None).otherwise(F.col("class_id")))
        .join(linked.withColumnRenamed("id", "class_id"), "class_id", "left")
        .select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    )
    if not count_links:
        return found
    sizes = Table(
        info.where("size > 0 and id is not null").groupBy("d1", "d2")
        .agg(F.min("id").alias("class_id"), F.countDistinct("id").alias("n"))
        .groupBy("class_id").agg(F.max("n").alias("n")),
        "class-sizes",
    ).df
    members = texts.join(linked, "id").join(sizes.withColumnsRenamed({"class_id": "id", "n": "weight"}), "id")
    others = count_degrees(members.select("id", "component", "weight", "body"), k, num, den).toDF("class_id", "m")
    counts = sizes.join(others, "class_id", "left").select(
        F.col("class_id").alias("_class"), (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("_links")
    )
    n_links = F.when(F.col("n_shingles") > 0, F.col("_links"))
    return (
        found.join(Table(counts, "link-counts").df, F.col("class_id") == F.col("_class"), "left")
        .withColumn("n_links", F.coalesce(n_links, F.lit(0)).cast("long")).drop("_class", "_links")
    )


SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), s as (
  select doc_id, list_distinct(case when len(words) = 0 then []
    when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingles
  from w
), n as (select doc_id, len(shingles)::bigint as n_shingles from s),
e as (select doc_id, unnest(shingles) as shingle from s),
r as (select shingle from e group by shingle having count(*) > 1),
p as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from e x join r using (shingle) join e y using (shingle) where x.doc_id < y.doc_id
  group by x.doc_id, y.doc_id
), l as (
  select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * common >= 80 * (na.n_shingles + nb.n_shingles - common)
), u as (select a, b from l union all select b, a from l),
c as (
  with recursive reach(doc_id, other) as (
    select doc_id, doc_id from n
    union
    select reach.doc_id, u.b from reach join u on reach.other = u.a
  ) select doc_id, min(other) as component_id from reach group by doc_id
)
select n.doc_id, n.n_shingles, c.component_id, coalesce(k.class_id, n.doc_id) as class_id, coalesce(d.n_links, 0)::bigint as n_links
from n join c using (doc_id)
left join (select doc_id, min(doc_id) over (partition by words) as class_id from (
  select doc_id, array_to_string(words, ' ') as words from w where len(words) > 0)) k using (doc_id)
left join (select a as doc_id, count(*) as n_links from u group by a) d using (doc_id)
"""
