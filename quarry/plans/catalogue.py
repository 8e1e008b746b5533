"""Queries over the star schema that exercise every operator family, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import geometry, paths
from quarry.operators import audit, dedup, matching, splits, stats, triage
from quarry.sources import readers, sinks
from quarry.tables import Table

CATALOGUE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f):
        CATALOGUE[f.__name__] = (f, sql)
        return f

    return register


@query("""
select d.source, count(*)::bigint as items, count_if(l.doc_id is null)::bigint as unlabelled
from documents d left join (select distinct doc_id from labels) l using (doc_id) group by d.source
""")
def q01_unlabelled_items(spark, sf):
    flagged = audit.flag_present(
        table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), ["doc_id"], "labelled"
    )
    return stats.flag_counts(flagged, {"unlabelled": ~F.col("labelled")}, ["source"]).withColumnRenamed("total", "items")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def q02_orphan_items(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.missing(table(spark, sf, "orders").select("o_orderkey"), lines, ["o_orderkey"])


@query("""
with c as (select o_orderkey, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey),
k as (select case when n = 0 then '无目标' when n = 1 then '单件包裹' when n <= 3 then '2-3件包裹' when n <= 6 then '4-6件包裹'
  else '多件复杂场景' end as count_class from c)
select count_class, count(*)::bigint as n, round(count(*) / sum(count(*)) over (), 6)::double as share from k group by count_class
""")
def q03_count_class_dist(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    counted = stats.counted_per(orders, lines, "key").withColumn("count_class", stats.count_class("n"))
    return stats.shares(counted, "count_class").withColumn("share", F.round("share", 6))


@query("""
select case when l_discount < 0.03 then '小尺寸' when l_discount < 0.10 then '中等尺寸' else '大尺寸' end as size_class,
  count(*)::bigint as n from lineitem group by 1
""")
def q04_size_class_dist(spark, sf):
    sized = table(spark, sf, "lineitem").withColumn("size_class", stats.size_class("l_discount"))
    return sized.groupBy("size_class").agg(F.count("*").alias("n"))


@query("""
select b.bin, count(p_partkey)::bigint as n from range(1, 13) b(bin)
left join part on floor(12 * (p_size * 3.6::double) / 180) + 1 = b.bin group by b.bin
""")
def q05_angle_bins_zero_filled(spark, sf):
    parts = table(spark, sf, "part").withColumn("angle", F.col("p_size") * F.lit(3.6))
    return stats.binned(parts, "angle", 0.0, 180.0, 12)


def _boxes(spark, sf) -> DataFrame:
    """Oriented boxes from line items, in an image of 1000 by 1000 per order."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("index"),
        (F.col("l_partkey") % 800 + 100).cast("double").alias("cx"),
        (F.col("l_suppkey") % 90 * 9 + 80).cast("double").alias("cy"),
        (F.col("l_quantity") * 4 + 10.5).alias("w"), (F.col("l_discount") * 400 + 8.37).alias("h"),
        (F.abs("l_tax") * 10).alias("angle"),
    ).withColumn("poly", geometry.box("cx", "cy", "w", "h", "angle"))


BOX_SQL = """b as (
  select l_orderkey as image, l_linenumber as index, l_partkey % 800 + 100.0::double as cx, l_suppkey % 90 * 9 + 80.0::double as cy,
    l_quantity * 4 + 10.5 as w, l_discount * 400 + 8.37 as h, abs(l_tax) * 10 as angle from lineitem
)"""


@query(f"""
with {BOX_SQL}, e as (
  select *, abs(w / 2 * cos(angle)) + abs(h / 2 * sin(angle)) as ex, abs(w / 2 * sin(angle)) + abs(h / 2 * cos(angle)) as ey from b
)
select image, index, round(w * h, 3) as area, round(degrees(angle) + case when w < h then 90 else 0 end, 3) as axis,
  round(greatest(w, h) / least(w, h), 4) as ratio, round(cx, 3) as x,
  cx - ex <= 35 or cy - ey <= 35 or cx + ex >= 965 or cy + ey >= 965 as at_edge,
  w * h / 1000000 <= 0.005 as small, greatest(w, h) / least(w, h) >= 3.5 as extreme
from e
""")
def q06_obb_features(spark, sf):
    boxes = _boxes(spark, sf).withColumn("long", geometry.long_axis("poly"))
    ratio = geometry.area_ratio("poly", F.lit(1000), F.lit(1000))
    return boxes.select(
        "image", "index", F.round(geometry.area("poly"), 3).alias("area"), F.round("long.angle", 3).alias("axis"),
        F.round("long.ratio", 4).alias("ratio"), F.round(geometry.centre("poly")["x"], 3).alias("x"),
        geometry.near_edge("poly", F.lit(1000), F.lit(1000)).alias("at_edge"),
        geometry.is_small(ratio).alias("small"), geometry.extreme_aspect("w", "h").alias("extreme"),
    )


@query("""
with b as (
  select l_orderkey as image, l_linenumber as i, l_partkey % 100 as x, l_suppkey % 60 as y, l_quantity as w, l_quantity + 5 as h
  from lineitem
), p as (
  select a.image, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y))
    / greatest(1, least(a.w * a.h, b.w * b.h)) as o
  from b a join b on a.image = b.image and a.i < b.i
)
select image, count(*)::bigint as pairs, count_if(o >= 0.15)::bigint as overlapping, bool_or(o > 0.15) as has_overlap,
  round(count_if(o >= 0.15) / count(*), 6) as overlap_pair_ratio
from p group by image
""")
def q07_pair_overlap(spark, sf):
    boxes = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("index"),
        (F.col("l_partkey") % 100).alias("x"), (F.col("l_suppkey") % 60).alias("y"), F.col("l_quantity").alias("w"),
    )
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    poly = boxes.withColumn("poly", geometry.aabb(x, y, x + w, y + w + 5))
    return matching.pair_overlaps(poly).withColumn("overlap_pair_ratio", F.round("overlap_pair_ratio", 6))


def _corners_sql(cx: str, cy: str, w: str, h: str, angle: str) -> str:
    """Corners of a box in SQL, in the order of ``geometry.box``."""
    corner = lambda i, j: (
        f"{{'x': {cx} + {w} * {i} * cos({angle}) - {h} * {j} * sin({angle}), "
        f"'y': {cy} + {w} * {i} * sin({angle}) + {h} * {j} * cos({angle})}}"
    )
    return "[" + ", ".join(corner(i, j) for i, j in ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5))) + "]"


def _common_area_sql(pairs: str, keys: str) -> str:
    """CTEs from ``pairs(keys, p, q)``, counter-clockwise quadrilaterals, to
    ``common(keys, area)``: corners of either inside the other and crossings of
    edges, in order around their middle."""
    side = lambda a, b, v: f"(({b}).x - ({a}).x) * (({v}).y - ({a}).y) - (({b}).y - ({a}).y) * (({v}).x - ({a}).x)"
    inside = lambda v, q: " and ".join(f"{side(f'{q}[{i + 1}]', f'{q}[{(i + 1) % 4 + 1}]', v)} >= -1e-9" for i in range(4))
    return f"""
edges as (
  select {keys}, p, q, p[e1] as a, p[e1 % 4 + 1] as b, q[e2] as c, q[e2 % 4 + 1] as d
  from {pairs}, range(1, 5) r(e1), range(1, 5) t(e2)
), sides as (
  select {keys}, a, b, {side('a', 'b', 'c')} as sc, {side('a', 'b', 'd')} as sd, {side('c', 'd', 'a')} as sa, {side('c', 'd', 'b')} as sb from edges
), points as (
  select {keys}, a.x + sa / (sa - sb) * (b.x - a.x) as x, a.y + sa / (sa - sb) * (b.y - a.y) as y
  from sides where sc * sd < 0 and sa * sb < 0
  union all
  select {keys}, v.x, v.y from (select {keys}, q, unnest(p) as v from {pairs}) where {inside('v', 'q')}
  union all
  select {keys}, v.x, v.y from (select {keys}, p, unnest(q) as v from {pairs}) where {inside('v', 'p')}
), around as (
  select *, avg(x) over w as mx, avg(y) over w as my, count(*) over w as n from points window w as (partition by {keys})
), ring as (
  select *, coalesce(lead(x) over w, first_value(x) over w) as nx, coalesce(lead(y) over w, first_value(y) over w) as ny
  from around window w as (partition by {keys} order by atan2(y - my, x - mx))
), common as (
  select {keys}, abs(sum((x - mx) * (ny - my) - (nx - mx) * (y - my))) / 2 as area from ring group by {keys}
)"""


#: Boxes with corners from line items.
POLY_SQL = f"""{BOX_SQL}, boxes as (select *, {_corners_sql('cx', 'cy', 'w', 'h', 'angle')} as poly from b)"""


@query(f"""
with {POLY_SQL}, pairs as (
  select row_number() over () as id, x.image, x.index as i, y.index as j, x.poly as p, y.poly as q, x.w * x.h as sp, y.w * y.h as sq
  from boxes x join boxes y on x.image = y.image and x.index < y.index
), {_common_area_sql('pairs', 'id')}
select image, i, j, round(coalesce(area, 0) / (sp + sq - coalesce(area, 0)), 6) + 0.0 as iou from pairs left join common using (id)
""")
def q08_rotated_iou(spark, sf):
    boxes = _boxes(spark, sf)
    a = boxes.select("image", F.col("index").alias("i"), F.col("poly").alias("p"))
    b = boxes.select("image", F.col("index").alias("j"), F.col("poly").alias("q"))
    return geometry.with_iou(a.join(b, "image").where("i < j"), "p", "q").withColumn("iou", F.round("iou", 6))


@query("""
select l_orderkey, count(*)::bigint as n_det, round(avg(l_discount * 10), 6) as mean_conf, round(min(l_discount * 10), 6) + 0.0 as min_conf,
  round(max(l_discount * 10), 6) + 0.0 as max_conf, round(avg((l_discount * 10 between 0.15 and 0.55)::int), 6) as uncertain_ratio,
  round(avg((l_discount * 10 < 0.15)::int), 6) as very_low_conf_ratio
from lineitem group by l_orderkey
""")
def q09_confidence_profile(spark, sf):
    pred = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_discount") * 10 + 0.0).alias("conf"))
    profile = triage.confidence_profile(pred, "l_orderkey")
    return profile.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in profile.dtypes))


def _triage_input(spark, sf) -> DataFrame:
    """Orders as images: features from keys and prices, confidences from line items."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    images = table(spark, sf, "orders").select(
        "o_orderkey",
        F.pmod(F.round(F.col("o_totalprice") * 100).cast("long"), F.lit(200)).cast("double").alias("blur_var"),
        (cust % 50 / F.lit(100.0)).alias("dark_ratio"), (cust % 40 / F.lit(100.0)).alias("bright_ratio"),
        (key % 13 != 0).alias("readable"), (key % 11 == 0).alias("is_duplicate_drop"),
        *(F.when(key % m == 0, 0.25).otherwise(0.0).alias(c) for c, m in FEATURES.items()),
    )
    pred = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_discount") * 10).alias("conf"))
    profile = triage.confidence_profile(pred, "l_orderkey").withColumnRenamed("l_orderkey", "o_orderkey")
    return triage.with_metrics(triage.quality_flags(images), profile, "o_orderkey")


#: Features of the triage query, and the divisor of the keys that have them.
FEATURES = {"edge_ratio": 5, "small_ratio": 7, "huge_ratio": 17, "overlap_pair_ratio": 19, "angled_ratio": 23, "extreme_aspect_ratio": 29}


def _triage_sql() -> str:
    terms = [(f"n_det > 0 and {m} > 0", f"{a} + {b} * {m}", why) for m, a, b, why in triage.TERMS]
    terms += [
        ("n_det = 0", "3.0", "nothing detected"), ("n_det >= 5", "least(1.5, 0.25 * (n_det - 4))", "many targets"),
        ("moderate_blur", "1.4", "moderate blur"), ("moderate_light", "1.2", "moderate lighting"),
    ]
    total = " + ".join(f"case when {on} then {value} else 0 end" for on, value, _ in terms)
    reasons = ", ".join(f"case when {on} then '{why}' end" for on, _, why in terms)
    features = ", ".join(f"case when o_orderkey % {m} = 0 then 0.25 else 0 end as {c}" for c, m in FEATURES.items())
    return f"""
with p as (
  select l_orderkey, count(*) as n_det, avg(l_discount * 10) as mean_conf, avg((l_discount * 10 between 0.15 and 0.55)::int) as uncertain_ratio,
    avg((l_discount * 10 < 0.15)::int) as very_low_conf_ratio from lineitem group by l_orderkey
), i as (
  select o_orderkey, round(o_totalprice * 100)::bigint % 200 as blur, o_custkey % 50 / 100.0::double as dark, o_custkey % 40 / 100.0::double as bright,
    {features}, coalesce(n_det, 0) as n_det, coalesce(mean_conf, 0) as mean_conf, coalesce(uncertain_ratio, 0) as uncertain_ratio,
    coalesce(very_low_conf_ratio, 0) as very_low_conf_ratio
  from orders left join p on l_orderkey = o_orderkey
), f as (
  select *, blur < 20 or dark >= 0.35 or bright >= 0.35 as fatal, blur >= 20 and blur < 80 as moderate_blur,
    (dark >= 0.12 and dark < 0.35) or (bright >= 0.10 and bright < 0.35) as moderate_light from i
), s as (
  select *, {total} as total, array_to_string(list_filter([{reasons}], lambda x: x is not null), ' | ') as why,
    n_det > 0 and mean_conf >= 0.9 and not moderate_blur and not moderate_light and uncertain_ratio = 0 and very_low_conf_ratio = 0
      and edge_ratio = 0 and small_ratio = 0 and huge_ratio = 0 and overlap_pair_ratio = 0 as easy,
    ('0x' || substr(sha1('42|' || o_orderkey), 1, 16))::ubigint::double / 18446744073709551615.0::double < 0.1 as stays from f
)
select o_orderkey,
  case when o_orderkey % 13 = 0 then -99 when fatal then -10 when o_orderkey % 11 = 0 then -5 else round(total, 3) end::double as challenge_score,
  case when o_orderkey % 13 = 0 or fatal or o_orderkey % 11 = 0 then 'DROP' when total >= 1.5 or not easy or stays then 'KEEP' else 'DROP' end as keep_drop,
  case when o_orderkey % 13 = 0 then 'unreadable' when fatal then 'low_value' when o_orderkey % 11 = 0 then 'duplicate'
    when total >= 4 then 'high_value' when total >= 1.5 or not easy or stays then 'valuable' else 'low_value' end as category,
  case when o_orderkey % 13 = 0 then 'unreadable' when fatal then 'fatal quality' when o_orderkey % 11 = 0 then 'surplus copy' else why end as reasons
from s
"""


@query(_triage_sql())
def q10_triage_score(spark, sf):
    scored = triage.score(_triage_input(spark, sf).withColumn("name", F.col("o_orderkey").cast("string")), name="name")
    return scored.select("o_orderkey", F.round("challenge_score", 3).alias("challenge_score"), "keep_drop", "category", "reasons")


@query("""
select page_id, ('0x' || substr(sha1('42|' || url), 1, 16))::ubigint::double / 18446744073709551615.0::double < 0.1 as kept from pages
""")
def q11_hash_keep(spark, sf):
    return table(spark, sf, "pages").select("page_id", paths.hash_keep("url", 0.1, 42).alias("kept"))


HASH_SQL = r"""t as (
  select doc_id, unnest(list_distinct(string_split_regex(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '[ \t\n\r]+'))) as t from documents
), m as (
  select doc_id, ('0x' || substr(md5(t), 1, 8))::bigint as hi, ('0x' || substr(md5(t), 9, 8))::bigint as lo from t
), b as (
  select doc_id, k, sum(case when ((case when k < 32 then lo >> k else hi >> (k - 32) end) & 1) = 1 then 1 else -1 end) as s
  from m, range(0, 63) r(k) group by doc_id, k
), h as (select doc_id, sum(case when s > 0 then 1::bigint << k else 0 end)::bigint as h from b group by doc_id),
g as (select h, min(doc_id) as first from h group by h),
pairs as (
  select g.first as a, h.doc_id as b, 0 as distance from h join g using (h) where h.doc_id > g.first
  union all
  select x.first, y.first, bit_count(xor(x.h, y.h))::int from g x join g y on x.first < y.first and bit_count(xor(x.h, y.h)) <= 5
)"""


def _hashes(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").where("text is not null")
    return Table(dedup.token_simhash(docs, "doc_id", "text"), "simhashes").df


@query(f"with {HASH_SQL} select a, b, distance from pairs")
def q12_simhash_pairs(spark, sf):
    return dedup.hamming_pairs(_hashes(spark, sf), "doc_id", "simhash")


@query("""
with v as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings)
select a.vec_id as a, b.vec_id as b, round(corr(a.x, b.x), 4) as correlation
from v a join v b on b.vec_id = a.vec_id + 1 and a.i = b.i group by a.vec_id, b.vec_id
""")
def q13_corr_verify(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    pairs = vectors.select(F.col("vec_id").alias("a"), (F.col("vec_id") + 1).alias("b"))
    found = dedup.verified(pairs, vectors, "vec_id", "v", least=-1.0)
    return found.withColumn("correlation", F.round("correlation", 4))


COMPONENT_SQL = f"""with recursive {HASH_SQL}, links as (select a, b from pairs union all select b, a from pairs),
reach(id, other) as (select a, a from links union select id, b from reach join links on other = a),
comp as (select id, min(other) as component from reach group by id)"""


@query(f"{COMPONENT_SQL} select id as doc_id, component from comp")
def q14_dup_components(spark, sf):
    hashes = _hashes(spark, sf)
    pairs = dedup.hamming_pairs(hashes, "doc_id", "simhash")
    return dedup.groups(hashes.select("doc_id"), pairs.select("a", "b"), "doc_id")


@query(f"""{COMPONENT_SQL}, r as (
  select doc_id, component, row_number() over (partition by component order by n_chars % 3 = 0, n_chars / 7.0 desc, n_chars * 2 desc, doc_id)::int as duplicate_rank,
    dense_rank() over (order by component)::int as duplicate_group
  from comp join documents on id = doc_id
) select doc_id, duplicate_group, duplicate_rank, duplicate_rank > 2 as is_duplicate_drop from r""")
def q15_dup_rank_keep2(spark, sf):
    hashes = _hashes(spark, sf)
    pairs = dedup.hamming_pairs(hashes, "doc_id", "simhash")
    rows = table(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") % 3 == 0).alias("fatal_quality"), (F.col("n_chars") / 7.0).alias("quality_score"),
        F.col("n_chars").alias("width"), F.lit(2).alias("height"),
    )
    ranked = dedup.number_groups(dedup.rank(dedup.groups(rows, pairs.select("a", "b"), "doc_id"), "doc_id"))
    return ranked.select("doc_id", "duplicate_group", "duplicate_rank", "is_duplicate_drop")


SPLIT_SQL = """s as (
  select doc_id, text, source, row_number() over (partition by source order by sha1('24' || doc_id)) as k, count(*) over (partition by source) as n
  from documents
), d as (
  select doc_id, text, source, case when k <= case when n <= 1 then n else greatest(1, least(floor(n * 0.8::double)::bigint, n - 1)) end
    then 'train' else 'val' end as split from s
)"""


@query(f"with {SPLIT_SQL} select doc_id, source, split from d")
def q16_stratified_split(spark, sf):
    return splits.stratified_split(table(spark, sf, "documents").select("doc_id", "source"), "source", "doc_id")


@query(f"""with {SPLIT_SQL}
select md5(text) as digest from d where split = 'train' intersect select md5(text) from d where split = 'val'""")
def q17_split_leakage(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", F.md5("text").alias("digest"))
    split = splits.stratified_split(docs, "source", "doc_id")
    return audit.leakage(split.where("split = 'train'"), split.where("split = 'val'"), ["digest"])


@query("""
select page_id, case when starts_with(lower(url), 'https://m.') then '/root/mobile/' || substr(url, 11) else url end as path,
  starts_with(lower(url), 'https://m.') as changed from pages
""")
def q18_path_rewrite(spark, sf):
    new = paths.rewrite_prefix("url", "HTTPS://M.", "/root/mobile/")
    return table(spark, sf, "pages").select("page_id", new.alias("n")).select("page_id", "n.path", "n.changed")


@query(r"""
with p as (select c_custkey, 'H:/d/images_cvat' || lpad((c_custkey % 7)::varchar, 2, '0') || '_dataset/images/' ||
  case when c_custkey % 5 = 0 then 'val' else 'train' end || '/' || c_mktsegment || '/' || c_custkey || '.jpg' as path from customer)
select c_custkey, replace(regexp_replace(path, '\.jpg$', '.txt'), '/images/', '/labels/') as label,
  regexp_extract(path, '(images_cvat[^/]+_dataset)', 1) as dataset, regexp_extract(path, '/(?:train|val)/(.+)$', 1) as relative from p
""")
def q19_path_to_label(spark, sf):
    key = F.col("c_custkey")
    path = F.concat(
        F.lit("H:/d/images_cvat"), F.lpad((key % 7).cast("string"), 2, "0"), F.lit("_dataset/images/"),
        F.when(key % 5 == 0, "val").otherwise("train"), F.lit("/"), "c_mktsegment", F.lit("/"), key.cast("string"), F.lit(".jpg"),
    )
    rows = table(spark, sf, "customer").select("c_custkey", path.alias("path"))
    return rows.select(
        "c_custkey", paths.image_to_label_path("path").alias("label"),
        paths.entry_dataset("path").alias("dataset"), paths.entry_relative("path").alias("relative"),
    )


@query("""
with e as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as i from events),
s as (select *, row_number() over (partition by user_id order by i) as k from e where i % 5 = 0)
select event_id, printf('u%d_img_%06d_frame_%08d_time_%010.3fs.jpg', user_id, k, i, i / 30.0) as name from s
""")
def q20_frame_stride(spark, sf):
    events = table(spark, sf, "events")
    frames = stats.numbered(events, ["user_id"], ["ts", "event_id"], "i").withColumn("i", F.col("i") - 1)
    picked = stats.numbered(splits.stride(frames, "i", 5), ["user_id"], ["i"], "k")
    video = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return picked.select("event_id", paths.frame_name(video, "k", "i", F.col("i") / 30.0).alias("name"))


@query("""
with recursive t as (select distinct user_id, epoch_us(ts) / 1e6 as t from events),
pick(user_id, t) as (
  select user_id, min(t) from t group by user_id
  union all
  select p.user_id, (select min(t.t) from t where t.user_id = p.user_id and t.t >= p.t + 3600) from pick p
  where exists (select 1 from t where t.user_id = p.user_id and t.t >= p.t + 3600)
) select user_id, round(t, 3) as t from pick
""")
def q21_time_spaced(spark, sf):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = table(spark, sf, "events").select("user_id", seconds.alias("t"))
    return splits.spaced(events, "user_id", "t", 3600).withColumn("t", F.round("t", 3))


PATTERNS = {"corrupt": "corrupt|invalid|error", "the": "the", "license": "licen[sc]e", "digits": "[0-9]+"}


@query("select source, " + ", ".join(f"sum(len(regexp_extract_all(text, '(?i){p}')))::bigint as {n}" for n, p in PATTERNS.items()) + " from documents group by source")
def q22_log_pattern_counts(spark, sf):
    return stats.pattern_counts(table(spark, sf, "documents"), "text", PATTERNS, ["source"])


@query("""
select event_id, case when event_id % 3 = 0 then 30000.0 / 1001 when event_id % 3 = 1 then 25.0 end as fps_rounded_from,
  (value + 1) as seconds from events
""")
def q23_json_probe(spark, sf):
    rate = F.when(F.col("event_id") % 3 == 0, "30000/1001").when(F.col("event_id") % 3 == 1, "25").otherwise("0/0")
    stream = F.struct(F.lit("h264").alias("codec_name"), F.lit("0/0").alias("avg_frame_rate"), rate.alias("r_frame_rate"), F.lit("N/A").alias("duration"))
    whole = F.struct(F.array(stream).alias("streams"), F.struct((F.col("value") + 1).cast("string").alias("duration")).alias("format"))
    rows = table(spark, sf, "events").select("event_id", F.to_json(whole).alias("probe"))
    return readers.probe(rows).select("event_id", F.col("fps").alias("fps_rounded_from"), "seconds")


def _matching_input(spark, sf) -> tuple[DataFrame, DataFrame]:
    boxes = _boxes(spark, sf).withColumn("cls", (F.col("index") % 2).cast("int")).withColumn("image", F.col("image").cast("string"))
    gt = boxes.select("image", F.col("index").alias("gt_index"), "cls", "poly")
    moved = geometry.box(F.col("cx") + F.col("index") % 4 * 2, F.col("cy") + 1, F.col("w") * 0.95, "h", F.col("angle") + 0.05)
    pred = boxes.select("image", F.col("index").alias("pred_index"), "cls", moved.alias("poly"), ((F.col("index") % 10 + 1) / 10.0).alias("conf"))
    return gt, pred


#: Ground truth, predictions, their IoU, and the greedy matches of all and of confident predictions.
MATCH_SQL = f"""{POLY_SQL}, gt as (select image::varchar as image, index as g, index % 2 as cls, poly, w * h as area, w, h, angle from boxes),
pred as (
  select image::varchar as image, index as p, index % 2 as cls, (index % 10 + 1) / 10.0 as conf, w * 0.95 * h as area, w * 0.95 as w, h, angle + 0.05 as angle,
    {_corners_sql('(cx + index % 4 * 2)', '(cy + 1)', '(w * 0.95)', 'h', '(angle + 0.05)')} as poly from boxes
), pairs as (
  select row_number() over () as id, gt.image, g, p, gt.cls = pred.cls as same, conf, gt.poly as p_, pred.poly as q_, gt.area as sp, pred.area as sq
  from gt join pred on gt.image = pred.image
), shapes as (select id, p_ as p, q_ as q from pairs), {_common_area_sql('shapes', 'id')},
scored as (
  select image, g, p, same, conf, round(coalesce(area, 0) / (sp + sq - coalesce(area, 0)), 12) as iou from pairs left join common using (id)
), turns as (
  select s.*, c.least, row_number() over (partition by image, c.least order by iou desc, g, p) as k
  from scored s join (values (0.0), (0.25)) c(least) on conf >= c.least where same and iou >= 0.5
), matched(image, least, k, g, p, iou, conf, gs, ps, free) as (
  select image, least, k, g, p, iou, conf, [g], [p], true from turns where k = 1
  union all
  select t.image, t.least, t.k, t.g, t.p, t.iou, t.conf,
    case when list_contains(m.gs, t.g) or list_contains(m.ps, t.p) then m.gs else list_append(m.gs, t.g) end,
    case when list_contains(m.gs, t.g) or list_contains(m.ps, t.p) then m.ps else list_append(m.ps, t.p) end,
    not (list_contains(m.gs, t.g) or list_contains(m.ps, t.p))
  from matched m join turns t on t.image = m.image and t.least = m.least and t.k = m.k + 1
), taken as (select image, least, g, p, iou, conf from matched where free)"""


@query(f"""
with recursive {MATCH_SQL}
select image, g as gt_index, p as pred_index, round(iou, 6) + 0.0 as iou, conf from taken where least = 0
""")
def q24_greedy_match(spark, sf):
    gt, pred = _matching_input(spark, sf)
    return matching.greedy_match(matching.overlaps(gt, pred)).withColumn("iou", F.round("iou", 6))


@query(f"""
with recursive {MATCH_SQL}, axes as (
  select image, g as index, 'g' as side, degrees(angle) + case when w < h then 90 else 0 end as angle, greatest(w, h) / least(w, h) as ratio from gt
  union all
  select image, p, 'p', degrees(angle) + case when w < h then 90 else 0 end, greatest(w, h) / least(w, h) from pred
), best as (select image, g, max(iou) as best from scored group by image, g having max(iou) > 0),
found as (
  select gt.image, gt.g, e.p is null as fn, b.best >= 0.10 and b.best < 0.80 as low_iou, d.conf < 0.8 as low_conf,
    x.ratio >= 1.10 and least(abs(x.angle - y.angle) % 180, 180 - abs(x.angle - y.angle) % 180) > 10 as angle_err
  from gt left join (select * from taken where least = 0.25) e on e.image = gt.image and e.g = gt.g
  left join (select * from taken where least = 0) d on d.image = gt.image and d.g = gt.g
  left join best b on b.image = gt.image and b.g = gt.g
  left join axes x on x.image = gt.image and x.index = gt.g and x.side = 'g'
  left join axes y on y.image = gt.image and y.index = d.p and y.side = 'p'
), surplus as (
  select count(*) as n from pred where conf >= 0.25 and (image, p) not in (select (image, p) from taken where least = 0.25)
)
select count_if(fn)::bigint as fn, coalesce(count_if(low_iou), 0)::bigint as low_iou, coalesce(count_if(low_conf), 0)::bigint as low_conf,
  coalesce(count_if(angle_err), 0)::bigint as angle_err, (select n from surplus)::bigint as fp, count(*)::bigint as gt from found
""")
def q25_issue_summary(spark, sf):
    return matching.issue_counts(matching.issues(*_matching_input(spark, sf)))


@query("""
select image, gt_index, pred_index, iou from (
  select l_orderkey as image, l_partkey as gt_index, l_linenumber as pred_index, l_quantity / 100 as iou,
    row_number() over (partition by l_orderkey, l_partkey order by l_quantity desc, l_linenumber) as r from lineitem
) where r = 1
""")
def q26_best_candidate(spark, sf):
    return matching.best_candidates(
        table(spark, sf, "lineitem").select(
            F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("gt_index"),
            F.col("l_linenumber").alias("pred_index"), (F.col("l_quantity") / 100).alias("iou"),
        )
    )


@query("""
select k from (select unnest(range(0, 1000 + (select count(distinct doc_id) from labels))) as k)
where k not in (select doc_id from labels) order by k limit 1000
""")
def q27_index_allocation(spark, sf):
    return audit.free_indices(table(spark, sf, "labels"), "doc_id", 0, 1000)


@query("""
with k as (select md5(text) as key, count(*) as n from documents group by 1)
select doc_id, coalesce(n, 0)::bigint as candidates, case when n is null then 'missing' when n = 1 then 'move' else 'ambiguous' end as status
from (select doc_id, md5(replace(text, '###', '')) as key from documents) left join k using (key)
""")
def q28_relocation_status(spark, sf):
    docs = table(spark, sf, "documents")
    wanted = docs.select("doc_id", F.md5(F.replace("text", F.lit("###"), F.lit(""))).alias("key"))
    return audit.relocation(wanted, docs.select(F.md5("text").alias("key")), "key").select("doc_id", "candidates", "status")


@query("""
select c_custkey, row_number() over (partition by c_mktsegment order by c_custkey % 100, c_custkey // 100)::int as no from customer
""")
def q29_natural_order(spark, sf):
    name = F.concat(F.lit("B"), (F.col("c_custkey") % 100).cast("string"), F.lit("_a"), F.floor(F.col("c_custkey") / 100).cast("string"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", paths.natural_key(name).alias("key"))
    return stats.numbered(rows, ["c_mktsegment"], ["key"]).select("c_custkey", "no")


@query("""
select l_returnflag, count(*)::bigint as images, round(sum(l_extendedprice), 1) as total_ms, round(avg(l_extendedprice), 4) as mean_ms,
  round(1000 / avg(l_extendedprice), 8) as fps from lineitem group by l_returnflag
""")
def q30_speed_stats(spark, sf):
    s = stats.speeds(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return s.select("l_returnflag", "images", F.round("total_ms", 1).alias("total_ms"), F.round("mean_ms", 4).alias("mean_ms"), F.round("fps", 8).alias("fps"))


@query("""
with s as (select p_partkey, p_size * 160 as a, p_size * 90 + p_partkey % 3 as b, p_partkey % 2 = 0 as turned from part),
w as (select p_partkey, case when turned then b else a end as w, case when turned then a else b end as h from s),
u as (select greatest(w, h) as w, least(w, h) as h, h > w as rotated from w)
select rotated, count(*)::bigint as total, count_if(abs(w / h - 16 / 9.0::double) / (16 / 9.0::double) <= 0.005)::bigint as kept,
  count_if(not abs(w / h - 16 / 9.0::double) / (16 / 9.0::double) <= 0.005)::bigint as removed
from u group by rotated
""")
def q31_aspect_filter(spark, sf):
    size, key = F.col("p_size") * 160, F.col("p_size") * 90 + F.col("p_partkey") % 3
    turned = F.col("p_partkey") % 2 == 0
    rows = table(spark, sf, "part").select(
        geometry.upright(F.when(turned, key).otherwise(size), F.when(turned, size).otherwise(key)).alias("u")
    )
    good = geometry.is_16_by_9(F.col("u.width"), F.col("u.height"))
    flagged = rows.select("u.rotated", good.alias("good"))
    return stats.flag_counts(flagged, {"kept": F.col("good"), "removed": ~F.col("good")}, ["rotated"])


@query("""
with m as (select l_orderkey, l_linenumber, l_quantity * 6 as blur, l_discount * 5 as dark, abs(l_tax) * 4 as bright, l_quantity * 20 as w, l_quantity * 30 as h from lineitem)
select l_orderkey, l_linenumber, round(0.5 * greatest(0, least(1, (blur - 20) / 160)) + 0.3 * (1 - greatest(0, least(1, greatest(dark, bright) / 0.35)))
  + 0.2 * greatest(0, least(1, sqrt(h * w) / 1500)), 6) as quality_score, blur < 20 or dark >= 0.35 or bright >= 0.35 as fatal_quality from m
""")
def q32_quality_score(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 6).alias("blur_var"), (F.col("l_discount") * 5).alias("dark_ratio"),
        (F.abs("l_tax") * 4).alias("bright_ratio"), (F.col("l_quantity") * 20).alias("width"), (F.col("l_quantity") * 30).alias("height"),
    )
    return triage.quality_flags(rows).select(
        "l_orderkey", "l_linenumber", F.round(triage.quality_score(), 6).alias("quality_score"), "fatal_quality"
    )


@query(f"""
with {POLY_SQL}
select image, index as pred_index, printf('0 0.500000 %.3f %.3f %.3f %.3f %.8f', cx, cy, w, h, angle) || ' ' ||
  array_to_string(flatten(list_transform(poly, lambda v: [printf('%.3f', v.x), printf('%.3f', v.y)])), ' ') as line
from boxes
""")
def q33_prediction_lines(spark, sf):
    pred = _boxes(spark, sf).select(
        "image", F.col("index").alias("pred_index"), F.lit(0).alias("cls"), F.lit(0.5).alias("conf"), "cx", "cy", "w", "h", "angle", "poly"
    )
    return sinks.prediction_lines(pred)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q10_triage_score(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOGUE.items() if sql}


from quarry.plans import curation  # noqa: E402,F401  registers its queries
