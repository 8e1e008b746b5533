"""More queries over the star schema: lists, labels, paths, plans of files and reports.

Files and folders stand for keys of the tables: a customer is an image, its nation
a dataset, an order an image with the boxes of its line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import geometry, paths, pixels
from quarry.operators import audit, dedup, matching, splits, stats, triage
from quarry.plans import triage as plans
from quarry.plans.catalogue import BOX_SQL, MATCH_SQL, POLY_SQL, _boxes, _common_area_sql, _matching_input, _triage_input, _triage_sql, query, table
from quarry.sources import readers, reports, sinks
from quarry.tables import scratch_path


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def custkey() -> Column:
    return F.col("c_custkey")


def nationkey() -> Column:
    return F.col("c_nationkey")


def mktsegment() -> Column:
    return F.col("c_mktsegment")


@query(r"""
select 'list' || c_nationkey as file, (2 * row_number() over (partition by c_nationkey order by c_custkey) - 1)::int as line_no,
  'D:/' || c_mktsegment || '/images/' || c_custkey || '.jpg' as normalized from customer
""")
def q34_list_lines(spark, sf):
    """List files with quotes, backslashes, blank lines, CR LF and a byte order mark."""
    line = _text(' "D:\\', mktsegment(), "\\images\\", custkey(), '.jpg"\t')
    files = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "\r\n \r\n").alias("v")
    )
    rows = readers.parse_lines(files.select(_text("list", nationkey()).alias("file"), F.concat(F.lit("\ufeff"), "v").alias("value")))
    return rows.select("file", "line_no", "normalized")


def _label_files(spark, sf, tokens) -> DataFrame:
    """A label file per order; ``tokens`` gives the number of tokens of a line."""
    numbers = [(F.col("l_partkey") % (90 + i) / F.lit(100.0)).cast("string") for i in range(10)]
    line = F.array_join(F.slice(F.array((F.col("l_linenumber") % 3).cast("string"), *numbers), F.lit(1), tokens), " ")
    lines = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line"))))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("value")
    ).select(F.col("l_orderkey").cast("string").alias("file"), "value")


LABEL_SQL = """l as (
  select l_orderkey::varchar as file, l_linenumber, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) - 1 as k
  from lineitem
)"""


@query(f"""
with {LABEL_SQL}
select file, k::int as gt_index, (l_linenumber % 3)::int as cls, (l_partkey % 90 / 100.0::double * 640)::float::double as x1,
  (l_partkey % 97 / 100.0::double * 480)::float::double as y4 from l
""")
def q35_labels_strict(spark, sf):
    boxes = readers.parse_labels(_label_files(spark, sf, F.lit(9)))
    sized = readers.denormalize(boxes.withColumns({"width": F.lit(640), "height": F.lit(480)}))
    return sized.select("file", "gt_index", "cls", F.col("poly")[0]["x"].alias("x1"), F.col("poly")[3]["y"].alias("y4"))


@query(f"""
with {LABEL_SQL}
select file, (row_number() over (partition by file order by k) - 1)::int as gt_index, l_partkey % 91 / 100.0::double as y1
from l where l_linenumber % 4 <> 0
""")
def q36_labels_lenient(spark, sf):
    many = F.when(F.col("l_linenumber") % 4 == 0, 7).when(F.col("l_linenumber") % 4 == 1, 11).otherwise(9)
    boxes = readers.parse_labels(_label_files(spark, sf, many), strict=False)
    return boxes.select("file", "gt_index", F.col("poly")[0]["y"].alias("y1"))


@query("""
select c_custkey, ['bmp', 'jpeg', 'jpg', 'png', 'tif', 'tiff', 'webp'][c_custkey % 7 + 1] as ext from customer where c_custkey % 5 <> 0
""")
def q37_images_of_labels(spark, sf):
    """All paths a label's image may have, and the one that there is."""
    root = F.concat(F.lit("/d/Labels/x/labels/train/"), custkey().cast("string"))
    rows = table(spark, sf, "customer").select("c_custkey", F.concat(root, F.lit(".txt")).alias("label"))
    ext = F.get(F.array(*map(F.lit, paths.IMAGE_EXTENSIONS)), (custkey() % 7).cast("int"))
    image = F.concat(F.lit("/d/Labels/x/images/train/"), custkey().cast("string"), F.lit("."), ext)
    images = table(spark, sf, "customer").where(custkey() % 5 != 0).select(image.alias("path"))
    candidates = rows.select("c_custkey", F.explode(paths.label_to_images("label")).alias("path"))
    return audit.present(candidates, images, ["path"]).select("c_custkey", paths.extension("path").alias("ext"))


@query("select c_custkey from customer where c_custkey % 5 = 0")
def q38_orphan_labels(spark, sf):
    """Labels none of whose possible images is there."""
    label = F.concat(F.lit("/d/labels/train/"), custkey().cast("string"), F.lit(".txt"))
    rows = table(spark, sf, "customer").select("c_custkey", label.alias("label"))
    image = F.concat(F.lit("/d/images/train/"), custkey().cast("string"), F.lit(".png"))
    images = table(spark, sf, "customer").where(custkey() % 5 != 0).select(image.alias("path"))
    candidates = rows.select("c_custkey", F.explode(paths.label_to_images("label")).alias("path"))
    there = audit.present(candidates, images, ["path"])
    return audit.missing(rows, there, ["c_custkey"]).select("c_custkey")


@query("""
with p as (select c_custkey, c_custkey % 6 as m, case c_custkey % 6 when 2 then 'X:/a/Images/Train/' || c_custkey || '.jpg'
  when 3 then '/b/images/val/' || c_custkey || '.jpg' when 4 then '/c/images/val/images/train/' || c_custkey else c_custkey || '.jpg' end as path from customer)
select c_custkey, case m when 0 then path when 1 then '/set/' || path when 2 then '/set/Images/Train/' || c_custkey || '.jpg'
  when 3 then '/set/images/val/' || c_custkey || '.jpg' when 4 then '/set/images/train/' || c_custkey else '/set/' || path end as resolved from p
""")
def q39_resolved_paths(spark, sf):
    kind = custkey() % 6
    path = (
        F.when(kind == 2, _text("X:/a/Images/Train/", custkey(), ".jpg")).when(kind == 3, _text("/b/images/val/", custkey(), ".jpg"))
        .when(kind == 4, _text("/c/images/val/images/train/", custkey())).otherwise(_text(custkey(), ".jpg"))
    )
    rows = table(spark, sf, "customer").select("c_custkey", path.alias("path"))
    return rows.select("c_custkey", paths.resolve_list_path("path", "/set", kind == 0, kind == 1).alias("resolved"))


@query("""
with p as (select c_custkey as k, c_nationkey as n, c_mktsegment || '/img.' || c_custkey || '.jpg' as rel from customer)
select k, '/r/n' || n || '/' || rel as absolute, rel as relative, '/other/' || rel as custom, '/r/labels/' || regexp_replace(rel, '\\.jpg$', '.txt') as label,
  '/r/n' || n || '/images/train/' || rel as side, '/r/' || case when k % 2 = 0 then 'KEEP' else 'DROP' end || '/c' || n || '/' || rel as output,
  printf('%06d_', k) || 'img.' || k as prediction, 'r' as source from p
""")
def q40_made_paths(spark, sf):
    rel = _text(mktsegment(), "/img.", custkey(), ".jpg")
    rows = table(spark, sf, "customer").select(custkey().alias("k"), _text("n", nationkey()).alias("set"), rel.alias("rel"))
    rows = rows.withColumn("path", F.concat(F.lit("/r/"), "set", F.lit("/"), "rel"))
    rows = rows.withColumn("own", F.concat(F.lit("/r/"), "rel")).withColumn("choice", F.when(F.col("k") % 2 == 0, "KEEP").otherwise("DROP"))
    return rows.select(
        "k", paths.grouped_path("path", "absolute", "/r").alias("absolute"), paths.grouped_path("own", "relative", "/r").alias("relative"),
        paths.grouped_path("own", "custom_root", "/r", "/other/").alias("custom"), paths.label_of("rel", "/r").alias("label"),
        paths.side_path("/r", "set", "images", F.lit("train"), "rel").alias("side"),
        paths.output_path("/r", "choice", F.translate("set", "n", "c"), "rel").alias("output"), paths.prediction_stem("k", "path").alias("prediction"),
        paths.source_dataset("path").alias("source"),
    )


@query("""
with t as (select l_orderkey, l_linenumber, l_linenumber % 2 = 1 as fn, l_partkey % 2 = 1 as fp, l_suppkey % 2 = 1 as angle from lineitem)
select l_orderkey, l_linenumber, case when fn or fp or angle then array_to_string(list_filter([case when fn then 'FN' end,
  case when angle then 'ANGLEERR' end, case when fp then 'FP' end], lambda x: x is not null), '_') || '__' else '' end || 'b__c__' || l_orderkey || '__x.jpg' as name from t
""")
def q41_safe_names(spark, sf):
    tag = lambda c, t: F.when(F.col(c) % 2 == 1, t)
    tags = F.filter(F.array(tag("l_partkey", "FP"), tag("l_linenumber", "FN"), tag("l_suppkey", "ANGLE_ERR")), lambda x: x.isNotNull())
    path = _text("/a/b/c/", F.col("l_orderkey"), "/x.jpg")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", paths.safe_output_name(path, tags).alias("name"))


@query("""
with n as (select c_custkey, c_nationkey, case c_custkey % 3 when 0 then c_custkey % 1000 || '.jpg' when 1 then '00' || c_custkey || '.JPG' else 'B_' || c_custkey || '.jpg' end as name from customer)
select c_custkey, row_number() over (partition by c_nationkey order by c_custkey % 3 = 2,
  case c_custkey % 3 when 0 then c_custkey % 1000 when 1 then c_custkey end, lower(name), c_custkey)::int as no from n
""")
def q42_numeric_order(spark, sf):
    name = F.when(custkey() % 3 == 0, _text(custkey() % 1000, ".jpg")).when(custkey() % 3 == 1, _text("00", custkey(), ".JPG")).otherwise(_text("B_", custkey(), ".jpg"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", paths.numeric_key(name).alias("key"))
    return stats.numbered(rows, ["c_nationkey"], ["key", "c_custkey"]).select("c_custkey", "no")


@query("""
with s as (select event_id, (event_id * 37 % 100000)::bigint as s from events)
select event_id, case when event_id % 50 = 0 then '--:--' when s >= 3600 then printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60)
  else printf('%02d:%02d', s // 60, s % 60) end as clock, event_id % 9 + 1 || ' × ' || event_id % 7 + 2 as size,
  case when event_id % 10 = 0 then 12.5 else (event_id % 60 + 1) / greatest(event_id % 4, 1)::double end as rate,
  round_even((event_id % 64) / 8.0::double, 2) as rounded, greatest(1, round_even((event_id % 31) * 0.5::double, 0))::int as step from events join s using (event_id)
""")
def q43_numbers(spark, sf):
    key = F.col("event_id")
    seconds = F.when(key % 50 != 0, key * 37 % 100000)
    rate = F.when(key % 10 == 0, paths.assembly_rate(F.lit(1.0), F.lit(1), 12.5)).otherwise(paths.assembly_rate(key % 60 + 1, key % 4))
    return table(spark, sf, "events").select(
        "event_id", paths.clock(seconds).alias("clock"), paths.size_text((key % 9 + 1).cast("int"), (key % 7 + 2).cast("int")).alias("size"),
        rate.alias("rate"), paths.round_half_even(key % 64 / F.lit(8.0), 2).alias("rounded"), splits.step_of_seconds(key % 31 + F.lit(0.0), 0.5).alias("step"),
    )


@query("""
with a as (select l_orderkey, l_linenumber, l_partkey % 361 - 180.0::double as a, l_suppkey % 181 * 1.0::double as b, l_quantity / 10 as r from lineitem),
f as (select *, case when abs(a) <= pi() + 1e-6 then degrees(a) else a end as d from a),
m as (select *, d - 180 * floor(d / 180) as m from f),
x as (select *, case when m > 90 then 180 - m else m end as folded from m)
select l_orderkey, l_linenumber, least(abs(a - b) % 180, 180 - abs(a - b) % 180) as difference, round(folded, 6) as folded, folded between 15 and 75 as angled from x
""")
def q44_angles(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 361 - F.lit(180.0)).alias("a"), (F.col("l_suppkey") % 181 * F.lit(1.0)).alias("b")
    )
    folded = geometry.fold_angle("a")
    return rows.select(
        "l_orderkey", "l_linenumber", geometry.angle_difference("a", "b").alias("difference"), F.round(folded, 6).alias("folded"), geometry.is_angled(folded).alias("angled")
    )


@query("""
with s as (select p_partkey as k, p_size * 1.0::double as s, p_partkey % 4 = 0 as uneven from part)
select k, case when not uneven then 100 * s end as fx, case when not uneven then 50 * s end as cy, case when not uneven then 1.0::double end as last from s
""")
def q45_scaled_camera(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    matrix = F.array(*(F.lit(float(x)) for x in (100, 0, 60, 0, 100, 50, 0, 0, 1)))
    rows = table(spark, sf, "part").select(
        key.alias("k"), matrix.alias("m"), F.lit(640).alias("w"), F.lit(480).alias("h"), (size * 640).alias("tw"),
        (size * 480 + F.when(key % 4 == 0, 7).otherwise(0)).alias("th"),
    )
    scaled = rows.select("k", geometry.scaled_camera("m", "w", "h", "tw", "th").alias("s"))
    return scaled.select("k", F.get("s", F.lit(0)).alias("fx"), F.get("s", F.lit(5)).alias("cy"), F.get("s", F.lit(8)).alias("last"))


@query("""
with i as (select c_custkey, '/set/n' || c_nationkey || '/' || c_custkey % 1000 || '.jpg' as path, c_custkey % 1000 as name from customer),
u as (select name, min(path) as path from (select distinct name, path from i) group by name having count(*) = 1),
p as (select o_orderkey, case o_orderkey % 3 when 0 then '/set/n' || c_nationkey || '/' || c_custkey % 1000 || '.jpg' else '/elsewhere/' || c_custkey % 1000 || '.jpg' end as image,
  c_custkey % 1000 as name from orders join customer on o_custkey = c_custkey)
select o_orderkey, image from p where image in (select path from i)
union all select o_orderkey, u.path from p join u using (name) where image not in (select path from i)
""")
def q46_attached_predictions(spark, sf):
    """Detections by path, else by a name that one image has."""
    name = _text(custkey() % 1000, ".jpg")
    customers = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("/set/n"), nationkey().cast("string"), F.lit("/"), name).alias("path"), name.alias("name"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    found = orders.join(customers, "c_custkey")
    image = F.when(F.col("o_orderkey") % 3 == 0, F.col("path")).otherwise(F.concat(F.lit("/elsewhere/"), "name"))
    return audit.attach_predictions(customers.select("path", "name").distinct(), found.select("o_orderkey", image.alias("image"))).select("o_orderkey", "image")


@query(f"""
with {POLY_SQL}, e as (
  select *, abs(w / 2 * cos(angle)) + abs(h / 2 * sin(angle)) as ex, abs(w / 2 * sin(angle)) + abs(h / 2 * cos(angle)) as ey,
    case when abs(angle) <= pi() + 1e-6 then degrees(angle) else angle end as d, l.conf
  from boxes join (select l_orderkey, l_linenumber, any_value(l_discount * 10) as conf from lineitem group by l_orderkey, l_linenumber having count(*) = 1) l
    on l.l_orderkey = image and l.l_linenumber = index
), f as (
  select *, case when d - 180 * floor(d / 180) > 90 then 180 - (d - 180 * floor(d / 180)) else d - 180 * floor(d / 180) end as fold from e
), pairs as (
  select row_number() over () as id, x.image, x.poly as p, y.poly as q, x.w * x.h as sp, y.w * y.h as sq from f x join f y on x.image = y.image and x.index < y.index
), {_common_area_sql('pairs', 'id')}, o as (
  select image, count_if(coalesce(area, 0) / greatest(1, least(sp, sq)) >= 0.15) / count(*) as share from pairs left join common using (id) group by image
)
select f.image, count(*)::bigint as n_det, round(avg((cx - ex <= 35 or cy - ey <= 35 or cx + ex >= 965 or cy + ey >= 965)::int), 6) as edge_ratio,
  round(avg((w * h / 1000000 <= 0.005)::int), 6) as small_ratio, round(avg((w * h / 1000000 >= 0.35)::int), 6) as huge_ratio,
  round(avg((fold between 15 and 75)::int), 6) as angled_ratio, round(avg((greatest(w, h) / least(w, h) >= 3.5)::int), 6) as extreme_aspect_ratio,
  round(avg((conf < 0.15)::int), 6) as very_low_conf_ratio, round(coalesce(any_value(share), 0), 6) as overlap_pair_ratio
from f left join o on o.image = f.image group by f.image
""")
def q47_detection_profile(spark, sf):
    once = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.first("l_discount").alias("d"), F.count("*").alias("n")).where("n = 1")
    conf = once.select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("index"), (F.col("d") * 10).alias("conf"))
    pred = _boxes(spark, sf).join(conf, ["image", "index"]).withColumnRenamed("index", "pred_index")
    images = pred.select(F.col("image").alias("path")).distinct().withColumns({"width": F.lit(1000), "height": F.lit(1000)})
    rows = plans.profile(pred, images).withColumnRenamed("path", "image")
    ratios = ("edge_ratio", "small_ratio", "huge_ratio", "angled_ratio", "extreme_aspect_ratio", "very_low_conf_ratio", "overlap_pair_ratio")
    return rows.select("image", "n_det", *(F.round(c, 6).alias(c) for c in ratios))


@query("""
with n as (select unnest(['AUTOMOBILE', 'none', 'BUILDING', 'MACHINERY']) as c_mktsegment, unnest([0, 1, 2, 3]) as place)
select place::int as place, n.c_mktsegment, count(c_custkey)::bigint as n from n left join customer using (c_mktsegment) group by all
""")
def q48_counts_in_order(spark, sf):
    return stats.in_order(table(spark, sf, "customer"), "c_mktsegment", ["AUTOMOBILE", "none", "BUILDING", "MACHINERY"])


@query("""
select d.source, count_if(d.doc_id % 5 <> 0)::bigint as train, count_if(d.doc_id % 5 = 0)::bigint as val,
  count_if(d.doc_id % 5 <> 0 and l.doc_id is null)::bigint as train_missing, count_if(d.doc_id % 5 = 0 and l.doc_id is null)::bigint as val_missing,
  round(avg((l.doc_id is null)::int), 6) as missing_share, count(*)::bigint as total
from documents d left join (select distinct doc_id from labels) l using (doc_id) group by d.source
""")
def q49_dataset_totals(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    rows = audit.flag_present(docs, table(spark, sf, "labels"), ["doc_id"], "labelled")
    train, gone = F.col("doc_id") % 5 != 0, ~F.col("labelled")
    flags = {"train": train, "val": ~train, "train_missing": train & gone, "val_missing": ~train & gone, "missing": gone}
    counts = stats.flag_counts(rows, flags, ["source"])
    return counts.withColumn("missing_share", F.round(F.col("missing") / F.col("total"), 6)).drop("missing")


@query("""
select a, b, distance from (
  select l_orderkey as b, l_partkey as a, min(l_quantity)::int as distance, row_number() over (partition by l_orderkey order by min(l_quantity)::int, l_partkey) as r
  from lineitem group by l_orderkey, l_partkey
) where r <= 2
""")
def q50_nearest_partners(spark, sf):
    pairs = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("b"), F.col("l_partkey").alias("a")).agg(F.min("l_quantity").cast("int").alias("distance"))
    return dedup.nearest(pairs, 2)


@query("""
select c_custkey, (row_number() over (order by lower(c_name), c_custkey))::bigint as line from customer
""")
def q51_lists_written_and_read(spark, sf):
    """A list written in order, read back by its files' names and line numbers."""
    rows = table(spark, sf, "customer").select("c_custkey", F.lower("c_name").alias("n"), F.concat(F.lit("/a/"), custkey().cast("string"), F.lit(".jpg")).alias("path"))
    where = scratch_path(spark, "list")
    sinks.write_list(rows, where, "path", ["n", "c_custkey"])
    back = readers.list_rows(spark, where)
    sizes = back.groupBy("file").agg(F.max("line_no").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a file
    placed = back.join(sizes.select("file", before.alias("before")), "file")
    return placed.select(paths.stem("normalized").cast("long").alias("c_custkey"), (F.col("before") + F.col("line_no")).alias("line"))


def _entries(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.when(custkey() % 5 == 0, "val").otherwise("train").alias("split"), _text("images_cvat", nationkey(), "_dataset").alias("dataset"), _text("d/", custkey(), ".jpg").alias("relative")
    )


@query("""
with c as (select *, case when c_custkey % 5 = 0 then 'val' else 'train' end as split, 'images_cvat' || c_nationkey || '_dataset' as dataset from customer)
select split, dataset, 'd/' || c_custkey || '.jpg' as relative_image, '/r/' || dataset || '/images/' || split || '/d/' || c_custkey || '.jpg' as image_destination,
  case when c_custkey % 7 = 0 then 'missing' when split = 'train' then 'already_ok' else 'moved' end as image_status,
  '/r/' || dataset || '/labels/' || split || '/d/' || c_custkey || '.txt' as label_destination,
  case when c_custkey % 3 = 0 then 'missing' when split = 'val' then 'already_ok' else 'moved' end as label_status from c
""")
def q52_move_manifest(spark, sf):
    """Images are all in train, labels in val; some are missing."""
    rows = _entries(spark, sf).withColumn("k", paths.stem("relative").cast("long"))
    images = rows.where("k % 7 <> 0").select("dataset", F.lit("images").alias("side"), F.lit("train").alias("at"), "relative")
    labels = rows.where("k % 3 <> 0").select(F.upper("dataset").alias("dataset"), F.lit("labels").alias("side"), F.lit("val").alias("at"), paths.swap_suffix("relative").alias("relative"))
    return sinks.manifest(_entries(spark, sf), images.unionByName(labels), "/r")


@query("""
with f as (select c_custkey, c_custkey % 4 as m from customer)
select c_custkey::varchar as stem, case when m in (1, 3) then case m when 1 then '/old/' || c_custkey || '.txt' else '/r/labels/train/' || c_custkey || '.txt' end end as source,
  '/r/labels/train/' || c_custkey || '.txt' as destination, case m when 0 then 'missing' when 1 then 'ready' when 2 then 'ambiguous' else 'already_ok' end as status from f
""")
def q53_label_relocation(spark, sf):
    stem, m = custkey().cast("string"), custkey() % 4
    rows = table(spark, sf, "customer")
    images = rows.select(stem.alias("stem"), F.concat(F.lit("train/"), stem, F.lit(".jpg")).alias("relative"))
    home = F.concat(F.lit("/r/labels/train/"), stem, F.lit(".txt"))
    places = F.when(m == 1, F.array(_text("/old/", stem, ".txt"))).when(m == 2, F.array(home, _text("/old/", stem, ".txt"))).when(m == 3, F.array(home))
    return sinks.relocation_plan(images, rows.select(stem.alias("stem"), F.explode(places).alias("path")), "/r")


@query("""
with f as (select case when c_custkey % 3 = 0 then '/out/' || c_mktsegment || '/' || c_custkey || '.txt' else '/root/set/a/' || c_custkey || '.txt' end as source, c_custkey as k from customer)
select source, case when k % 3 = 0 then '/bak/_external/' || k || '.txt' else '/bak/a/' || k || '.txt' end as destination, 'ready' as status from f
""")
def q54_backup_plan(spark, sf):
    path = F.when(custkey() % 3 == 0, _text("/out/", mktsegment(), "/", custkey(), ".txt")).otherwise(_text("/root/set/a/", custkey(), ".txt"))
    return sinks.backup_plan(table(spark, sf, "customer").select(path.alias("path")), "/root/set", "/bak")


@query("""
select 'l' || c_nationkey as file, count_if(c_custkey % 4 <> 0)::bigint as kept, count_if(c_custkey % 4 = 0)::bigint as removed from customer group by c_nationkey
""")
def q55_pruned_lists(spark, sf):
    rows = table(spark, sf, "customer").select(_text("l", nationkey()).alias("file"), custkey().alias("line_no"), _text('"', custkey(), '.jpg"').alias("original"))
    rows = rows.withColumn("normalized", paths.normalize_list_path("original"))
    images = table(spark, sf, "customer").where(custkey() % 4 != 0).select(_text(custkey(), ".jpg").alias("path"))
    pruned = sinks.pruned_list(rows, images)
    return pruned.groupBy("file").agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("removed"))


@query("""
with l as (select c_nationkey, c_custkey, c_custkey % 3 = 0 as hit from customer), e as (
  select c_nationkey, array_agg('/new/' || c_custkey || '.jpg' order by c_custkey) as e from (
    select *, row_number() over (partition by c_nationkey order by c_custkey) as r from l where hit) where r <= 5 group by c_nationkey
)
select 'dir/l' || c_nationkey || '.txt' as file, 'dir/l' || c_nationkey || '_autodl.txt' as output, count_if(hit)::bigint as changed, count_if(not hit)::bigint as unchanged,
  array_to_string(any_value(e), ',') as examples from l left join e using (c_nationkey) group by c_nationkey
""")
def q56_rewritten_lists(spark, sf):
    line = F.when(custkey() % 3 == 0, _text("h:\\Old/", custkey(), ".jpg")).otherwise(_text("/else/", custkey(), ".jpg"))
    rows = table(spark, sf, "customer").select(_text("dir/l", nationkey(), ".txt").alias("file"), custkey().cast("int").alias("line_no"), line.alias("original"))
    lines = sinks.rewritten_list(rows, "H:/old/", "/new/")
    counts = sinks.rewrite_counts(lines).join(lines.select("file", "output").distinct(), "file")
    return counts.select("file", "output", "changed", "unchanged", F.array_join("examples", ",").alias("examples"))


def _scored(spark, sf) -> DataFrame:
    name = F.col("o_orderkey").cast("string")
    rows = triage.score(_triage_input(spark, sf).withColumn("name", name), name="name")
    return rows.withColumns(
        {
            "path": F.concat(F.lit("/in/"), "name"), "rel_path": F.col("name"), "duplicate_rank": F.lit(None).cast("int"),
            "duplicate_group": F.when(F.col("is_duplicate_drop"), F.col("o_orderkey").cast("int")), "width": F.lit(1280), "height": F.lit(720),
            "brightness": F.col("o_orderkey") / F.lit(7.0), "quality_score": F.col("dark_ratio") / 3,
        }
    ).withColumn("output_path", paths.output_path("/out", "keep_drop", "category", "rel_path"))


@query(f"""
with t as ({_triage_sql()})
select '/in/' || o_orderkey as path, o_orderkey::varchar as rel_path, category, keep_drop, reasons,
  case when o_orderkey % 11 = 0 then o_orderkey else -1 end::int as duplicate_group, -1 as duplicate_rank, round(o_custkey % 50 / 100.0::double / 3, 6) as quality_score,
  round(o_orderkey / 7.0::double, 4) as brightness, challenge_score, '/out/' || keep_drop || '/' || category || '/' || o_orderkey as output_path
from t join orders using (o_orderkey)
""")
def q57_triage_report(spark, sf):
    """The report of 28 columns; those of numbers alone are shown by a few."""
    report = reports.triage_report(_scored(spark, sf))
    assert len(report.columns) == 28
    shown = ("path", "rel_path", "category", "keep_drop", "reasons", "duplicate_group", "duplicate_rank", "quality_score", "brightness", "challenge_score", "output_path")
    return report.select(*shown).withColumn("challenge_score", F.round("challenge_score", 3))


@query(f"""
with t as ({_triage_sql()})
select count(*)::bigint as total_images, count(distinct case when o_orderkey % 11 = 0 and o_orderkey > 0 then o_orderkey end)::bigint as duplicate_groups,
  (select string_agg(k || '=' || n, ',' order by k) from (select keep_drop || '/' || category as k, count(*) as n from t group by 1)) as counts, '0.1' as rate from t
""")
def q58_triage_summary(spark, sf):
    made = reports.triage_summary(_scored(spark, sf), {"input": "/in"}, {"EASY_KEEP_RATE": 0.1})
    parsed = F.from_json("summary", "total_images long, duplicate_groups long, counts map<string,long>, parameters map<string,string>")
    rows = made.select(parsed.alias("s"))
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("s.counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return rows.select("s.total_images", "s.duplicate_groups", counts.alias("counts"), F.col("s.parameters")["EASY_KEEP_RATE"].alias("rate"))


ISSUE_SQL = f"""{MATCH_SQL}, axes as (
  select image, g as index, 'g' as side, degrees(angle) + case when w < h then 90 else 0 end as angle, greatest(w, h) / least(w, h) as ratio from gt
  union all
  select image, p, 'p', degrees(angle) + case when w < h then 90 else 0 end, greatest(w, h) / least(w, h) from pred
), best as (select image, g, max(iou) as best from scored group by image, g having max(iou) > 0),
diagnosed as (
  select gt.image, gt.g, e.p is null as fn, coalesce(b.best >= 0.10 and b.best < 0.80, false) as low_iou, coalesce(d.conf < 0.8, false) as low_conf,
    d.conf, b.best, x.ratio, least(abs(x.angle - y.angle) % 180, 180 - abs(x.angle - y.angle) % 180) as error
  from gt left join (select * from taken where least = 0.25) e on e.image = gt.image and e.g = gt.g
  left join (select * from taken where least = 0) d on d.image = gt.image and d.g = gt.g
  left join best b on b.image = gt.image and b.g = gt.g
  left join axes x on x.image = gt.image and x.index = gt.g and x.side = 'g'
  left join axes y on y.image = gt.image and y.index = d.p and y.side = 'p'
), listed as (
  select image, 'GT' as object_type, g as gt_index, list_filter([case when fn then 'FN' end, case when low_iou then 'LOW_IOU' end,
      case when low_conf then 'LOW_CONF' end, case when ratio >= 1.10 and error > 10 then 'ANGLE_ERR' end], lambda x: x is not null) as tags,
    conf, coalesce(best, 0) as best, error from diagnosed
  union all
  select image, 'FP', null, ['FP'], conf, null, null from pred where conf >= 0.25 and (image, p) not in (select (image, p) from taken where least = 0.25)
)"""


def _issues(spark, sf) -> DataFrame:
    return matching.issues(*_matching_input(spark, sf))


@query(f"""
with recursive {ISSUE_SQL}
select image, object_type, gt_index, array_to_string(tags, '|') as issues, round(conf, 6) as confidence, round(best, 6) + 0.0 as best_iou, round(error, 4) as angle_error_deg from listed
""")
def q59_problem_report(spark, sf):
    report = reports.problem_report(_issues(spark, sf))
    assert len(report.columns) == 12
    return report.select("image", "object_type", "gt_index", "issues", "confidence", "best_iou", "angle_error_deg")


@query(f"""
with recursive {ISSUE_SQL}, t as (
  select count(distinct image) as images, count_if(object_type = 'GT') as gt, count(distinct case when len(tags) > 0 then image end) as problems,
    count_if(list_contains(tags, 'FN')) as fn, count_if(list_contains(tags, 'LOW_CONF')) as low_conf, count_if(list_contains(tags, 'LOW_IOU')) as low_iou,
    count_if(list_contains(tags, 'ANGLE_ERR')) as angle_err, count_if(list_contains(tags, 'FP')) as fp from listed
)
select unnest(range(0, 8))::int as no, unnest(['验证图片总数：' || images, 'GT 总数：' || gt, '问题图片数：' || problems, 'FN 漏检：' || fn,
  'LOW_CONF 低置信度：' || low_conf, 'LOW_IOU OBB定位偏差：' || low_iou, 'ANGLE_ERR 角度误差：' || angle_err, 'FP 误检：' || fp]) as line from t
""")
def q60_problem_summary(spark, sf):
    return reports.problem_summary(reports.problem_totals(_issues(spark, sf)))


def _statistics(spark, sf) -> tuple[DataFrame, DataFrame]:
    images = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("path"), F.concat(F.lit("d"), (F.col("o_custkey") % 3).cast("string")).alias("dataset"), F.lit(1000).alias("width"), F.lit(1000).alias("height")
    )
    boxes = _boxes(spark, sf).select("image", "index", "poly")
    return reports.image_statistics(images, boxes, matching.pair_overlaps(boxes)), reports.target_statistics(images, boxes)


STAT_SQL = f"""{POLY_SQL}, t as (select b.*, w * h / 1000000 as ratio, degrees(angle) + case when w < h then 90 else 0 end as axis from boxes b join orders on o_orderkey = image),
pairs as (
  select row_number() over () as id, x.image, x.poly as p, y.poly as q, x.w * x.h as sp, y.w * y.h as sq from boxes x join boxes y on x.image = y.image and x.index < y.index
), {_common_area_sql('pairs', 'id')}, o as (
  select image, bool_or(coalesce(area, 0) / greatest(1, least(sp, sq)) > 0.15) as has from pairs left join common using (id) group by image
), i as (
  select o_orderkey, o_custkey, (select count(*) from b where image = o_orderkey) as n, coalesce(has, false) as has from orders left join o on o.image = o_orderkey
), c as (select *, case when n = 0 then '无目标' when n = 1 then '单件包裹' when n <= 3 then '2-3件包裹' when n <= 6 then '4-6件包裹' else '多件复杂场景' end as cls from i),
z as (select *, case when ratio < 0.03 then '小尺寸' when ratio < 0.10 then '中等尺寸' else '大尺寸' end as size from t)"""


@query(f"""
with {STAT_SQL}
select o_orderkey as "图片路径", 'd' || o_custkey % 3 as "数据集来源", 1000 as "图像宽度", 1000 as "图像高度", n::bigint as "包裹数量", cls as "数量类别", has as "是否存在遮挡贴靠" from c
""")
def q61_image_statistics(spark, sf):
    return _statistics(spark, sf)[0]


@query(f"""
with {STAT_SQL}
select image as "图片路径", index as "目标编号", round(cx / 1000, 6) as "归一化中心X", round(ratio, 6) as "面积占比", size as "尺寸类别", round(axis, 4) as "角度(度)" from z
""")
def q62_target_statistics(spark, sf):
    rows = _statistics(spark, sf)[1]
    number = lambda c, d: F.round(c, d).alias(c)
    return rows.select("图片路径", "目标编号", number("归一化中心X", 6), number("面积占比", 6), "尺寸类别", number("角度(度)", 4))


@query(f"""
with {STAT_SQL}, n as (select floor(axis / 15)::int + 1 as bin, count(*) as n from z group by 1)
select k::int as bin, (k - 1) * 15 || '-' || k * 15 || '°' as "角度区间", round(coalesce(n, 0) / (select count(*) from z), 6) as "比例"
from range(1, 13) r(k) left join n on n.bin = k
""")
def q63_angle_distribution(spark, sf):
    rows = reports.angle_distribution(_statistics(spark, sf)[1])
    return rows.select(F.col("bin").cast("int").alias("bin"), "角度区间", F.round("比例", 6).alias("比例"))


@query(f"""
with {STAT_SQL}, s as (select cls as k, count(*) as n, count(*) / sum(count(*)) over () as share from c group by 1),
y as (select size as k, count(*) as n, count(*) / sum(count(*)) over () as share from z group by 1)
select 0 as part, 0 as no, '图片总数量：' || count(*) as line from c union all select 1, 0, '目标总数量：' || count(*) from z
union all select 2, row_number() over (order by n desc, k), ' - ' || k || ': ' || printf('%.2f%%', 100 * share) from s
union all select 3, row_number() over (order by n desc, k), ' - ' || k || ': ' || printf('%.2f%%', 100 * share) from y
union all select 4, 0, '图片级遮挡/贴靠比例：' || printf('%.2f%%', 100 * avg(has::int)) from c
""")
def q64_statistics_advice(spark, sf):
    return reports.advice(*_statistics(spark, sf)).withColumn("no", F.col("no").cast("long"))


@query(f"""
with {STAT_SQL}
select (select count(*) from c)::bigint as images, (select count(*) from z)::bigint as targets, (select round(avg(has::int), 6) from c) as overlap,
  (select round(count_if(size = '小尺寸') / count(*), 6) from z) as small, (select round(count_if(cls = '单件包裹') / count(*), 6) from c) as single
""")
def q65_statistics_summary(spark, sf):
    made = reports.statistics_summary(*_statistics(spark, sf))
    kinds = "`图片总数量` long, `目标总数量` long, `图片级_包裹数量分布` map<string,double>, `目标级_尺寸分布` map<string,double>, `图片级_遮挡贴靠比例` double"
    rows = made.select(F.from_json("summary", kinds).alias("s"))
    share = lambda m, k, n: F.round(F.coalesce(F.col(f"s.{m}")[k], F.lit(0.0)), 6).alias(n)
    return rows.select(
        F.col("s.图片总数量").alias("images"), F.col("s.目标总数量").alias("targets"), F.round("s.图片级_遮挡贴靠比例", 6).alias("overlap"),
        share("目标级_尺寸分布", "小尺寸", "small"), share("图片级_包裹数量分布", "单件包裹", "single"),
    )


@query("""
select p_partkey, 'p' || p_partkey || chr(10) || '    Original : ' || p_size || ' x ' || p_size * 2 || chr(10) || '    Final    : ' || p_size * 2 || ' x ' || p_size || chr(10)
  || '    Ratio    : ' || printf('%.6f', p_size * 2 / p_size) || chr(10) || '    Action   : REMOVED' || chr(10) || chr(10) as record from part
""")
def q66_aspect_warnings(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", _text("p", F.col("p_partkey")).alias("path"), F.col("p_size").cast("int").alias("w"))
    rows = rows.withColumn("h", F.col("w") * 2).withColumn("u", geometry.upright("w", "h"))
    rows = rows.withColumns({"fw": F.col("u.width"), "fh": F.col("u.height")}).where(~geometry.is_16_by_9("fw", "fh"))
    return rows.select("p_partkey", reports.aspect_warning("path", "w", "h", "fw", "fh", True).alias("record"))


@query("""
with v as (select user_id, count_if(event_id % 7 = 0) as saved from events group by user_id)
select count_if(saved > 0)::bigint as success, count_if(saved = 0)::bigint as failed, sum(saved)::bigint as saved,
  coalesce((select string_agg('v' || user_id, ',' order by 'v' || user_id) from v where saved = 0), '') as failed_videos from v
""")
def q67_run_totals(spark, sf):
    videos = table(spark, sf, "events").groupBy(_text("v", F.col("user_id")).alias("video")).agg(F.count_if(F.col("event_id") % 7 == 0).alias("saved"))
    return reports.run_totals(videos).withColumn("failed_videos", F.array_join("failed_videos", ","))


@query("""
with f as (select c_custkey % 200 as stem, c_mktsegment || '/' || c_custkey as path from customer)
select stem::varchar as stem, string_agg(path, ',' order by path) as paths from f group by stem
""")
def q68_stem_groups(spark, sf):
    rows = table(spark, sf, "customer").select((custkey() % 200).cast("string").alias("stem"), _text(mktsegment(), "/", custkey()).alias("path"))
    return audit.stem_groups(rows).withColumn("paths", F.array_join("paths", ","))


@query("select c_custkey::varchar as stem from customer union select o_custkey::varchar from orders union select s_suppkey::varchar from supplier")
def q69_all_stems(spark, sf):
    frame = lambda t, c: table(spark, sf, t).select(F.col(c).cast("string").alias("stem"))
    return audit.all_stems(frame("customer", "c_custkey"), frame("orders", "o_custkey"), frame("supplier", "s_suppkey"))


@query("""
select source::int as source, k, row_number() over (order by source, k)::bigint as place from (
  select 0 as source, r_regionkey as k from region union all select 1, n_nationkey from nation union all select 2, r_regionkey from region)
""")
def q70_lists_in_turn(spark, sf):
    region, nation = (table(spark, sf, t).select(F.col(c).alias("k")) for t, c in (("region", "r_regionkey"), ("nation", "n_nationkey")))
    rows = audit.in_turn(region, nation, region).withColumn("_all", F.lit(0))
    return stats.numbered(rows, ["_all"], ["source", "k"], "place").select("source", "k", F.col("place").cast("long").alias("place"))


@query("select c_custkey, c_mktsegment from customer where lower(c_mktsegment) in ('building', 'machinery') order by c_custkey limit 50")
def q71_of_datasets(spark, sf):
    wanted = spark.createDataFrame([("Building",), ("MACHINERY",), ("none",)], "dataset string")
    rows = audit.of_datasets(table(spark, sf, "customer").select("c_custkey", mktsegment().alias("dataset")), wanted)
    return audit.samples(rows, ["c_custkey"], 50).withColumnRenamed("dataset", "c_mktsegment")


@query("""
with f as (select 'n' || c_nationkey || '/s' || c_custkey % 5 || '/' || c_custkey as path from customer where c_nationkey % 3 <> 0 and c_custkey % 5 <> 2),
d as (select distinct 'n' || c_nationkey as folder from customer union select distinct 'n' || c_nationkey || '/s' || c_custkey % 5 from customer)
select folder, len(string_split(folder, '/'))::int as depth from d where not exists (select 1 from f where starts_with(path, folder || '/'))
""")
def q72_empty_folders(spark, sf):
    top, sub = _text("n", nationkey()), _text("n", nationkey(), "/s", custkey() % 5)
    rows = table(spark, sf, "customer")
    folders = rows.select(F.explode(F.array(top, sub)).alias("folder")).distinct()
    files = rows.where((nationkey() % 3 != 0) & (custkey() % 5 != 2)).select(F.concat(sub, F.lit("/"), custkey().cast("string")).alias("path"))
    return sinks.empty_folders(folders, files)


@query("""
select '/f/v' || user_id || '_img_' || event_id || '.jpg' as source from events where user_id = 7
""")
def q73_stale_outputs(spark, sf):
    name = _text("v", F.col("user_id"), "_img_", F.col("event_id"), ".jpg")
    files = table(spark, sf, "events").select(name.alias("name"), F.concat(F.lit("/f/"), name).alias("path"))
    return sinks.stale_outputs(files, "v7").select("source")


@query("""
with f as (select n_nationkey as no, n_name || '''s.jpg' as path from nation)
select no, 0 as part, 'file ''' || replace(path, '''', '''\\''''') || '''' as line from f union all select no, 1, 'duration 0.040000000000' from f
union all select no, 2, 'file ''' || replace(path, '''', '''\\''''') || '''' from f where no = (select max(no) from f)
""".replace("\\\\", "\\"))
def q74_concat_list(spark, sf):
    frames = table(spark, sf, "nation").select(F.col("n_nationkey").alias("no"), F.concat("n_name", F.lit("'s.jpg")).alias("path"))
    return sinks.concat_lines(frames, 25.0)


@query("""
select c_custkey as k, case when c_custkey % 6 = 0 then 'missing' when c_custkey % 6 = 1 then 'already_ok' when c_custkey % 6 = 2 then 'conflict' when c_custkey % 6 = 3 then 'already_ok' else 'ready' end as status from customer
""")
def q75_plan_status(spark, sf):
    source, goal, m = _text("/s/", custkey()), _text("/g/", custkey()), custkey() % 6
    rows = table(spark, sf, "customer")
    plan = rows.select(custkey().alias("k"), source.alias("source"), goal.alias("destination"))
    here = rows.where(~m.isin(0, 1)).select(source.alias("path"), F.lit(10).alias("length"))
    there = rows.where(m.isin(1, 2, 3)).select(goal.alias("path"), F.when(m == 2, 99).otherwise(10).alias("length"))
    return sinks.plan_status(plan, here.unionByName(there)).select("k", "status")


@query("""
select o_orderkey, case when o_orderkey % 4 = 0 then 'dull' || ' | copy failed: gone' when o_orderkey % 4 = 1 then 'dull' when o_orderkey % 4 = 2 then 'copy failed: gone' else '' end as reasons from orders
""")
def q76_failures_in_reasons(spark, sf):
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select("o_orderkey", key.cast("string").alias("path"), F.when(key % 4 < 2, "dull").otherwise("").alias("reasons"))
    done = rows.where("o_orderkey % 2 = 0").select(F.col("path").alias("source"), F.lit("failed").alias("status"), F.lit("gone").alias("error"))
    return sinks.with_failures(rows, done).select("o_orderkey", "reasons")


@query("""
with r as (select user_id, event_id, epoch_us(ts) / 1e6 as t from events)
select user_id, count(*)::bigint as frames, round(max(t) - min(t), 3) as seconds from r group by user_id
""")
def q77_frames_per_video(spark, sf):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("frames"), F.round(F.max(seconds) - F.min(seconds), 3).alias("seconds"))


@query("""
select lower('images_cvat' || c_nationkey || '_dataset') as key, 'images_cvat' || c_nationkey || '_DATASET' as dataset from customer group by all
""")
def q78_datasets(spark, sf):
    path = F.when(custkey() % 2 == 0, _text("/x/images_cvat", nationkey(), "_dataset/images/a.jpg")).otherwise(_text("/x/images_cvat", nationkey(), "_DATASET/images/a.jpg"))
    rows = readers.datasets(table(spark, sf, "customer").select(path.alias("path")))
    return rows.select("key", F.upper(F.regexp_extract("dataset", "(_dataset)$|(_DATASET)$", 0)).alias("s"), "dataset").select(
        "key", F.concat(F.regexp_replace("dataset", "(?i)_dataset$", ""), F.lit("_DATASET")).alias("dataset")
    )


@query("""
select doc_id, n_chars >= 500 as usable from documents where n_chars % 3 <> 0 and n_chars % 7 <> 0
""")
def q79_eligible(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id", "n_chars", F.lit(True).alias("readable"), (F.col("n_chars") % 3 == 0).alias("is_duplicate_drop"), (F.col("n_chars") % 7 == 0).alias("fatal_quality")
    )
    return triage.eligible(rows).select("doc_id", (F.col("n_chars") >= 500).alias("usable"))


@query(f"""
with recursive {MATCH_SQL}
select image, g as gt_index from gt where (image, g) not in (select (image, g) from taken where least = 0)
""")
def q80_unmatched(spark, sf):
    gt, pred = _matching_input(spark, sf)
    return matching.unmatched(gt, matching.greedy_match(matching.overlaps(gt, pred)), "gt_index").select("image", "gt_index")


@query(f"""
with recursive {ISSUE_SQL}
select image, count_if(list_contains(tags, 'FN'))::bigint as fn, count_if(list_contains(tags, 'LOW_IOU'))::bigint as low_iou, count_if(list_contains(tags, 'LOW_CONF'))::bigint as low_conf,
  count_if(list_contains(tags, 'ANGLE_ERR'))::bigint as angle_err, count_if(list_contains(tags, 'FP'))::bigint as fp, count_if(object_type = 'GT')::bigint as gt from listed group by image
""")
def q81_issues_per_image(spark, sf):
    return matching.issue_counts(_issues(spark, sf), ["image"])


@query(f"""
with {BOX_SQL}
select image, index, round(degrees(angle) + case when w < h then 90 else 0 end, 4) as angle from b
""")
def q82_rectangle_angles(spark, sf):
    rows = pixels.with_rectangle_angle(_boxes(spark, sf).select("image", "index", "poly"), "poly", "angle")
    return rows.withColumn("angle", F.round("angle", 4))


@query("""
select c_custkey, row_number() over (partition by c_nationkey order by c_custkey)::int as line_no from customer where c_custkey % 3 <> 0
""")
def q83_existing_rows(spark, sf):
    """Rows of lists whose image is there, numbered anew."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", _text(custkey(), ".jpg").alias("normalized"))
    images = table(spark, sf, "customer").where(custkey() % 3 != 0).select(_text(custkey(), ".jpg").alias("path"))
    return stats.numbered(readers.existing_rows(rows, images), ["c_nationkey"], ["c_custkey"], "line_no").select("c_custkey", "line_no")


VECTOR_SQL = """s as (select vec_id, embedding[1:8]::double[] as v, vec_id % 40 as h from embeddings),
near as (select x.vec_id as a, y.vec_id as b from s x join s y on x.vec_id < y.vec_id where bit_count(xor(x.h::bigint, y.h::bigint)) <= 5),
c as (
  select a, b, corr(u, w) as c from (
    select a, b, unnest(x.v) as u, unnest(y.v) as w from near join s x on x.vec_id = a join s y on y.vec_id = b) group by a, b
)"""


@query(f"""
with recursive {VECTOR_SQL}, l as (select a, b from c where c >= 0.8 union all select b, a from c where c >= 0.8),
r(id, other) as (select a, a from l union select id, b from r join l on other = a)
select id as vec_id, min(other) as component from r group by id
""")
def q84_similar_groups(spark, sf):
    """Near hashes, verified by correlation, in groups: the whole chain."""
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.slice("embedding", 1, 8).cast("array<double>").alias("v"), (F.col("vec_id") % 40).cast("long").alias("h")
    )
    pairs = dedup.similar_pairs(rows, "vec_id", "h", "v", least=0.8)
    return dedup.groups(rows.select("vec_id"), pairs.select("a", "b"), "vec_id")
