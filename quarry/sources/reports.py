"""Reports as DataFrames in their written form: columns, order, rounding, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry, paths
from quarry.operators import stats
from quarry.operators.matching import ADVICE

#: The columns of the triage report, with the digits kept of each number.
TRIAGE = {
    "path": None, "rel_path": None, "category": None, "keep_drop": None, "reasons": None,
    "duplicate_group": None, "duplicate_rank": None, "width": None, "height": None,
    "blur_var": 4, "brightness": 4, "dark_ratio": 6, "bright_ratio": 6, "quality_score": 6, "n_det": None,
    "mean_conf": 6, "min_conf": 6, "max_conf": 6, "uncertain_ratio": 6, "very_low_conf_ratio": 6,
    "edge_ratio": 6, "small_ratio": 6, "huge_ratio": 6, "angled_ratio": 6, "extreme_aspect_ratio": 6,
    "overlap_pair_ratio": 6, "challenge_score": 6, "output_path": None,
}
#: The columns of the problem report, with the digits kept.
PROBLEMS = {
    "source_dataset": None, "image": None, "label": None, "output_image": None, "object_type": None, "gt_index": None,
    "issues": None, "confidence": 6, "best_iou": 6, "angle_error_deg": 4, "aspect_ratio": 4, "recommended_action": None,
}
#: The columns of the statistics.
IMAGES = {
    "path": "图片路径", "dataset": "数据集来源", "width": "图像宽度", "height": "图像高度",
    "n": "包裹数量", "count_class": "数量类别", "has_overlap": "是否存在遮挡贴靠",
}
TARGETS = {
    "path": "图片路径", "dataset": "数据集来源", "index": "目标编号", "width": "图像宽度", "height": "图像高度",
    "x": "中心X(pixel)", "y": "中心Y(pixel)", "nx": "归一化中心X", "ny": "归一化中心Y",
    "area_ratio": "面积占比", "size_class": "尺寸类别", "angle_deg": "角度(度)",
}


def _written(df: DataFrame, columns: dict[str, int | None]) -> DataFrame:
    return df.select(*(F.col(c) if d is None else F.bround(F.col(c), d).alias(c) for c, d in columns.items()))


def triage_report(scored: DataFrame) -> DataFrame:
    """The 28 columns of a triage report; images without a group have -1."""
    return _written(scored.fillna(-1, ["duplicate_group", "duplicate_rank"]), TRIAGE)


def triage_summary(scored: DataFrame, inputs: dict[str, str], parameters: dict[str, object]) -> DataFrame:
    """``summary``: one JSON text with the inputs, totals, counts per decision in
    order of their names, and the parameters."""
    name = F.concat_ws("/", "keep_drop", "category")
    counts = scored.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("name", "n"))).alias("c"), F.sum("n").alias("total"))
    groups = scored.agg(F.countDistinct(F.when(F.col("duplicate_group") > 0, F.col("duplicate_group"))).alias("groups"))
    fixed = lambda d: F.create_map(*(F.lit(x) for k, v in d.items() for x in (k, str(v)))) if d else F.lit(None)
    return listed.crossJoin(groups).select(  # one row each
        F.to_json(
            F.struct(
                *(F.lit(v).alias(k) for k, v in inputs.items()),
                F.coalesce("total", F.lit(0)).alias("total_images"), F.col("groups").alias("duplicate_groups"),
                F.map_from_entries("c").alias("counts"), fixed(parameters).alias("parameters"),
            )
        ).alias("summary")
    )


def problem_report(issues: DataFrame) -> DataFrame:
    """The 12 columns of a problem report; an image's copy is named after all its tags."""
    rows = image_names(issues).withColumns(
        {
            "source_dataset": F.coalesce(paths.source_dataset("image"), F.lit("")),
            "label": paths.image_to_label_path("image"),
            "output_image": F.col("output_name"),
        }
    )
    rows = rows.withColumn("best_iou", F.when(F.col("object_type") == "GT", F.coalesce("best_iou", F.lit(0.0))))
    return _written(rows, PROBLEMS)


def image_names(issues: DataFrame) -> DataFrame:
    """``output_name`` of all rows of an image from all its tags: what its copy is called."""
    tags = issues.select("image", F.explode("tags").alias("t")).groupBy("image").agg(F.collect_set("t").alias("_tags"))
    return issues.drop("output_name").join(tags, "image", "left").withColumn(
        "output_name", paths.safe_output_name("image", F.coalesce("_tags", F.array().cast("array<string>")))
    ).drop("_tags")


def problem_totals(issues: DataFrame) -> DataFrame:
    """One row: images, ground truth, images with a problem, and each issue's number."""
    with_any = F.size("tags") > 0
    return issues.agg(
        F.countDistinct("image").alias("images"),
        F.count_if(F.col("object_type") == "GT").alias("gt"),
        F.countDistinct(F.when(with_any, F.col("image"))).alias("problem_images"),
        *(F.count_if(F.array_contains("tags", t)).alias(t.lower()) for t in ADVICE),
    )


def problem_summary(totals: DataFrame) -> DataFrame:
    """``no, line``: the totals as lines of text."""
    named = (("images", "验证图片总数"), ("gt", "GT 总数"), ("problem_images", "问题图片数"), ("fn", "FN 漏检"), ("low_conf", "LOW_CONF 低置信度"),
             ("low_iou", "LOW_IOU OBB定位偏差"), ("angle_err", "ANGLE_ERR 角度误差"), ("fp", "FP 误检"))
    lines = F.array(*(F.concat(F.lit(f"{text}："), F.col(c).cast("string")) for c, text in named))
    return totals.select(F.posexplode(lines).alias("no", "line"))


def image_statistics(images: DataFrame, boxes: DataFrame, overlaps: DataFrame) -> DataFrame:
    """A row per image: its targets, their class of number, and whether any overlap."""
    keyed = images.withColumnRenamed("path", "image")
    per_image = stats.counted_per(keyed, boxes, "image").withColumn("count_class", stats.count_class("n"))
    rows = keyed.join(per_image, "image").join(overlaps.select("image", "has_overlap"), "image", "left")
    rows = rows.withColumn("path", F.col("image")).fillna(False, ["has_overlap"])
    return rows.select(*(F.col(c).alias(n) for c, n in IMAGES.items()))


def target_statistics(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """A row per target: its centre, relative centre, area, size class and angle."""
    rows = boxes.join(images.withColumnRenamed("path", "image"), "image")
    centre = geometry.centre("poly")
    rows = rows.withColumns({"path": F.col("image"), "x": centre["x"], "y": centre["y"]}).withColumns(
        {
            "nx": F.when(F.col("width") > 0, F.col("x") / F.col("width")).otherwise(0.0),
            "ny": F.when(F.col("height") > 0, F.col("y") / F.col("height")).otherwise(0.0),
            "area_ratio": geometry.area("poly") / (F.col("width") * F.col("height")),
            "angle_deg": geometry.long_axis("poly")["angle"],
        }
    )
    rows = rows.withColumn("size_class", stats.size_class("area_ratio"))
    return rows.select(*(F.col(c).alias(n) for c, n in TARGETS.items()))


def angle_distribution(targets: DataFrame, column: str = "角度(度)", step: int = 15) -> DataFrame:
    """Share of each range of angles, empty ones too, in order."""
    bins = stats.binned(targets, column, 0.0, 180.0, 180 // step)
    low = (F.col("bin") - 1) * step
    label = F.concat(low.cast("string"), F.lit("-"), (low + step).cast("string"), F.lit("°"))
    whole = targets.agg(F.count("*").alias("_all"))
    return bins.crossJoin(F.broadcast(whole)).select(  # one row
        "bin", label.alias("角度区间"), F.coalesce(F.try_divide("n", "_all"), F.lit(0.0)).alias("比例")
    )


def statistics_summary(images: DataFrame, targets: DataFrame) -> DataFrame:
    """``summary``: one JSON text of totals and distributions; empty tables give zeros."""
    shared = lambda df, c: stats.shares(df, c).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "share")))).alias("m")
    ).select(F.coalesce("m", F.create_map().cast("map<string,double>")).alias(c))
    total = images.agg(F.count("*").alias("图片总数量"), F.coalesce(F.avg(F.col(IMAGES["has_overlap"]).cast("int")), F.lit(0.0)).alias("图片级_遮挡贴靠比例"))
    whole = total.crossJoin(targets.agg(F.count("*").alias("目标总数量")))  # one row each
    whole = whole.crossJoin(shared(images, "数量类别")).crossJoin(shared(targets, "尺寸类别"))
    return whole.select(
        F.to_json(
            F.struct(
                "图片总数量", "目标总数量", F.col("数量类别").alias("图片级_包裹数量分布"),
                F.col("尺寸类别").alias("目标级_尺寸分布"), "图片级_遮挡贴靠比例",
            )
        ).alias("summary")
    )


def advice(images: DataFrame, targets: DataFrame) -> DataFrame:
    """``part, no, line``: totals, then shares in percent, the largest first, then the
    share of images with overlaps."""
    percent = lambda c: F.format_string("%.2f%%", 100 * c)
    count = lambda df, part, text: df.agg(F.concat(F.lit(text), F.count("*").cast("string")).alias("line")).select(
        F.lit(part).alias("part"), F.lit(0).alias("no"), "line"
    )

    def listed(df: DataFrame, part: int, column: str) -> DataFrame:
        ranked = stats.numbered(stats.shares(df, column).withColumn("_", F.lit(0)), ["_"], [F.desc("n"), column])
        return ranked.select(F.lit(part).alias("part"), "no", F.concat(F.lit(" - "), column, F.lit(": "), percent(F.col("share"))).alias("line"))

    overlap = images.agg(F.avg(F.col(IMAGES["has_overlap"]).cast("int")).alias("s")).where("s is not null")
    return (
        count(images, 0, "图片总数量：").unionByName(count(targets, 1, "目标总数量："))
        .unionByName(listed(images, 2, "数量类别")).unionByName(listed(targets, 3, "尺寸类别"))
        .unionByName(overlap.select(F.lit(4).alias("part"), F.lit(0).alias("no"), F.concat(F.lit("图片级遮挡/贴靠比例："), percent(F.col("s"))).alias("line")))
    )


def aspect_warning(path: str, width: str, height: str, final_width: str, final_height: str, removed: bool) -> Column:
    """The log's lines on an image that isn't 16:9."""
    size = lambda w, h: F.format_string("%d x %d", F.col(w), F.col(h))
    ratio = F.format_string("%.6f", F.col(final_width) / F.col(final_height))
    return F.concat(
        F.col(path), F.lit("\n    Original : "), size(width, height), F.lit("\n    Final    : "), size(final_width, final_height),
        F.lit("\n    Ratio    : "), ratio, F.lit(f"\n    Action   : {'REMOVED' if removed else 'KEPT'}\n\n"),
    )


def run_totals(videos: DataFrame) -> DataFrame:
    """One row from ``video, saved``: a video that saved a frame has succeeded,
    whatever its exit code; the others by name."""
    good = F.col("saved") > 0
    return videos.agg(
        F.count_if(good).alias("success"), F.count_if(~F.coalesce(good, F.lit(False))).alias("failed"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"),
        F.sort_array(F.collect_list(F.when(~F.coalesce(good, F.lit(False)), F.col("video")))).alias("failed_videos"),
    )
