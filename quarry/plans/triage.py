"""The three workflows as plans: triage, diagnosis, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry, paths
from quarry.operators import dedup, matching, stats
from quarry.operators import triage as rules


def triage(metrics: DataFrame, detections: DataFrame, root: str, keep: int = 2, keep_rate: float = 0.1, seed=42) -> DataFrame:
    """Pixel metrics and detections (image, conf, poly, w, h, angle) to scored and
    routed images: flags, near-duplicate groups, the profile, the ladder."""
    flagged = rules.quality_flags(metrics.withColumn("readable", F.col("height").isNotNull()))
    flagged = flagged.fillna(False, ["fatal_quality", "moderate_blur", "moderate_lighting"]).withColumn(
        "quality_score", F.coalesce(rules.quality_score(), F.lit(0.0))
    )
    usable = flagged.where("readable").withColumn("id", F.xxhash64("path"))
    pairs = dedup.similar_pairs(usable, "id", "phash", "histogram")
    ranked = dedup.number_groups(
        dedup.rank(dedup.groups(usable.withColumnRenamed("id", "key"), pairs.select("a", "b"), "key"), "key", keep)
    ).select("path", "duplicate_group", "duplicate_rank", "is_duplicate_drop")
    images = flagged.join(ranked, "path", "left").fillna(False, ["is_duplicate_drop"])
    scored = rules.score(
        rules.with_metrics(images, profile(detections, flagged), "path").withColumn(
            "rel_path", F.regexp_replace("path", f"^\\Q{root.rstrip('/')}/\\E", "")
        ),
        keep_rate, seed,
    )
    return scored.withColumn("output_path", paths.output_path(root, "keep_drop", "category", "rel_path"))


def profile(detections: DataFrame, images: DataFrame) -> DataFrame:
    """All shares that the ladder reads, per image path."""
    size = images.select(F.col("path").alias("image"), F.col("width").alias("iw"), F.col("height").alias("ih"))
    seen = detections.join(size, "image")
    ratio = geometry.area_ratio("poly", "iw", "ih")
    share = lambda c, n: F.avg(c.cast("double")).alias(n)
    shapes = seen.groupBy(F.col("image").alias("path")).agg(
        share(geometry.near_edge("poly", "iw", "ih"), "edge_ratio"),
        share(geometry.is_small(ratio), "small_ratio"),
        share(geometry.is_huge(ratio), "huge_ratio"),
        share(geometry.is_angled(geometry.fold_angle("angle")), "angled_ratio"),
        share(geometry.extreme_aspect("w", "h"), "extreme_aspect_ratio"),
    )
    pairs = matching.pair_overlaps(seen.withColumnRenamed("pred_index", "index"))
    return (
        rules.confidence_profile(seen, "image").withColumnRenamed("image", "path")
        .join(shapes, "path")
        .join(pairs.select(F.col("image").alias("path"), "overlap_pair_ratio"), "path", "left")
        .fillna(0.0)
    )


def statistics(images: DataFrame, boxes: DataFrame) -> dict[str, DataFrame]:
    """Image and target tables, and the distributions of targets, sizes and angles."""
    targets = (
        boxes.join(images.select(F.col("path").alias("image"), "width", "height", "dataset"), "image")
        .withColumn("area_ratio", geometry.area("poly") / (F.col("width") * F.col("height")))
        .withColumn("size_class", stats.size_class("area_ratio"))
        .withColumn("angle_deg", geometry.long_axis("poly")["angle"])
        .withColumn("centre", geometry.centre("poly"))
    )
    per_image = stats.counted_per(images.withColumnRenamed("path", "image"), boxes, "image")
    per_image = per_image.withColumn("count_class", stats.count_class("n"))
    return {
        "images": per_image,
        "targets": targets,
        "counts": stats.shares(per_image, "count_class"),
        "sizes": stats.shares(targets, "size_class"),
        "angles": stats.binned(targets, "angle_deg", 0.0, 180.0, 12),
    }
