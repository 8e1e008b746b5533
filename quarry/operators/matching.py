"""Ground truth against predictions: one-to-one matching, issues, reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import geometry, paths
from quarry.tables import Table

#: Limits of the issue rules.
EVAL_CONF, MATCH_IOU, LOW_IOU, LOW_CONF, ANGLE_RATIO, ANGLE_ERROR = 0.25, 0.5, (0.10, 0.80), 0.8, 1.10, 10.0
ADVICE = {"FN": "check label", "LOW_IOU": "check box", "LOW_CONF": "add samples", "ANGLE_ERR": "check angle", "FP": "check for a missing label"}


def _bounded(df: DataFrame, polygon: str, name: str) -> DataFrame:
    return df.withColumns({f"{name}{n}": c for n, c in geometry.bounds(polygon).items()})


def _meet(a: str, b: str) -> str:
    """Whether the bounds of two polygons share an area."""
    return f"{a}x0 < {b}x1 and {b}x0 < {a}x1 and {a}y0 < {b}y1 and {b}y0 < {a}y1"


def overlaps(gt: DataFrame, pred: DataFrame, same_class: bool = True) -> DataFrame:
    """``image, gt_index, pred_index, iou, conf`` of boxes in one image that overlap;
    without ``same_class``, of any two classes, and ``same`` tells if they are one."""
    g = gt.select("image", "gt_index", F.col("cls").alias("g_cls"), F.col("poly").alias("gp"))
    p = pred.select("image", "pred_index", F.col("cls").alias("p_cls"), F.col("poly").alias("pp"), "conf")
    # boxes apart along an axis share nothing: no need to clip them
    pairs = _bounded(g, "gp", "g").join(_bounded(p, "pp", "p"), "image")
    pairs = pairs.where(_meet("g", "p")).withColumn("same", F.col("g_cls").eqNullSafe(F.col("p_cls")))
    named = ["image", "gt_index", "pred_index", "conf"]
    if same_class:
        near = geometry.with_iou(pairs.where("same").select(*named, "gp", "pp"), "gp", "pp")
        return near.select("image", "gt_index", "pred_index", "iou", "conf")
    near = geometry.with_iou(pairs.select(*named, "same", "gp", "pp"), "gp", "pp")
    return near.select("image", "gt_index", "pred_index", "iou", "conf", "same")


def greedy_match(candidates: DataFrame, least_iou: float = MATCH_IOU) -> DataFrame:
    """One-to-one pairs per image: the best IoU first (ties: smaller indices), taken
    if both are still free.  Each choice depends on those before it, so an image is
    one task's; its candidates come in that order in a sorted shuffle and are read
    as a stream: what is held is the taken boxes of one image."""
    wanted = candidates.where(F.col("iou") >= least_iou)
    at = [wanted.columns.index(c) for c in ("image", "gt_index", "pred_index", "iou")]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, left, right = None, set(), set()
        for batch in batches:
            keep = []
            for i, g, p, iou in zip(*(batch.column(k).to_pylist() for k in at)):
                if i != image:
                    image, left, right = i, set(), set()
                free = iou >= least_iou and g not in left and p not in right
                if free:
                    left.add(g)
                    right.add(p)
                keep.append(free)
            yield batch.filter(pa.array(keep, pa.bool_()))

    ordered = wanted.repartition("image").sortWithinPartitions("image", F.desc("iou"), "gt_index", "pred_index")
    return ordered.mapInArrow(match, wanted.schema)


def best_candidates(candidates: DataFrame) -> DataFrame:
    """The prediction that overlaps each ground truth most, if any does."""
    w = Window.partitionBy("image", "gt_index").orderBy(F.desc("iou"), "pred_index")
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1 and iou > 0").drop("_r")


def unmatched(rows: DataFrame, matches: DataFrame, index: str) -> DataFrame:
    return rows.join(matches.select("image", index), ["image", index], "left_anti")


def issues(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """A row per ground truth and per false positive, with issues in a fixed order
    and advice.  Confident predictions decide FN and FP, all of them the rest."""
    confident = pred.where(F.col("conf") >= EVAL_CONF)
    pairs = Table(overlaps(gt, pred, same_class=False), "overlaps").df  # boxes are clipped once
    evaluated = greedy_match(pairs.where((F.col("conf") >= EVAL_CONF) & F.col("same")))
    diagnosed = greedy_match(pairs.where("same"))
    best = best_candidates(pairs)
    axis = lambda df, i, n: df.select("image", i, geometry.long_axis("poly").alias(n))
    on = ["image", "gt_index"]
    rows = (
        gt.select("image", "gt_index")
        .join(evaluated.select(*on, F.lit(True).alias("found")), on, "left")
        .join(diagnosed.select(*on, "pred_index", F.col("conf").alias("match_conf")), on, "left")
        .join(best.select(*on, F.col("iou").alias("best_iou")), on, "left")
        .join(axis(gt, "gt_index", "g_axis"), on, "left")
        .join(axis(pred, "pred_index", "p_axis"), ["image", "pred_index"], "left")
        .withColumn("g_angle", F.col("g_axis.angle")).withColumn("p_angle", F.col("p_axis.angle"))
        .withColumn("angle_error_deg", geometry.angle_difference("g_angle", "p_angle"))
    )
    rules = F.array(
        F.when(F.col("found").isNull(), "FN"),
        F.when((F.col("best_iou") >= LOW_IOU[0]) & (F.col("best_iou") < LOW_IOU[1]), "LOW_IOU"),
        F.when(F.col("match_conf") < LOW_CONF, "LOW_CONF"),
        F.when((F.col("g_axis.ratio") >= ANGLE_RATIO) & (F.col("angle_error_deg") > ANGLE_ERROR), "ANGLE_ERR"),
    )
    advice = F.create_map(*(F.lit(x) for kv in ADVICE.items() for x in kv))
    found = rows.select(
        "image", F.lit("GT").alias("object_type"), "gt_index",
        F.filter(rules, lambda x: x.isNotNull()).alias("tags"),
        F.col("match_conf").alias("confidence"), "best_iou", "angle_error_deg",
        F.col("g_axis.ratio").alias("aspect_ratio"),
    )
    false = unmatched(confident, evaluated, "pred_index").select(
        "image", F.lit("FP").alias("object_type"), F.lit(None).cast("int").alias("gt_index"),
        F.array(F.lit("FP")).alias("tags"), F.col("conf").alias("confidence"),
        *(F.lit(None).cast("double").alias(c) for c in ("best_iou", "angle_error_deg", "aspect_ratio")),
    )
    return found.unionByName(false).withColumns(
        {
            "issues": F.array_join("tags", "|"),
            "recommended_action": F.array_join(F.transform("tags", lambda t: advice[t]), "；"),
            "output_name": paths.safe_output_name("image", "tags"),
        }
    )


def issue_counts(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return rows.groupBy(*(by or [])).agg(
        *(F.count_if(F.array_contains("tags", t)).alias(t.lower()) for t in ADVICE),
        F.count_if(F.col("object_type") == "GT").alias("gt"),
    )


def pair_overlaps(boxes: DataFrame, least: float = 0.15) -> DataFrame:
    """Per image: pairs, overlapping pairs (areas above 1), their share, and
    whether any pair overlaps (strictly, whatever the areas).

    Pairs are counted from the number of boxes; only those whose bounds meet are
    joined and clipped, and an image without any has none that overlap."""
    sized = boxes.select("image", F.col("index").alias("i"), F.col("poly").alias("p"), geometry.area("poly").alias("area"))
    each = sized.groupBy("image", "i").agg(F.count("*").alias("n"), F.count_if(F.col("area") > 1).alias("m"))
    # pairs of different indices
    among = lambda c: ((F.sum(c) * F.sum(c) - F.sum(F.col(c) * F.col(c))) / 2).cast("long")
    counts = each.groupBy("image").agg(among("n").alias("any"), among("m").alias("pairs"))
    a = _bounded(sized, "p", "a")
    b = _bounded(sized.select("image", F.col("i").alias("j"), F.col("p").alias("q")), "q", "b")
    near = a.join(b, "image").where("i < j").where(_meet("a", "b")).select("image", "p", "q")
    near = geometry.with_areas(near, "p", "q")
    near = near.withColumn("o", F.col("area_both") / F.greatest(F.lit(1.0), F.least("area_p", "area_q")))
    real = (F.col("area_p") > 1) & (F.col("area_q") > 1)
    found = near.groupBy("image").agg(
        F.count_if(real & (F.col("o") >= least)).alias("overlapping"), F.bool_or(F.col("o") > least).alias("has_overlap")
    )
    return (
        counts.where("any > 0").drop("any").join(found, "image", "left")
        .fillna(0, ["overlapping"]).fillna(False, ["has_overlap"])
        .withColumn("overlap_pair_ratio", F.coalesce(F.try_divide("overlapping", "pairs"), F.lit(0.0)))
    )
