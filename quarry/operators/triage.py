"""Quality flags, confidence profiles, the scoring ladder and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import paths


def quality_flags(df: DataFrame) -> DataFrame:
    """fatal, moderate blur, moderate lighting from blur_var, dark_ratio, bright_ratio."""
    blur, dark, bright = F.col("blur_var"), F.col("dark_ratio"), F.col("bright_ratio")
    return df.withColumns(
        {
            "fatal_quality": (blur < 20) | (dark >= 0.35) | (bright >= 0.35),
            "moderate_blur": (blur >= 20) & (blur < 80),
            "moderate_lighting": ((dark >= 0.12) & (dark < 0.35)) | ((bright >= 0.10) & (bright < 0.35)),
        }
    )


def quality_score() -> Column:
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    light = F.greatest("dark_ratio", "bright_ratio")
    return (
        0.5 * clip((F.col("blur_var") - 20) / 160)
        + 0.3 * (1 - clip(light / 0.35))
        + 0.2 * clip(F.sqrt(F.col("height").cast("double") * F.col("width")) / 1500)
    )


def confidence_profile(pred: DataFrame, by: str) -> DataFrame:
    """n_det, mean/min/max confidence and the shares of uncertain and very low ones.

    Confidences are added up from the smallest: a sum in the order in which rows come
    differs in its last bit from run to run, and limits would decide by it."""
    share = lambda c: F.avg(c.cast("double"))
    conf, w = F.col("conf"), Window.partitionBy(by).orderBy("conf")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = pred.select(by, "conf").withColumns({"_n": F.row_number().over(w), "_sum": F.sum("conf").over(upto)})
    return added.groupBy(by).agg(
        F.count("*").alias("n_det"),
        F.try_divide(F.max_by("_sum", "_n"), F.count(conf)).alias("mean_conf"), F.min(conf).alias("min_conf"), F.max(conf).alias("max_conf"),
        share(conf.between(0.15, 0.55)).alias("uncertain_ratio"),
        share(conf < 0.15).alias("very_low_conf_ratio"),
    )


#: (metric, weight if it is above 0, weight of its value, reason)
TERMS = (
    ("very_low_conf_ratio", 2.0, 1.0, "very low confidence"),
    ("uncertain_ratio", 1.5, 1.0, "uncertain confidence"),
    ("edge_ratio", 1.2, 0.8, "near the edge"),
    ("small_ratio", 1.2, 0.8, "small target"),
    ("huge_ratio", 0.8, 0.5, "huge target"),
    ("overlap_pair_ratio", 1.5, 1.0, "overlapping targets"),
    ("angled_ratio", 0.8, 0.5, "special angle"),
    ("extreme_aspect_ratio", 0.7, 0.5, "extreme aspect"),
)


def score(df: DataFrame, keep_rate: float = 0.1, seed=42, name: str = "rel_path") -> DataFrame:
    """challenge_score, keep_drop, category and reasons per image.

    In order: unreadable, fatal quality, surplus copy; else the sum of all terms.
    A score of 4 is of high value, 1.5 valuable; what is easy stays by its hash
    with probability ``keep_rate``; the rest is valuable."""
    col = F.col
    any_det = col("n_det") > 0
    terms = [(any_det & (col(m) > 0), F.lit(a) + b * col(m), why) for m, a, b, why in TERMS]
    terms += [
        (col("n_det") == 0, F.lit(3.0), "nothing detected"),
        (any_det & (col("n_det") >= 5), F.least(F.lit(1.5), 0.25 * (col("n_det") - 4)), "many targets"),
        (col("moderate_blur"), F.lit(1.4), "moderate blur"),
        (col("moderate_lighting"), F.lit(1.2), "moderate lighting"),
    ]
    total = F.lit(0.0)
    for on, value, _ in terms:
        total = total + F.when(on, value).otherwise(0.0)
    reasons = paths.joined_reasons(F.array(*(F.when(on, F.lit(why)) for on, _, why in terms)))
    easy = any_det & (col("mean_conf") >= 0.9) & ~col("moderate_blur") & ~col("moderate_lighting")
    for m in ("uncertain_ratio", "very_low_conf_ratio", "edge_ratio", "small_ratio", "huge_ratio", "overlap_pair_ratio"):
        easy = easy & (col(m) == 0)
    ladder = lambda a, b, c, d: (
        F.when(~col("readable"), a).when(col("fatal_quality"), b).when(col("is_duplicate_drop"), c).otherwise(d)
    )
    stays = paths.hash_keep(name, keep_rate, seed)
    routed = df.withColumns({"_total": total, "_easy": easy, "_stays": stays})
    high, worth, dull = (F.col("_total") >= 4.0), (F.col("_total") >= 1.5), (F.col("_easy") & ~F.col("_stays"))
    return routed.withColumns(
        {
            "challenge_score": ladder(F.lit(-99.0), F.lit(-10.0), F.lit(-5.0), F.col("_total")),
            "keep_drop": ladder(*[F.lit("DROP")] * 3, F.when(high | worth | ~dull, "KEEP").otherwise("DROP")),
            "category": ladder(
                F.lit("unreadable"), F.lit("low_value"), F.lit("duplicate"),
                F.when(high, "high_value").when(worth | ~dull, "valuable").otherwise("low_value"),
            ),
            "reasons": ladder(F.lit("unreadable"), F.lit("fatal quality"), F.lit("surplus copy"), reasons),
        }
    ).drop("_total", "_easy", "_stays")


def eligible(df: DataFrame) -> DataFrame:
    """What goes on to the model."""
    return df.where("readable and not is_duplicate_drop and not fatal_quality")


def with_metrics(images: DataFrame, metrics: DataFrame, on: str) -> DataFrame:
    """Metrics attached; images that have none count as without detections, and
    ``inferred`` tells which."""
    joined = images.join(metrics.withColumn("inferred", F.lit(True)), on, "left")
    return joined.fillna(0, [c for c in metrics.columns if c != on]).fillna({"inferred": False})
