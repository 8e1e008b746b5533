"""Scans: images, labels, list files, detections, calibration, probes and logs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import paths

GT = "image string, gt_index int, cls int, poly array<struct<x:double,y:double>>"
PROBE = (
    "streams array<struct<codec_name:string,codec_long_name:string,width:int,height:int,r_frame_rate:string,"
    "avg_frame_rate:string,nb_frames:string,duration:string,time_base:string>>,format struct<duration:string>"
)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def inventory(
    spark: SparkSession,
    root: str,
    extensions: tuple[str, ...] = paths.IMAGE_EXTENSIONS,
    recursive: bool = True,
    missing: str = "empty",
    limit: int | None = None,
    order: str | None = None,
) -> DataFrame:
    """``path, length, mtime, name, stem, ext`` of the files below root, contents unread.

    A missing root gives no rows, or an error with ``missing="error"``, which wants
    at least one file, too; ``order`` is "path" (whatever its case), "natural" (digit
    runs by value) or "numeric" (numeric names first); ``limit`` takes the first files
    in order, before anything is decoded."""
    if not exists(spark, root):
        if missing == "error":
            raise FileNotFoundError(root)
        return spark.createDataFrame([], "path string, length long, mtime timestamp, name string, stem string, ext string")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
        .select("path", "length", F.col("modificationTime").alias("mtime"))
        .withColumn("name", F.regexp_extract("path", "([^/]*)$", 1))
        .withColumn("stem", paths.stem("path")).withColumn("ext", paths.extension("path"))
        .where(F.col("ext").isin(*extensions))
    )
    if missing == "error" and files.isEmpty():
        raise FileNotFoundError(f"no image in {root}")
    keys = {
        "path": [F.lower("path"), "path"], "natural": [paths.natural_key("name"), "path"], "numeric": [paths.numeric_key("name"), "path"],
    }[order or "path"]
    return files.orderBy(*keys).limit(limit) if limit else files.orderBy(*keys) if order else files


def datasets(images: DataFrame) -> DataFrame:
    """Distinct dataset names, one spelling of each, in order."""
    name = F.regexp_extract("path", paths.DATASET, 1)
    return (
        images.select(name.alias("dataset")).where("dataset <> ''")
        .groupBy(F.lower("dataset").alias("key")).agg(F.min("dataset").alias("dataset")).orderBy("key")
    )


def existing_rows(rows: DataFrame, images: DataFrame) -> DataFrame:
    """List rows whose image is there; an error if there is none at all."""
    known = images.select(F.col("path").alias("normalized")).distinct()
    kept = rows.join(known, "normalized", "left_semi")
    if kept.isEmpty():
        raise FileNotFoundError("no image of the list is there")
    return kept


def list_rows(spark: SparkSession, path: str, missing: str = "empty") -> DataFrame:
    """``file, line_no, original, normalized`` of the non-blank lines of list files."""
    if not exists(spark, path):
        if missing == "error":
            raise FileNotFoundError(path)
        return spark.createDataFrame([], "file string, line_no int, original string, normalized string")
    return parse_lines(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value"))


def parse_lines(files: DataFrame) -> DataFrame:
    """Lines of ``file, value`` with their numbers, without a byte order mark."""
    body = F.regexp_replace("value", "^﻿", "")
    return (
        files.select("file", F.posexplode(F.split(body, "\r\n?|\n")).alias("pos", "original"))
        .where(paths.strip("original") != "")
        .select("file", (F.col("pos") + 1).alias("line_no"), "original", paths.normalize_list_path("original").alias("normalized"))
    )


def parse_labels(files: DataFrame, strict: bool = True) -> DataFrame:
    """``file, gt_index, cls, poly`` (corners in 0..1) of label texts ``file, value``.

    Strict: each non-blank line has exactly nine tokens, else an error.  Lenient:
    lines with fewer are skipped, classes and further tokens ignored."""
    lines = parse_lines(files).withColumn("t", F.split(paths.strip("original"), r"\s+"))
    if strict:
        lines = lines.withColumn(
            "t",
            F.when(F.size("t") == 9, F.col("t")).otherwise(
                F.raise_error(F.concat(F.lit("label line without nine tokens: "), "file", F.lit(":"), F.col("line_no")))
            ),
        )
    else:
        lines = lines.where(F.size("t") >= 9)
    corner = "transform(sequence(0, 3), i -> named_struct('x', cast(t[1 + 2 * i] as double), 'y', cast(t[2 + 2 * i] as double)))"
    order = F.expr("row_number() over (partition by file order by line_no)") - 1
    cls = F.expr("cast(cast(t[0] as double) as int)") if strict else F.lit(None).cast("int")
    return lines.select("file", order.alias("gt_index"), cls.alias("cls"), F.expr(corner).alias("poly"))


def labels(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    return parse_labels(files.select(F.input_file_name().alias("file"), "value"), strict)


def denormalize(boxes: DataFrame) -> DataFrame:
    """Corners in pixels, through float as label tools keep them; needs width, height."""
    scaled = "transform(poly, v -> named_struct('x', cast(cast(v.x * width as float) as double), 'y', cast(cast(v.y * height as float) as double)))"
    return boxes.withColumn("poly", F.expr(scaled))


def decoded_images(spark: SparkSession, root: str, on_error: str = "flag") -> DataFrame:
    """``path, height, width, channels, data`` (BGR bytes).  on_error: "flag" keeps
    unreadable files with a null height, "drop" leaves them out, "fail" raises."""
    image = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", on_error == "drop").load(root)
    rows = image.select(
        F.col("image.origin").alias("path"),
        *(F.when(F.col("image.height") > 0, F.col(f"image.{c}")).alias(n)
          for c, n in (("height", "height"), ("width", "width"), ("nChannels", "channels"), ("data", "data"))),
    )
    if on_error == "fail":
        bad = F.raise_error(F.concat(F.lit("unreadable image: "), "path"))
        rows = rows.withColumn("height", F.coalesce("height", bad.cast("int")))
    return rows


def calibration(text: str) -> dict:
    """The fields of an OpenCV calibration YAML; driver side, a small file."""
    number = lambda key: re.search(rf"^{key}:\s*([-+.\deE]+)", text, re.M)
    matrix = lambda key: [
        float(x) for x in re.search(rf"^{key}:.*?data:\s*\[(.*?)\]", text, re.M | re.S)[1].split(",")
    ]
    out = {
        "image_width": int(float(number("image_width")[1])),
        "image_height": int(float(number("image_height")[1])),
        "rms": float(number("rms")[1]) if number("rms") else None,
        "camera_matrix": matrix("camera_matrix"),
        "distortion_coefficients": matrix("distortion_coefficients"),
    }
    if len(out["camera_matrix"]) != 9:
        raise ValueError("the camera matrix must be 3 by 3")
    if len(out["distortion_coefficients"]) not in (4, 5, 8, 12, 14):
        raise ValueError("4, 5, 8, 12 or 14 distortion coefficients are supported")
    return out


def probe(rows: DataFrame, column: str = "probe") -> DataFrame:
    """Video facts from ffprobe JSON; bad JSON gives nulls."""
    first = F.get(F.col("_p.streams"), F.lit(0))
    return rows.withColumn("_p", F.from_json(column, PROBE)).select(
        *(c for c in rows.columns if c != column),
        first["codec_name"].alias("codec"), first["width"].alias("width"), first["height"].alias("height"),
        paths.frame_rate(first["avg_frame_rate"], first["r_frame_rate"]).alias("fps"),
        paths.duration(first["duration"], F.col("_p.format.duration")).alias("seconds"),
        first["nb_frames"].try_cast("long").alias("frames"),
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.input_file_name().alias("video"), F.col("value").alias("line"))
