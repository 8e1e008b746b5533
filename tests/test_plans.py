"""Whole workflows on small tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import geometry, pixels
from quarry.operators import matching
from quarry.plans import triage
from quarry.sources import readers, reports

from tests_common import bmp


def test_from_files_to_report(spark, tmp_path):
    """Scan, decode, measure, group, score and report."""
    draw = np.random.default_rng(5)
    noise = draw.integers(60, 200, (40, 40, 3))
    blurred = np.full((40, 40, 3), 128)
    for name, img in (("a", noise), ("b", noise), ("c", noise), ("d", noise[::-1]), ("e", blurred)):
        (tmp_path / f"{name}.bmp").write_bytes(bmp([[tuple(int(x) for x in p) for p in row] for row in img]))
    (tmp_path / "f.png").write_bytes(b"broken")
    measured = pixels.metrics(readers.decoded_images(spark, str(tmp_path)))
    boxes = [("a", 0, 0.9, 20.0, 20.0, 8.0, 8.0, 0.0), ("a", 1, 0.1, 22.0, 22.0, 8.0, 8.0, 0.0), ("d", 0, 0.95, 20.0, 20.0, 12.0, 12.0, 0.0)]
    where = {r.path[-5]: r.path for r in measured.where("height is not null").collect()}
    pred = spark.createDataFrame([(where[n], *rest) for n, *rest in boxes], "image string, pred_index int, conf double, cx double, cy double, w double, h double, angle double")
    pred = pred.withColumn("poly", geometry.box("cx", "cy", "w", "h", "angle"))
    scored = triage.triage(measured, pred, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: r for r in reports.triage_report(scored).collect()}
    assert len(rows) == 6 and rows["f.png"].category == "unreadable" and rows["f.png"].challenge_score == -99
    assert rows["e.bmp"].category == "low_value" and rows["e.bmp"].blur_var == 0
    assert sorted(rows[f"{n}.bmp"].duplicate_rank for n in "abc") == [1, 2, 3]
    assert [rows[f"{n}.bmp"].category for n in "abc"].count("duplicate") == 1
    assert rows["d.bmp"].duplicate_group == -1 and rows["d.bmp"].n_det == 1
    summary = json.loads(reports.triage_summary(scored, {"input": "x"}, {}).first().summary)
    assert summary["total_images"] == 6 and summary["duplicate_groups"] == 1 and sum(summary["counts"].values()) == 6


def test_statistics_frames(spark):
    images = spark.createDataFrame([("a", 100, 100, "s"), ("b", 100, 100, "s")], "path string, width int, height int, dataset string")
    boxes = spark.createDataFrame([("a", 1, 50.0, 50.0, 40.0, 20.0, 0.0), ("a", 2, 55.0, 50.0, 10.0, 30.0, 0.0)], "image string, index int, cx double, cy double, w double, h double, angle double")
    boxes = boxes.withColumn("poly", geometry.box("cx", "cy", "w", "h", "angle"))
    frames = triage.statistics(images, boxes)
    assert {r.count_class: r.n for r in frames["counts"].collect()} == {"无目标": 1, "2-3件包裹": 1}
    assert {r.bin: r.n for r in frames["angles"].collect() if r.n} == {1: 1, 7: 1}
    per_image = reports.image_statistics(images, boxes, matching.pair_overlaps(boxes))
    targets = reports.target_statistics(images, boxes)
    lines = [r.line for r in reports.advice(per_image, targets).orderBy("part", "no").collect()]
    assert lines[:2] == ["图片总数量：2", "目标总数量：2"] and lines[-1] == "图片级遮挡/贴靠比例：50.00%"
    empty = boxes.limit(0)
    nothing = reports.target_statistics(images, empty)
    assert json.loads(reports.statistics_summary(per_image.limit(0), nothing).first().summary)["图片总数量"] == 0


def test_corrected_and_turned_images(spark):
    img = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    rows = [("wide", 4, 6, 3, img.tobytes()), ("tall", 6, 4, 3, np.rot90(img).copy().tobytes()), ("bad", None, None, None, None), ("twice", 8, 12, 3, bytes(8 * 12 * 3))]
    images = spark.createDataFrame(rows, "path string, height int, width int, channels int, data binary")
    got = {r.path: r for r in pixels.turned(images).collect()}
    assert (got["tall"].height, got["tall"].width) == (4, 6) and bytes(got["tall"].data) == img.tobytes() and got["bad"].error == "unreadable"
    lens = {"image_width": 6, "image_height": 4, "camera_matrix": [5.0, 0, 3, 0, 5, 2, 0, 0, 1], "distortion_coefficients": [0.0, 0, 0, 0]}
    got = {r.path: r for r in pixels.corrected(images, lens).collect()}
    assert bytes(got["wide"].data) == img.tobytes() and "calibrated for 6 x 4" in got["tall"].error and got["twice"].data is None
    assert pixels.corrected(images, lens, other_sizes=True).where("path = 'twice'").first().error is None


def test_inventory_wants_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.inventory(spark, str(tmp_path), missing="error")
    rows = spark.createDataFrame([("a",)], "normalized string")
    with pytest.raises(FileNotFoundError):
        readers.existing_rows(rows, spark.createDataFrame([("b",)], "path string"))
    assert readers.existing_rows(rows, rows.select(F.col("normalized").alias("path"))).count() == 1
