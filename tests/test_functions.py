import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import geometry, paths, pixels
from quarry.operators import splits, stats
from quarry.sources import readers, sinks


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_paths(spark):
    image = "H:/d/images_cvat00_dataset/images/train/a/b/001.jpg"
    assert one(spark, paths.image_to_label_path("p"), p=image) == "H:/d/images_cvat00_dataset/labels/train/a/b/001.txt"
    entry = "/root/x/images_cvat00_dataset/images/train/a/001.jpg"
    assert one(spark, paths.entry_dataset("p"), p=entry) == "images_cvat00_dataset"
    assert one(spark, paths.entry_relative("p"), p=entry) == "a/001.jpg"
    changed = one(spark, paths.rewrite_prefix("p", "H:/TRAIN_DATA", "/root/new"), p="h:\\TRAIN_DATA\\x\\1.jpg")
    assert tuple(changed) == ("/root/new/x/1.jpg", True)
    assert tuple(one(spark, paths.rewrite_prefix("p", "H:/T", "/r"), p="  ")) == ("", False)
    assert one(spark, paths.normalize_list_path("p"), p=" \"a\\b.jpg\"\t") == "a/b.jpg"
    name = paths.safe_output_name("p", F.array(F.lit("LOW_CONF"), F.lit("FN")))
    assert one(spark, name, p="/h/images_cvat00_dataset/images/train/000123.jpg") == (
        "FN_LOWCONF__images_cvat00_dataset__images__train__000123.jpg"
    )
    frame = paths.frame_name(F.lit("v"), F.lit(1), F.lit(30), F.lit(1.0))
    assert one(spark, frame) == "v_img_000001_frame_00000030_time_000001.000s.jpg"


def test_numbers(spark):
    values = {"30000/1001": 30000 / 1001, "0/0": None, "": None, "25": 25.0, "a": None}
    for text, want in values.items():
        assert one(spark, paths.fraction("p"), p=text) == want
    assert [one(spark, paths.clock("s"), s=s) for s in (5, 198, 3700, -1)] == ["00:05", "03:18", "01:01:40", "--:--"]
    names = ["a10", "a2", "A1", "b", "a02b", "7", "10"]
    rows = spark.createDataFrame([(n,) for n in names], ["n"]).orderBy(paths.natural_key("n"), "n").collect()
    assert [r.n for r in rows] == ["7", "10", "A1", "a2", "a02b", "a10", "b"]


def test_angles(spark):
    for value, want in ((0.5, 28.6479), (-0.3, 17.1887), (2.0, 65.4084), (100.0, 80.0), (170.0, 10.0)):
        assert one(spark, geometry.fold_angle("a"), a=value) == pytest.approx(want, abs=1e-4)
    for a, b, want in ((175.0, 5.0, 10), (0.0, 90.0, 90), (10.0, 170.0, 20)):
        assert one(spark, geometry.angle_difference("a", "b"), a=a, b=b) == pytest.approx(want)


def polygons(spark, p, q):
    to = lambda pts: [{"x": float(x), "y": float(y)} for x, y in pts]
    return spark.createDataFrame([(to(p), to(q))], f"p {geometry.POLYGON}, q {geometry.POLYGON}")


def test_areas_by_batch_equal_the_expression(spark):
    box = lambda a, b: geometry.box(
        F.col("id") * a % 7 * 1.5, F.col("id") * b % 5 * 1.25, F.col("id") % 4 + 1.5, F.col("id") % 3 + 0.5, F.col("id") * a / 10.0
    )
    rows = spark.range(400).withColumn("p", box(3, 2)).withColumn("q", F.reverse(box(5, 7)))
    rows = rows.union(rows.selectExpr("id + 400", "p", "p")).union(rows.limit(9).selectExpr("id + 900", "slice(p, 1, 3)", "q"))
    wanted = {r.id: r.iou for r in rows.select("id", geometry.iou("p", "q").alias("iou")).collect()}
    found = {r.id: r.iou for r in geometry.with_iou(rows, "p", "q").collect()}
    assert found == pytest.approx(wanted, abs=1e-9)
    odd = spark.sql("select * from values (1), (2), (3) t(id)").select(
        "id",
        F.when(F.col("id") == 1, geometry.aabb(F.lit(0), F.lit(0), F.lit(1), F.lit(1))).alias("p"),
        F.when(F.col("id") == 2, geometry.aabb(F.lit(0), F.lit(0), F.lit(1), F.lit(1))).alias("q"),
    )
    assert [r.iou for r in geometry.with_iou(odd, "p", "q").collect()] == [0.0] * 3
    assert geometry.with_iou(odd.where("id > 3"), "p", "q").collect() == []


def test_intersection(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    shifted = [(2, 2), (2, 6), (6, 6), (6, 2)]  # clockwise
    d = math.sqrt(2)
    cases = [
        (square, shifted, 4.0),
        ([(-1, -1), (1, -1), (1, 1), (-1, 1)], [(d, 0), (0, d), (-d, 0), (0, -d)], 8 * (d - 1)),
        (square, [(9, 9), (10, 9), (10, 10), (9, 10)], 0.0),
    ]
    for p, q, want in cases:
        df = polygons(spark, p, q)
        assert df.select(geometry.intersection_area("p", "q")).first()[0] == pytest.approx(want)
        assert df.select(geometry.intersection_area("q", "p")).first()[0] == pytest.approx(want)
    assert polygons(spark, square, shifted).select(geometry.iou("p", "q")).first()[0] == pytest.approx(4 / 28)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 300), st.integers(1, 200), st.integers(1, 200))
def test_rectangle_angle(turn, w, h):
    a = math.radians(turn)
    rot = np.array([[math.cos(a), -math.sin(a)], [math.sin(a), math.cos(a)]])
    got = pixels.rectangle_angle((np.array([[0, 0], [w, 0], [w, h], [0, h]]) @ rot.T))
    wants = [turn % 180, (turn + 90) % 180] if w == h else [(turn if w > h else turn + 90) % 180]
    assert min(min(abs(got - x), 180 - abs(got - x)) for x in wants) < 1e-6


def test_pixels():
    img = np.random.default_rng(1).integers(0, 256, (40, 60, 3), dtype=np.uint8)
    assert pixels.resize_area(img, 40, 60) == pytest.approx(img.astype(float))
    assert pixels.resize_area(img, 1, 1)[0, 0] == pytest.approx(img.reshape(-1, 3).mean(axis=0))
    assert 0 <= pixels.phash(img) < 2**63 and pixels.phash(img) == pixels.phash(img.copy())
    assert pixels.hsv_histogram(img).sum() == pytest.approx(1, abs=1e-5)
    flat = np.full((30, 30, 3), 240, np.uint8)
    assert pixels.quality(flat) == pytest.approx((0, 240, 0, 1))
    eye = np.array([[50, 0, 30], [0, 50, 20], [0, 0, 1]], float)
    x, y = pixels.undistort_map(eye, np.zeros(5), 40, 60)
    assert pixels.remap(img, x, y) == pytest.approx(img.astype(float))


def test_aspect_and_classes(spark):
    for w, h, want in ((1920, 1080, True), (1366, 768, True), (1280, 800, False), (0, 9, False)):
        assert one(spark, geometry.is_16_by_9("w", "h"), w=w, h=h) is want
    assert [one(spark, stats.count_class("n"), n=n) for n in (0, 1, 3, 6, 7)] == list(stats.COUNT_CLASSES)
    assert [one(spark, stats.size_class("r"), r=r) for r in (0.0299, 0.03, 0.0999, 0.1)] == [
        stats.SIZE_CLASSES[i] for i in (0, 1, 1, 2)
    ]
    assert [one(spark, splits.train_size(F.col("n"), 0.8), n=n) for n in (1, 2, 5, 10)] == [1, 1, 4, 8]


def test_readers(spark):
    files = spark.createDataFrame([("l", "\ufeff\"a\\1.jpg\"\r\n\n b.jpg ")], ["file", "value"])
    assert [(r.line_no, r.normalized) for r in readers.parse_lines(files).collect()] == [(1, "a/1.jpg"), (3, "b.jpg")]
    good = spark.createDataFrame([("l", "0 0 0 1 0 1 1 0 1\n\n2.0 0 0 1 0 1 1 0 1\n")], ["file", "value"])
    assert [(r.gt_index, r.cls) for r in readers.parse_labels(good).collect()] == [(0, 0), (1, 2)]
    bad = spark.createDataFrame([("l", "0 1 2")], ["file", "value"])
    assert readers.parse_labels(bad, strict=False).count() == 0
    with pytest.raises(Exception, match="nine tokens"):
        readers.parse_labels(bad).collect()
    assert readers.inventory(spark, "/tmp/quarry-no-such-folder").count() == 0
    yaml = "%YAML:1.0\nimage_width: 2560\nimage_height: 1440\nrms: 2.8e-01\ncamera_matrix: !!opencv-matrix\n   data: [1,0,2,0,1,3,0,0,1]\ndistortion_coefficients: !!opencv-matrix\n   data: [ 1., 2., 3., 4. ]\n"
    assert readers.calibration(yaml)["camera_matrix"][5] == 3.0


def test_sinks(spark):
    assert sinks.patch_yaml("  train: a\nnames: x\n", "t", "v") == "  train: t\nnames: x\nval: v\n"
    frames = spark.createDataFrame([(1, "a.jpg"), (2, "b.jpg")], ["no", "path"])
    lines = [r.line for r in sinks.concat_lines(frames, 25).orderBy("no", "part").collect()]
    assert lines == ["file 'a.jpg'", "duration 0.040000000000", "file 'b.jpg'", "duration 0.040000000000", "file 'b.jpg'"]
