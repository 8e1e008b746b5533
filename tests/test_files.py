"""Files: scans, lists, images decoded from disk, plans carried out, streams."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import paths, pixels
from quarry.operators import audit
from quarry.sources import readers, sinks
from quarry.streaming import ingest

from tests_common import bmp


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "images_cvat1_dataset" / "images" / "train"
    root.mkdir(parents=True)
    for name, colour in (("a10", (255, 0, 0)), ("A9", (0, 255, 0)), ("b", (10, 20, 30))):
        (root / f"{name}.bmp").write_bytes(bmp([[colour] * 4] * 2))
    (root / "broken.png").write_bytes(b"no image")
    (root / "note.txt").write_text("x")
    return tmp_path


def test_inventory_orders(spark, folder):
    files = readers.inventory(spark, str(folder))
    assert {r.name for r in files.collect()} == {"a10.bmp", "A9.bmp", "b.bmp", "broken.png"}
    natural = [r.name for r in files.orderBy(paths.natural_key("name")).collect()]
    assert natural == ["A9.bmp", "a10.bmp", "b.bmp", "broken.png"]
    assert [r.name for r in readers.inventory(spark, str(folder), limit=2).collect()] == ["a10.bmp", "A9.bmp"]
    assert readers.inventory(spark, str(folder), ("txt",)).count() == 1
    assert readers.inventory(spark, str(folder / "gone")).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.inventory(spark, str(folder / "gone"), missing="error")
    assert [r.dataset for r in readers.datasets(files).collect()] == ["images_cvat1_dataset"]


def test_natural_key_of_long_digit_runs(spark):
    names = ["9" * 25, "1" + "0" * 25, "x2", "x10", "x002", "x"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").orderBy(paths.natural_key("n"), "n").collect()
    assert [r.n for r in rows] == ["9" * 25, "1" + "0" * 25, "x", "x002", "x2", "x10"]


def test_decoded_images(spark, folder):
    rows = {os.path.basename(r.path): r for r in readers.decoded_images(spark, str(folder)).collect()}
    assert rows["broken.png"].height is None and (rows["b.bmp"].height, rows["b.bmp"].width) == (2, 4)
    assert bytes(rows["b.bmp"].data[:3]) == bytes((30, 20, 10))
    kept = readers.decoded_images(spark, str(folder), on_error="drop")
    assert kept.count() == 3
    with pytest.raises(Exception, match="unreadable image"):
        readers.decoded_images(spark, str(folder), on_error="fail").collect()


def test_pixel_kernels_by_hand():
    """Values worked out on paper for small images."""
    flat = np.full((8, 8, 3), 100, np.uint8)
    assert pixels.quality(flat) == pytest.approx((0, 100, 0, 0))
    half = flat.copy()
    half[:4] = 0
    blur, brightness, dark, bright = pixels.quality(half)
    assert (dark, bright) == (0.5, 0) and brightness == pytest.approx(50) and blur > 0
    assert pixels.limit_long_side(half, 4).shape[:2] == (4, 4) and pixels.limit_long_side(half, 4)[0, 0, 0] == pytest.approx(0)
    assert pixels.phash(flat) >= 0 and pixels.phash(flat) == pixels.phash(flat)
    red = np.zeros((4, 4, 3), np.uint8)
    red[:, :, 2] = 255  # BGR
    hist = np.asarray(pixels.hsv_histogram(red)).reshape(16, 16)
    assert hist[0, 15] == pytest.approx(1) and hist.sum() == pytest.approx(1)


def test_lists_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"/a/{i:04d}") for i in range(500)], "i int, path string").repartition(7)
    sinks.write_list(rows, str(tmp_path / "list"), "path", ["i"])
    lines = [x for f in sorted((tmp_path / "list").glob("part-*")) for x in f.read_text().splitlines()]
    assert lines == [f"/a/{i:04d}" for i in range(500)]
    sinks.export_list(rows, str(tmp_path / "one.txt"), "path", ["i"])
    assert (tmp_path / "one.txt").read_text() == "".join(f"/a/{i:04d}\n" for i in range(500))
    with pytest.raises(ValueError):
        sinks.export_list(rows, str(tmp_path / "two.txt"), "path", ["i"], max_rows=10)


def test_actions_on_executors(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"{i}.txt").write_text(str(i))
    at = lambda *p: str(tmp_path.joinpath(*p))
    plan = spark.createDataFrame(
        [(at("0.txt"), at("out", "0.txt"), "ready"), (at("1.txt"), at("out", "x", "1.txt"), "ready"), (at("gone.txt"), at("out", "g.txt"), "ready"), (at("2.txt"), at("out", "2.txt"), "missing")],
        "source string, destination string, status string",
    )
    assert {r.status for r in sinks.execute(plan, "copy").collect()} == {"ready", "missing"} and not os.path.exists(at("out"))
    done = {os.path.basename(r.source): r for r in sinks.execute(plan, "copy", dry_run=False).collect()}
    assert {k: r.status for k, r in done.items()} == {"0.txt": "copied", "1.txt": "copied", "gone.txt": "failed", "2.txt": "missing"}
    assert open(at("out", "x", "1.txt")).read() == "1" and "gone.txt" in done["gone.txt"].error
    again = {os.path.basename(r.source): r.status for r in sinks.execute(plan, "link", dry_run=False).collect()}
    assert again["0.txt"] == "already_ok"
    with pytest.raises(OSError, match="gone.txt"):
        sinks.execute(plan, "copy", dry_run=False, stop_on_error=True)
    move = spark.createDataFrame([(at("3.txt"), at("moved", "3.txt"), "ready")], plan.schema)
    for want in ("moved", "already_ok"):
        assert [r.status for r in sinks.execute(move, "move", dry_run=False).collect()] == [want]
    assert not os.path.exists(at("3.txt")) and os.path.exists(at("moved", "3.txt"))
    linked = spark.createDataFrame([(at("2.txt"), at("links", "2.txt"), "ready")], plan.schema)
    assert [r.status for r in sinks.execute(linked, "link", dry_run=False).collect()] == ["linked"]
    assert os.path.samefile(at("2.txt"), at("links", "2.txt"))
    drop = spark.createDataFrame([(at("moved", "3.txt"), None, "ready")], plan.schema)
    assert [r.status for r in sinks.execute(drop, "delete", dry_run=False).collect()] == ["deleted"]
    assert sinks.remove_empty(str(tmp_path)) == 1 and not os.path.exists(at("moved"))
    assert {r.status: r.n for r in sinks.outcome(spark.createDataFrame([("a",), ("a",)], "status string")).collect()} == {"a": 2}


def test_expressions_and_arguments():
    assert sinks.select_expression("frame", 1) is None and sinks.select_expression("frame", 5) == r"select=not(mod(n\,5))"
    assert sinks.select_expression("second", 2) == r"select=isnan(prev_selected_t)+gte(t-prev_selected_t\,2.0)"
    for bad in (("second", 0), ("other", 1)):
        with pytest.raises(ValueError):
            sinks.select_expression(*bad)
    assert paths.inference_size("square") == (960, 960) and paths.inference_size("rect") == (544, 960)
    good = dict(alpha=0.5, quality=95, start=0, width=6, source="/a", output="/b", recursive=True)
    audit.check_arguments(**good)
    for change in ({"alpha": 2}, {"quality": 101}, {"start": -1}, {"width": 0}, {"output": "/a/"}, {"output": "/a/b"}):
        with pytest.raises(ValueError):
            audit.check_arguments(**{**good, **change})


def test_entries_of_odd_paths(spark):
    rows = [
        (r"H:\d\images_cvat01_dataset\images\train\a\b.jpg", "images_cvat01_dataset", "a/b.jpg"), ("x/IMAGES_CVAT2_DATASET//Images/VAL/c.jpg", "IMAGES_CVAT2_DATASET", "c.jpg"),
        ("images_cvat3_dataset/labels/train/a.txt", None, None), ("images_cvat3_dataset/images/train", None, None), ("", None, None),
        ("images_cvat4_dataset/images_cvat5_dataset/images/val/d/e.jpg", "images_cvat5_dataset", "d/e.jpg"),
    ]
    frame = spark.createDataFrame([(p,) for p, _, _ in rows], "p string")
    got = frame.select("p", paths.entry_dataset("p").alias("d"), paths.entry_relative("p").alias("r")).collect()
    assert [tuple(r) for r in got] == rows


def test_arrivals(spark, tmp_path):
    schema = "path string, blur_var double, dark_ratio double, bright_ratio double, height int, width int"
    rows = spark.createDataFrame([("a", 10.0, 0.0, 0.0, 100, 100), ("b", 90.0, 0.0, 0.0, 100, 100)], schema)
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # a second run finds nothing new
        query = ingest.flag_arrivals(ingest.arriving(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination()
    got = {r.path: r.fatal_quality for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": True, "b": False} and spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_free_indices(spark):
    for taken in ([], [5], [0, 1, 2], [7, 3, 3, 20, 10**12], list(range(0, 400, 3))):
        frame = spark.createDataFrame([(x,) for x in taken], "k long").repartition(5)
        got = sorted(r.k for r in audit.free_indices(frame, "k", 1, 25).collect())
        assert got == [x for x in range(1, 1000) if x not in taken][:25]
    assert audit.free_indices(frame, "k", 1, 5).select(F.count("*")).first()[0] == 5
