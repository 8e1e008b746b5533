"""Pixel kernels in numpy, and the Arrow operator that applies them to images.

They follow their definitions (area resampling, type-II DCT, Laplacian, HSV), not
any library's rounding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def gray(bgr: np.ndarray) -> np.ndarray:
    return bgr[..., :3].astype(float) @ np.array([0.114, 0.587, 0.299])


def _area_weights(n: int, m: int) -> np.ndarray:
    """(m, n): what each of n cells gives to m equal spans over them."""
    edges = np.linspace(0, n, m + 1)
    low, high = edges[:-1, None], edges[1:, None]
    cells = np.arange(n)[None, :]
    part = np.clip(np.minimum(high, cells + 1) - np.maximum(low, cells), 0, None)
    return part / part.sum(axis=1, keepdims=True)


def resize_area(img: np.ndarray, height: int, width: int) -> np.ndarray:
    rows, cols = _area_weights(img.shape[0], height), _area_weights(img.shape[1], width)
    out = np.tensordot(rows, img.astype(float), axes=(1, 0))
    return np.moveaxis(np.tensordot(cols, out, axes=(1, 1)), 0, 1)


def limit_long_side(img: np.ndarray, most: int) -> np.ndarray:
    """Scaled down so that the long side is at most ``most``; never up."""
    h, w = img.shape[:2]
    if max(h, w) <= most:
        return img
    scale = most / max(h, w)
    return resize_area(img, max(1, round(h * scale)), max(1, round(w * scale)))


def phash(bgr: np.ndarray) -> int:
    """63 bits: which low DCT frequencies lie above their median, the mean left out."""
    small = resize_area(gray(bgr), 32, 32)
    k, n = np.arange(8)[:, None], np.arange(32)[None, :]
    basis = np.cos(np.pi * k * (2 * n + 1) / 64) * np.where(k == 0, np.sqrt(1 / 32), np.sqrt(2 / 32))
    low = (basis @ small @ basis.T).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return int("".join("1" if b else "0" for b in bits), 2)


def hsv_histogram(bgr: np.ndarray, bins: int = 16) -> np.ndarray:
    """Hue by saturation, shares of all pixels, row by row."""
    x = limit_long_side(bgr, 320)[..., :3].astype(float) / 255
    top, low = x.max(axis=2), x.min(axis=2)
    span = np.where(top > low, top - low, 1.0)
    b, g, r = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(top == r, (g - b) / span % 6, np.where(top == g, (b - r) / span + 2, (r - g) / span + 4)) / 6
    sat = np.where(top > 0, (top - low) / np.where(top > 0, top, 1.0), 0.0)
    hue = np.where(top > low, hue, 0.0)
    cell = np.minimum((hue * bins).astype(int), bins - 1) * bins + np.minimum((sat * bins).astype(int), bins - 1)
    counts = np.bincount(cell.ravel(), minlength=bins * bins)
    return (counts / counts.sum()).astype(np.float32)


def quality(bgr: np.ndarray) -> tuple[float, float, float, float]:
    """Variance of the Laplacian, mean gray, shares of dark and of bright pixels."""
    g = gray(limit_long_side(bgr, 640))
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    laplace = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    return float(laplace.var()), float(g.mean()), float((g <= 20).mean()), float((g >= 235).mean())


def rotate_upright(img: np.ndarray) -> np.ndarray:
    """A portrait image turned by 90 degrees clockwise."""
    return np.rot90(img, -1) if img.shape[0] > img.shape[1] else img


def rectangle_angle(points: np.ndarray) -> float:
    """Degrees in [0, 180) of the long side of the smallest rectangle around the
    points: one of its sides lies along an edge of their hull."""
    hull = convex_hull(points)
    if len(hull) < 2:
        return 0.0
    best = None
    for edge in np.diff(np.vstack((hull, hull[:1])), axis=0):
        angle = np.arctan2(edge[1], edge[0])
        c, s = np.cos(angle), np.sin(angle)
        x, y = hull @ np.array([c, s]), hull @ np.array([-s, c])
        w, h = np.ptp(x), np.ptp(y)
        if best is None or w * h < best[0] - 1e-12:
            best = (w * h, np.degrees(angle) + (90 if w < h else 0))
    return float(best[1] % 180)


def convex_hull(points: np.ndarray) -> np.ndarray:
    pts = sorted(set(map(tuple, np.asarray(points, dtype=float))))
    if len(pts) < 3:
        return np.array(pts)

    def half(seq):
        out: list[tuple] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def undistort_map(matrix: np.ndarray, distortion: np.ndarray, height: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each pixel of the corrected image lies in the given one (radial and
    tangential terms, and the rational ones where there are eight)."""
    k = np.zeros(14)
    k[: len(distortion)] = distortion
    fx, fy, cx, cy = matrix[0, 0], matrix[1, 1], matrix[0, 2], matrix[1, 2]
    v, u = np.mgrid[0:height, 0:width].astype(float)
    x, y = (u - cx) / fx, (v - cy) / fy
    r = x * x + y * y
    radial = (1 + r * (k[0] + r * (k[1] + r * k[4]))) / (1 + r * (k[5] + r * (k[6] + r * k[7])))
    px = x * radial + 2 * k[2] * x * y + k[3] * (r + 2 * x * x) + r * (k[8] + r * k[9])
    py = y * radial + k[2] * (r + 2 * y * y) + 2 * k[3] * x * y + r * (k[10] + r * k[11])
    return px * fx + cx, py * fy + cy


def remap(img: np.ndarray, at_x: np.ndarray, at_y: np.ndarray) -> np.ndarray:
    """Bilinear samples; black outside."""
    h, w = img.shape[:2]
    x0, y0 = np.floor(at_x).astype(int), np.floor(at_y).astype(int)
    out = np.zeros((*at_x.shape, *img.shape[2:]))
    for dy in (0, 1):
        for dx in (0, 1):
            x, y = x0 + dx, y0 + dy
            weight = (1 - np.abs(at_x - x)) * (1 - np.abs(at_y - y))
            inside = (x >= 0) & (x < w) & (y >= 0) & (y < h)
            part = img[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype(float)
            scale = np.where(inside, weight, 0.0)
            out += part * (scale[..., None] if img.ndim == 3 else scale)
    return out


METRICS = "path string, width int, height int, blur_var double, brightness double, dark_ratio double, bright_ratio double, phash long, histogram array<float>"


def _measure() -> Callable:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path, h, w, channels, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not h:
                    rows.append((path, None, None, None, None, None, None, None, None))
                    continue
                img = np.frombuffer(data, np.uint8).reshape(h, w, channels)
                img = np.repeat(img, 3, axis=2) if channels == 1 else img
                rows.append((path, w, h, *quality(img), phash(img), hsv_histogram(img).tolist()))
            names = [x.split()[0] for x in METRICS.split(", ")]
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int64(), pa.list_(pa.float32())]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return measure


def metrics(images: DataFrame) -> DataFrame:
    """Pixel metrics of decoded images; null for the unreadable."""
    return images.select("path", "height", "width", "channels", "data").mapInArrow(_measure(), METRICS)


IMAGE = "path string, height int, width int, channels int, data binary, error string"


def _each(change: Callable) -> Callable:
    """``change`` of each readable image's pixels; what fails keeps its row and says why."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path, h, w, channels, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not h:
                    rows.append((path, None, None, None, None, "unreadable"))
                    continue
                try:
                    img = np.ascontiguousarray(change(np.frombuffer(data, np.uint8).reshape(h, w, channels)))
                    rows.append((path, *img.shape, img.tobytes(), None))
                except ValueError as problem:
                    rows.append((path, h, w, channels, None, str(problem)))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
            names = [x.split()[0] for x in IMAGE.split(", ")]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return run


def turned(images: DataFrame) -> DataFrame:
    """Decoded images, portrait ones turned by 90 degrees: ``path, height, width,
    channels, data, error``."""
    return images.select("path", "height", "width", "channels", "data").mapInArrow(_each(rotate_upright), IMAGE)


def corrected(images: DataFrame, calibration: dict, other_sizes: bool = False) -> DataFrame:
    """Decoded images without their lens's distortion: ``path, height, width, channels,
    data, error``.  The calibration (``readers.calibration``) holds for its own size
    and, with ``other_sizes``, for others of the same shape; the rest fail."""
    matrix = np.array(calibration["camera_matrix"], float).reshape(3, 3)
    coefficients = np.array(calibration["distortion_coefficients"], float)
    size = calibration["image_height"], calibration["image_width"]
    maps: dict[tuple, tuple] = {}

    def change(img: np.ndarray) -> np.ndarray:
        h, w = img.shape[:2]
        if (h, w) not in maps:
            sy, sx = h / size[0], w / size[1]
            if (h, w) != size and not (other_sizes and abs(sx - sy) <= 1e-6):
                raise ValueError(f"calibrated for {size[1]} x {size[0]}, not {w} x {h}")
            maps[h, w] = undistort_map(np.diag([sx, sy, 1.0]) @ matrix, coefficients, h, w)
        return np.clip(np.rint(remap(img, *maps[h, w])), 0, 255).astype(np.uint8)

    return images.select("path", "height", "width", "channels", "data").mapInArrow(_each(change), IMAGE)


def with_rectangle_angle(boxes: DataFrame, polygon: str, name: str = "angle_deg") -> DataFrame:
    """The angle of the smallest rectangle around each polygon, whatever its shape."""
    rest = [c for c in boxes.columns if c != polygon]

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                rectangle_angle(np.array([(c["x"], c["y"]) for c in corners])) if corners else None
                for corners in batch.column(0).to_pylist()
            ]
            yield pa.record_batch([*batch.columns[1:], pa.array(found, pa.float64())], [*rest, name])

    schema = boxes.select(*rest).schema.add(name, "double")
    return boxes.select(polygon, *rest).mapInArrow(angles, schema)
