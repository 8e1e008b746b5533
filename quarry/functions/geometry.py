"""Oriented boxes as arrays of corner structs: built-in expressions, and for many
pairs of boxes a clip of whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLYGON = "array<struct<x:double,y:double>>"


def polygon(*xy) -> Column:
    """Corners from x1, y1, x2, y2, ... (names or Columns)."""
    as_col = [F.col(v) if isinstance(v, str) else v for v in xy]
    return F.array(
        *(
            F.struct(as_col[i].cast("double").alias("x"), as_col[i + 1].cast("double").alias("y"))
            for i in range(0, len(as_col), 2)
        )
    )


def box(cx, cy, w, h, angle) -> Column:
    """The rectangle of a centre, sides and an angle in radians, counter-clockwise."""
    cx, cy, w, h, angle = (F.col(v) if isinstance(v, str) else v for v in (cx, cy, w, h, angle))
    c, s = F.cos(angle), F.sin(angle)
    corners = []
    for i, j in ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)):
        corners += [cx + w * i * c - h * j * s, cy + w * i * s + h * j * c]
    return polygon(*corners)


def aabb(x1, y1, x2, y2) -> Column:
    return polygon(x1, y1, x2, y1, x2, y2, x1, y2)


def signed_area(p: str) -> str:
    nxt = f"{p}[(i + 1) % size({p})]"
    return (
        f"(aggregate(sequence(0, size({p}) - 1), 0D, (s, i) -> s + {p}[i].x * {nxt}.y - {nxt}.x * {p}[i].y) / 2)"
    )


def _four(p: str, four: str, other: str) -> str:
    """A box has four corners, and plain arithmetic on them compiles; polygons of
    other sizes go through arrays."""
    return f"case when size({p}) = 4 then {four} else {other} end"


def area(p: str) -> Column:
    x = " + ".join(f"({p}[{i}].x * {p}[{(i + 1) % 4}].y - {p}[{(i + 1) % 4}].x * {p}[{i}].y)" for i in range(4))
    return F.expr(_four(p, f"abs(({x}) / 2)", f"if(size({p}) < 3, 0D, abs({signed_area(p)}))"))


def _intersection(p: str, q: str) -> str:
    turned = f"if({signed_area(q)} < 0, reverse({q}), {q})"
    side = "((b.x - a.x) * ({0}.y - a.y) - (b.y - a.y) * ({0}.x - a.x))"
    here, there = side.format("v"), side.format("u")
    at = f"({there} / ({there} - {here}))"
    # on an upright or level edge the crossing has that edge's coordinate, to the last bit
    cross = (
        f"named_struct('x', if(b.x = a.x, a.x, u.x + {at} * (v.x - u.x)), 'y', if(b.y = a.y, a.y, u.y + {at} * (v.y - u.y)))"
    )
    step = (
        f"case when {here} >= 0 and {there} >= 0 then array(v) "
        f"when {here} >= 0 then array({cross}, v) "
        f"when {there} >= 0 then array({cross}) else slice(array(v), 1, 0) end"
    )
    # one-element arrays bind names inside an expression
    clip = (
        "if(size(acc) = 0, acc, flatten(zip_with(acc, concat(slice(acc, -1, 1), slice(acc, 1, size(acc) - 1)), "
        f"(v, u) -> {step.replace('a.', 'e.a.').replace('b.', 'e.b.')})))"
    )
    edges = f"transform(edge_of, (a, i) -> named_struct('a', a, 'b', edge_of[(i + 1) % size(edge_of)]))"
    clipped = f"aggregate({edges}, {p}, (acc, e) -> {clip})"
    whole = (
        f"element_at(transform(array({turned}), edge_of -> element_at(transform(array({clipped}), c -> "
        f"if(size(c) < 3, 0D, abs({signed_area('c')}))), 1)), 1)"
    )
    # what lies apart along an axis needs no clipping
    apart = " or ".join(
        f"array_max(transform({a}, v -> v.{f})) <= array_min(transform({b}, v -> v.{f}))"
        for f in "xy" for a, b in ((p, q), (q, p))
    )
    return f"if(size({p}) < 3 or size({q}) < 3 or {apart}, 0D, {whole})"


def intersection_area(p: str, q: str) -> Column:
    """Area common to two convex polygons: p clipped by each edge of q in turn."""
    return F.expr(_intersection(p, q))


def iou(p: str, q: str) -> Column:
    """0 where either area, or the union, is not positive.  The clip is evaluated once."""
    size = lambda x: f"if(size({x}) < 3, 0D, abs({signed_area(x)}))"
    return F.expr(
        f"element_at(transform(array(named_struct('o', {_intersection(p, q)}, 'a', {size(p)}, 'b', {size(q)})), z -> "
        "if(z.a > 0 and z.b > 0 and z.a + z.b - z.o > 0, z.o / (z.a + z.b - z.o), 0D)), 1)"
    )


def overlap_of_smaller(p: str, q: str) -> Column:
    return intersection_area(p, q) / F.greatest(F.lit(1.0), F.least(area(p), area(q)))


def _corners(column: pa.Array) -> np.ndarray:
    """(rows, most corners, 2); shorter polygons repeat their first corner, which
    changes neither area nor clip, and missing ones are a point."""
    size = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = column.flatten()
    xy = np.column_stack([np.asarray(flat.field(i), dtype=float) for i in (0, 1)])
    xy = np.vstack((xy, [[0.0, 0.0]]))
    start = np.cumsum(size) - size
    i = np.arange(max(int(size.max(initial=0)), 1))
    at = start[:, None] + np.where(i < size[:, None], i, 0)
    return xy[np.where(size[:, None] > 0, at, len(xy) - 1)]


def _signed_areas(p: np.ndarray) -> np.ndarray:
    n = np.roll(p, -1, axis=1)
    return (p[:, :, 0] * n[:, :, 1] - n[:, :, 0] * p[:, :, 1]).sum(axis=1) / 2


def _common_areas(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Each p clipped by the edges of its q; corners that are left move to the
    front, and the places behind them repeat the first."""
    q = np.where((_signed_areas(q) < 0)[:, None, None], q[:, ::-1], q)
    for i in range(q.shape[1]):
        a, edge = q[:, i, None], (q[:, (i + 1) % q.shape[1]] - q[:, i])[:, None]
        here = edge[..., 0] * (p[..., 1] - a[..., 1]) - edge[..., 1] * (p[..., 0] - a[..., 0])
        u, there = np.roll(p, 1, axis=1), np.roll(here, 1, axis=1)
        inside, crossed = here >= 0, (here >= 0) != (there >= 0)
        t = there / np.where(crossed, there - here, 1.0)
        # on an upright or level edge the crossing has that edge's coordinate, to the last bit
        cross = np.where(edge == 0, a, u + t[..., None] * (p - u))
        points = np.stack((cross, p), axis=2).reshape(len(p), 2 * p.shape[1], 2)
        left = np.stack((crossed, inside), axis=2).reshape(len(p), 2 * p.shape[1])
        order = np.argsort(~left, axis=1, kind="stable")[:, : max(int(left.sum(axis=1).max(initial=0)), 1)]
        points = np.take_along_axis(points, order[..., None], axis=1)
        p = np.where(np.take_along_axis(left, order, axis=1)[..., None], points, points[:, :1])
    return np.abs(_signed_areas(p))


def with_areas(pairs: DataFrame, p: str, q: str) -> DataFrame:
    """``area_p, area_q, area_both`` in place of two columns of convex polygons; what
    ``intersection_area`` gives, a batch at a time.  Null polygons have area 0."""
    rest = [c for c in pairs.columns if c not in (p, q)]

    def clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _corners(batch.column(0)), _corners(batch.column(1))
            both = np.zeros(len(a))
            # what lies apart along an axis needs no clipping
            meet = ((a.max(axis=1) > b.min(axis=1)) & (b.max(axis=1) > a.min(axis=1))).all(axis=1)
            both[meet] = _common_areas(a[meet], b[meet])
            areas = (np.abs(_signed_areas(a)), np.abs(_signed_areas(b)), both)
            yield pa.record_batch(
                [*batch.columns[2:], *(pa.array(x) for x in areas)],
                [*rest, "area_p", "area_q", "area_both"],
            )

    schema = pairs.select(*rest).schema
    for name in ("area_p", "area_q", "area_both"):
        schema = schema.add(name, "double")
    return pairs.select(p, q, *rest).mapInArrow(clip, schema)


def with_iou(pairs: DataFrame, p: str, q: str) -> DataFrame:
    """``iou`` in place of two polygon columns; 0 where an area, or the union, is not positive."""
    union = F.col("area_p") + F.col("area_q") - F.col("area_both")
    real = (F.col("area_p") > 0) & (F.col("area_q") > 0) & (union > 0)
    return (
        with_areas(pairs, p, q).withColumn("iou", F.when(real, F.col("area_both") / union).otherwise(0.0))
        .drop("area_p", "area_q", "area_both")
    )


def long_axis(p: str) -> Column:
    """struct(angle, ratio) of the first longest edge: degrees in [0, 180), and its
    length over the shorter neighbour's; nulls for a degenerate box."""
    edges = (
        f"transform({p}, (v, i) -> named_struct('dx', {p}[(i + 1) % size({p})].x - v.x, "
        f"'dy', {p}[(i + 1) % size({p})].y - v.y))"
    )
    lengths = "transform(e, z -> sqrt(z.dx * z.dx + z.dy * z.dy))"
    general = (
        f"element_at(transform(array({edges}), e -> element_at(transform(array({lengths}), l -> "
        "element_at(transform(array(cast(array_position(l, array_max(l)) as int) - 1), k -> "
        "named_struct('angle', if(array_min(l) <= 1e-9, null, pmod(degrees(atan2(e[k].dy, e[k].dx)), 180D)), "
        "'ratio', if(array_min(l) <= 1e-9, null, l[k] / least(l[(k + 1) % size(l)], l[(k + size(l) - 1) % size(l)])))"
        "), 1)), 1)), 1)"
    )
    dx, dy = ([f"({p}[{(i + 1) % 4}].{v} - {p}[{i}].{v})" for i in range(4)] for v in "xy")
    length = [f"sqrt({x} * {x} + {y} * {y})" for x, y in zip(dx, dy)]
    longest = f"greatest({', '.join(length)})"
    pick = lambda value: "case " + " ".join(
        f"when {length[i]} = {longest} then {value(i)}" for i in range(4)
    ) + " end"
    angle = pick(lambda i: f"pmod(degrees(atan2({dy[i]}, {dx[i]})), 180D)")
    ratio = pick(lambda i: f"{length[i]} / least({length[(i + 1) % 4]}, {length[(i + 3) % 4]})")
    flat = f"least({', '.join(length)}) <= 1e-9"
    four = f"named_struct('angle', if({flat}, null, {angle}), 'ratio', if({flat}, null, {ratio}))"
    return F.expr(_four(p, four, general))


def angle_difference(a, b) -> Column:
    d = F.abs(F.col(a) - F.col(b)) % 180
    return F.least(d, 180 - d)


def fold_angle(c, unit: str = "guess") -> Column:
    """Degrees folded into [0, 90].  "guess" takes an angle of at most pi as radians."""
    c = F.col(c) if isinstance(c, str) else c
    degrees = {
        "degrees": c,
        "radians": F.degrees(c),
        "guess": F.when(F.abs(c) <= 3.141592653589793 + 1e-6, F.degrees(c)).otherwise(c),
    }[unit]
    turned = F.pmod(degrees, F.lit(180.0))
    return F.when(turned > 90, 180 - turned).otherwise(turned)


def near_edge(p: str, width, height, margin: float = 0.035) -> Column:
    w, h = (F.col(v) if isinstance(v, str) else v for v in (width, height))
    b = bounds(p)
    return (
        (b["x0"] <= w * margin) | (b["y0"] <= h * margin)
        | (b["x1"] >= w * (1 - margin)) | (b["y1"] >= h * (1 - margin))
    )


def bounds(p: str) -> dict[str, Column]:
    """x0, x1, y0, y1 of a polygon."""
    end = lambda v, four, rest: F.expr(
        _four(p, f"{four}({', '.join(f'{p}[{i}].{v}' for i in range(4))})", f"{rest}(transform({p}, c -> c.{v}))")
    )
    return {f"{v}{s}": end(v, f, r) for v in "xy" for s, f, r in ((0, "least", "array_min"), (1, "greatest", "array_max"))}


def area_ratio(p: str, width, height) -> Column:
    w, h = (F.col(v) if isinstance(v, str) else v for v in (width, height))
    return area(p) / F.greatest(F.lit(1.0), w * h)


def is_small(ratio: Column) -> Column:
    return ratio <= 0.005


def is_huge(ratio: Column) -> Column:
    return ratio >= 0.35


def extreme_aspect(w, h, limit: float = 3.5) -> Column:
    w, h = (F.col(v) if isinstance(v, str) else v for v in (w, h))
    return (w > 1) & (h > 1) & (F.greatest(w, h) / F.greatest(F.lit(1.0), F.least(w, h)) >= limit)


def is_angled(folded: Column) -> Column:
    return folded.between(15, 75)


def centre(p: str) -> Column:
    mean = lambda f: F.expr(
        _four(p, f"({' + '.join(f'{p}[{i}].{f}' for i in range(4))}) / 4", f"aggregate({p}, 0D, (s, v) -> s + v.{f}) / size({p})")
    )
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def is_16_by_9(w, h, tolerance: float = 0.005) -> Column:
    w, h = (F.col(v) if isinstance(v, str) else v for v in (w, h))
    return F.coalesce((w > 0) & (h > 0) & (F.abs(F.try_divide(w, h) - 16 / 9) / (16 / 9) <= tolerance), F.lit(False))


def upright(w, h) -> Column:
    """struct(width, height, rotated): portrait turned by 90 degrees."""
    w, h = (F.col(v) if isinstance(v, str) else v for v in (w, h))
    return F.struct(F.greatest(w, h).alias("width"), F.least(w, h).alias("height"), (h > w).alias("rotated"))


def hamming(a, b) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def correlation(p: str, q: str) -> Column:
    """Pearson correlation of two arrays; 1 where either does not vary."""
    mean = lambda a: f"(aggregate({a}, 0D, (s, v) -> s + v) / size({a}))"
    dot = lambda a, ma, b, mb: (
        f"aggregate(zip_with({a}, {b}, (u, v) -> (u - m.{ma}) * (v - m.{mb})), 0D, (s, v) -> s + v)"
    )
    pp, qq, pq = dot(p, "p", p, "p"), dot(q, "q", q, "q"), dot(p, "p", q, "q")
    return F.expr(
        f"element_at(transform(array(named_struct('p', {mean(p)}, 'q', {mean(q)})), m -> "
        f"if({pp} <= 0 or {qq} <= 0, 1D, {pq} / sqrt({pp} * {qq}))), 1)"
    )


def scaled_camera(matrix: str, from_w, from_h, to_w, to_h) -> Column:
    """The 3x3 matrix for another image size; null where the two scales differ."""
    sx, sy = F.col(to_w) / F.col(from_w), F.col(to_h) / F.col(from_h)
    k = lambda i: F.get(matrix, F.lit(i))
    rows = F.array(*(k(i) * (sx if i < 3 else sy if i < 6 else F.lit(1.0)) for i in range(9)))
    return F.when(F.abs(sx - sy) <= 1e-6, rows)
