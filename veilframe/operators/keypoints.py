"""Keypoint operators. Keypoints are ``ARRAY<STRUCT<x, y, v>>`` in joint order; higher-order functions keep them in
one row. What computes with every joint (shares of a box, mirroring, similarities, fits, rasters) is an Arrow function over a batch of rows, as Spark
interprets lambdas entry by entry."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import lists as L

c = F.col

#: The joints of the body, and which joint each becomes when the image is mirrored.
COCO_JOINTS = (
    "nose", "left_eye", "right_eye", "left_ear", "right_ear", "left_shoulder", "right_shoulder", "left_elbow", "right_elbow",
    "left_wrist", "right_wrist", "left_hip", "right_hip", "left_knee", "right_knee", "left_ankle", "right_ankle",
)
FACE_JOINTS = COCO_JOINTS[:7]
#: Per-joint spread of the object keypoint similarity, in tenths.
OKS_SIGMAS = (0.26, 0.25, 0.25, 0.35, 0.35, 0.79, 0.79, 0.72, 0.72, 0.62, 0.62, 1.07, 1.07, 0.87, 0.87, 0.89, 0.89)
#: Padding of the face crop by type, and whether the crop keeps the image's orientation.
FACE_PADDING = {
    "half": (0.0, False), "mid_full": (0.0675, False), "full": (0.2109375, False), "full_no_align": (0.2109375, True),
    "whole_face": (0.40, False), "whole_face_no_align": (0.40, True), "head": (0.70, False), "head_no_align": (0.70, True),
}
#: Limbs of the joint map by body part: head, torso, left arm, right arm, left leg, right leg.
LIMBS = (
    ((0, 1), (0, 2), (1, 3), (2, 4)), ((5, 6), (5, 11), (6, 12), (11, 12)),
    ((5, 7), (7, 9)), ((6, 8), (8, 10)), ((11, 13), (13, 15)), ((12, 14), (14, 16)),
)


def flip_map(joints=COCO_JOINTS) -> list[int]:
    swap = lambda n: n.replace("left_", "R_").replace("right_", "left_").replace("R_", "right_")
    return [joints.index(swap(n)) for n in joints]


def first_inside(kps: Column, n: int = 3) -> Column:
    """Whether the first n joints lie in the closed box."""
    return F.forall(F.slice(kps, 1, n), lambda p: (p["x"] >= c("x0")) & (p["x"] <= c("x1")) & (p["y"] >= c("y0")) & (p["y"] <= c("y1")))


def boxed(kps: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """``to_box`` of a batch."""
    px, py, v = L.fields(kps, "x", "y", "v")
    x0, y0, w, h = L.spread(kps, x0, y0, *(pc.subtract(b, a).cast("double") for a, b in ((x0, x1), (y0, y1))))
    x, y = (pc.divide_checked(pc.subtract(p, at).cast("double"), size) for p, at, size in ((px, x0, w), (py, y0, h)))
    seen = pc.greater(v.cast("double"), 0)
    for share in (x, y):
        seen = pc.and_kleene(seen, pc.and_kleene(pc.greater_equal(share, 0), pc.less_equal(share, 1)))
    return L.relisted(kps, x=x, y=y, v=seen)


def to_box(kps: Column) -> Column:
    """Coordinates as shares of the box; visible only if seen and inside."""
    return F.arrow_udf(boxed, "array<struct<x: double, y: double, v: boolean>>")(kps, "x0", "y0", "x1", "y1")


def clamp_to_crop(kps: Column) -> Column:
    """Shares of the crop's width, clamped to 0..1, all visible."""
    w = (c("x1") - c("x0")).cast("double")
    clamp = lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v))
    return F.transform(kps, lambda p: F.struct(clamp((p["x"] - c("x0")) / w).alias("x"), clamp((p["y"] - c("y0")) / w).alias("y"), F.lit(1).alias("v")))


def visible(kps: Column, threshold: float, strict: bool) -> Column:
    return F.transform(kps, lambda p: (p["v"] > threshold) if strict else (p["v"] >= threshold))


def some_visible(kps: pa.Array) -> pa.Array:
    """``any_visible`` of a batch."""
    (v,) = L.fields(kps, "v")
    seen, unknown = L.hits(kps, pc.not_equal(v.cast("double"), 0)) > 0, L.hits(kps, v.is_null()) > 0
    return pa.array(seen, mask=np.asarray(kps.is_null()) | ~seen & unknown)


def any_visible(kps: Column) -> Column:
    """Null where no joint is known to be visible and one is unknown."""
    return F.arrow_udf(some_visible, "boolean")(kps)


def mirrored(kps: pa.Array, joints=COCO_JOINTS) -> pa.Array:
    """``mirror`` of a batch."""
    order = np.array(flip_map(joints))
    at = L.entries_at(kps, np.repeat(np.arange(len(kps)), len(order)), np.tile(order, len(kps)))
    x, y, v = (f.take(at) for f in L.fields(kps, "x", "y", "v"))
    ends = pa.array(np.arange(len(kps) + 1, dtype=np.int32) * len(order))
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pc.subtract(1.0, x.cast("double")), y.cast("double"), v], ["x", "y", "v"]))


def mirror(kps: Column, joints=COCO_JOINTS, visibility: str = "bigint") -> Column:
    """Left and right joints change places and x becomes 1 - x. visibility: the type of v. Joints that a list lacks are null."""

    @F.arrow_udf(f"array<struct<x: double, y: double, v: {visibility}>>")
    def turned(kps: pa.Array) -> pa.Array:
        return mirrored(kps, joints)

    return turned(kps)


def midpoint(kps: Column, a: int, b: int) -> Column:
    """(x, y) between two joints, NULL unless both are visible."""
    p, q = F.get(kps, F.lit(a)), F.get(kps, F.lit(b))
    return F.when((p["v"] != 0) & (q["v"] != 0), F.struct(((p["x"] + q["x"]) / 2).alias("x"), ((p["y"] + q["y"]) / 2).alias("y")))


def similarities(found: pa.Array, truth: pa.Array, area: pa.Array) -> pa.Array:
    """``oks`` of a batch."""
    scales = pa.array([-0.5 / (2 * s / 10) ** 2 for s in OKS_SIGMAS])
    rows, place = L.parents(truth), L.places(truth)
    x, y, v = L.fields(truth, "x", "y", "v")
    other = L.entries_at(found, rows, place)
    dx, dy = (pc.subtract(o.take(other), t).cast("double") for o, t in zip(L.fields(found, "x", "y"), (x, y), strict=True))
    scale = scales.take(pa.array(place, mask=place >= len(scales)))
    (size,) = L.spread(truth, pc.add(area.cast("double"), float(np.spacing(1))))
    term = pc.exp(pc.multiply(pc.divide_checked(pc.add(pc.multiply(dx, dx), pc.multiply(dy, dy)), size), scale))
    counts = np.asarray(pc.and_(pc.fill_null(pc.greater(v.cast("double"), 0), False), term.is_valid()))
    n = np.bincount(rows[counts], minlength=len(truth))
    total = np.bincount(rows[counts], np.asarray(term.filter(pa.array(counts))), len(truth))
    return pa.array(total / np.maximum(n, 1), mask=n == 0)


def oks(found: Column, truth: Column, area: Column) -> Column:
    """Mean over visible true joints of exp(-d2 / (2 (2 sigma)^2 (area + eps))); NULL if none is visible. Joints that are unknown or that one side
    lacks don't count."""
    return F.arrow_udf(similarities, "double")(found, truth, area)


def eye_angle(kps: Column) -> Column:
    left, right = F.get(kps, F.lit(1)), F.get(kps, F.lit(2))
    return F.atan2((right["y"] - left["y"]).cast("double"), (right["x"] - left["x"]).cast("double"))


def rotation(angle: Column, cx: Column, cy: Column) -> Column:
    """2x3 matrix, row by row, of the rotation by an angle about a point."""
    a, b = F.cos(angle), F.sin(angle)
    return F.array(a, b, (1 - a) * cx - b * cy, -b, a, b * cx + (1 - a) * cy)


def polygon_area(points: Column) -> Column:
    """Shoelace area of ARRAY<STRUCT<x, y>>."""
    ids = F.sequence(F.lit(0), F.size(points) - 1)
    cross = F.transform(ids, lambda i: F.get(points, i)["x"] * F.get(points, (i + 1) % F.size(points))["y"] - F.get(points, (i + 1) % F.size(points))["x"] * F.get(points, i)["y"])
    return F.abs(F.aggregate(cross, F.lit(0).cast("long"), lambda a, x: a + x)) / 2.0


def averaged_yaw(xs: Column) -> Column:
    """From the x of 68 landmarks: right minus left mean distance of the nose bridge to the jaw."""
    at = lambda i: F.get(xs, F.lit(i))
    left = ((at(27) - at(0)) + (at(28) - at(1)) + (at(29) - at(2))) / 3.0
    right = ((at(16) - at(27)) + (at(15) - at(28)) + (at(14) - at(29))) / 3.0
    return right - left


def affine(matrix: Column, x: Column, y: Column) -> tuple[Column, Column]:
    m = [F.get(matrix, F.lit(i)) for i in range(6)]
    return m[0] * x + m[1] * y + m[2], m[3] * x + m[4] * y + m[5]


def affine_inverse(matrix: Column) -> Column:
    m = [F.get(matrix, F.lit(i)) for i in range(6)]
    det = m[0] * m[4] - m[1] * m[3]
    a, b, d, e = m[4] / det, -m[1] / det, -m[3] / det, m[0] / det
    return F.array(a, b, -(a * m[2] + b * m[5]), d, e, -(d * m[2] + e * m[5]))


def quantize_blend(x: Column, t: float, size: int) -> Column:
    """Landmark at half resolution blended with full: floor(x * size / 2) / (size * 2) lerped by t (the divisor of
    the coarse one is kept as it is published)."""
    coarse = F.floor(x * (size / 2)) / (size * 2)
    return coarse * (1 - t) + x * t


def flatten(kps: Column) -> Column:
    return F.flatten(F.transform(kps, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double"))))


def heatmap_peaks(cells: DataFrame, keys: list[str]) -> DataFrame:
    """cells(keys, row, col, value) -> per map: row and column maxima first met, and the largest value."""
    best = cells.groupBy(*keys).agg(F.max("value").alias("confidence"), F.min_by("row", F.struct(-c("value"), c("row"))).alias("peak_row"), F.min_by("col", F.struct(-c("value"), c("col"))).alias("peak_col"))
    return best


def heatmap_keypoints(cells: DataFrame, boxes: DataFrame, keys: list[str], box_key: str, rows: int = 64, cols: int = 48) -> DataFrame:
    """Peaks of rows x cols maps as points of the image: shares of the map become shares of the (padded) box it was made from."""
    peaks = heatmap_peaks(cells, keys).join(boxes.select(box_key, "x0", "y0", "x1", "y1"), box_key)
    px = c("peak_col") * F.lit(1.0 / cols) * (c("x1") - c("x0")) + c("x0")
    py = c("peak_row") * F.lit(1.0 / rows) * (c("y1") - c("y0")) + c("y0")
    return peaks.select(*keys, px.alias("px"), py.alias("py"), "confidence")


def similarity_fit(source: np.ndarray, target: np.ndarray, scale: bool = True) -> np.ndarray:
    """Least-squares similarity (rotation, scale, shift) of matched 2-D points, as a 2x3 matrix; NaN for points that
    all coincide. The rotation is the orthogonal factor of the cross-covariance, reflections excluded."""
    mean_s, mean_t = source.mean(0), target.mean(0)
    s, t = source - mean_s, target - mean_t
    u, sizes, vt = np.linalg.svd(t.T @ s / len(s))
    if sizes[0] == 0:
        return np.full((2, 3), np.nan)
    sign = np.array([1.0, np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1.0])
    turn = (u * sign) @ vt
    grow = (sizes * sign).sum() / s.var(0).sum() if scale else 1.0
    return np.c_[grow * turn, mean_t - grow * turn @ mean_s]


def similarity_fits(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``similarity_fit`` of many sets of as many points: arrays of sets x points x 2 -> sets x 2 x 3."""
    mean_s, mean_t = source.mean(1), target.mean(1)
    s, t = source - mean_s[:, None], target - mean_t[:, None]
    u, sizes, vt = np.linalg.svd(np.swapaxes(t, 1, 2) @ s / source.shape[1])
    flip = np.sign(np.linalg.det(u) * np.linalg.det(vt))
    sign = np.column_stack([np.ones(len(s)), np.where(flip == 0, 1.0, flip)])
    spread = s.var(1).sum(1)
    still = sizes[:, 0] == 0
    grow = (sizes * sign).sum(1) / np.where(still, 1.0, spread)
    turn = grow[:, None, None] * ((u * sign[:, None]) @ vt)
    out = np.concatenate([turn, (mean_t - (turn @ mean_s[:, :, None])[:, :, 0])[:, :, None]], axis=2)
    out[still] = np.nan
    return out


def similarity_udf(source: Column, target: Column) -> Column:
    """Two arrays of x1, y1, x2, y2... -> 2x3 matrix. Sets of as many points are fitted together."""

    @F.arrow_udf("array<double>")
    def fit(source: pa.Array, target: pa.Array) -> pa.Array:
        sizes = np.asarray(pc.list_value_length(source))
        out = np.empty((len(sizes), 6))
        for n in np.unique(sizes):
            rows = pa.array(np.flatnonzero(sizes == n))
            a, b = (np.asarray(m.take(rows).flatten()).reshape(len(rows), -1, 2) for m in (source, target))
            out[sizes == n] = similarity_fits(a, b).reshape(-1, 6)
        return pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * 6, out.ravel())

    return fit(source, target)


def affine_from_triangles(source: list[Column], target: list[Column]) -> Column:
    """2x3 matrix that maps three points (x1, y1, x2, y2, x3, y3) onto three others, by Cramer's rule."""
    x1, y1, x2, y2, x3, y3 = source
    det = x1 * (y2 - y3) - y1 * (x2 - x3) + (x2 * y3 - x3 * y2)

    def row(t1, t2, t3):
        a = (t1 * (y2 - y3) - y1 * (t2 - t3) + (t2 * y3 - t3 * y2)) / det
        b = (x1 * (t2 - t3) - t1 * (x2 - x3) + (x2 * t3 - x3 * t2)) / det
        return [a, b, (x1 * (y2 * t3 - y3 * t2) - y1 * (x2 * t3 - x3 * t2) + t1 * (x2 * y3 - x3 * y2)) / det]

    return F.array(*row(*target[0::2]), *row(*target[1::2]))


def line_cells(x0: int, y0: int, x1: int, y1: int) -> list[tuple[int, int]]:
    """Cells of a one-pixel line."""
    n = max(abs(x1 - x0), abs(y1 - y0), 1)
    return [(math.floor(x0 + (x1 - x0) * i / n + 0.5), math.floor(y0 + (y1 - y0) * i / n + 0.5)) for i in range(n + 1)]


def draw_joints(kps: pa.Array, size: int) -> np.ndarray:
    """Keypoints in 0..1 of many rows -> rows x size x size, limbs of body part k drawn as k + 1, later parts over earlier ones."""
    first = L.starts(kps)
    x, y, v = (np.asarray(pc.fill_null(f.cast("double"), 0.0)) for f in L.fields(kps, "x", "y", "v"))
    seen, rows = v != 0, np.flatnonzero(L.lengths(kps))
    grid = np.zeros((len(kps), size, size), np.uint8)
    for part, limbs in enumerate(LIMBS):
        for a, b in limbs:
            both = rows[seen[first[rows] + a] & seen[first[rows] + b]]
            ends = [np.trunc(f[first[both] + k] * (size - 1)) for k in (a, b) for f in (x, y)]
            if not all(np.isfinite(e).all() for e in ends):
                raise ValueError("visible joints have to be finite")
            line, cx, cy = L.line_steps(*(e.astype(np.int64) for e in ends))
            on = (cx >= 0) & (cx < size) & (cy >= 0) & (cy < size)
            grid[both[line[on]], cy[on], cx[on]] = part + 1
    return grid


def joint_maps(kps: pa.Array, size: int) -> pa.Array:
    """``joint_map`` of a batch."""
    parts = [draw_joints(kps.slice(a, b - a), size).reshape(b - a, -1) for a, b in L.slices(len(kps), size * size)]
    return L.binaries(np.concatenate(parts) if parts else np.zeros((0, size * size), np.uint8), np.asarray(kps.is_null()))


def joint_map(size: int):
    """Arrow function: keypoints in 0..1 -> size x size bytes, limbs of body part k drawn as k + 1; null keypoints have no map."""

    @F.arrow_udf("binary")
    def draw(kps: pa.Array) -> pa.Array:
        return joint_maps(kps, size)

    return draw
