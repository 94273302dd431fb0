"""Run-length masks: a mask is the sorted list of places where it starts and stops, [start, end, start, end, ...), over the pixels of its image in
row order. Areas, intersections and unions merge runs; no pixels are joined or unpacked. A run may reach over several rows.

Small numpy helpers, and Arrow functions over columns of runs (array of whole numbers).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

RUNS = "array<bigint>"
EMPTY = np.zeros(0, np.int64)


def joined(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs in order as boundaries; runs that touch become one."""
    if not len(starts):
        return EMPTY
    apart = starts[1:] > ends[:-1]
    return np.column_stack([starts[np.r_[True, apart]], ends[np.r_[apart, True]]]).ravel().astype(np.int64)


def from_array(mask: np.ndarray, x0: int, y0: int, width: int, height: int) -> np.ndarray:
    """Of a bool array whose corner lies at (x0, y0) of a width x height image; what lies outside is cut off."""
    mask = mask[max(0, -y0) : max(0, height - y0), max(0, -x0) : max(0, width - x0)]
    x0, y0 = max(0, x0), max(0, y0)
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (ys, xs), (ye, xe) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return joined((ys + y0) * width + xs + x0, (ye + y0) * width + xe + x0)


def from_bits(bits: bytes, box: tuple[int, int, int, int], width: int, height: int) -> np.ndarray:
    """Of the packed bits of a box, row by row."""
    x0, y0, x1, y1 = box
    return from_array(np.unpackbits(np.frombuffer(bits, np.uint8), count=(x1 - x0) * (y1 - y0)).reshape(y1 - y0, x1 - x0).astype(bool), x0, y0, width, height)


def from_box(box: tuple[int, int, int, int], width: int, height: int) -> np.ndarray:
    x0, y0, x1, y1 = max(0, box[0]), max(0, box[1]), min(width, box[2]), min(height, box[3])
    if x1 <= x0 or y1 <= y0:
        return EMPTY
    rows = np.arange(y0, y1, dtype=np.int64) * width
    return joined(rows + x0, rows + x1)


def to_array(runs: np.ndarray, box: tuple[int, int, int, int], width: int) -> np.ndarray:
    """The mask inside a box, which may leave the image."""
    x0, y0, x1, y1 = box
    out = np.zeros((y1 - y0, x1 - x0), bool)
    for y, a, b in zip(*row_runs(runs, width), strict=True):
        if y0 <= y < y1:
            out[y - y0, max(0, a - x0) : max(0, b - x0)] = True
    return out


def area(runs: np.ndarray) -> int:
    return int((runs[1::2] - runs[::2]).sum())


def covered_before(runs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many pixels of the mask lie before each place."""
    if not len(runs):
        return np.zeros(len(at), np.int64)
    total = np.r_[0, np.cumsum(runs[1::2] - runs[::2])]
    k = np.searchsorted(runs[::2], at, "right")  # runs that start at or before the place
    last = np.maximum(k - 1, 0)
    over = np.where(k > 0, np.maximum(0, runs[1::2][last] - at), 0)  # what the last of them has beyond it
    return total[k] - over


def intersection(a: np.ndarray, b: np.ndarray) -> int:
    return int((covered_before(a, b[1::2]) - covered_before(a, b[::2])).sum())


def laid_out(masks: pa.ListArray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of a column one after the other, each ``step`` beyond the one before: (boundaries of all, how many each has). None is an empty mask."""
    sizes = pc.fill_null(pc.list_value_length(masks), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return masks.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(np.arange(len(sizes)) * step, sizes), sizes


def intersections(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """``intersection`` of each row of two columns, by one search over all rows."""
    step = 1 + max((pc.max(m.flatten()).as_py() or 0) for m in (a, b))
    (first, _), (second, sizes) = laid_out(a, step), laid_out(b, step)
    both = np.r_[0, np.cumsum(covered_before(first, second[1::2]) - covered_before(first, second[::2]))]
    ends = np.cumsum(sizes // 2)
    return both[ends] - both[ends - sizes // 2]


def iou(a: np.ndarray, b: np.ndarray, eps: float = 0.0) -> float:
    """0 where both are empty."""
    both = intersection(a, b)
    either = area(a) + area(b) - both + eps
    return both / either if either else 0.0


def union(*masks: np.ndarray) -> np.ndarray:
    starts, ends = np.concatenate([m[::2] for m in masks]), np.concatenate([m[1::2] for m in masks])
    if not len(starts):
        return EMPTY
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    return joined(starts, ends)


def row_runs(runs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(y, x from, x to) with a run for each row."""
    if not len(runs):
        return EMPTY, EMPTY, EMPTY
    starts, ends = runs[::2], runs[1::2]
    first = starts // width
    a, b = starts - first * width, ends - first * width
    if b.max() <= width:  # no run reaches over a row
        return first, a, b
    n = (ends - 1) // width - first + 1
    which = np.repeat(np.arange(len(n)), n)
    y = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return y, np.maximum(starts[which], y * width) - y * width, np.minimum(ends[which], (y + 1) * width) - y * width


def tight(runs: np.ndarray, width: int, height: int) -> tuple[int, int, int, int]:
    """Tight half-open box; the whole image for an empty mask."""
    if not len(runs):
        return 0, 0, width, height
    y, a, b = row_runs(runs, width)
    return int(a.min()), int(y[0]), int(b.max()), int(y[-1]) + 1


def sampled_box(runs: np.ndarray, box: tuple[int, int, int, int], width: int, size: tuple[int, int]) -> tuple[int, int, int, int] | None:
    """Tight box, in crop pixels, of the mask cut to a box and scaled to size (height, width) by nearest neighbours: pixel t of n takes floor(t *
    length / n). None if no pixel is hit."""
    x0, y0, x1, y1 = box
    h, w = size
    y, a, b = row_runs(runs, width)
    y, a, b = y - y0, np.maximum(a - x0, 0), np.minimum(b - x0, x1 - x0)
    up = lambda v, n, length: -(-v * n // length)  # noqa: E731  the first sample at or after a place
    t0, t1, s0, s1 = up(y, h, y1 - y0), up(y + 1, h, y1 - y0), up(a, w, x1 - x0), up(b, w, x1 - x0)
    hit = np.flatnonzero((t1 > t0) & (s1 > s0) & (y >= 0) & (y < y1 - y0))
    return (int(s0[hit].min()), int(t0[hit[0]]), int(s1[hit].max()), int(t1[hit[-1]])) if len(hit) else None


def pads(box: tuple[int, int, int, int], width: int, height: int, size: tuple[int, int]) -> tuple[int, int, int, int]:
    """Left, top, right, bottom: what of a crop lies outside the image, in whole crop pixels. Both axes go by the rows' scale, as a box has the crop's shape."""
    x0, y0, x1, y1 = box
    return tuple(min(n, max(0, v) * size[0] // (y1 - y0)) for v, n in zip((-x0, -y0, x1 - width, y1 - height), (size[1], size[0]) * 2, strict=True))


def dilation_radius(size: tuple[int, int], share: float) -> int:
    return int((size[0] * size[1]) ** 0.5 * share)


def dilated_box(runs: np.ndarray, box: tuple[int, int, int, int], width: int, height: int, size: tuple[int, int], share: float) -> tuple[int, int, int, int]:
    """Tight box, in image pixels, of the mask cut to a box, scaled to size, dilated by a disk and cleared in the padding. A disk moves each side by its
    radius, so the dilated mask itself isn't needed. Sides are floored in the crop; an empty mask gives the box."""
    at = sampled_box(runs, box, width, size)
    if at is None:
        return box
    h, w = size
    r = dilation_radius(size, share)
    left, top, right, bottom = pads(box, width, height, size)
    sides = max(left, at[0] - r), max(top, at[1] - r), min(w - right, at[2] + r), min(h - bottom, at[3] + r)
    if sides[0] >= sides[2] or sides[1] >= sides[3]:
        return box
    x0, y0, x1, y1 = box
    return x0 + sides[0] * (x1 - x0) // w, y0 + sides[1] * (y1 - y0) // h, x0 + sides[2] * (x1 - x0) // w, y0 + sides[3] * (y1 - y0) // h


def rows_of_all(masks: list[np.ndarray], widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row_runs`` of many masks one after the other: (which mask, y, x from, x to)."""
    runs = np.concatenate(masks)
    which = np.repeat(np.arange(len(masks)), [len(m) // 2 for m in masks])
    starts, ends, width = runs[::2], runs[1::2], widths[which]
    y, last = starts // width, (ends - 1) // width
    if (y == last).all():
        return which, y, starts - y * width, ends - y * width
    n = last - y + 1
    run = np.repeat(np.arange(len(n)), n)
    y = y[run] + np.arange(len(run)) - (np.cumsum(n) - n)[run]
    which, width = which[run], width[run]
    return which, y, np.maximum(starts[run], y * width) - y * width, np.minimum(ends[run], (y + 1) * width) - y * width


def firsts(which: np.ndarray) -> np.ndarray:
    """Where groups of equal numbers begin."""
    return np.flatnonzero(np.diff(which, prepend=-1))


def measures(masks: list[np.ndarray], images: list[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """``area`` and ``tight`` of many masks. images: width and height of each one's image."""
    which, y, a, b = rows_of_all(masks, np.array(images)[:, 0])
    boxes = np.array([(0, 0, w, h) for w, h in images])
    if len(which):
        at = firsts(which)
        boxes[which[at]] = np.column_stack([np.minimum.reduceat(a, at), y[at], np.maximum.reduceat(b, at), y[np.r_[at[1:], len(y)] - 1] + 1])
    return np.bincount(which, b - a, len(masks)).astype(np.int64).tolist(), list(map(tuple, boxes.tolist()))


def dilated_boxes(masks: list[np.ndarray], boxes: list[tuple[int, int, int, int]], images: list[tuple[int, int]], size: tuple[int, int], share: float) -> list[tuple[int, int, int, int]]:
    """``dilated_box`` of many masks, each in the box of its own."""
    (h, w), r, image, out = size, dilation_radius(size, share), np.array(images), np.array(boxes)
    which, y, a, b = rows_of_all(masks, image[:, 0])
    x0, y0, x1, y1 = out[which].T
    y, a, b = y - y0, np.maximum(a - x0, 0), np.minimum(b - x0, x1 - x0)
    up = lambda v, n, length: -(-v * n // length)  # noqa: E731  the first sample at or after a place
    t0, t1, s0, s1 = up(y, h, y1 - y0), up(y + 1, h, y1 - y0), up(a, w, x1 - x0), up(b, w, x1 - x0)
    hit = np.flatnonzero((t1 > t0) & (s1 > s0) & (y >= 0) & (y < y1 - y0))
    if len(hit):
        at = firsts(which[hit])
        k = which[hit][at]
        x0, y0, x1, y1 = out[k].T
        tall = y1 - y0
        left, top, right, bottom = (np.minimum(n, np.maximum(0, v) * h // tall) for v, n in ((-x0, w), (-y0, h), (x1 - image[k, 0], w), (y1 - image[k, 1], h)))
        s0, s1 = np.minimum.reduceat(s0[hit], at), np.maximum.reduceat(s1[hit], at)
        t0, t1 = t0[hit][at], t1[hit][np.r_[at[1:], len(hit)] - 1]
        s0, t0, s1, t1 = np.maximum(left, s0 - r), np.maximum(top, t0 - r), np.minimum(w - right, s1 + r), np.minimum(h - bottom, t1 + r)
        some = (s0 < s1) & (t0 < t1)
        wide = x1 - x0
        out[k[some]] = np.column_stack([x0 + s0 * wide // w, y0 + t0 * tall // h, x0 + s1 * wide // w, y0 + t1 * tall // h])[some]
    return list(map(tuple, out.tolist()))


def nearest(mask: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    return mask[np.arange(size[0]) * mask.shape[0] // size[0]][:, np.arange(size[1]) * mask.shape[1] // size[1]]


def dilate(mask: np.ndarray, r: int) -> np.ndarray:
    """By a disk: each row of the disk is a run of pixels."""
    h, w = mask.shape
    count = np.pad(np.cumsum(np.pad(mask.astype(np.int32), ((r, r), (r, r))), axis=1), ((0, 0), (1, 0)))
    out = np.zeros_like(mask)
    for dy in range(-r, r + 1):
        half = int((r * r - dy * dy) ** 0.5 + 1e-9)
        rows = count[r + dy : r + dy + h]
        out |= rows[:, r + half + 1 : r + half + 1 + w] > rows[:, r - half : r - half + w]
    return out


def dilated(runs: np.ndarray, box: tuple[int, int, int, int], width: int, height: int, size: tuple[int, int], share: float) -> np.ndarray:
    """The dilated mask of ``dilated_box`` in image pixels, scaled back to the box by nearest neighbours."""
    x0, y0, x1, y1 = box
    crop = dilate(nearest(to_array(runs, box, width), size), dilation_radius(size, share))
    left, top, right, bottom = pads(box, width, height, size)
    crop[:top] = crop[:, :left] = crop[size[0] - bottom :] = crop[:, size[1] - right :] = False
    return from_array(nearest(crop, (y1 - y0, x1 - x0)), x0, y0, width, height)


def box_runs(x0: Column, y0: Column, x1: Column, y1: Column, width: Column) -> Column:
    """Runs of a box inside its image, by the JVM."""
    y = F.sequence(y0.cast("long"), y1.cast("long") - 1)
    each = F.when((y1 > y0) & (x1 > x0), F.flatten(F.transform(y, lambda v: F.array(v * width + x0, v * width + x1))))
    return F.coalesce(each, F.array().cast(RUNS))


# Functions that make their Arrow function when they are called: one that is kept in a module holds a handle of the session once it was used, and the
# package goes to workers by value.


def runs_intersection(a: str | Column, b: str | Column) -> Column:
    """Pixels that both masks have."""

    @F.arrow_udf(LongType())
    def both(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(intersections(x, y))

    return both(a, b)


class Made(NamedTuple):
    """How the runs of a side are made: of which columns, and by a function of those, a batch at once."""

    columns: tuple[str, ...]
    make: Callable[..., pa.Array]

    def of(self, prefix: str) -> list[str]:
        return [prefix + n for n in self.columns]


def box_rows(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, width: int) -> pa.Array:
    """``box_runs`` of many boxes at once."""
    return row_masks(x0, y0, x1, y1, width, lambda h, w: (np.where(w > 0, np.maximum(h, 0), 0), 0 * h, 0 * w))


def row_masks(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, width: int, shape: Callable) -> pa.Array:
    """A run for each row of boxes. shape(heights, widths): how many rows a mask has, how many of them are narrower, and by how much on each side."""
    x0, y0, x1, y1 = (np.asarray(v, dtype=np.int64) for v in (x0, y0, x1, y1))
    n, narrow, by = shape(y1 - y0, x1 - x0)
    box = np.repeat(np.arange(len(n)), n)
    row = np.arange(len(box)) - (np.cumsum(n) - n)[box]
    cut = np.where(row < narrow[box], by[box], 0)
    start = (y0[box] + row) * width
    ends = np.r_[0, 2 * np.cumsum(n)].astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.column_stack([start + x0[box] + cut, start + x1[box] - cut]).ravel())


def made_intersection(left: Made, right: Made, other: str) -> Column:
    """Pixels that both masks of a pair have; runs are made and merged in one worker. other: the prefix of the right side's columns."""
    among, first, second = len(left.columns), left.make, right.make

    @F.arrow_udf(LongType())
    def both(*columns: pa.Array) -> pa.Array:
        return pa.array(intersections(first(*columns[:among]), second(*columns[among:])))

    return both(*left.of(""), *right.of(other))


def made_union(left: Made, right: Made, other: str) -> Column:
    among, first, second = len(left.columns), left.make, right.make

    @F.pandas_udf(ArrayType(LongType()))
    def either(*columns: pd.Series) -> pd.Series:
        sides = (first(*columns[:among]), second(*columns[among:]))
        (a, b), (i, j) = (m.flatten().to_numpy() for m in sides), (m.offsets.to_numpy() for m in sides)
        return pd.Series([union(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]) for k in range(len(sides[0]))])

    return either(*left.of(""), *right.of(other))


def runs_summary(runs: str | Column, width: int) -> Column:
    """Of masks that aren't empty: pixels n, the sum of their places, and the tight box."""

    @F.pandas_udf("n bigint, places bigint, x0 bigint, y0 bigint, x1 bigint, y1 bigint")
    def summary(masks: pd.Series) -> pd.DataFrame:
        rows = []
        for m in map(np.asarray, masks):
            a, b = m[::2], m[1::2]
            rows.append((int((b - a).sum()), int(((b - a) * (a + b - 1) // 2).sum()), *tight(m, width, 0)))
        return pd.DataFrame(rows, columns=["n", "places", "x0", "y0", "x1", "y1"])

    return summary(runs)


def runs_area(runs: Column) -> Column:
    """By the JVM: what lies between starts and ends."""
    return F.aggregate(F.transform(runs, lambda v, i: F.when(i % 2 == 1, v).otherwise(-v)), F.lit(0).cast("bigint"), lambda s, v: s + v)
