"""Regions of a mask by runs, and their outer borders: which regions lie in no hole of another, the border pixels in order, the area inside.

Small numpy helpers for one image's mask; work grows with runs and border pixels, not with the area of regions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

#: The eight neighbours, clockwise from the left, as (dy, dx).
AROUND = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))


def row_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(y, from, to) of the runs of set pixels, row by row."""
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (y, start), (_, end) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return y, start, end


def label_runs(mask: np.ndarray, corners: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(y, from, to, region) of the runs; regions are numbered from 0 by their first pixel. corners: pixels that touch at a corner belong together."""
    y, start, end = row_runs(mask)
    parent = list(range(len(y)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    first = np.searchsorted(y, np.arange(mask.shape[0] + 1))
    room = 1 if corners else 0
    for row in range(1, mask.shape[0]):
        a, b, stop_a, stop_b = first[row - 1], first[row], first[row], first[row + 1]
        while a < stop_a and b < stop_b:
            if start[a] < end[b] + room and start[b] < end[a] + room:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
            if end[a] < end[b]:
                a += 1
            else:
                b += 1
    tops = np.array([root(k) for k in range(len(y))], np.int64)
    return y, start, end, np.unique(tops, return_inverse=True)[1] if len(tops) else tops


def region_boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Half-open boxes of all 8-connected regions, in order of their first pixel, those in holes of others too."""
    y, start, end, region = label_runs(mask, True)
    n = int(region.max()) + 1 if len(region) else 0
    x0, x1, y0, y1 = np.full(n, mask.shape[1]), np.zeros(n, int), np.full(n, mask.shape[0]), np.zeros(n, int)
    np.minimum.at(x0, region, start)
    np.maximum.at(x1, region, end)
    np.minimum.at(y0, region, y)
    np.maximum.at(y1, region, y + 1)
    return [tuple(map(int, b)) for b in zip(x0, y0, x1, y1, strict=True)]


def follow(mask: np.ndarray, y: int, x: int) -> list[tuple[int, int]]:
    """The outer border of the region whose first pixel is (y, x), as (x, y) in order; pixels of thin parts come more than once. The mask has an empty
    frame."""
    came = next((k for k in range(8) if mask[y + AROUND[k][0], x + AROUND[k][1]]), None)
    if came is None:
        return [(x, y)]
    last = (y + AROUND[came][0], x + AROUND[came][1])  # where the walk ends before it is back at the first
    at, back, out = (y, x), came, []
    while True:
        out.append((at[1], at[0]))
        # counter-clockwise from the pixel that it came from
        for turn in range(1, 9):
            k = (back - turn) % 8
            to = (at[0] + AROUND[k][0], at[1] + AROUND[k][1])
            if mask[to]:
                break
        if to == (y, x) and at == last:
            return out
        at, back = to, (k + 4) % 8


def external_contours(mask: np.ndarray) -> list[list[tuple[int, int]]]:
    """Outer borders of the 8-connected regions that lie in no hole of another, in order of their first pixel."""
    framed = np.pad(mask.astype(bool), 1)
    y, start, _, region = label_runs(framed, True)
    by, bs, be, ground = label_runs(~framed, False)
    places = by * framed.shape[1] + bs
    out = []
    for k in np.unique(region, return_index=True)[1]:
        # left of a region's first pixel is what surrounds it
        left = np.searchsorted(places, y[k] * framed.shape[1] + start[k] - 1, "right") - 1
        if ground[left] == 0:
            out.append([(a - 1, b - 1) for a, b in follow(framed, int(y[k]), int(start[k]))])
    return out


def contour_area(points: list[tuple[int, int]]) -> float:
    """The area inside a border through the centres of its pixels."""
    x, y = np.array(points, np.int64).T
    return abs(int((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def contour_box(points: list[tuple[int, int]]) -> tuple[int, int, int, int]:
    x, y = np.array(points).T
    return int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1


#: Regions that may be text, by exclusive bounds of width over height, area inside the border, width and height.
TEXT_LIMITS = ((1.5, 8.0), (100, 50_000), (10, 500), (10, 100))


def text_regions(mask: np.ndarray, limits=TEXT_LIMITS) -> list[tuple[int, int, int, int, float]]:
    """(x0, y0, x1, y1, area) of the regions that may be text."""
    out = []
    for points in external_contours(mask):
        x0, y0, x1, y1 = contour_box(points)
        w, h, area = x1 - x0, y1 - y0, contour_area(points)
        if all(low < v < high for v, (low, high) in zip((w / h, area, w, h), limits, strict=True)):
            out.append((x0, y0, x1, y1, area))
    return out


def contours_udf(width: int, height: int, threshold: int, limits=None):
    """Arrow function: grey values in row order -> box and area of the external contours above the threshold, or of those that may be text."""

    @F.pandas_udf("array<struct<x0: int, y0: int, x1: int, y1: int, area: double>>")
    def find(px: pd.Series) -> pd.Series:
        masks = (np.reshape(p, (height, width)) > threshold for p in px)
        if limits is None:
            return pd.Series([[(*contour_box(q), contour_area(q)) for q in external_contours(m)] for m in masks])
        return pd.Series([text_regions(m, limits) for m in masks])

    return find
