"""Mask and image-plane operators over the pixel relation (image_id, y, x, v) and over packed crops.

Neighbourhood operators shift the pixel relation by a small table of offsets (at most the size of the kernel) and
group by pixel; groups never cross an image. On whole images the same semantics exist as numpy kernels in
``operators.kernels``.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lists as L
from .keypoints import line_cells

c = F.col
PIXEL = ("image_id", "y", "x")


def disk(n: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-n, n + 1) for dx in range(-n, n + 1) if dx * dx + dy * dy <= n * n]


def square(n: int) -> list[tuple[int, int]]:
    return [(dy, dx) for dy in range(-n, n + 1) for dx in range(-n, n + 1)]


def box_mask(df: DataFrame, out: str = "hit") -> Column:
    """Whether a pixel lies in the half-open box x0, y0, x1, y1 of its row."""
    return ((c("x") >= c("x0")) & (c("x") < c("x1")) & (c("y") >= c("y0")) & (c("y") < c("y1"))).alias(out)


def tight_box(mask: DataFrame, keys=("image_id",), hit: str = "hit", width: int = 8, height: int = 8) -> DataFrame:
    """Tight half-open box of the hit pixels; an empty mask gives the whole image."""
    on = lambda v: F.when(c(hit), v)
    out = mask.groupBy(*keys).agg(F.min(on(c("x"))).alias("x0"), F.min(on(c("y"))).alias("y0"), (F.max(on(c("x"))) + 1).alias("x1"), (F.max(on(c("y"))) + 1).alias("y1"))
    return out.select(*keys, *[F.coalesce(c(n), F.lit(v).cast("long")).alias(n) for n, v in (("x0", 0), ("y0", 0), ("x1", width), ("y1", height))])


def shifted(pixels: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """Each pixel seen from each of its neighbours: y, x of the neighbour, dy, dx towards the source."""
    table = F.array(*[F.struct(F.lit(dy).cast("long").alias("dy"), F.lit(dx).cast("long").alias("dx")) for dy, dx in offsets])
    rows = pixels.withColumn("_o", F.explode(table))
    return rows.withColumns({"y": c("y") - c("_o")["dy"], "x": c("x") - c("_o")["dx"], "dy": c("_o")["dy"], "dx": c("_o")["dx"]}).drop("_o")


def dilate(mask: DataFrame, offsets: list[tuple[int, int]], width: int, height: int) -> DataFrame:
    """A pixel is hit if any pixel under the kernel is."""
    rows = shifted(mask.select(*PIXEL, "hit"), offsets)
    rows = rows.filter((c("x") >= 0) & (c("x") < width) & (c("y") >= 0) & (c("y") < height))
    return rows.groupBy(*PIXEL).agg(F.max("hit").alias("hit"))


def reflect(v: Column, size: int) -> Column:
    """Index mirrored at the border, the border itself not repeated."""
    return F.when(v < 0, -v).when(v >= size, 2 * (size - 1) - v).otherwise(v)


def reflected(pixels: DataFrame, radius: int, width: int, height: int) -> DataFrame:
    """The pixels with a border of the given radius mirrored around them."""
    def copies(axis: str, size: int) -> Column:
        v = c(axis)
        low = F.when((v >= 1) & (v <= radius), -v)
        high = F.when((v <= size - 2) & (v >= size - 1 - radius), 2 * (size - 1) - v)
        return F.filter(F.array(v, low, high), lambda x: x.isNotNull())

    rows = pixels.withColumn("_y", F.explode(copies("y", height))).withColumn("_x", F.explode(copies("x", width)))
    return rows.withColumn("y", c("_y")).withColumn("x", c("_x")).drop("_y", "_x")


def erode(mask: DataFrame, offsets: list[tuple[int, int]], width: int, height: int) -> DataFrame:
    """A pixel is hit if all pixels under the kernel are, the image mirrored at its border."""
    radius = max(max(abs(a), abs(b)) for a, b in offsets)
    rows = shifted(reflected(mask.select(*PIXEL, "hit"), radius, width, height), offsets)
    rows = rows.filter((c("x") >= 0) & (c("x") < width) & (c("y") >= 0) & (c("y") < height))
    return rows.groupBy(*PIXEL).agg(F.min("hit").alias("hit"))


def strip_padding(hit: Column, pads: dict[str, Column], scale: Column, width: int, height: int) -> Column:
    """Hits in the padding strips of a crop, scaled and floored, on all four sides are cleared."""
    strip = {k: F.floor(v * scale) for k, v in pads.items()}
    inside = (c("x") >= strip["pad_left"]) & (c("y") >= strip["pad_top"])
    return hit & inside & (c("x") < width - strip["pad_right"]) & (c("y") < height - strip["pad_bottom"])


def mask_iou(a: DataFrame, b: DataFrame, keys: list[str], eps: float = 0.0) -> DataFrame:
    """Pixel relations with ``hit`` joined on key and pixel: intersection over union per key."""
    both = a.select(*keys, "y", "x", c("hit").alias("_a")).join(b.select(*keys, "y", "x", c("hit").alias("_b")), [*keys, "y", "x"])
    out = both.groupBy(*keys).agg(F.count_if(c("_a") & c("_b")).alias("n_and"), F.count_if(c("_a") | c("_b")).alias("n_or"))
    return out.withColumn("iou", F.when(c("n_or") + eps > 0, c("n_and") / (c("n_or") + eps)))


def pack_bits(mask: DataFrame, keys=("image_id",)) -> DataFrame:
    """Masks as hexadecimal rows, most significant bit first."""
    weight = F.get(F.array(*[F.lit(128 >> i).cast("long") for i in range(8)]), c("x").cast("int"))
    rows = mask.groupBy(*keys, "y").agg(F.sum(F.when(c("hit"), weight).otherwise(F.lit(0).cast("long"))).alias("b"))
    ordered = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("y", "b"))).alias("r"))
    return ordered.select(*keys, F.array_join(F.transform("r", lambda r: F.lpad(F.hex(r["b"]), 2, "0")), "").alias("packed"))


def unpack_bits(packed: DataFrame, keys=("image_id",)) -> DataFrame:
    rows = packed.select(*keys, F.posexplode(F.split(F.regexp_replace("packed", "(..)", "$1,"), ",")).alias("y", "h")).filter("h <> ''")
    bits = rows.select(*keys, c("y").cast("long").alias("y"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("x"), "h")
    return bits.select(*keys, "y", "x", (F.floor(F.conv("h", 16, 10).cast("long") / F.pow(F.lit(2.0), 7 - c("x"))) % 2 == 1).alias("hit"))


def resize_nearest(pixels: DataFrame, size_in: int, size_out: int) -> DataFrame:
    """Each output pixel takes input floor(i * in / out)."""
    ids = lambda axis: F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(size_out - 1).cast("long")), lambda o: F.floor(o * size_in / size_out) == c(axis)))
    rows = pixels.withColumn("_y", ids("y")).withColumn("_x", ids("x"))
    return rows.withColumn("y", c("_y")).withColumn("x", c("_x")).drop("_y", "_x")


def pool(pixels: DataFrame, factor: int, how, value: str = "v") -> DataFrame:
    """Blocks of factor x factor become one pixel by the given aggregate."""
    return pixels.groupBy("image_id", F.floor(c("y") / factor).alias("y"), F.floor(c("x") / factor).alias("x")).agg(how(value).alias(value))


def adaptive_pool(pixels: DataFrame, size_in: int, size_out: int, how, value: str = "v") -> DataFrame:
    """size_out x size_out cells whatever the size: cell t takes the pixels from floor(t * size_in / size_out) up to
    ceil((t + 1) * size_in / size_out), so neighbours may share pixels."""
    spans = [range(t * size_in // size_out, -(-(t + 1) * size_in // size_out)) for t in range(size_out)]
    cells = lambda at: F.explode(F.get(F.array(*[F.array(*[F.lit(t).cast("long") for t, span in enumerate(spans) if k in span]) for k in range(size_in)]), c(at).cast("int")))
    rows = pixels.select("image_id", cells("y").alias("_t"), "x", value).select("image_id", c("_t").alias("y"), cells("x").alias("x"), value)
    return rows.groupBy("image_id", "y", "x").agg(how(value).alias(value))


def otsu(pixels: DataFrame) -> DataFrame:
    """Per image the grey value with the largest between-class variance (first on ties): values above it are foreground."""
    hist = pixels.groupBy("image_id", "v").agg(F.count("*").cast("double").alias("n"))
    w = Window.partitionBy("image_id").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    full = Window.partitionBy("image_id")
    h = hist.withColumns({"n0": F.sum("n").over(w), "s0": F.sum(c("n") * c("v")).over(w), "nt": F.sum("n").over(full), "st": F.sum(c("n") * c("v")).over(full)})
    n1 = c("nt") - c("n0")
    gap = c("s0") / c("n0") - (c("st") - c("s0")) / n1
    h = h.withColumn("between", F.when(n1 > 0, c("n0") * n1 * gap * gap).otherwise(F.lit(0.0)))
    return h.groupBy("image_id").agg(F.max_by("v", F.struct(F.round("between", 6), -c("v"))).alias("threshold"))


def fill_polygons(polygons: list[list[tuple[float, float]]], width: int, height: int) -> np.ndarray:
    """Union of polygons, boundary included, as a mask: even-odd test of pixel centres plus the edges' own pixels."""
    ys, xs = np.mgrid[0:height, 0:width]
    out = np.zeros((height, width), bool)
    for p in polygons:
        inside = np.zeros_like(out)
        for (xa, ya), (xb, yb) in zip(p, p[1:] + p[:1], strict=True):
            if ya != yb:
                cross = (ys >= min(ya, yb)) & (ys < max(ya, yb)) & (xs < (xb - xa) * (ys - ya) / (yb - ya) + xa)
                inside ^= cross
            for x, y in line_cells(int(xa), int(ya), int(xb), int(yb)):
                if 0 <= x < width and 0 <= y < height:
                    out[y, x] = True
        out |= inside
    return out


def encode_runs(mask: np.ndarray) -> list[int]:
    """Run lengths column by column, the first one of empty cells."""
    flat = np.asarray(mask, bool).ravel(order="F")
    edges = np.flatnonzero(np.diff(flat)) + 1
    runs = np.diff(np.concatenate([[0], edges, [len(flat)]])).tolist()
    return [0, *runs] if len(flat) and flat[0] else runs


def runs_to_text(runs: list[int]) -> str:
    """Run lengths as text: from the fourth on the difference to the one before last; five bits a character, lowest first, the sixth says
    that more follow; characters start at "0"."""
    out = []
    for i, n in enumerate(runs):
        x = n - runs[i - 2] if i > 2 else n
        more = True
        while more:
            low = x & 31
            x >>= 5
            more = x != (-1 if low & 16 else 0)
            out.append(chr(48 + low + 32 * more))
    return "".join(out)


def text_to_runs(text: str) -> list[int]:
    runs, x, k = [], 0, 0
    for ch in text:
        code = ord(ch) - 48
        x |= (code & 31) << (5 * k)
        k += 1
        if code & 32:
            continue
        if code & 16:
            x -= 1 << (5 * k)
        runs.append(x + runs[-2] if len(runs) > 2 else x)
        x, k = 0, 0
    return runs


def decode_mask(segmentation, height: int, width: int) -> np.ndarray:
    """A segmentation of an annotation file as a mask: polygons ([[x0, y0, x1, y1, ...], ...]) or run lengths ({size, counts}), as numbers or text."""
    if isinstance(segmentation, dict):
        counts = segmentation["counts"]
        runs = text_to_runs(counts) if isinstance(counts, str) else counts
        flat = np.repeat(np.arange(len(runs)) % 2 == 1, runs)
        return flat.reshape((height, width), order="F")
    return fill_polygons([list(zip(p[0::2], p[1::2], strict=True)) for p in segmentation], width, height)


def masks_of(annotations: DataFrame) -> DataFrame:
    """annotations(id, segmentation as JSON text, height, width) -> id, mask (packed bits, row by row), area; a null segmentation has no mask."""

    @F.pandas_udf("struct<mask: binary, area: bigint>")
    def decode(segmentation: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
        rows = []
        for text, h, w in zip(segmentation, height, width, strict=True):
            m = None if text is None else decode_mask(json.loads(text), int(h), int(w))
            rows.append((None, None) if m is None else (np.packbits(m).tobytes(), int(m.sum())))
        return pd.DataFrame(rows, columns=["mask", "area"])

    return annotations.select("id", decode("segmentation", "height", "width").alias("m")).select("id", "m.*")


def polygon_masks(corners: pa.Array, width: int, height: int) -> np.ndarray:
    """``fill_polygons`` of a column of single polygons: rows x height x width. A row of cells is inside between crossings of edges, which are counted; null
    polygons are empty."""
    n, row, xa, ya = len(corners), L.parents(corners), *(np.asarray(v.cast("double")) for v in L.fields(corners, "x", "y"))
    last = L.starts(corners)[row] + L.lengths(corners)[row] - 1
    after = np.where(np.arange(len(row)) == last, L.starts(corners)[row], np.arange(len(row)) + 1)
    xb, yb = xa[after], ya[after]
    # integer rows y with min(ya, yb) <= y < max(ya, yb), inside the image
    clipped = lambda v: np.clip(np.ceil(v), 0, height).astype(np.int64)
    low, high = clipped(np.minimum(ya, yb)), clipped(np.maximum(ya, yb))
    edge = np.repeat(np.arange(len(row)), high - low)
    y = np.arange(len(edge)) - (np.cumsum(high - low) - (high - low))[edge] + low[edge]
    cross = (xb - xa)[edge] * (y - ya[edge]) / (yb - ya)[edge] + xa[edge]
    left = np.clip(np.ceil(cross), 0, width).astype(np.int64)  # cells left of the crossing
    counts = np.bincount((row[edge] * height + y) * (width + 1) + left, minlength=n * height * (width + 1)).reshape(n, height, width + 1)
    out = np.cumsum(counts[:, :, :0:-1], axis=2)[:, :, ::-1] % 2 == 1  # edges whose crossing lies right of the cell
    line, cx, cy = L.line_steps(*(np.trunc(v).astype(np.int64) for v in (xa, ya, xb, yb)))
    on = (cx >= 0) & (cx < width) & (cy >= 0) & (cy < height)
    out[row[line[on]], cy[on], cx[on]] = True
    return out


def packed_polygons(corners: pa.Array, width: int, height: int) -> pa.Array:
    """``polygon_udf`` of a batch."""
    parts = [np.packbits(polygon_masks(corners.slice(a, b - a), width, height).reshape(b - a, -1), axis=1) for a, b in L.slices(len(corners), width * height)]
    return L.binaries(np.concatenate(parts) if parts else np.zeros((0, -(-width * height // 8)), np.uint8), np.asarray(corners.is_null()))


def polygon_udf(width: int, height: int):
    """Arrow function: corners (x, y) of a polygon -> packed bits of its cells; null corners have no mask."""

    @F.arrow_udf("binary")
    def fill(corners: pa.Array) -> pa.Array:
        return packed_polygons(corners, width, height)

    return fill


def brush_udf(size: int):
    """Arrow function: seeded random strokes inside the centred hole, packed bits (1 = anonymise)."""

    @F.pandas_udf("binary")
    def draw(seed: pd.Series) -> pd.Series:
        out = []
        for s in seed:
            rng = np.random.default_rng(abs(int(s)))
            grid = np.zeros((size, size), bool)
            for _ in range(rng.integers(1, 5)):
                points = rng.integers(0, size, (rng.integers(2, 6), 2))
                width = int(rng.integers(1, max(2, size // 8)))
                for (xa, ya), (xb, yb) in zip(points, points[1:], strict=False):
                    for x, y in line_cells(int(xa), int(ya), int(xb), int(yb)):
                        grid[max(0, y - width) : y + width + 1, max(0, x - width) : x + width + 1] = True
            hole = np.zeros_like(grid)
            hole[size // 4 : size // 4 + size // 2, size // 4 : size // 4 + size // 2] = True
            out.append(np.packbits(grid & hole).tobytes())
        return pd.Series(out)

    return draw
