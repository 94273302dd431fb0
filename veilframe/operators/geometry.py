"""Box geometry: conversions, expansion, clipping, filters. Everything is Column arithmetic.

Image sizes may be numbers or columns, so a table of images of all sizes needs no common frame. Division that Python floors is ``floor(a / 2.0)``; ``round`` is half-even (``bround``) where the semantics
are those of numpy or torch; int() truncates, as a cast does. Where an input is outside an operator's
domain the result is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import held

c = F.col
COORDS = ("x0", "y0", "x1", "y1")


def col_of(size) -> Column:
    """A size that is a number or a column."""
    return size if isinstance(size, Column) else F.lit(size)


def half(x: Column) -> Column:
    return F.floor(x / 2.0)


def whole(x: Column) -> Column:
    return x.cast("long")


def yolo_to_voc(df: DataFrame, width, height, floor: bool = False) -> DataFrame:
    """Normalised centre boxes to corners, rounded half up or floored."""
    fix = F.floor if floor else (lambda x: F.floor(x + 0.5))
    return df.withColumns(
        {
            "vx0": fix((c("xc") - c("w") / 2) * width), "vy0": fix((c("yc") - c("h") / 2) * height),
            "vx1": fix((c("xc") + c("w") / 2) * width), "vy1": fix((c("yc") + c("h") / 2) * height),
        }
    )


def xywh_to_xyxy(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    return [whole(F.bround(v)) for v in (x, y, x + w, y + h)]


def absolute(x: Column, size: int) -> Column:
    return whole(F.bround(x * size))


def expand_axis(df: DataFrame, start: str, end: str, target: Column, limit) -> DataFrame:
    """Grows [start, end) to the target width about its middle, then shifts it inside [0, limit) where one side
    only is out. The columns start and end are replaced."""
    limit = col_of(limit)
    grow = whole(target) - (c(end) - c(start))
    df = df.withColumn("_g", grow).withColumn("_s", c(start) - half(c("_g"))).withColumn("_e", c(end) + c("_g") - half(c("_g")))
    right = F.when((c("_s") < 0) & (c("_e") < limit), F.least(-c("_s"), limit - c("_e"))).otherwise(F.lit(0))
    df = df.withColumn("_both", (c("_s") < 0) & (c("_e") > limit)).withColumn("_r", right)
    df = df.withColumn("_s2", c("_s") + c("_r")).withColumn("_e2", c("_e") + c("_r"))
    left = F.when(~c("_both") & (c("_e2") > limit) & (c("_s2") > 0), F.least(c("_e2") - limit, c("_s2"))).otherwise(F.lit(0))
    df = df.withColumn("_l", left).withColumn(start, held(c("_s2") - c("_l"))).withColumn(end, held(c("_e2") - c("_l")))
    return df.drop("_g", "_s", "_e", "_both", "_r", "_s2", "_e2", "_l")


def expand_by_share(df: DataFrame, share: float, width, height) -> DataFrame:
    """Both sides grow by int(sqrt(area) * share), at most to the image."""
    df = df.withColumn("_h", c("y1") - c("y0")).withColumn("_w", c("x1") - c("x0"))
    df = df.withColumn("_x", F.floor(F.sqrt(c("_h") * c("_w")) * share))
    df = expand_axis(df, "x0", "x1", F.least(c("_w") + c("_x"), col_of(width)), width)
    df = expand_axis(df, "y0", "y1", F.least(c("_h") + c("_x"), col_of(height)), height)
    return df.drop("_h", "_w", "_x")


def expand_to_ratio(df: DataFrame, ratio: float, width, height) -> DataFrame:
    """The shorter side, by height / width against the ratio, grows until the ratio holds."""
    df = df.withColumn("_h", c("y1") - c("y0")).withColumn("_w", c("x1") - c("x0")).withColumn("_r", c("_h") / c("_w"))
    df = df.withColumn("_th", F.when(c("_r") < ratio, F.floor(c("_w") * ratio)).otherwise(c("_h")))
    df = df.withColumn("_tw", F.when(c("_r") > ratio, F.floor(c("_h") / ratio)).otherwise(c("_w")))
    return expand_axis(expand_axis(df, "y0", "y1", c("_th"), height), "x0", "x1", c("_tw"), width).drop("_h", "_w", "_r", "_th", "_tw")


def expand_for_background(df: DataFrame, mask_area: Column, background: float, width, height) -> DataFrame:
    """Grows boxes whose mask leaves too little background until it is at least the share."""
    df = df.withColumn("_h", c("y1") - c("y0")).withColumn("_w", c("x1") - c("x0")).withColumn("_m", mask_area)
    enough = (1 - c("_m") / (c("_h") * c("_w"))) > background
    df = df.withColumn("_p", F.when(enough, F.lit(None).cast("double")).otherwise(F.sqrt(c("_m") / (1 - background) / (c("_h") * c("_w")))))
    df = df.withColumn("_tw", F.coalesce(F.ceil(c("_p") * c("_w")), c("_w"))).withColumn("_th", F.coalesce(F.ceil(c("_p") * c("_h")), c("_h")))
    kept = df.withColumns({f"_k{n}": c(n) for n in COORDS}).withColumn("_grow", c("_p").isNotNull())
    grown = expand_axis(expand_axis(kept, "x0", "x1", c("_tw"), width), "y0", "y1", c("_th"), height)
    grown = grown.withColumns({n: F.when(c("_grow"), c(n)).otherwise(c(f"_k{n}")) for n in COORDS})
    return grown.drop("_h", "_w", "_m", "_p", "_tw", "_th", "_grow", *[f"_k{n}" for n in COORDS])


def expanded_box(df: DataFrame, mask_area: Column, background=0.3, share=0.1, ratio=288 / 160, width=640, height=480) -> DataFrame:
    df = df.withColumn("_area", mask_area)
    df = expand_to_ratio(expand_by_share(df, share, width, height), ratio, width, height)
    df = expand_for_background(df, c("_area"), background, width, height).drop("_area")
    return df.withColumns({n: held(c(n)) for n in COORDS})


def include_box(width, height, minimum_area=1024, ratio_range=(0.0, 99999.0), min_inside=0.0) -> Column:
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    inside = (F.least(c("x1"), col_of(width)) - F.greatest(F.lit(0), c("x0"))) * (F.least(col_of(height), c("y1")) - F.greatest(F.lit(0), c("y0")))
    ratio = h / w
    return (inside / (w * h) >= min_inside) & (ratio > ratio_range[0]) & (ratio < ratio_range[1]) & (w * h >= minimum_area)


def quadratic(df: DataFrame, width, height) -> DataFrame:
    """The square of the longer side about the box, kept inside the image; NULL where none fits. Adds qx, qy, qw, qh."""
    W, H = col_of(width), col_of(height)
    df = df.withColumn("_w", c("x1") - c("x0")).withColumn("_h", c("y1") - c("y0")).withColumn("_d", F.abs(c("_h") - c("_w")))
    fits = F.greatest("_w", "_h") <= F.least(W, H)
    # the longer side never exceeds the smaller image side here, so the short side can always grow to it
    tall = c("_h") < c("_w")
    side = F.greatest(c("_w"), c("_h"))
    qx = F.when(~tall & (c("_d") > 0), F.greatest(F.lit(0), c("x0") - half(c("_d")))).otherwise(c("x0"))
    qy = F.when(tall, F.greatest(F.lit(0), c("y0") - half(c("_d")))).otherwise(c("y0"))
    df = df.withColumn("qw", F.when(fits, side)).withColumn("qh", F.when(fits, side)).withColumn("_qx", qx).withColumn("_qy", qy)
    moved = c("_d") > 0
    df = df.withColumn("qx", F.when(moved & (c("_qx") + c("qw") > W), W - c("qw")).otherwise(c("_qx")))
    df = df.withColumn("qy", F.when(moved & (c("_qy") + c("qh") > H), H - c("qh")).otherwise(c("_qy")))
    ok = fits & (c("qx") >= 0) & (c("qy") >= 0) & (c("qx") + c("qw") <= W) & (c("qy") + c("qh") <= H)
    df = df.withColumn("_ok", ok)
    return df.withColumns({n: held(F.when(c("_ok"), c(n))) for n in ("qx", "qy", "qw", "qh")}).drop("_w", "_h", "_d", "_qx", "_qy", "_ok")


def expand_square(df: DataFrame, share: float, width, height) -> DataFrame:
    """quadratic, then a margin of int(side * share) as far as the image allows; adds ex0..ey1, NULL where the
    result would not contain the box or leave the image."""
    W, H = col_of(width), col_of(height)
    df = quadratic(df, width, height)
    f = F.least(half(H - c("qw")), half(W - c("qh")), F.floor(F.greatest(c("qw"), c("qh")) * share))
    df = df.withColumn("_f", F.greatest(f, F.lit(0)))
    df = df.withColumn("_s", c("qw") + 2 * c("_f"))
    # the margin is bounded by half of what is left, so the side stays inside the image
    for q, limit, out in (("qy", H, "ey0"), ("qx", W, "ex0")):
        at = F.when(c("_f") > 0, F.greatest(F.lit(0), c(q) - c("_f"))).otherwise(c(q))
        df = df.withColumn("_at", at).withColumn(out, F.when((c("_f") > 0) & (c("_at") + c("_s") > limit), limit - c("_s")).otherwise(c("_at")))
    df = df.withColumn("ex1", c("ex0") + c("_s")).withColumn("ey1", c("ey0") + c("_s"))
    ok = (c("ex0") >= 0) & (c("ey0") >= 0) & (c("ex1") <= W) & (c("ey1") <= H)
    ok = ok & (c("ex0") <= c("x0")) & (c("ey0") <= c("y0")) & (c("ex1") >= c("x1")) & (c("ey1") >= c("y1"))
    df = df.withColumn("_ok", ok)
    return df.withColumns({n: held(F.when(c("_ok"), c(n))) for n in ("ex0", "ey0", "ex1", "ey1")}).drop("_f", "_s", "_at", "_ok", "qx", "qy", "qw", "qh")


def expand_simple(share: float) -> dict[str, Column]:
    """A square of (1 + share) times the longer side about the centre; may leave the image."""
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    r = half(F.greatest(w, h) * (1.0 + share))
    xc, yc = c("x0") + half(w), c("y0") + half(h)
    return {"sx0": whole(xc - r), "sy0": whole(yc - r), "sx1": whole(xc + r), "sy1": whole(yc + r)}


def expand_face(df: DataFrame, width, height, simple: bool = False) -> DataFrame:
    """simple: the simple square of .4. Else the margin square of .35, or the simple one of .7 where there is none."""
    if simple:
        return df.withColumns({f"f{n[1:]}": v for n, v in expand_simple(0.4).items()})
    df = expand_square(df, 0.35, width, height).withColumns(expand_simple(0.7))
    df = df.withColumns({f"f{n}": F.coalesce(c(f"e{n}"), c(f"s{n}")) for n in COORDS})
    return df.drop(*[f"e{n}" for n in COORDS], *[f"s{n}" for n in COORDS])


def clip_inside(width, height) -> dict[str, Column]:
    """To pixels that exist: the far side at most size - 1."""
    return {"x0": F.greatest(F.lit(0), c("x0")), "y0": F.greatest(F.lit(0), c("y0")), "x1": F.least(c("x1"), col_of(width) - 1), "y1": F.least(c("y1"), col_of(height) - 1)}


def clip_crop(width, height) -> dict[str, Column]:
    """To the half-open image."""
    return {"x0": F.greatest(F.lit(0), c("x0")), "y0": F.greatest(F.lit(0), c("y0")), "x1": F.least(c("x1"), col_of(width)), "y1": F.least(c("y1"), col_of(height))}


def padding(width, height) -> dict[str, Column]:
    zero = F.lit(0)
    return {
        "pad_left": F.greatest(-c("x0"), zero), "pad_top": F.greatest(-c("y0"), zero),
        "pad_right": F.greatest(c("x1") - col_of(width), zero), "pad_bottom": F.greatest(c("y1") - col_of(height), zero),
    }


def to_crop(inner: tuple[str, ...], outer: tuple[str, ...], size: int) -> dict[str, Column]:
    """Corners of the inner box in pixels of a crop of the outer box scaled to size, truncated."""
    w = c(outer[2]) - c(outer[0])
    return {f"c{n}": whole((c(inner[i]) - c(outer[i % 2])) * size / w) for i, n in enumerate(COORDS)}


def union_box(a: tuple[str, ...], b: tuple[str, ...]) -> dict[str, Column]:
    return {n: (F.least if i < 2 else F.greatest)(c(a[i]), c(b[i])) for i, n in enumerate(COORDS)}


def from_crop(inner: tuple[str, ...], outer: tuple[str, ...], size_w: int, size_h: int) -> dict[str, Column]:
    """A box in crop pixels back in image pixels: scaled, truncated, then moved to the outer box, which may start outside the image."""
    w, h = c(outer[2]) - c(outer[0]), c(outer[3]) - c(outer[1])
    sides, sizes = (w, h), (size_w, size_h)
    return {f"b{n}": whole(c(inner[i]) * sides[i % 2] / sizes[i % 2]) + c(outer[i % 2]) for i, n in enumerate(COORDS)}


def centre_offsets(width: Column, height: Column) -> dict[str, Column]:
    side = F.least(width, height)
    return {"side": side, "off_x": half(width - side), "off_y": half(height - side)}


def max_resolution(width: Column, height: Column, limit: int) -> dict[str, Column]:
    f = F.greatest(width / limit, height / limit, F.lit(1.0))
    return {"new_w": whole(width / f), "new_h": whole(height / f)}


def centred_mask(size: int) -> tuple[int, int, int, int]:
    """The fixed centred hole of half the side."""
    return size // 4, size // 4, size // 4 + size // 2, size // 4 + size // 2


def random_mask(width: int, height: int, *seed: Column) -> dict[str, Column]:
    """A hole of half the sides at a seeded uniform place: x0, y0, x1, y1. The last place that would fit is never drawn."""
    out = {}
    for axis, size in (("x", width), ("y", height)):
        u = F.conv(F.substr(F.md5(F.concat_ws("-", *seed, F.lit(axis))), F.lit(1), F.lit(5)), 16, 10).cast("long") / (1 << 20)
        low = F.floor(u * (size - size // 2))
        out |= {f"{axis}0": low, f"{axis}1": low + size // 2}
    return out


def pose_crop(df: DataFrame, width, height) -> DataFrame:
    """Grows the box about its middle to the 256:192 shape; replaces the corners."""
    df = df.withColumn("x1", F.least(c("x1"), col_of(width))).withColumn("y1", F.least(c("y1"), col_of(height)))
    df = df.withColumn("_w", c("x1") - c("x0")).withColumn("_h", c("y1") - c("y0")).withColumn("_f", F.lit(256 / 192) * c("_w") / c("_h"))
    df = df.withColumn("_ly", whole(F.bround(c("_h") * c("_f")) / 2)).withColumn("_lx", whole(F.bround(c("_w") / c("_f")) / 2))
    my, mx, tall = c("y0") + half(c("_h")), c("x0") + half(c("_w")), c("_f") > 1
    out = {
        "x0": F.when(tall, c("x0")).otherwise(mx - c("_lx")), "y0": F.when(tall, my - c("_ly")).otherwise(c("y0")),
        "x1": F.when(tall, c("x1")).otherwise(mx + c("_lx")), "y1": F.when(tall, my + c("_ly")).otherwise(c("y1")),
    }
    return df.withColumns(out).drop("_w", "_h", "_f", "_ly", "_lx")
