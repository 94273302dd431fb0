"""Queries of the pixel operators (X1-X29)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import kernels as K
from ..operators import masks as M
from ..operators import pixels as X

c = F.col
P = ("image_id", "y", "x")
HOLE = "(x >= 2 AND x < 6 AND y >= 2 AND y < 6)"


def hole():
    return (c("x") >= 2) & (c("x") < 6) & (c("y") >= 2) & (c("y") < 6)


def list_sql(values) -> str:
    return "[" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]"


def blur_sql(rel: str, size: int, sigma: float, n: int = 8) -> str:
    """(image_id, y, x, v) blurred along x, then y, mirrored at the border."""
    w, r, per = list_sql(X.gaussian(size, sigma)), size // 2, 2 * (n - 1)

    def one(src: str, axis: str) -> str:
        other = "y" if axis == "x" else "x"
        at = f"((({axis} + k - {r}) % {per} + {per}) % {per})"
        return f"(SELECT t.image_id, t.{other}, t.{axis}, sum(t.w * s.v) AS v FROM (SELECT image_id, {other}, {axis}, {w}[k + 1] AS w, CASE WHEN {at} >= {n} THEN {per} - {at} ELSE {at} END AS src FROM (SELECT *, unnest(range(0, {size})) AS k FROM {src}) e) t JOIN {src} s ON s.image_id = t.image_id AND s.{other} = t.{other} AND s.{axis} = t.src GROUP BY t.image_id, t.{other}, t.{axis})"

    return one(one(f"(SELECT image_id, y, x, v FROM {rel})", "x"), "y")


#: Regions of the query, in order; they overlap.
REGIONS = ((1, 1, 6, 5), (4, 3, 8, 8), (0, 6, 3, 7))


def blurred_region_sql(rel: str, box, size: int = 31) -> str:
    """The pixels with one region blurred, mirrored at the edge of the region, however often the kernel is wider than that."""
    x0, y0, x1, y1 = box
    w, r = list_sql(X.gaussian(size, 0)), size // 2

    def one(src: str, axis: str, first: int, n: int) -> str:
        other, per = "y" if axis == "x" else "x", 2 * (n - 1)
        at = f"((({axis} - {first} + k - {r}) % {per} + {per}) % {per})" if n > 1 else "0"
        return f"(SELECT t.image_id, t.{other}, t.{axis}, sum(t.w * s.v) AS v FROM (SELECT image_id, {other}, {axis}, {w}[k + 1] AS w, {first} + CASE WHEN {at} >= {n} THEN {per} - {at} ELSE {at} END AS src FROM (SELECT *, unnest(range(0, {size})) AS k FROM {src} i) e) t JOIN {src} s ON s.image_id = t.image_id AND s.{other} = t.{other} AND s.{axis} = t.src GROUP BY t.image_id, t.{other}, t.{axis})"

    roi = f"(SELECT * FROM {rel} z WHERE x >= {x0} AND x < {x1} AND y >= {y0} AND y < {y1})"
    done = one(one(roi, "x", x0, x1 - x0), "y", y0, y1 - y0)
    return f"(SELECT p.image_id, p.y, p.x, CASE WHEN b.v IS NULL THEN p.v ELSE CAST(round_even(round(b.v, 6), 0) AS BIGINT) END AS v FROM {rel} p LEFT JOIN {done} b ON b.image_id = p.image_id AND b.y = p.y AND b.x = p.x)"


def x01_sql() -> str:
    steps = [("pixels", None)] + [(f"step{k}", box) for k, box in enumerate(REGIONS)]
    parts = [f"{name} AS MATERIALIZED (SELECT image_id, y, x, v FROM {blurred_region_sql(steps[k][0], box)} q)" for k, (name, box) in enumerate(steps[1:])]
    return f"WITH {', '.join(parts)} SELECT * FROM {steps[-1][0]}"


@query("x01_blur_region", x01_sql())
def x01(spark, d):
    """Regions one after the other, each blurred by itself with 31 taps, so overlaps are blurred twice."""

    @F.pandas_udf("array<bigint>")
    def blurred(px: pd.Series) -> pd.Series:
        return pd.Series([K.redact(np.reshape(p, (8, 8, 1)).astype(np.uint8), list(REGIONS), K.gaussian_blur).ravel().astype(np.int64) for p in px])

    rows = R.images(spark, d).select("image_id", F.posexplode(blurred("px")).alias("i", "v"))
    return rows.select("image_id", F.floor(c("i") / 8).alias("y"), (c("i") % 8).cast("long").alias("x"), "v")


@query("x02_blur_generator", f"SELECT p.image_id, p.y, p.x, round(CASE WHEN p.x >= 2 AND p.x < 6 AND p.y >= 2 AND p.y < 6 THEN b.v ELSE p.v END, 6) AS v FROM pixels p JOIN {blur_sql('pixels', 7, 7)} b USING (image_id, y, x)")
def x02(spark, d):
    p = R.pixels(spark, d)
    b = X.blur(p, 7, 7, 8, 8).withColumnRenamed("v", "b")
    return p.join(b, list(P)).select(*P, F.round(F.when(hole(), c("b")).otherwise(c("v")), 6).alias("v"))


def taps_sql(src: str, axis: str, n_in: int, n_out: int) -> str:
    rows = ", ".join(f"({t}, {s}, {w!r}::DOUBLE)" for t, s, w in X.linear_taps(n_in, n_out))
    other = "y" if axis == "x" else "x"
    return f"(SELECT image_id, {other}, k.t AS {axis}, sum(k.w * v) AS v FROM {src} s JOIN (VALUES {rows}) k(t, s, w) ON k.s = s.{axis} GROUP BY image_id, {other}, k.t)"


PIXELATED = taps_sql(taps_sql(taps_sql(taps_sql("(SELECT image_id, y, x, v FROM pixels)", "x", 8, 4), "y", 8, 4), "x", 4, 8), "y", 4, 8)


@query("x03_pixelate", f"SELECT image_id, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x, round(v, 6) AS v FROM {PIXELATED}")
def x03(spark, d):
    return X.pixelate(R.pixels(spark, d), 4, 8, 8).select(*P, F.round("v", 6).alias("v"))


@query("x04_mask_out", f"SELECT image_id, y, x, CASE WHEN {HOLE} THEN 128 ELSE v END AS v FROM pixels")
def x04(spark, d):
    return R.pixels(spark, d).select(*P, X.mask_out(c("v"), ~hole()).alias("v"))


@query("x05_noise_out", f"SELECT image_id, y, x, CASE WHEN NOT {HOLE} THEN v ELSE CAST(round_even((CAST('0x' || substr(md5(image_id || '-' || y || '-' || x), 1, 5) AS BIGINT) / 1048576.0 + 1) * 127.5, 0) AS BIGINT) END AS v FROM pixels")
def x05(spark, d):
    return R.pixels(spark, d).select(*P, X.noise_out(c("v"), ~hole(), c("image_id"), c("y"), c("x")).alias("v"))


@query("x06_identity", "SELECT image_id, y, x, v FROM pixels")
def x06(spark, d):
    return R.pixels(spark, d)


@query("x07_condition", f"SELECT image_id, y, x, CASE WHEN NOT {HOLE} THEN v ELSE 127 END AS v FROM pixels")
def x07(spark, d):
    return R.pixels(spark, d).select(*P, X.condition(c("v"), ~hole()).alias("v"))


@query("x08_masked_blend", "SELECT image_id, y, x, (1 - CASE WHEN b >= 128 THEN 1 ELSE 0 END) * a + CASE WHEN b >= 128 THEN 1 ELSE 0 END * b AS v FROM pairs")
def x08(spark, d):
    return R.pairs(spark, d).select(*P, X.blend(c("a"), c("b"), F.when(c("b") >= 128, 1).otherwise(0)).alias("v"))


#: Layers over the images: three squares an image, each in a colour of its own.
LAYERS = "SELECT p.image_id, p.y, p.x, (p.v + 50 * o) % 256 AS v, o AS det_id FROM (SELECT *, unnest(range(0, 3)) AS o FROM pixels) p WHERE x >= (image_id + o) % 5 AND x < (image_id + o) % 5 + 4 AND y >= o AND y < o + 4"


def layers(spark, d):
    rows = R.pixels(spark, d).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    left = (c("image_id") + c("o")) % 5
    return rows.filter((c("x") >= left) & (c("x") < left + 4) & (c("y") >= c("o")) & (c("y") < c("o") + 4)).select(*P, ((c("v") + 50 * c("o")) % 256).alias("v"), c("o").alias("det_id"))


@query("x09_paste_last", f"SELECT p.image_id, p.y, p.x, coalesce(t.v, p.v) AS v FROM pixels p LEFT JOIN (SELECT image_id, y, x, arg_max(v, det_id) AS v FROM ({LAYERS}) l GROUP BY image_id, y, x) t USING (image_id, y, x)")
def x09(spark, d):
    return X.over(R.pixels(spark, d), X.paste_last(layers(spark, d), [c("det_id")]))


@query("x10_paste_first", f"SELECT p.image_id, p.y, p.x, coalesce(t.v, p.v) AS v FROM pixels p LEFT JOIN (SELECT image_id, y, x, arg_min(v, det_id) AS v FROM ({LAYERS}) l GROUP BY image_id, y, x) t USING (image_id, y, x)")
def x10(spark, d):
    return X.over(R.pixels(spark, d), X.paste_first(layers(spark, d), [c("det_id")]))


@query("x14_crop_pad", "SELECT i.image_id, gy.y, gx.x, coalesce(p.v, 0) AS v FROM (SELECT DISTINCT image_id FROM pixels) i JOIN (SELECT unnest(range(0, 9)) AS y) gy ON true JOIN (SELECT unnest(range(0, 9)) AS x) gx ON true LEFT JOIN pixels p ON p.image_id = i.image_id AND p.y = gy.y - 2 AND p.x = gx.x + 3")
def x14(spark, d):
    return X.crop(R.pixels(spark, d), 3, -2, 12, 7)


@query("x16_grey", "SELECT image_id, y, x, round(a * 0.299e0 + b * 0.587e0 + ((a + b) % 256) * 0.114e0, 6) AS v FROM pairs")
def x16(spark, d):
    return R.pairs(spark, d).select(*P, F.round(X.grey(c("a"), c("b"), (c("a") + c("b")) % 256), 6).alias("v"))


@query("x17_hsv", """WITH q AS (SELECT image_id, y, x, a AS r, b AS g, (a + b) % 256 AS bl FROM pairs), w AS (SELECT *, greatest(r, g, bl) AS hi, greatest(r, g, bl) - least(r, g, bl) AS d FROM q)
SELECT image_id, y, x, round(60 * CASE WHEN d = 0 THEN 0.0 WHEN hi = r THEN CASE WHEN g < bl THEN (g - bl) / CAST(d AS DOUBLE) + 6 ELSE (g - bl) / CAST(d AS DOUBLE) END WHEN hi = g THEN (bl - r) / CAST(d AS DOUBLE) + 2 ELSE (r - g) / CAST(d AS DOUBLE) + 4 END, 6) AS h,
 round(CASE WHEN hi > 0 THEN d / CAST(hi AS DOUBLE) ELSE 0.0 END, 6) AS s, round(hi / 255.0, 6) AS value FROM w""")
def x17(spark, d):
    out = X.hsv(c("a"), c("b"), (c("a") + c("b")) % 256)
    return R.pairs(spark, d).select(*P, *[F.round(v, 6).alias(k) for k, v in out.items()])


@query("x17_soft_histogram", """WITH s AS (SELECT image_id, CASE WHEN greatest(a, b, (a + b) % 256) > 0 THEN (greatest(a, b, (a + b) % 256) - least(a, b, (a + b) % 256)) / CAST(greatest(a, b, (a + b) % 256) AS DOUBLE) ELSE 0.0 END AS v FROM pairs),
 q AS (SELECT image_id, bin, avg(exp((v - bin / 255.0e0) * (v - bin / 255.0e0) / -0.02e0)) AS m FROM s, (SELECT unnest(range(0, 256)) AS bin) z GROUP BY image_id, bin)
SELECT image_id, CAST(bin AS INT) AS bin, round(m / (sum(m) OVER (PARTITION BY image_id) + 1e-10), 9) AS share FROM q""")
def x17h(spark, d):
    """Of saturation, sharper than by default so that the bins differ."""
    im = R.images(spark, d)
    both = im.join(im.select((c("image_id") - 1).alias("image_id"), c("px").alias("other")), "image_id")
    s = F.transform(F.arrays_zip("px", "other"), lambda p: X.hsv(p["px"], p["other"], (p["px"] + p["other"]) % 256)["s"])
    rows = both.select("image_id", s.alias("s")).select("image_id", F.posexplode(X.soft_histogram(c("s"), 256, 0.1)).alias("bin", "share"))
    return rows.withColumn("share", F.round("share", 9))


@query("x18_histogram_match", """WITH s AS MATERIALIZED (SELECT image_id, v, sum(n) OVER (PARTITION BY image_id ORDER BY v) / CAST(sum(n) OVER (PARTITION BY image_id) AS DOUBLE) AS q FROM (SELECT image_id, v, count(*) AS n FROM pixels GROUP BY image_id, v) h),
 m AS (SELECT a.image_id, a.v, a.q, max(b.q) FILTER (b.q <= a.q) AS lq, max(b.v) FILTER (b.q <= a.q) AS lv, min(b.q) FILTER (b.q >= a.q) AS hq, min(b.v) FILTER (b.q >= a.q) AS hv FROM s a JOIN s b ON b.image_id = a.image_id + 1 GROUP BY a.image_id, a.v, a.q)
SELECT p.image_id, p.y, p.x, round(CASE WHEN lq IS NULL THEN hv WHEN hq = lq THEN lv ELSE lv + (hv - lv) * (q - lq) / (hq - lq) END, 6) AS v FROM pixels p JOIN m ON m.image_id = p.image_id AND m.v = p.v""")
def x18(spark, d):
    p = R.pixels(spark, d)
    return X.histogram_match(p, p.withColumn("image_id", c("image_id") - 1)).filter("v is not null").withColumn("v", F.round("v", 6))


@query("x18_weighted_blend", f"""WITH keep AS MATERIALIZED (SELECT image_id, y, x, CASE WHEN {HOLE} THEN 0 ELSE 1 END AS v FROM pairs), w AS (SELECT image_id, y, x, v / max(v) OVER (PARTITION BY image_id) AS w FROM {blur_sql("keep", 19, 10)} g)
SELECT image_id, y, x, round((1 - w) * a + w * b, 6) AS v FROM pairs JOIN w USING (image_id, y, x)""")
def x18b(spark, d):
    """What is matched shows outside the hole, with a soft edge."""
    p = R.pairs(spark, d)
    weights = X.soft_edge(p.select(*P, F.when(hole(), 0).otherwise(1).alias("v")), 19, 10, 8, 8)
    out = X.weighted_pair(p, weights, "a", "b")
    return out.withColumn("v", F.round("v", 6))


@query("x19_cdf_distance", """WITH q AS (SELECT image_id, abs(sum(a) OVER o / (sum(a) OVER w + 1e-14) - sum(b) OVER o / (sum(b) OVER w + 1e-14)) AS d FROM pairs WINDOW o AS (PARTITION BY image_id ORDER BY y, x ROWS UNBOUNDED PRECEDING), w AS (PARTITION BY image_id))
SELECT image_id, round(sum(d), 6) AS w1, round(sqrt(sum(d * d)), 6) AS w2 FROM q GROUP BY image_id""")
def x19(spark, d):
    p = R.pairs(spark, d)
    one, two = X.cdf_distance(p, 1), X.cdf_distance(p, 2)
    return one.select("image_id", F.round("distance", 6).alias("w1")).join(two.select("image_id", F.round("distance", 6).alias("w2")), "image_id")


@query("x20_denormalise", "SELECT image_id, y, x, CAST(round_even(least(1.0, greatest(0.0, (v / 127.5 - 1) * 0.5 + 0.5)) * 255, 0) AS BIGINT) AS v FROM pixels")
def x20(spark, d):
    unit = (c("v") / 127.5 - 1) * 0.5 + 0.5
    return R.pixels(spark, d).select(*P, F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), unit)) * 255).cast("long").alias("v"))


@query("x21_flip", "SELECT image_id, y, 7 - x AS x, v FROM pixels")
def x21(spark, d):
    return X.flip(R.pixels(spark, d), 8)


@query("x22_centre_crop", "SELECT image_id, y - 1 AS y, x - 1 AS x, v FROM pixels WHERE x >= 1 AND x < 7 AND y >= 1 AND y < 7")
def x22(spark, d):
    return X.crop(R.pixels(spark, d), 1, 1, 7, 7)


@query("x25_mask_overlay", "SELECT image_id, y, x, round(v * 0.7e0 + 0.3e0 * CASE WHEN v >= 128 THEN 255 ELSE 0 END, 6) AS v FROM pixels")
def x25(spark, d):
    return R.pixels(spark, d).select(*P, F.round(c("v") * 0.7 + 0.3 * F.when(c("v") >= 128, 255).otherwise(0), 6).alias("v"))


@query("x27_heat_overlay", """WITH h AS (SELECT *, (255 - floor((CASE WHEN max(b) OVER w > min(b) OVER w THEN (b - min(b) OVER w) / CAST(max(b) OVER w - min(b) OVER w AS DOUBLE) ELSE 0.0 END * 0.95e0 + 0.05e0) * 255)) / 255.0e0 AS t FROM pairs WINDOW w AS (PARTITION BY image_id))
SELECT image_id, y, x, round(0.6e0 * a + 102 * greatest(0, least(1, 1.5e0 - abs(4 * t - 3))), 6) AS r, round(0.6e0 * a + 102 * greatest(0, least(1, 1.5e0 - abs(4 * t - 2))), 6) AS g, round(0.6e0 * a + 102 * greatest(0, least(1, 1.5e0 - abs(4 * t - 1))), 6) AS b FROM h""")
def x27(spark, d):
    out = X.heat_overlay(R.pairs(spark, d).withColumnRenamed("a", "v"), "b")
    return out.select(*P, *[F.round(k, 6).alias(k) for k in ("r", "g", "b")])


@query("x28_progressive_blend", """SELECT p.image_id, p.y, p.x, round(b.m * 0.7e0 + p.v * 0.3e0, 6) AS v FROM pixels p JOIN (SELECT image_id, y // 2 AS y2, x // 2 AS x2, avg(v) AS m FROM pixels GROUP BY ALL) b ON b.image_id = p.image_id AND b.y2 = p.y // 2 AND b.x2 = p.x // 2""")
def x28(spark, d):
    p = R.pixels(spark, d).withColumns({"y2": F.floor(c("y") / 2), "x2": F.floor(c("x") / 2)})
    small = M.pool(p.select(*P, "v"), 2, F.avg).select("image_id", c("y").alias("y2"), c("x").alias("x2"), c("v").alias("m"))
    return p.join(small, ["image_id", "y2", "x2"]).select(*P, F.round(c("m") * 0.7 + c("v") * 0.3, 6).alias("v"))


@query("x29_masked_view", f"SELECT p.image_id, p.y, p.x, CASE WHEN t.image_id IS NULL THEN p.v ELSE 0 END AS v FROM pixels p LEFT JOIN (SELECT DISTINCT image_id, y, x FROM ({LAYERS}) l) t USING (image_id, y, x)")
def x29(spark, d):
    covered = layers(spark, d).select(*P).distinct().withColumn("v", F.lit(0).cast("long"))
    return X.over(R.pixels(spark, d), covered)
