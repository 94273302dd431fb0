"""Pixel operators: anonymisers, compositing and resampling over the pixel relation (image_id, y, x, v).

Blurs and resampling join the pixels with a small table of (offset or source, weight) built from the
parameters, as an array literal; sums are per image and pixel. Whole images have numpy twins in ``kernels``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import let


c = F.col
PIXEL = ("image_id", "y", "x")


def gaussian(size: int, sigma: float = 0.0) -> list[float]:
    """Normalised weights of an odd kernel; sigma 0 derives it from the size."""
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    w = [math.exp(-((i - size // 2) ** 2) / (2 * sigma * sigma)) for i in range(size)]
    return [x / sum(w) for x in w]


def convolve_axis(pixels: DataFrame, axis: str, weights: list[float], size: int, value: str = "v") -> DataFrame:
    """One pass of a separable filter, the image mirrored at its border (the border itself not repeated)."""
    r = len(weights) // 2
    period = 2 * (size - 1)
    mirror = lambda at: min(at % period, period - at % period) if period else 0
    shares = [[0.0] * size for _ in range(size)]  # of a source in each target; taps that meet in a source are added
    for target in range(size):
        for k, w in enumerate(weights):
            shares[mirror(target + k - r)][target] += w
    # each pixel gives its share to all targets of its line, so no relation is joined; a target has to be a pixel itself
    taps = lambda s: F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(w).alias("w")) for t, w in enumerate(shares[s]) if w or t == s])
    rows = pixels.select(*PIXEL, c(value).alias("_v"), F.explode(F.get(F.array(*[taps(s) for s in range(size)]), c(axis).cast("int"))).alias("_t"))
    other = "x" if axis == "y" else "y"
    own = F.bool_or(c(axis) == c("_t")["t"]).alias("_own")
    given = rows.groupBy("image_id", other, c("_t")["t"].alias("_target")).agg(F.sum(c("_t")["w"] * c("_v")).alias(value), own)
    return given.filter("_own").select("image_id", *[(c("_target") if n == axis else c(n)).alias(n) for n in ("y", "x")], value)


def blur(pixels: DataFrame, size: int, sigma: float, width: int, height: int, value: str = "v") -> DataFrame:
    w = gaussian(size, sigma)
    return convolve_axis(convolve_axis(pixels, "x", w, width, value), "y", w, height, value)


def blur_region(pixels: DataFrame, inside: Column, blurred: DataFrame) -> DataFrame:
    """Blurred values, rounded half to even, inside the region; the pixels' own outside."""
    b = blurred.withColumnRenamed("v", "_b")
    return pixels.join(b, list(PIXEL)).select(*PIXEL, F.when(inside, F.bround("_b").cast("long")).otherwise(c("v")).alias("v"))


def linear_taps(size_in: int, size_out: int) -> list[tuple[int, int, float]]:
    """(target, source, weight) of linear resampling with aligned corners."""
    out = []
    for t in range(size_out):
        at = t * (size_in - 1) / (size_out - 1) if size_out > 1 else 0.0
        low = min(int(at), size_in - 1)
        frac = at - low
        out.append((t, low, 1 - frac))
        if frac > 0:
            out.append((t, low + 1, frac))
    return out


def resample_axis(pixels: DataFrame, axis: str, taps: list[tuple[int, int, float]], value: str = "v") -> DataFrame:
    table = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(s).cast("long").alias("s"), F.lit(float(w)).alias("w")) for t, s, w in taps])
    rows = pixels.withColumn("_k", F.explode(F.filter(table, lambda k: k["s"] == c(axis))))
    other = "x" if axis == "y" else "y"
    return rows.groupBy("image_id", other, c("_k")["t"].alias(axis)).agg(F.sum(c("_k")["w"] * c(value)).alias(value)).select(*PIXEL, value)


def resize_linear(pixels: DataFrame, w_in: int, h_in: int, w_out: int, h_out: int, value: str = "v") -> DataFrame:
    return resample_axis(resample_axis(pixels, "x", linear_taps(w_in, w_out), value), "y", linear_taps(h_in, h_out), value)


def pixelate(pixels: DataFrame, cells: int, width: int, height: int, value: str = "v") -> DataFrame:
    """Down to cells x cells and up again, linear both ways."""
    return resize_linear(resize_linear(pixels, width, height, cells, cells, value), cells, cells, width, height, value)


def mask_out(v: Column, keep: Column) -> Column:
    """Mid-grey in the hole: zero between -1 and 1, half-even in bytes."""
    return F.when(keep, v).otherwise(F.bround(F.lit(127.5)).cast("long"))


def noise_out(v: Column, keep: Column, *seed: Column) -> Column:
    """Seeded noise of the bright half in the hole."""
    u = F.conv(F.substr(F.md5(F.concat_ws("-", *seed)), F.lit(1), F.lit(5)), 16, 10).cast("long") / (1 << 20)
    return F.when(keep, v).otherwise(F.bround((u + 1) * 127.5).cast("long"))


def condition(v: Column, keep: Column) -> Column:
    return F.when(keep, v).otherwise(F.lit(127))


def blend(a: Column, b: Column, m: Column) -> Column:
    return (1 - m) * a + m * b


def paste_last(layers: DataFrame, order: list[Column]) -> DataFrame:
    """layers(image_id, y, x, v, order columns): the last layer that covers a pixel wins."""
    return layers.groupBy(*PIXEL).agg(F.max_by("v", F.struct(*order)).alias("v"))


def paste_first(layers: DataFrame, order: list[Column]) -> DataFrame:
    """The first layer that covers a pixel wins."""
    return layers.groupBy(*PIXEL).agg(F.min_by("v", F.struct(*order)).alias("v"))


def over(base: DataFrame, top: DataFrame) -> DataFrame:
    """Composited pixels over the image: untouched ones are the image's own."""
    return base.join(top.withColumnRenamed("v", "_top"), list(PIXEL), "left").select(*PIXEL, F.coalesce("_top", "v").alias("v"))


def crop(pixels: DataFrame, x0: int, y0: int, x1: int, y1: int, fill: int = 0) -> DataFrame:
    """A crop that may leave the image; what is outside has the fill value."""
    ids = pixels.select("image_id").distinct()
    axis = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    grid = ids.withColumn("y", axis(y1 - y0)).withColumn("x", axis(x1 - x0))
    inside = pixels.select("image_id", (c("y") - y0).alias("y"), (c("x") - x0).alias("x"), "v")
    return grid.join(inside, list(PIXEL), "left").select(*PIXEL, F.coalesce("v", F.lit(fill)).alias("v"))


def grey(r: Column, g: Column, b: Column) -> Column:
    return r * 0.299 + g * 0.587 + b * 0.114


def hsv(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """Hue in degrees, saturation and value in 0..1, of byte channels."""
    hi, lo = F.greatest(r, g, b), F.least(r, g, b)
    d = hi - lo
    hue = F.when(d == 0, 0.0).when(hi == r, F.pmod((g - b) / d, F.lit(6))).when(hi == g, (b - r) / d + 2).otherwise((r - g) / d + 4)
    return {"h": hue * 60, "s": F.when(hi > 0, d / hi).otherwise(0.0), "value": hi / 255.0}


def soft_histogram(values: Column, bins: int = 256, bandwidth: float = 1.0) -> Column:
    """Shares of an array of values in 0..1 over evenly spaced bin centres; each value counts in every bin by a Gaussian
    of its distance. The array stays in its row, so nothing is exploded or shuffled."""
    total = lambda shares: F.aggregate(shares, F.lit(1e-10), lambda s, v: s + v)

    def near(vs: Column, at: Column) -> Column:
        return F.aggregate(vs, F.lit(0.0), lambda s, v: s + F.exp((v - at) * (v - at) / (-2.0 * bandwidth**2))) / F.size(vs)

    means = let(values, lambda vs: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda k: near(vs, k / (bins - 1))))
    return let(means, lambda shares: let(total(shares), lambda t: F.transform(shares, lambda v: v / t)))


def jet(v: Column) -> dict[str, Column]:
    """The rainbow map of a value in 0..1, blue to red: each channel a tent about its own quarter."""
    tent = lambda at: F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.5 - F.abs(4 * v - at)))
    return {"r": tent(3), "g": tent(2), "b": tent(1)}


def stretched(pixels: DataFrame, value: str = "v") -> DataFrame:
    """Each image's values over 0..1, from its least to its greatest; a flat image becomes 0."""
    w = Window.partitionBy("image_id")
    low, high = F.min(value).over(w), F.max(value).over(w)
    return pixels.withColumn(value, F.when(high > low, (c(value) - low) / (high - low)).otherwise(0.0))


def heat_overlay(pixels: DataFrame, heat: str) -> DataFrame:
    """pixels(v, heat): 0.6 of the image and 0.4 of its rainbow-coloured heat, low heat red; one column a channel."""
    shade = 255 - F.floor((c("_h") * 0.95 + 0.05) * 255)
    rows = stretched(pixels.withColumn("_h", c(heat).cast("double")), "_h")
    return rows.select(*PIXEL, *[(0.6 * c("v") + 0.4 * 255 * v).alias(k) for k, v in jet(shade / 255).items()])


def soft_edge(keep: DataFrame, size: int, sigma: float, width: int, height: int) -> DataFrame:
    """Weights of a 0/1 relation (image_id, y, x, v), blurred and divided by the image's greatest; 0 where that is 0."""
    w = F.max("v").over(Window.partitionBy("image_id"))
    return blur(keep, size, sigma, width, height).withColumn("v", F.when(w > 0, c("v") / w).otherwise(0.0))


def weighted_blend(plain: DataFrame, matched: DataFrame, weights: DataFrame) -> DataFrame:
    """The matched image where the weight is 1, the plain one where it is 0."""
    return weighted_pair(plain.join(matched.withColumnRenamed("v", "_m"), list(PIXEL)), weights, "v", "_m")


def weighted_pair(both: DataFrame, weights: DataFrame, plain: str, matched: str) -> DataFrame:
    """``weighted_blend`` of a relation that has both images' values in a row."""
    rows = both.join(weights.select(*PIXEL, c("v").alias("_w")), list(PIXEL))
    return rows.select(*PIXEL, blend(c(plain), c(matched), c("_w")).alias("v"))


def cdf(pixels: DataFrame) -> DataFrame:
    """Per image and value: share of pixels at or below it."""
    h = pixels.groupBy("image_id", "v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("image_id")
    up = w.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return h.select("image_id", "v", (F.sum("n").over(up) / F.sum("n").over(w)).alias("q"), F.round(F.sum("n").over(up) / F.sum("n").over(w), 9).alias("qr"))


def histogram_match(source: DataFrame, reference: DataFrame) -> DataFrame:
    """Each source value becomes the reference value at its own cumulative share, linear between the shares of neighbouring reference values, the least one below
    the first. The quantile functions of an image are merged by one sort, so no value is paired with all others."""
    s = cdf(source).select("image_id", "q", F.lit(1).alias("side"), c("v").alias("sv"), F.lit(None).cast("struct<q: double, v: double>").alias("r"))
    r = cdf(reference).select("image_id", "q", F.lit(0).alias("side"), F.lit(None).cast("long").alias("sv"), F.struct("q", c("v").cast("double").alias("v")).alias("r"))
    # at equal shares the reference comes first from both ends, so it is on both sides
    up = Window.partitionBy("image_id").orderBy("q", "side").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("image_id").orderBy(c("q").desc(), "side").rowsBetween(Window.unboundedPreceding, 0)
    below, above = F.last("r", ignorenulls=True).over(up), F.last("r", ignorenulls=True).over(down)
    merged = s.unionByName(r).withColumn("a", below).withColumn("b", above).filter("side = 1")
    step = c("a")["v"] + (c("b")["v"] - c("a")["v"]) * (c("q") - c("a")["q"]) / (c("b")["q"] - c("a")["q"])
    mapped = F.when(c("a").isNull(), c("b")["v"]).when(c("b").isNull() | (c("b")["q"] == c("a")["q"]), c("a")["v"]).otherwise(step)
    return source.join(merged.select("image_id", c("sv").alias("v"), mapped.alias("mapped")), ["image_id", "v"]).select(*PIXEL, c("mapped").alias("v"))


def cdf_distance(pairs: DataFrame, p: int) -> DataFrame:
    """Distance of the cumulative distributions of two normalised signals a, b in pixel order: p = 1 is Wasserstein-1."""
    order = Window.partitionBy("image_id").orderBy("y", "x").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("image_id")
    share = lambda n: F.sum(n).over(order) / (F.sum(n).over(whole) + 1e-14)
    d = pairs.withColumn("d", F.abs(share("a") - share("b")))
    total = F.sum(F.pow("d", F.lit(p)))
    return d.groupBy("image_id").agg((total if p == 1 else F.pow(total, F.lit(1.0 / p))).alias("distance"))


def flip(pixels: DataFrame, width: int) -> DataFrame:
    return pixels.withColumn("x", width - 1 - c("x"))


def side_by_side(left: DataFrame, right: DataFrame, width: int) -> DataFrame:
    return left.select(*PIXEL, "v").unionByName(right.select("image_id", "y", (c("x") + width).alias("x"), "v"))


