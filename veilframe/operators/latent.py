"""Latent vectors and identities of tracks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def lerp(a: Column, b: Column, t) -> Column:
    return F.zip_with(a, b, lambda x, y: x + (y - x) * t)


def truncate(w: Column, centre: Column, t: Column) -> Column:
    """From the centre towards w by t, clamped to 0..1."""
    return lerp(centre, w, F.least(F.lit(1.0), F.greatest(F.lit(0.0), t)))


def multi_modal(rows: DataFrame, centres: DataFrame, n_centres: int, t: float) -> DataFrame:
    """rows(z_idx, w), centres(centre, vec): truncation towards centre z_idx mod n."""
    return rows.withColumn("centre", F.pmod("z_idx", F.lit(n_centres))).join(centres, "centre").withColumn("w", truncate(c("w"), c("vec"), F.lit(t))).drop("vec")


def slerp(a: Column, b: Column, t) -> Column:
    """Along the great circle between two directions."""
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    na, nb = norm(a), norm(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: (x / na) * (y / nb)), F.lit(0.0), lambda s, v: s + v)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    p, q = F.sin((1 - t) * angle) / F.sin(angle), F.sin(t * angle) / F.sin(angle)
    return F.zip_with(a, b, lambda x, y: p * (x / na) + q * (y / nb))


def track_seed(*keys: Column) -> Column:
    """The same number for the same (video, track), whichever task computes it."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 31))


def normals(dim: int, truncation: float | None = None):
    """Arrow function: seed -> dim standard normals of that seed; with a truncation level, values beyond it are
    drawn again, and after ten rounds uniformly."""

    @F.pandas_udf("array<double>")
    def draw(seed: pd.Series) -> pd.Series:
        out = []
        for s in seed:
            rng = np.random.RandomState(int(s) % (1 << 32))
            z = rng.normal(size=dim)
            if truncation is not None:
                for _ in range(10):
                    far = np.abs(z) >= truncation
                    if not far.any():
                        break
                    z[far] = rng.normal(size=int(far.sum()))
                far = np.abs(z) >= truncation
                z[far] = rng.uniform(-truncation, truncation, int(far.sum()))
            out.append(z.tolist())
        return pd.Series(out)

    return draw


def frame_index(frames: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The running number of each frame of a clip, from 1."""
    return frames.withColumn("frame_no", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))


def guide(unconditional: Column, conditional: Column, scale: float) -> Column:
    return F.zip_with(unconditional, conditional, lambda u, v: (1 - scale) * u + scale * v)


def nullify(state: Column, null: Column, degree: float) -> Column:
    """Blend towards the empty state by the degree of anonymisation."""
    return F.zip_with(state, null, lambda s, n: (1 - degree) * s + degree * n)


def add_direction(styles: Column, direction: Column, strength: float) -> Column:
    return F.zip_with(styles, direction, lambda s, d: s + d * strength)


def reuse_detections(images: DataFrame, cache: DataFrame) -> DataFrame:
    """images(image_id, data), cache(digest, ...): adds the digest and whether a cached detection exists."""
    keyed = images.withColumn("digest", F.md5("data"))
    return keyed.join(cache.select("digest", F.lit(True).alias("cached")).distinct(), "digest", "left").withColumn("cached", F.coalesce("cached", F.lit(False)))
