"""Wide moments, k-means, nearest entries, order statistics with ties and pooled similarity, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from veilframe.functions import relations
from veilframe.operators import matching, metrics
from veilframe.plans import catalog


def vectors(spark, x, extra=()):
    rows = [(k, k % 2, [float(v) for v in row]) for k, row in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, part int, vec array<double>")


@pytest.mark.parametrize(("n", "dim", "tasks"), [(50, 7, 1), (400, 16, 150), (60, 2048, 3)])
def test_moments_equal_numpy(spark, n, dim, tasks):
    x = np.random.default_rng(n).normal(size=(n, dim)) + 1000.0  # a large mean: raw sums would lose digits
    frame = vectors(spark, x, [(-1, None, [0.0] * dim), (-2, 1, None)]).repartition(tasks)
    rows = metrics.gram_rows(frame, "part").collect()
    for part in (0, 1):
        mine = sorted((r for r in rows if r.part == part), key=lambda r: r.i)
        assert {r.n for r in mine} == {len(x[part::2])}
        assert np.allclose(mine[0].mean, x[part::2].mean(0), rtol=1e-12)
        assert np.allclose(np.array([r.m2 for r in mine]) / (mine[0].n - 1), np.cov(x[part::2].T), rtol=1e-8, atol=1e-10)


def slow_frechet(x, y):
    """Through the eigenvalues of the product itself, which is neither symmetric nor taken apart."""
    a, b = np.cov(x.T), np.cov(y.T)
    return ((x.mean(0) - y.mean(0)) ** 2).sum() + np.trace(a) + np.trace(b) - 2 * np.sqrt(np.clip(np.linalg.eigvals(a @ b).real, 0, None)).sum()


def test_frechet_equals_numpy(spark):
    x = np.array([r.vec for r in relations.features(spark, SMALL).orderBy("vec_id").collect()])
    ids = np.array([r.vec_id for r in relations.features(spark, SMALL).orderBy("vec_id").collect()])
    got = catalog.QUERIES["a08_frechet_groups"](spark, SMALL).first().distance
    assert x.shape[1] == 64
    assert got == pytest.approx(slow_frechet(x[ids % 2 == 0], x[ids % 2 == 1]), abs=1e-5)


def test_frechet_of_rotated_diagonals(spark):
    """Covariances that share a rotated basis: the roots are those of the diagonals."""
    rng = np.random.default_rng(3)
    turn, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    base = rng.normal(size=(300, 12))
    base = (base - base.mean(0)) @ np.linalg.inv(np.linalg.cholesky(np.cov(base.T))).T  # covariance one
    s, t = rng.uniform(0.5, 2, 12), rng.uniform(0.5, 2, 12)
    frame = vectors(spark, np.stack([base * s @ turn, base * t @ turn + 0.5], 1).reshape(-1, 12))
    assert metrics.frechet_distance(frame, "part", 0, 1) == pytest.approx(12 * 0.25 + ((s - t) ** 2).sum(), rel=1e-9)


def slow_lloyd(x, centres, tol):
    while True:
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
        done = ((new - centres) ** 2).sum() <= tol * x.var(0).mean()
        cost = ((x - centres[near]) ** 2).sum()
        centres = new
        if done:
            return centres, cost


def test_k_means_equals_slow_version(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(80, 6)) * 0.2 + 5 * rng.normal(size=6) for _ in range(9)])
    frame = vectors(spark, x).repartition(5)
    seeds = metrics.seed_centres(frame, 9)
    assert len(seeds) == 9
    assert np.array_equal(seeds, metrics.seed_centres(frame.repartition(2), 9))
    far = np.vstack([seeds, np.full((1, 6), 1e6)])  # no vector is next to it: it stays
    for start in (seeds, far):
        centres, n, cost, rounds = metrics.k_means(frame, centres=start)
        want, least = slow_lloyd(x, start, 1e-5)
        assert np.allclose(centres, want, atol=1e-9)
        assert cost == pytest.approx(least, rel=1e-9)
        assert n.sum() == len(x)
        assert rounds < 100
    assert (centres[9] == 1e6).all()


def test_k_means_of_512_centres(spark):
    x = np.random.default_rng(5).normal(size=(3000, 8))
    centres, n, cost, _ = metrics.k_means(vectors(spark, x), 512, limit=30)
    assert centres.shape == (512, 8)
    assert n.sum() == 3000
    assert cost < 0.3 * ((x - x.mean(0)) ** 2).sum()


def test_k_means_stores_vectors_once(spark, monkeypatch):
    """The given table is read by one pass, whatever rounds follow; those read bytes, which are gone afterwards; spread is that of all vectors."""
    from veilframe.functions import storage

    x = np.random.default_rng(8).normal(size=(700, 5)) * 3 + 1e3
    frame = vectors(spark, x).repartition(6)
    read, plain = [], metrics.centre_sums
    monkeypatch.setattr(metrics, "centre_sums", lambda rows, centres: (read.append(rows.columns), plain(rows, centres))[1])
    before = storage.marked()
    *_, rounds = metrics.k_means(frame, 7)
    assert len(read) > rounds
    assert all("vec" not in names for names in read)
    assert storage.marked() == before
    kept = metrics.stored_vectors(frame)
    assert metrics.mean_variance(kept.df) == pytest.approx(x.var(0).mean(), rel=1e-12)
    (total, n, cost), want = plain(kept.df, x[:7]), plain(frame, x[:7])
    assert np.allclose(total, want[0], rtol=1e-12)
    assert np.array_equal(n, want[1])
    assert cost == pytest.approx(want[2], rel=1e-12)
    kept.drop()


def test_fewer_different_vectors_than_centres(spark):
    frame = vectors(spark, np.repeat(np.eye(3), 4, 0))
    centres, n, cost, _ = metrics.k_means(frame, 8)
    assert (len(centres), cost, n.sum()) == (3, 0.0, 12)


def test_nearest_of_27000_entries(spark):
    rng = np.random.default_rng(4)
    table = rng.integers(-3, 4, (27_000, 8)).astype(float)  # many entries are equal: ties go to the smallest
    x = np.concatenate([rng.integers(-3, 4, (60, 8)).astype(float), rng.normal(size=(60, 8))])
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(999, None)], "id long, vec array<double>")
    entries = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(table)], "entry long, ref array<double>")
    got = {r.id: (r.entry, r.distance) for r in matching.nearest_rows(frame, entries).collect()}
    d = np.round(((x[:, None] - table[None]) ** 2).sum(2), 9)
    assert got == {k: (int(d[k].argmin()), pytest.approx(d[k].min(), abs=1e-9)) for k in range(len(x))}
    with pytest.raises(ValueError, match="bytes"):
        matching.nearest_rows(frame, entries, max_bytes=1000)
    assert matching.nearest_rows(frame, entries.limit(0)).count() == 0


@pytest.mark.parametrize("values", [[3.0] * 95 + [1.0, 2.0, 4.0, 5.0, 6.0], [1.0], list(range(100)), [2.0, 2.0, 9.0]])
def test_trimmed_with_ties(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(4)
    got = metrics.trimmed(frame, "v", 0.02, 0.97).first()
    s = np.sort(np.array(values, float))
    lo, hi = s[int(np.floor(0.02 * (len(s) - 1)))], s[int(np.ceil(0.97 * (len(s) - 1)))]
    kept = s[(s >= lo) & (s <= hi)]
    assert (got["n"], got["mean"], got["std"]) == (len(kept), pytest.approx(kept.mean()), pytest.approx(kept.std(), abs=1e-12))


def test_trimmed_of_nothing(spark):
    assert metrics.trimmed(spark.createDataFrame([], "v double"), "v", 0.1, 0.9).first().n == 0


def slow_ssim(a, b, size=11, sigma=1.5):
    f = max(1, round(min(a.shape) / 256))
    pool = lambda v: v[: v.shape[0] // f * f, : v.shape[1] // f * f].reshape(v.shape[0] // f, f, v.shape[1] // f, f).mean((1, 3))
    a, b = pool(a.astype(float)), pool(b.astype(float))
    g = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    g /= g.sum()

    def blur(v):
        rows = sum(w * v[:, k : v.shape[1] - size + 1 + k] for k, w in enumerate(g))
        return sum(w * rows[k : rows.shape[0] - size + 1 + k] for k, w in enumerate(g))

    ma, mb = blur(a), blur(b)
    va, vb, cov = blur(a * a) - ma**2, blur(b * b) - mb**2, blur(a * b) - ma * mb
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    return ((2 * ma * mb + c1) / (ma**2 + mb**2 + c1) * (2 * cov + c2) / (va + vb + c2)).mean()


@pytest.mark.parametrize(("height", "width"), [(24, 30), (385, 390), (391, 401)])
def test_ssim_pools_large_images(spark, height, width):
    rng = np.random.default_rng(width)
    a = rng.integers(0, 256, (height, width))
    b = np.clip(a + rng.integers(-40, 40, a.shape), 0, 255)
    ys, xs = np.mgrid[0:height, 0:width]
    import pandas as pd

    frame = spark.createDataFrame(pd.DataFrame({"image_id": 1, "y": ys.ravel(), "x": xs.ravel(), "a": a.ravel(), "b": b.ravel()}))
    got = metrics.ssim(frame, width=width, height=height).first().ssim
    assert got == pytest.approx(slow_ssim(a, b), abs=1e-9)
    assert metrics.pooling(height, width) == (1 if height < 384 else 2)
