"""Arrow functions over lists: by brute force, with nulls and lists of other lengths, and what a row costs."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from veilframe.functions import relations as R
from veilframe.operators import keypoints as K
from veilframe.operators import lists as L
from veilframe.operators import masks as M
from veilframe.plans import catalog

KPS = [[{"x": 3, "y": 4, "v": 1}, {"x": 12, "y": 4, "v": 2}, {"x": None, "y": 1, "v": 1}, None], [], None, [{"x": 9, "y": 9, "v": 0}, {"x": 5, "y": 5, "v": None}]]
POINT = "array<struct<x: bigint, y: bigint, v: bigint>>"
#: Queries whose joints were taken one by one by lambdas, which Spark interprets.
NO_LAMBDA = ("p02_keypoints_to_box", "p05_drop_unseen", "p06_mirror", "p08_joint_map", "p09_oks", "a12_mean_oks")


@pytest.mark.parametrize("name", NO_LAMBDA)
def test_no_joint_is_interpreted(spark, name):
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("ArrowEvalPython") == 1


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, k, 2, 3, 12, 13) for i, k in enumerate(KPS)], f"id long, kps {POINT}, x0 long, y0 long, x1 long, y1 long")


def test_operators_on_odd_lists(rows):
    got = rows.select("id", K.to_box(F.col("kps")).alias("b"), K.any_visible(F.col("kps")).alias("a"), K.mirror(F.col("kps"), ("nose", "left_eye", "right_eye")).alias("m")).orderBy("id").collect()
    assert [tuple(p) for p in got[0].b] == [(0.1, 0.1, True), (1.0, 0.1, True), (None, -0.2, False), (None, None, None)]
    assert got[1].b == [] and got[2].b is None
    assert [g.a for g in got] == [True, False, None, None]
    assert [tuple(p) for p in got[0].m] == [(-2.0, 4.0, 1), (None, 1.0, 1), (-11.0, 4.0, 2)]
    assert [tuple(p) for p in got[3].m] == [(-8.0, 9.0, 0), (None, None, None), (-4.0, 5.0, None)]
    assert [tuple(p) for p in got[2].m] == [(None, None, None)] * 3


def test_oks_on_odd_lists(rows):
    moved = F.transform("kps", lambda p: F.struct((p["x"] + 3).alias("x"), (p["y"] - 1).alias("y"), p["v"].alias("v")))
    got = rows.select("id", K.oks(moved, F.col("kps"), F.lit(100.0)).alias("all"), K.oks(F.slice(moved, 1, 1), F.col("kps"), F.lit(100.0)).alias("one")).orderBy("id").collect()
    terms = [math.exp(-10 / (2 * (2 * s / 10) ** 2 * 100)) for s in K.OKS_SIGMAS[:2]]
    assert got[0]["all"] == pytest.approx(sum(terms) / 2) and got[0]["one"] == pytest.approx(terms[0])
    assert [g["all"] for g in got[1:]] == [None] * 3


def test_joint_maps_line_by_line():
    rng = np.random.default_rng(5)
    for size in (7, 16):
        kps = [None, *([{"x": float(x), "y": float(y), "v": bool(v)} for x, y, v in zip(rng.uniform(-0.2, 1.2, 17), rng.uniform(-0.2, 1.2, 17), rng.random(17) < 0.8)] for _ in range(40))]
        got = K.joint_maps(pa.array(kps), size).to_pylist()
        assert got[0] is None
        for points, found in zip(kps[1:], got[1:], strict=True):
            grid = np.zeros((size, size), np.uint8)
            for part, limbs in enumerate(K.LIMBS):
                for p, q in ((points[a], points[b]) for a, b in limbs):
                    if p["v"] and q["v"]:
                        for x, y in K.line_cells(*[int(v * (size - 1)) for v in (p["x"], p["y"], q["x"], q["y"])]):
                            if 0 <= x < size and 0 <= y < size:
                                grid[y, x] = part + 1
            assert found == grid.tobytes()


def test_slices_cover_all_rows():
    for n, each in ((0, 5), (7, 3), (10, 100)):
        got = list(L.slices(n, each, 10))
        assert [i for a, b in got for i in range(a, b)] == list(range(n)) and all((b - a) * each <= max(10, each) for a, b in got)


def test_keypoints_are_those_of_the_relation(spark, duck):
    sql = R.with_relations("SELECT image_id, det_id, list({'x': px, 'y': py, 'v': v} ORDER BY k) AS kps FROM kps GROUP BY image_id, det_id ORDER BY image_id, det_id LIMIT 500")
    got = R.keypoints(spark, SMALL).orderBy("image_id", "det_id").limit(500).select("image_id", "det_id", "kps").collect()
    assert [(r.image_id, r.det_id, [p.asDict() for p in r.kps]) for r in got] == duck.execute(sql).fetchall()


def test_polygons_of_a_batch():
    rng = np.random.default_rng(3)
    whole = [[(int(x), int(y)) for x, y in rng.integers(-4, 24, (n, 2))] for n in rng.integers(1, 8, 60)]
    slanted = [[(float(x), float(y)) for x, y in rng.uniform(-4, 24, (n, 2))] for n in rng.integers(1, 8, 60)]
    for polygons in (whole, slanted):
        got = M.polygon_masks(pa.array([None, [], *([{"x": x, "y": y} for x, y in p] for p in polygons)]), 16, 12)
        assert not got[:2].any()
        for p, mask in zip(polygons, got[2:], strict=True):
            assert (mask == M.fill_polygons([p], 16, 12)).all()


def test_polygon_query_takes_one_pass(spark):
    plan = catalog.QUERIES["m04_polygon_fill"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert M.packed_polygons(pa.array([None, [{"x": 1, "y": 1}]]), 4, 2).to_pylist() == [None, bytes([0b00000100])]


def test_polygon_numbers_are_split_once(spark):
    from veilframe.sources import scan

    lines = [("1 2 3 4  5 6##text 1 2",), ("7,8, 9,10##x",), ("11 12",), (None,)]
    rows = spark.createDataFrame(lines, "line string").select(scan.parse_polygon(F.col("line")).alias("p"))
    assert [None if r.p is None else [tuple(q) for q in r.p] for r in rows.collect()] == [[(1, 2), (3, 4), (5, 6)], [(7, 8), (9, 10)], [(11, 12)], None]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_filters_join_no_pixels(spark):
    """Against the mirrored image, with a pixel missing; wide filters meet a source more than once."""
    from veilframe.operators import pixels as X

    rng, size, weights = np.random.default_rng(8), 5, X.gaussian(11, 4)
    image = {(y, x): float(rng.integers(0, 256)) for y in range(4) for x in range(size) if (y, x) != (2, 3)}
    rows = spark.createDataFrame([(1, y, x, v) for (y, x), v in image.items()], "image_id long, y long, x long, v double")
    out = X.convolve_axis(rows, "x", weights, size)
    fold = [min(i % 8, 8 - i % 8) for i in range(-5, size + 5)]
    expected = {(y, x): sum(w * image.get((y, fold[x + k]), 0.0) for k, w in enumerate(weights)) for y, x in image}
    assert {(r.y, r.x): r.v for r in out.collect()} == pytest.approx(expected)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    blended = catalog.QUERIES["x18_weighted_blend"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert blended.count("Join Inner") == 3  # images by pairs twice, pixels with weights once
