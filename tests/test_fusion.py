"""Run-length masks and fusion within an image, against pixels and against the column expressions."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilframe.operators import fusion, geometry, kernels, matching
from veilframe.operators import runs as R
from veilframe.operators.fusion import Fusion
from veilframe.plans import anonymize

W, H = 40, 30


def random_mask(rng, h=H, w=W):
    """Some rectangles, some dots, sometimes nothing."""
    out = np.zeros((h, w), bool)
    for _ in range(rng.integers(0, 4)):
        y, x = rng.integers(0, h), rng.integers(0, w)
        out[y : y + rng.integers(1, h), x : x + rng.integers(1, w)] = True
    return out ^ (rng.random((h, w)) < 0.03 * rng.integers(0, 2))


def tight_of(mask):
    ys, xs = np.nonzero(mask)
    return (int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1) if len(ys) else (0, 0, mask.shape[1], mask.shape[0])


def padded_cut(mask, box):
    x0, y0, x1, y1 = box
    big = np.pad(mask, ((200, 200), (200, 200)))
    return big[y0 + 200 : y1 + 200, x0 + 200 : x1 + 200]


def slow_dilated_crop(mask, box, size, share):
    """The crop's mask as it is described: cut, scaled by nearest neighbours, dilated pixel by pixel, cleared where the crop leaves the image."""
    cut = padded_cut(mask, box)
    small = np.array([[cut[t * cut.shape[0] // size[0], u * cut.shape[1] // size[1]] for u in range(size[1])] for t in range(size[0])])
    r = int((size[0] * size[1]) ** 0.5 * share)
    out = np.zeros_like(small)
    for y, x in zip(*np.nonzero(small), strict=True):
        for dy in range(-r, r + 1):
            for dx in range(-r, r + 1):
                if dy * dy + dx * dx <= r * r and 0 <= y + dy < size[0] and 0 <= x + dx < size[1]:
                    out[y + dy, x + dx] = True
    x0, y0, x1, y1 = box
    ratio = size[0] / (y1 - y0)
    left, top, right, low = (int(np.floor(max(0, v) * ratio)) for v in (-x0, -y0, x1 - mask.shape[1], y1 - mask.shape[0]))
    out[:top], out[:, :left], out[max(0, size[0] - low) :], out[:, max(0, size[1] - right) :] = False, False, False, False
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_pixels(seed):
    rng = np.random.default_rng(seed)
    a, b = random_mask(rng), random_mask(rng)
    ra, rb = R.from_array(a, 0, 0, W, H), R.from_array(b, 0, 0, W, H)
    assert (R.to_array(ra, (0, 0, W, H), W) == a).all()
    assert (R.to_array(ra, (-3, -2, W + 5, 9), W) == padded_cut(a, (-3, -2, W + 5, 9))).all()
    assert R.area(ra) == a.sum()
    assert R.intersection(ra, rb) == (a & b).sum()
    assert R.iou(ra, rb) == ((a & b).sum() / (a | b).sum() if (a | b).any() else 0)
    assert R.union(ra, rb).tolist() == R.from_array(a | b, 0, 0, W, H).tolist()
    assert R.tight(ra, W, H) == tight_of(a)
    x, y = int(rng.integers(-9, 9)), int(rng.integers(-9, 9))
    moved = np.zeros((H, W), bool)
    moved[max(0, y) : H + y, max(0, x) : W + x] = a[max(0, -y) : H - y, max(0, -x) : W - x]
    assert R.from_array(a, x, y, W, H).tolist() == R.from_array(moved, 0, 0, W, H).tolist()
    box = (5, 3, 25, 20)
    bits = np.packbits(a[3:20, 5:25]).tobytes()
    inside = np.zeros((H, W), bool)
    inside[3:20, 5:25] = a[3:20, 5:25]
    assert R.from_bits(bits, box, W, H).tolist() == R.from_array(inside, 0, 0, W, H).tolist()
    whole = np.zeros((H, W), bool)
    whole[3:20, 5:25] = True
    assert R.from_box(box, W, H).tolist() == R.from_array(whole, 0, 0, W, H).tolist()


@pytest.mark.parametrize("seed", range(25))
def test_dilated_boxes_equal_pixels(seed):
    rng = np.random.default_rng(100 + seed)
    mask = random_mask(rng)
    x0, y0 = int(rng.integers(-12, 20)), int(rng.integers(-12, 15))
    box, size, share = (x0, y0, x0 + int(rng.integers(5, 45)), y0 + int(rng.integers(5, 40))), (36, 20), 0.12
    crop = slow_dilated_crop(mask, box, size, share)
    runs = R.from_array(mask, 0, 0, W, H)
    if crop.any():
        w, h = box[2] - box[0], box[3] - box[1]
        a, b, c, d = tight_of(crop)
        assert R.dilated_box(runs, box, W, H, size, share) == (box[0] + a * w // size[1], box[1] + b * h // size[0], box[0] + c * w // size[1], box[1] + d * h // size[0])
    back = R.nearest(crop, (box[3] - box[1], box[2] - box[0]))
    assert R.dilated(runs, box, W, H, size, share).tolist() == R.from_array(back, box[0], box[1], W, H).tolist()


def test_expansions_equal_the_column_expressions(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        w, h = int(rng.integers(20, 700)), int(rng.integers(20, 500))
        x0, y0 = int(rng.integers(0, w - 4)), int(rng.integers(0, h - 4))
        x1, y1 = int(rng.integers(x0 + 1, w + 1)), int(rng.integers(y0 + 1, h + 1))
        rows.append((i, x0, y0, x1, y1, w, h, int(rng.integers(0, (x1 - x0) * (y1 - y0) + 1))))
    frame = spark.createDataFrame(rows, "i long, x0 long, y0 long, x1 long, y1 long, w long, h long, area long")
    grown = geometry.expanded_box(frame, F.col("area"), width=F.col("w"), height=F.col("h")).withColumn("kept", geometry.include_box(F.col("w"), F.col("h")))
    o = Fusion()
    for r in grown.collect():
        _, x0, y0, x1, y1, w, h, area = rows[r.i]
        box = fusion.expanded((x0, y0, x1, y1), area, w, h, o)
        assert (r.x0, r.y0, r.x1, r.y1) == box
        assert r.kept == fusion.included(box, w, h, o)
    simple = frame.select("i", *[v.alias(k) for k, v in geometry.expand_simple(0.4).items()])
    assert all((r.sx0, r.sy0, r.sx1, r.sy1) == fusion.simple_square(rows[r.i][1:5], 0.4) for r in simple.collect())


def image_of(spark, pixels, image_id=1):
    return spark.createDataFrame([(image_id, *pixels.shape, bytearray(pixels.tobytes()))], anonymize.IMAGE_SCHEMA)


def face_beside_mask(image):
    """A person whose mask is the left of its box, and a face in the box that the mask doesn't touch."""
    mask = np.zeros((36, 36), bool)
    mask[:, :15] = True
    return [anonymize.Found("person", 0.9, 10, 10, 46, 46, mask), anonymize.Found("face", 0.9, 30, 15, 40, 25)]


def test_face_beside_the_mask_is_redacted(spark):
    pixels = np.full((60, 70, 3), 200, np.uint8)
    out = anonymize.anonymise(image_of(spark, pixels), face_beside_mask, kernels.mask_out).first()
    new = np.frombuffer(bytes(out.data), np.uint8).reshape(pixels.shape)
    assert out.status == "ok"
    assert (new[15:25, 30:40] != 200).all()
    assert (new[10:46, 10:25] != 200).all()
    assert (new[50:, 60:] == 200).all()


def ell_with_face(image):
    """A face in the inner corner of a mask like an L: inside the mask's tight box, but not covered."""
    mask = np.zeros((40, 40), bool)
    mask[:, :8] = mask[32:] = True
    return [anonymize.Found("person", 0.9, 10, 10, 50, 50, mask), anonymize.Found("face", 0.9, 25, 15, 35, 25), anonymize.Found("face", 0.8, 12, 20, 16, 26)]


@pytest.mark.parametrize("published", [False, True])
def test_only_covered_faces_go(spark, published):
    """As published, a face goes for lying in the box; by default only one that pasted masks cover."""
    pixels = np.full((70, 80, 3), 200, np.uint8)
    found = anonymize.outcomes(image_of(spark, pixels), ell_with_face)
    kinds = sorted(r.det_id for r in anonymize.fuse_rows(found, Fusion(minimum_area=1, published=published)).select(F.inline("regions")).collect() if r.kind == "face")
    assert kinds == ([] if published else [2])
    out = anonymize.anonymise(image_of(spark, pixels), ell_with_face, kernels.mask_out, o=Fusion(minimum_area=1, published=published)).first()
    face = np.frombuffer(bytes(out.data), np.uint8).reshape(pixels.shape)[15:25, 25:35]
    assert (face == 200).all() if published else (face != 200).all()


def two_models(image):
    """Two persons, of which the dense model sees one a little shifted, and a third that it alone sees."""
    full = np.ones((20, 10), bool)
    return [
        anonymize.Found("person", 0.9, 5, 5, 15, 25, full), anonymize.Found("person", 0.8, 40, 5, 50, 25, full),
        anonymize.Found("person_cse", 0.7, 6, 6, 16, 26, full), anonymize.Found("person_cse", 0.6, 60, 30, 70, 50, full), anonymize.Found("person", 0.1, 0, 0, 70, 55),
    ]


def test_persons_match_and_merge(spark):
    found = anonymize.outcomes(image_of(spark, np.zeros((60, 80, 3), np.uint8)), two_models)
    see = lambda o: {(r.det_id, r.kind, r.own_x0, r.own_y0, r.own_x1, r.own_y1, r.mask_area) for r in anonymize.fuse_rows(found, o).select(F.inline("regions")).collect()}
    published = {(3, "person_cse", 5, 5, 16, 26, 200 + 200 - 9 * 19), (2, "person", 40, 5, 50, 25, 200)}
    assert see(Fusion(minimum_area=1, published=True)) == published
    assert see(Fusion(minimum_area=1)) == published | {(4, "person_cse", 60, 30, 70, 50, 200)}


def test_table_and_row_forms_agree(spark):
    """Detections from a table, gathered by image, fuse as those in the row of their image; ids may be texts."""
    pixels = np.zeros((60, 80, 3), np.uint8)
    schema = anonymize.IMAGE_SCHEMA.replace("image_id long", "image_id string")
    images = spark.createDataFrame([(name, *pixels.shape, bytearray(pixels.tobytes())) for name in ("a/1.png", "a/2.png")], schema)
    for detector in (two_models, ell_with_face):
        found = anonymize.outcomes(images, detector)
        rows = anonymize.fuse_rows(found, Fusion(minimum_area=1)).select("image_id", F.inline("regions"))
        table = anonymize.fuse(anonymize.detections_of(found), Fusion(minimum_area=1), F.col("width"), F.col("height"))
        assert sorted(map(str, rows.collect())) == sorted(map(str, table.collect()))
        assert {r.image_id for r in table.collect()} == {"a/1.png", "a/2.png"}
        together = anonymize.redact(images, table, found.select("image_id", "error"), kernels.mask_out)
        alone = anonymize.anonymise(images, detector, kernels.mask_out, o=Fusion(minimum_area=1))
        assert {(r.image_id, bytes(r.data), r.status) for r in together.collect()} == {(r.image_id, bytes(r.data), r.status) for r in alone.collect()}


def test_image_bytes_are_not_shuffled(spark):
    plan = anonymize.anonymise(image_of(spark, np.zeros((8, 8, 3), np.uint8)), face_beside_mask)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_greedy_keeps_ids_of_any_type(spark):
    pairs = spark.createDataFrame([("x.png", "a", "p"), ("x.png", "a", "q"), ("x.png", "b", "p"), ("x.png", "b", "q"), ("y.png", "a", "p")], "image_id string, det_id string, o_det_id string")
    got = {tuple(r) for r in matching.greedy(pairs, [F.col("det_id"), F.col("o_det_id")]).collect()}
    assert got == {("x.png", "a", "p"), ("x.png", "b", "q"), ("y.png", "a", "p")}


def test_odd_detections(spark):
    """Empty boxes go, unknown kinds are pasted by their box, empty masks reach the whole image rather than nothing."""
    found = [
        {"det_id": 1, "kind": "face", "score": 0.9, "x0": 5, "y0": 5, "x1": 5, "y1": 9}, {"det_id": 2, "kind": "plate", "score": 0.9, "x0": 3, "y0": 4, "x1": 9, "y1": 8},
        {"det_id": 3, "kind": "person", "score": 0.9, "x0": 3, "y0": 4, "x1": 9, "y1": 8, "runs": R.EMPTY},
    ]
    parts = {p.det_id: p for p in fusion.fuse(found, W, H, Fusion(minimum_area=1))}
    assert set(parts) == {2, 3}
    assert parts[2].box == (3, 4, 9, 8)
    assert R.area(parts[2].hole) == 24
    assert parts[3].box == (0, 0, W, H)
    assert fusion.fuse([], W, H, Fusion()) == []


def test_intersections_of_columns():
    """Row by row as the helper for one pair of masks; None is an empty mask."""
    rng = np.random.default_rng(3)
    masks = [sorted(rng.choice(500, 2 * int(n), replace=False).tolist()) for n in rng.integers(0, 9, 80)]
    a, b = masks[:40], masks[40:]
    got = R.intersections(pa.array([*a, None], pa.list_(pa.int64())), pa.array([*b, [0, 9]], pa.list_(pa.int64())))
    assert got.tolist() == [*(R.intersection(np.asarray(p, np.int64), np.asarray(q, np.int64)) for p, q in zip(a, b, strict=True)), 0]


def test_masks_are_made_after_the_join(spark):
    """No exchange or sort below the join holds runs; runs by the worker are those by the JVM."""
    from tests.conftest import SMALL
    from veilframe.functions import relations as D
    from veilframe.plans import catalog

    rows = D.masks(spark, SMALL).select("x0", "y0", "x1", "y1", "mask_area", D.mask_runs(*(F.col(n) for n in geometry.COORDS)).alias("runs")).toArrow()
    assert D.mask_rows(*(rows[n].combine_chunks() for n in geometry.COORDS)).to_pylist() == rows["runs"].to_pylist()
    assert [R.area(np.asarray(m)) for m in rows["runs"].to_pylist()] == rows["mask_area"].to_pylist()
    some = [[3, 5, 2], [1, 0, 4], [7, 5, 9], [4, 6, 4]]
    assert R.box_rows(*(pa.array(v) for v in some), W).to_pylist() == [[43, 47, 83, 87, 123, 127], [], []]
    for name in ("j05_match_in_order", "j07_near_misses", "j10_unmatched_persons", "m09_merged_runs"):
        plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Join"):] if name != "j10_unmatched_persons" else plan[plan.rindex("Join"):]
        assert "sequence" not in below and "both(" not in below


def test_boxes_need_one_exchange(spark):
    """Boxes lie by image; filters on coordinates stay above the place where those are computed."""
    from tests.conftest import SMALL
    from veilframe.functions import relations as D

    b = D.boxes(spark, SMALL)
    own = spark.sql(D.BOXES, lineitem=D.table(spark, SMALL, "lineitem"))
    assert b.schema == own.schema and b.exceptAll(own).count() == 0 == own.exceptAll(b).count()
    plan = b.filter("x1 - x0 > 40").groupBy("image_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert all("%" not in line for line in plan.splitlines() if "Filter" in line)


def test_masks_are_measured_together():
    """Against one mask at a time: empty masks, runs over several rows, boxes that leave the image."""
    rng = np.random.default_rng(4)
    masks, boxes, images = [], [], []
    for k in range(60):
        w, h = int(rng.integers(20, 40)), int(rng.integers(20, 40))
        x0, y0 = int(rng.integers(-5, 10)), int(rng.integers(-5, 10))
        box = x0, y0, x0 + int(rng.integers(4, 30)), y0 + int(rng.integers(4, 30))
        mask = R.EMPTY if k % 9 == 0 else R.from_array(rng.random((8, 9)) < (1.0 if k % 7 == 0 else 0.4), int(rng.integers(0, w - 9)), int(rng.integers(0, h - 8)), w, h)
        if k % 8 == 1:
            mask = np.array([3, 2 * w + 1])
        masks.append(mask), boxes.append(box), images.append((w, h))
    areas, tights = R.measures(masks, images)
    assert areas == [R.area(m) for m in masks] and tights == [R.tight(m, *i) for m, i in zip(masks, images, strict=True)]
    got = R.dilated_boxes(masks, boxes, images, (28, 16), 0.1)
    assert got == [R.dilated_box(m, b, *i, (28, 16), 0.1) for m, b, i in zip(masks, boxes, images, strict=True)]
    assert R.measures([R.EMPTY], [(4, 3)]) == ([0], [(0, 0, 4, 3)]) and R.dilated_boxes([R.EMPTY], [(0, 0, 2, 2)], [(4, 3)], (28, 16), 0.1) == [(0, 0, 2, 2)]


@pytest.mark.parametrize("name", ["plan_fused_regions", "plan_region_report"])
def test_fused_regions_make_masks_in_the_worker(spark, name):
    from tests.conftest import SMALL
    from veilframe.plans import catalog

    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "runs" not in plan and "lambda" not in plan
    assert "seed" not in plan and "keypoints" not in plan


def test_named_values_of_regions():
    """Only what is asked for is made, as in whole regions."""
    from veilframe.plans import anonymize

    found = [{"det_id": k, "kind": kind, "score": 0.9, "x0": 5 * k, "y0": 4, "x1": 5 * k + 30, "y1": 70, "runs": None} for k, kind in enumerate(("face", "vehicle", "person"))]
    whole = anonymize.regions_of(7, found, 640, 480, Fusion(), True)
    names = ("kind", "x1", "own_y0", "paste_order")
    assert len(whole) == 3
    assert anonymize.regions_of_all([(7, 480, 640, found)], Fusion(), True, names)[0] == [tuple(r[n] for n in names) for r in whole]
