"""Queries of the keypoint operators (P1-P19)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import geometry as G
from ..operators import keypoints as K
from ..operators import lists as L

c = F.col
ID = ("image_id", "det_id")


@query("p01_first_joints_inside", "SELECT image_id, det_id, bool_and(px >= x0 AND px <= x1 AND py >= y0 AND py <= y1) AS inside FROM kps WHERE k < 3 GROUP BY image_id, det_id")
def p01(spark, d):
    return R.keypoints(spark, d).select(*ID, K.first_inside(c("kps")).alias("inside"))


@query("p02_keypoints_to_box", """WITH q AS (SELECT *, (px - x0) / CAST(x1 - x0 AS DOUBLE) AS nx, (py - y0) / CAST(y1 - y0 AS DOUBLE) AS ny FROM kps)
SELECT image_id, det_id, round(sum(nx), 6) + 0.0 AS sum_x, round(sum(ny), 6) + 0.0 AS sum_y, count(*) FILTER (v > 0 AND nx >= 0 AND nx <= 1 AND ny >= 0 AND ny <= 1) AS n_visible FROM q GROUP BY image_id, det_id""")
def p02(spark, d):
    def summary(kps, det_id, *box):
        boxed = K.boxed(kps, *box)
        x, y, v = L.fields(boxed, "x", "y", "v")
        return pa.StructArray.from_arrays([L.totals(boxed, x), L.totals(boxed, y), pa.array(L.hits(boxed, v))], ["x", "y", "n"])

    k = R.boxes(spark, d).select(*ID, R.of_keypoints(summary, "struct<x: double, y: double, n: bigint>").alias("s"))
    total = lambda f: F.round(c("s")[f], 6) + 0.0
    return k.select(*ID, total("x").alias("sum_x"), total("y").alias("sum_y"), c("s")["n"].alias("n_visible"))


@query("p03_clamp_to_crop", """SELECT image_id, det_id, round(sum(least(1.0, greatest(0.0, (px - x0) / CAST(x1 - x0 AS DOUBLE)))), 6) AS sum_x,
 round(sum(least(1.0, greatest(0.0, (py - y0) / CAST(x1 - x0 AS DOUBLE)))), 6) AS sum_y, count(*) AS n_visible FROM kps GROUP BY image_id, det_id""")
def p03(spark, d):
    k = R.keypoints(spark, d).select(*ID, K.clamp_to_crop(c("kps")).alias("n"))
    total = lambda f: F.round(F.aggregate(F.transform("n", lambda p: p[f]), F.lit(0.0), lambda a, x: a + x), 6)
    return k.select(*ID, total("x").alias("sum_x"), total("y").alias("sum_y"), F.aggregate("n", F.lit(0).cast("long"), lambda a, p: a + p["v"]).alias("n_visible"))


@query("p04_visibility_threshold", "SELECT image_id, det_id, count(*) FILTER (v >= 1) AS at_least, count(*) FILTER (v > 1) AS above FROM kps GROUP BY image_id, det_id")
def p04(spark, d):
    n = lambda strict: F.size(F.filter(K.visible(c("kps"), 1, strict), lambda v: v)).cast("long")
    return R.keypoints(spark, d).select(*ID, n(False).alias("at_least"), n(True).alias("above"))


@query("p05_drop_unseen", "SELECT image_id, det_id FROM (SELECT image_id, det_id, max(CASE WHEN (k + det_id) % 17 < det_id % 3 THEN v ELSE 0 END) AS m FROM kps GROUP BY image_id, det_id) q WHERE m <> 0")
def p05(spark, d):
    def some(kps, det_id, *box):
        x, y, v = L.fields(kps, "x", "y", "v")
        det = np.asarray(det_id)[L.parents(kps)]
        return K.some_visible(L.relisted(kps, x=x, y=y, v=pc.if_else(pa.array((L.places(kps) + det) % 17 < det % 3), v, 0)))

    return R.boxes(spark, d).filter(R.of_keypoints(some, "boolean")).select(*ID)


FLIP = "[" + ", ".join(map(str, K.flip_map())) + "]"


@query("p06_mirror", f"""WITH q AS (SELECT image_id, det_id, k, (px - x0) / CAST(x1 - x0 AS DOUBLE) AS nx, v FROM kps), f AS (SELECT k AS target, {FLIP}[k + 1] AS k FROM (SELECT unnest(range(0, 17)) AS k) r)
SELECT image_id, det_id, round(sum((1 - nx) * (target + 1)), 6) AS weighted_x, CAST(sum(v * (target + 1)) AS BIGINT) AS weighted_v FROM q JOIN f USING (k) GROUP BY image_id, det_id""")
def p06(spark, d):
    def weighted(kps, det_id, *box):
        boxed = K.boxed(kps, *box)
        (x, y), (v,) = L.fields(boxed, "x", "y"), L.fields(kps, "v")
        m = K.mirrored(L.relisted(kps, x=x, y=y, v=v))
        times = pa.array(L.places(m) + 1.0)
        return pa.StructArray.from_arrays([L.totals(m, pc.multiply(f.cast("double"), times)) for f in L.fields(m, "x", "v")], ["x", "v"])

    m = R.boxes(spark, d).select(*ID, R.of_keypoints(weighted, "struct<x: double, v: double>").alias("w"))
    return m.select(*ID, F.round(c("w")["x"], 6).alias("weighted_x"), c("w")["v"].cast("long").alias("weighted_v"))


@query("p07_midpoints", """SELECT image_id, det_id, CASE WHEN min(CASE WHEN k IN (5, 6) THEN v END) > 0 THEN sum(CASE WHEN k IN (5, 6) THEN px END) / 2.0 END AS neck_x,
 CASE WHEN min(CASE WHEN k IN (5, 6) THEN v END) > 0 THEN sum(CASE WHEN k IN (5, 6) THEN py END) / 2.0 END AS neck_y,
 CASE WHEN min(CASE WHEN k IN (11, 12) THEN v END) > 0 THEN sum(CASE WHEN k IN (11, 12) THEN px END) / 2.0 END AS hip_x FROM kps GROUP BY image_id, det_id""")
def p07(spark, d):
    neck, hip = K.midpoint(c("kps"), 5, 6), K.midpoint(c("kps"), 11, 12)
    return R.keypoints(spark, d).select(*ID, neck["x"].alias("neck_x"), neck["y"].alias("neck_y"), hip["x"].alias("hip_x"))


_LIMBS_SQL = ", ".join(f"({part + 1}, {n}, {a}, {b})" for n, (part, (a, b)) in enumerate((p, limb) for p, limbs in enumerate(K.LIMBS) for limb in limbs))


@query("p08_joint_map", f"""WITH q AS MATERIALIZED (SELECT image_id, det_id, k, (px - x0) / CAST(x1 - x0 AS DOUBLE) AS nx, (py - y0) / CAST(y1 - y0 AS DOUBLE) AS ny, v FROM kps),
 s AS MATERIALIZED (SELECT image_id, det_id, k, CAST(trunc(nx * 15) AS BIGINT) AS gx, CAST(trunc(ny * 15) AS BIGINT) AS gy FROM q WHERE v > 0 AND nx >= 0 AND nx <= 1 AND ny >= 0 AND ny <= 1),
 l AS (SELECT a.image_id, a.det_id, part, a.gx AS ax, a.gy AS ay, b.gx AS bx, b.gy AS by_, greatest(abs(b.gx - a.gx), abs(b.gy - a.gy), 1) AS n FROM (VALUES {_LIMBS_SQL}) m(part, no, ka, kb) JOIN s a ON a.k = ka JOIN s b ON b.image_id = a.image_id AND b.det_id = a.det_id AND b.k = kb),
 cells AS (SELECT image_id, det_id, part, CAST(floor(ax + (bx - ax) * i / CAST(n AS DOUBLE) + 0.5) AS BIGINT) AS x, CAST(floor(ay + (by_ - ay) * i / CAST(n AS DOUBLE) + 0.5) AS BIGINT) AS y FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM l)),
 g AS (SELECT image_id, det_id, y, x, max(part) AS part FROM cells GROUP BY ALL)
SELECT b.image_id, b.det_id, count(part) AS n_drawn, CAST(coalesce(sum(part * (16 * y + x + 1)), 0) AS BIGINT) AS weighted FROM boxes b LEFT JOIN g USING (image_id, det_id) GROUP BY b.image_id, b.det_id""")
def p08(spark, d):
    """Drawn cells of each 16 x 16 map, and the sum of their values by place. Later parts cover earlier ones, so the largest stays."""
    def summary(kps, det_id, *box):
        grid = L.byte_rows(K.joint_maps(K.boxed(kps, *box), 16))
        return pa.StructArray.from_arrays([pa.array(np.count_nonzero(grid, axis=1)), pa.array((grid @ np.arange(1.0, 257.0)).astype(np.int64))], ["n", "weighted"])

    k = R.boxes(spark, d).select(*ID, R.of_keypoints(summary, "struct<n: bigint, weighted: bigint>").alias("s"))
    return k.select(*ID, c("s")["n"].alias("n_drawn"), c("s")["weighted"].alias("weighted"))


def shaken(kps: pa.Array, det_id: pa.Array) -> pa.Array:
    """What a detector found: keypoints moved by small numbers of the detection."""
    x, y, v = L.fields(kps, "x", "y", "v")
    det = np.asarray(det_id)[L.parents(kps)]
    return L.relisted(kps, x=pc.add(x, pa.array(det % 7)), y=pc.add(y, pa.array((L.places(kps) + det) % 5)), v=v)


def box_area(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    return pc.multiply(pc.subtract(x1, x0), pc.subtract(y1, y0))


SIGMA2 = "[" + ", ".join(repr((2 * s / 10) ** 2) + "::DOUBLE" for s in K.OKS_SIGMAS) + "]"


@query("p09_oks", f"""SELECT image_id, det_id, round(avg(CASE WHEN v > 0 THEN exp(-(CAST((det_id % 7) * (det_id % 7) + ((k + det_id) % 5) * ((k + det_id) % 5) AS DOUBLE) / {SIGMA2}[k + 1] / (CAST((x1 - x0) * (y1 - y0) AS DOUBLE) + 2.220446049250313e-16) / 2)) END), 6) AS oks FROM kps GROUP BY image_id, det_id""")
def p09(spark, d):
    def similarity(kps, det_id, *box):
        return K.similarities(shaken(kps, det_id), kps, box_area(*box))

    return R.boxes(spark, d).select(*ID, F.round(R.of_keypoints(similarity, "double"), 6).alias("oks"))


@query("p10_eye_rotation", """WITH q AS (SELECT image_id, det_id, any_value(x0) AS x0, any_value(y0) AS y0, any_value(x1) AS x1, any_value(y1) AS y1, max(CASE WHEN k = 1 THEN px END) AS lx, max(CASE WHEN k = 1 THEN py END) AS ly, max(CASE WHEN k = 2 THEN px END) AS rx, max(CASE WHEN k = 2 THEN py END) AS ry FROM kps GROUP BY image_id, det_id),
 r AS (SELECT *, atan2(CAST(ry - ly AS DOUBLE), CAST(rx - lx AS DOUBLE)) AS a, (x0 + x1) / 2.0 AS cx, (y0 + y1) / 2.0 AS cy FROM q)
SELECT image_id, det_id, round(a, 6) AS angle, round(cos(a), 6) AS m0, round((1 - cos(a)) * cx - sin(a) * cy, 6) AS m2, round(sin(a) * cx + (1 - cos(a)) * cy, 6) AS m5 FROM r""")
def p10(spark, d):
    k = R.keypoints(spark, d).withColumn("a", K.eye_angle(c("kps")))
    m = k.withColumn("m", K.rotation(c("a"), (c("x0") + c("x1")) / 2.0, (c("y0") + c("y1")) / 2.0))
    return m.select(*ID, F.round("a", 6).alias("angle"), *[F.round(F.get("m", F.lit(i)), 6).alias(f"m{i}") for i in (0, 2, 5)])


@query("p11_similarity_fit", "SELECT image_id, det_id, round(0.8e0 * (1 + det_id % 3), 6) AS m0, round(-0.6e0 * (1 + det_id % 3), 6) AS m1, CAST(det_id % 11 AS DOUBLE) AS m2, round(0.6e0 * (1 + det_id % 3), 6) AS m3, round(0.8e0 * (1 + det_id % 3), 6) AS m4, -5.0::DOUBLE AS m5 FROM boxes")
def p11(spark, d):
    """Targets are the keypoints turned, scaled and shifted by numbers of the detection, which the fit has to find."""
    grow, shift = 1 + c("det_id") % 3, c("det_id") % 11
    flat = K.flatten(c("kps"))
    turned = F.flatten(F.transform("kps", lambda p: F.array(grow * (p["x"] * 0.8 - p["y"] * 0.6) + shift, grow * (p["x"] * 0.6 + p["y"] * 0.8) - 5.0)))
    m = R.keypoints(spark, d).select(*ID, flat.alias("s"), turned.alias("t")).withColumn("m", K.similarity_udf("s", "t"))
    return m.select(*ID, *[(F.round(F.get("m", F.lit(i)), 6) + 0.0).alias(f"m{i}") for i in range(6)])


PADDING_SQL = "CASE kind WHEN 'face' THEN 0.2109375 WHEN 'vehicle' THEN 0.0 WHEN 'person' THEN 0.70 ELSE 0.40 END"


@query("p12_face_padding", f"SELECT image_id, det_id, round(sqrt(CAST((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0) AS DOUBLE)) * ({PADDING_SQL} * sqrt(2.0) + 0.5), 6) AS reach FROM boxes")
def p12(spark, d):
    by_kind = {"face": "full", "vehicle": "half", "person": "head", "person_cse": "whole_face"}
    table = F.create_map(*[F.lit(x) for k, t in by_kind.items() for x in (k, K.FACE_PADDING[t][0])])
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    return R.boxes(spark, d).select(*ID, F.round(F.sqrt((w * w + h * h).cast("double")) * (table[c("kind")] * F.sqrt(F.lit(2.0)) + 0.5), 6).alias("reach"))


@query("p13_polygon_area", """SELECT image_id, det_id, abs((x0 + det_id % 5) * y0 - (x1 + det_id % 5) * y0 + (x1 + det_id % 5) * y1 - x1 * y0 + x1 * y1 - x0 * y1 + x0 * y0 - (x0 + det_id % 5) * y1) / 2.0 AS area FROM boxes""")
def p13(spark, d):
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    s = c("det_id") % 5
    corners = F.array(p(c("x0") + s, c("y0")), p(c("x1") + s, c("y0")), p(c("x1"), c("y1")), p(c("x0"), c("y1")))
    return R.boxes(spark, d).withColumn("poly", corners).select(*ID, K.polygon_area(c("poly")).alias("area"))


@query("p14_averaged_yaw", """WITH q AS (SELECT image_id, det_id, x0, x1 FROM boxes)
SELECT image_id, det_id, round(((x0 + 16 * 5 % (x1 - x0) - (x0 + 27 * 5 % (x1 - x0))) + (x0 + 15 * 5 % (x1 - x0) - (x0 + 28 * 5 % (x1 - x0))) + (x0 + 14 * 5 % (x1 - x0) - (x0 + 29 * 5 % (x1 - x0)))) / 3.0
 - ((x0 + 27 * 5 % (x1 - x0) - x0) + (x0 + 28 * 5 % (x1 - x0) - (x0 + 5 % (x1 - x0))) + (x0 + 29 * 5 % (x1 - x0) - (x0 + 10 % (x1 - x0)))) / 3.0, 6) AS yaw FROM q""")
def p14(spark, d):
    xs = F.transform(F.sequence(F.lit(0), F.lit(67)), lambda i: c("x0") + i * 5 % (c("x1") - c("x0")))
    return R.boxes(spark, d).withColumn("xs", xs).select(*ID, F.round(K.averaged_yaw(c("xs")), 6).alias("yaw"))


@query("p15_affine_apply_invert", """SELECT image_id, det_id, round(1.5 * x0 + 0.25 * y0 + 7, 6) AS fx, round(-0.25 * x0 + 2.0 * y0 - 3, 6) AS fy, CAST(x0 AS DOUBLE) AS bx, CAST(y0 AS DOUBLE) AS "by" FROM boxes""")
def p15(spark, d):
    m = F.array(*[F.lit(float(v)) for v in (1.5, 0.25, 7, -0.25, 2.0, -3)])
    rows = R.boxes(spark, d).withColumn("m", m)
    fx, fy = K.affine(c("m"), c("x0"), c("y0"))
    rows = rows.withColumn("fx", fx).withColumn("fy", fy).withColumn("inv", K.affine_inverse(c("m")))
    bx, by = K.affine(c("inv"), c("fx"), c("fy"))
    return rows.select(*ID, F.round("fx", 6).alias("fx"), F.round("fy", 6).alias("fy"), F.abs(F.round(bx, 6)).alias("bx"), F.abs(F.round(by, 6)).alias("by"))


@query("p16_affine_from_triangles", """SELECT image_id, det_id, 2.0::DOUBLE AS a, 0.0::DOUBLE AS b, 1.0::DOUBLE AS shift_x, 3.0::DOUBLE AS e, -2.0::DOUBLE AS shift_y FROM boxes""")
def p16(spark, d):
    xs = [c("x0"), c("y0"), c("x1"), c("y0"), c("x0"), c("y1")]
    ts = [v * 2 + 1 if i % 2 == 0 else v * 3 - 2 for i, v in enumerate(xs)]
    m = R.boxes(spark, d).withColumn("m", K.affine_from_triangles([x.cast("double") for x in xs], [t.cast("double") for t in ts]))
    at = lambda i: (F.round(F.get("m", F.lit(i)), 6) + 0.0)
    return m.select(*ID, at(0).alias("a"), F.abs(at(1)).alias("b"), at(2).alias("shift_x"), at(4).alias("e"), at(5).alias("shift_y"))


@query("p17_landmark_blend", "SELECT image_id, det_id, round(sum(floor(((px - x0) / CAST(x1 - x0 AS DOUBLE)) * 64.0) / 256.0 * 0.75 + ((px - x0) / CAST(x1 - x0 AS DOUBLE)) * 0.25), 6) AS blended FROM kps GROUP BY image_id, det_id")
def p17(spark, d):
    xs = F.transform(K.to_box(c("kps")), lambda p: K.quantize_blend(p["x"], 0.25, 128))
    return R.keypoints(spark, d).select(*ID, F.round(F.aggregate(xs, F.lit(0.0), lambda a, x: a + x), 6).alias("blended"))


@query("p18_flatten_landmarks", "SELECT image_id, det_id, 34 AS n, CAST(sum(px * (2 * k + 1) + py * (2 * k + 2)) AS DOUBLE) AS weighted FROM kps GROUP BY image_id, det_id")
def p18(spark, d):
    f = R.keypoints(spark, d).withColumn("f", K.flatten(c("kps")))
    return f.select(*ID, F.size("f").alias("n"), F.aggregate(F.transform("f", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x).alias("weighted"))


@query("p19_heatmap_peaks", """WITH m AS (SELECT image_id, max(v) AS confidence FROM pixels GROUP BY image_id),
 p AS (SELECT image_id, confidence, min(y) AS r, min(x) AS k FROM pixels JOIN m USING (image_id) WHERE v = confidence GROUP BY image_id, confidence)
SELECT image_id, round(image_id % 50 + k * (30 + image_id % 7) / 8.0, 9) AS px, round(image_id % 40 + r * (60 + image_id % 9) / 8.0, 9) AS py, confidence FROM p""")
def p19(spark, d):
    cells = R.pixels(spark, d).select("image_id", c("y").alias("row"), c("x").alias("col"), c("v").alias("value"))
    i = c("image_id")
    boxes = cells.select("image_id").distinct().withColumns({"x0": i % 50, "y0": i % 40}).withColumns({"x1": c("x0") + 30 + i % 7, "y1": c("y0") + 60 + i % 9})
    k = K.heatmap_keypoints(cells, boxes, ["image_id"], "image_id", 8, 8)
    return k.select("image_id", F.round("px", 9).alias("px"), F.round("py", 9).alias("py"), "confidence")
