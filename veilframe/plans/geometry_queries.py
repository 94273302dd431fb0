"""Queries of the box geometry operators (B1-B25) over the derived detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import geometry as G

c = F.col
W, H = R.WIDTH, R.HEIGHT
ID = ("image_id", "det_id")
BOX = (*ID, *G.COORDS)


def sql_axis(rel: str, s: str, e: str, target: str, limit: int) -> str:
    """SQL of expand_axis over a relation; replaces the columns s and e."""
    a = f"(SELECT *, CAST({target} AS BIGINT) - ({e} - {s}) AS g_ FROM {rel})"
    b = f"(SELECT *, {s} - CAST(floor(g_ / 2.0) AS BIGINT) AS s_, {e} + g_ - CAST(floor(g_ / 2.0) AS BIGINT) AS e_ FROM {a})"
    d = f"(SELECT *, CASE WHEN s_ < 0 AND e_ < {limit} THEN least(-s_, {limit} - e_) ELSE 0 END AS r_, (s_ < 0 AND e_ > {limit}) AS both_ FROM {b})"
    f = f"(SELECT *, CASE WHEN NOT both_ AND e_ + r_ > {limit} AND s_ + r_ > 0 THEN least(e_ + r_ - {limit}, s_ + r_) ELSE 0 END AS l_ FROM {d})"
    return f"(SELECT * EXCLUDE (g_, s_, e_, r_, both_, l_) REPLACE (s_ + r_ - l_ AS {s}, e_ + r_ - l_ AS {e}) FROM {f})"


def sql_share(rel: str, share: float) -> str:
    t = f"(SELECT *, x1 - x0 AS w_, y1 - y0 AS h_, CAST(floor(sqrt((y1 - y0) * (x1 - x0)) * {share}e0) AS BIGINT) AS q_ FROM {rel})"
    t = sql_axis(sql_axis(t, "x0", "x1", f"least(w_ + q_, {W})", W), "y0", "y1", f"least(h_ + q_, {H})", H)
    return f"(SELECT * EXCLUDE (w_, h_, q_) FROM {t})"


def sql_ratio(rel: str, ratio: float) -> str:
    t = f"(SELECT *, x1 - x0 AS w_, y1 - y0 AS h_, (y1 - y0) / CAST(x1 - x0 AS DOUBLE) AS ra_ FROM {rel})"
    t = f"(SELECT *, CASE WHEN ra_ < {ratio} THEN floor(w_ * {ratio}) ELSE h_ END AS th_, CASE WHEN ra_ > {ratio} THEN floor(h_ / {ratio}) ELSE w_ END AS tw_ FROM {t})"
    t = sql_axis(sql_axis(t, "y0", "y1", "th_", H), "x0", "x1", "tw_", W)
    return f"(SELECT * EXCLUDE (w_, h_, ra_, th_, tw_) FROM {t})"


def sql_background(rel: str, area: str, share: float) -> str:
    t = f"(SELECT *, x1 - x0 AS w_, y1 - y0 AS h_, {area} AS m_, x0 AS k0_, y0 AS k1_, x1 AS k2_, y1 AS k3_ FROM {rel})"
    t = f"(SELECT *, CASE WHEN 1 - m_ / CAST(h_ * w_ AS DOUBLE) > {share} THEN NULL ELSE sqrt(m_ / (1 - CAST({share} AS DOUBLE)) / (h_ * w_)) END AS p_ FROM {t})"
    t = sql_axis(sql_axis(t, "x0", "x1", "coalesce(ceil(p_ * w_), w_)", W), "y0", "y1", "coalesce(ceil(p_ * h_), h_)", H)
    keep = ", ".join(f"CASE WHEN p_ IS NULL THEN k{i}_ ELSE {n} END AS {n}" for i, n in enumerate(G.COORDS))
    return f"(SELECT * EXCLUDE (w_, h_, m_, p_, k0_, k1_, k2_, k3_) REPLACE ({keep}) FROM {t})"


BOXCOLS = "image_id, det_id, x0, y0, x1, y1"
#: A mask area for boxes that carry no mask: a share of the box between 0 and 1.
AREA_SQL = "CAST(floor((x1 - x0) * (y1 - y0) * ((det_id % 10) / 10.0)) AS BIGINT)"


def mask_area():
    return F.floor((c("x1") - c("x0")) * (c("y1") - c("y0")) * ((c("det_id") % 10) / 10.0))


@query("b01_yolo_to_voc", "SELECT image_id, det_id, " + ", ".join(f"CAST(floor(({a} {s} {b} / 2) * {n} + 0.5) AS BIGINT) AS {o}" for a, b, s, n, o in (("xc", "w", "-", W, "vx0"), ("yc", "h", "-", H, "vy0"), ("xc", "w", "+", W, "vx1"), ("yc", "h", "+", H, "vy1"))) + " FROM yolo")
def b01(spark, d):
    return G.yolo_to_voc(R.yolo(spark, d), W, H).select(*ID, "vx0", "vy0", "vx1", "vy1")


@query("b02_xywh_to_xyxy", "SELECT image_id, det_id, CAST(round_even(x0 / 2.0, 0) AS BIGINT) AS r0, CAST(round_even(y0 / 2.0, 0) AS BIGINT) AS r1, CAST(round_even(x0 / 2.0 + (x1 - x0) / 4.0, 0) AS BIGINT) AS r2, CAST(round_even(y0 / 2.0 + (y1 - y0) / 4.0, 0) AS BIGINT) AS r3 FROM boxes")
def b02(spark, d):
    out = G.xywh_to_xyxy(c("x0") / 2.0, c("y0") / 2.0, (c("x1") - c("x0")) / 4.0, (c("y1") - c("y0")) / 4.0)
    return R.boxes(spark, d).select(*ID, *[v.alias(f"r{i}") for i, v in enumerate(out)])


@query("b03_relative_to_absolute", "SELECT image_id, det_id, CAST(round_even(xc * 640, 0) AS BIGINT) AS ax, CAST(round_even(yc * 480, 0) AS BIGINT) AS ay FROM yolo")
def b03(spark, d):
    return R.yolo(spark, d).select(*ID, G.absolute(c("xc"), W).alias("ax"), G.absolute(c("yc"), H).alias("ay"))


@query("b04_expand_axis", f"SELECT image_id, det_id, x0, x1 FROM {sql_axis('boxes', 'x0', 'x1', 'x1 - x0 + det_id * 37 % 700', W)}")
def b04(spark, d):
    return G.expand_axis(R.boxes(spark, d), "x0", "x1", c("x1") - c("x0") + c("det_id") * 37 % 700, W).select(*ID, "x0", "x1")


@query("b05_expand_to_ratio", f"SELECT {BOXCOLS} FROM {sql_ratio('boxes', 1.8)}")
def b05(spark, d):
    return G.expand_to_ratio(R.boxes(spark, d), 1.8, W, H).select(*BOX)


@query("b06_expand_by_share", f"SELECT {BOXCOLS} FROM {sql_share('boxes', 0.1)}")
def b06(spark, d):
    return G.expand_by_share(R.boxes(spark, d), 0.1, W, H).select(*BOX)


@query("b07_expand_for_background", f"SELECT {BOXCOLS} FROM {sql_background('boxes', AREA_SQL, 0.3)}")
def b07(spark, d):
    return G.expand_for_background(R.boxes(spark, d), mask_area(), 0.3, W, H).select(*BOX)


EXPANDED_SQL = sql_background(sql_ratio(sql_share(f"(SELECT *, {AREA_SQL} AS area_ FROM boxes)", 0.1), 1.8), "area_", 0.3)


@query("b08_expanded_box", f"SELECT {BOXCOLS} FROM {EXPANDED_SQL}")
def b08(spark, d):
    return G.expanded_box(R.boxes(spark, d), mask_area()).select(*BOX)


@query("b09_include_box", """SELECT image_id, det_id, x0, y0, x1, y1 FROM boxes
 WHERE (least(x1, 600) - greatest(0, x0)) * (least(400, y1) - greatest(0, y0)) / CAST((x1 - x0) * (y1 - y0) AS DOUBLE) >= 0.5
 AND (y1 - y0) / CAST(x1 - x0 AS DOUBLE) > 0.2 AND (y1 - y0) / CAST(x1 - x0 AS DOUBLE) < 3.0 AND (x1 - x0) * (y1 - y0) >= 1024""")
def b09(spark, d):
    return R.boxes(spark, d).filter(G.include_box(600, 400, 1024, (0.2, 3.0), 0.5)).select(*BOX)


SQUARE_SQL = """q1 AS MATERIALIZED (SELECT *, x1 - x0 AS w_, y1 - y0 AS h_, abs((y1 - y0) - (x1 - x0)) AS d_, greatest(x1 - x0, y1 - y0) AS side_ FROM boxes),
q2 AS MATERIALIZED (SELECT *, CASE WHEN h_ >= w_ AND d_ > 0 THEN greatest(0, x0 - CAST(floor(d_ / 2.0) AS BIGINT)) ELSE x0 END AS a_,
  CASE WHEN h_ < w_ THEN greatest(0, y0 - CAST(floor(d_ / 2.0) AS BIGINT)) ELSE y0 END AS b_ FROM q1 WHERE side_ <= 480),
q3 AS MATERIALIZED (SELECT *, CASE WHEN d_ > 0 AND a_ + side_ > 640 THEN 640 - side_ ELSE a_ END AS sx_, CASE WHEN d_ > 0 AND b_ + side_ > 480 THEN 480 - side_ ELSE b_ END AS sy_ FROM q2),
q4 AS MATERIALIZED (SELECT * FROM q3 WHERE sx_ >= 0 AND sy_ >= 0 AND sx_ + side_ <= 640 AND sy_ + side_ <= 480),
q5 AS MATERIALIZED (SELECT *, greatest(0, least(CAST(floor((480 - side_) / 2.0) AS BIGINT), CAST(floor((640 - side_) / 2.0) AS BIGINT), CAST(floor(side_ * 0.35e0) AS BIGINT))) AS f_ FROM q4),
q6 AS MATERIALIZED (SELECT *, side_ + 2 * f_ AS s_, CASE WHEN f_ > 0 THEN greatest(0, sx_ - f_) ELSE sx_ END AS ax_, CASE WHEN f_ > 0 THEN greatest(0, sy_ - f_) ELSE sy_ END AS ay_ FROM q5),
q7 AS MATERIALIZED (SELECT *, CASE WHEN f_ > 0 AND ax_ + s_ > 640 THEN 640 - s_ ELSE ax_ END AS ex0, CASE WHEN f_ > 0 AND ay_ + s_ > 480 THEN 480 - s_ ELSE ay_ END AS ey0 FROM q6),
q8 AS MATERIALIZED (SELECT *, ex0 + s_ AS ex1, ey0 + s_ AS ey1 FROM q7),
q9 AS MATERIALIZED (SELECT image_id, det_id, ex0, ey0, ex1, ey1 FROM q8 WHERE ex0 >= 0 AND ey0 >= 0 AND ex1 <= 640 AND ey1 <= 480 AND ex0 <= x0 AND ey0 <= y0 AND ex1 >= x1 AND ey1 >= y1)"""


@query("b10_quadratic_box", f"WITH {SQUARE_SQL} SELECT b.image_id, b.det_id, sx_ AS qx, sy_ AS qy, side_ AS qw, side_ AS qh FROM boxes b LEFT JOIN q4 USING (image_id, det_id)")
def b10(spark, d):
    return G.quadratic(R.boxes(spark, d), W, H).select(*ID, "qx", "qy", "qw", "qh")


@query("b11_expand_square", f"WITH {SQUARE_SQL} SELECT b.image_id, b.det_id, ex0, ey0, ex1, ey1 FROM boxes b LEFT JOIN q9 USING (image_id, det_id)")
def b11(spark, d):
    return G.expand_square(R.boxes(spark, d), 0.35, W, H).select(*ID, "ex0", "ey0", "ex1", "ey1")


def sql_simple(share: float) -> str:
    r = f"floor(greatest(x1 - x0, y1 - y0) * (1.0e0 + {share}e0) / 2.0)"
    mx, my = "(x0 + floor((x1 - x0) / 2.0))", "(y0 + floor((y1 - y0) / 2.0))"
    return f"CAST(trunc({mx} - {r}) AS BIGINT) AS sx0, CAST(trunc({my} - {r}) AS BIGINT) AS sy0, CAST(trunc({mx} + {r}) AS BIGINT) AS sx1, CAST(trunc({my} + {r}) AS BIGINT) AS sy1"


@query("b12_expand_simple", f"SELECT image_id, det_id, {sql_simple(0.4)} FROM boxes")
def b12(spark, d):
    return R.boxes(spark, d).select(*ID, *[v.alias(k) for k, v in G.expand_simple(0.4).items()])


@query("b13_expand_face", f"""WITH {SQUARE_SQL}, s AS (SELECT image_id, det_id, {sql_simple(0.7)} FROM boxes)
SELECT image_id, det_id, coalesce(ex0, sx0) AS fx0, coalesce(ey0, sy0) AS fy0, coalesce(ex1, sx1) AS fx1, coalesce(ey1, sy1) AS fy1 FROM s LEFT JOIN q9 USING (image_id, det_id)""")
def b13(spark, d):
    return G.expand_face(R.boxes(spark, d), W, H).select(*ID, "fx0", "fy0", "fx1", "fy1")


SIMPLE = f"(SELECT image_id, det_id, sx0 AS x0, sy0 AS y0, sx1 AS x1, sy1 AS y1 FROM (SELECT image_id, det_id, {sql_simple(0.7)} FROM boxes))"


def simple(spark, d):
    """Boxes that may leave the image."""
    return R.boxes(spark, d).select(*ID, *[v.alias(k[1:]) for k, v in G.expand_simple(0.7).items()])


@query("b14_clip_inside", f"SELECT image_id, det_id, greatest(0, x0) AS x0, greatest(0, y0) AS y0, least(x1, 639) AS x1, least(y1, 479) AS y1 FROM {SIMPLE}")
def b14(spark, d):
    return simple(spark, d).withColumns(G.clip_inside(W, H))


@query("b15_clip_crop", f"SELECT image_id, det_id, greatest(0, x0) AS x0, greatest(0, y0) AS y0, least(x1, 640) AS x1, least(y1, 480) AS y1 FROM {SIMPLE}")
def b15(spark, d):
    return simple(spark, d).withColumns(G.clip_crop(W, H))


@query("b16_padding", f"SELECT image_id, det_id, greatest(0, -x0) AS pad_left, greatest(0, -y0) AS pad_top, greatest(x1 - 640, 0) AS pad_right, greatest(y1 - 480, 0) AS pad_bottom FROM {SIMPLE}")
def b16(spark, d):
    return simple(spark, d).select(*ID, *[v.alias(k) for k, v in G.padding(W, H).items()])


@query("b17_box_to_crop", f"""SELECT image_id, det_id, CAST(trunc((x0 - sx0) * 128 / CAST(sx1 - sx0 AS DOUBLE)) AS BIGINT) AS cx0, CAST(trunc((y0 - sy0) * 128 / CAST(sx1 - sx0 AS DOUBLE)) AS BIGINT) AS cy0,
 CAST(trunc((x1 - sx0) * 128 / CAST(sx1 - sx0 AS DOUBLE)) AS BIGINT) AS cx1, CAST(trunc((y1 - sy0) * 128 / CAST(sx1 - sx0 AS DOUBLE)) AS BIGINT) AS cy1 FROM (SELECT *, {sql_simple(0.4)} FROM boxes)""")
def b17(spark, d):
    out = G.to_crop(G.COORDS, ("sx0", "sy0", "sx1", "sy1"), 128)
    return R.boxes(spark, d).withColumns(G.expand_simple(0.4)).select(*ID, *[v.alias(k) for k, v in out.items()])


NEXT_SQL = "(SELECT *, lead(x0) OVER p AS nx0, lead(y0) OVER p AS ny0, lead(x1) OVER p AS nx1, lead(y1) OVER p AS ny1 FROM boxes WINDOW p AS (PARTITION BY image_id ORDER BY det_id))"


@query("b18_union_box", f"SELECT image_id, det_id, least(x0, nx0) AS x0, least(y0, ny0) AS y0, greatest(x1, nx1) AS x1, greatest(y1, ny1) AS y1 FROM {NEXT_SQL} WHERE nx0 IS NOT NULL")
def b18(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("image_id").orderBy("det_id")
    both = R.boxes(spark, d).withColumns({f"n{n}": F.lead(n).over(w) for n in G.COORDS}).filter("nx0 is not null")
    return both.select(*ID, *[v.alias(k) for k, v in G.union_box(G.COORDS, ("nx0", "ny0", "nx1", "ny1")).items()])


@query("b19_box_from_crop", """SELECT image_id, det_id, CAST(trunc(10 * (x1 - x0) / 160.0e0) AS BIGINT) + x0 - 40 AS bx0, CAST(trunc(20 * (y1 - y0) / 288.0e0) AS BIGINT) + y0 - 40 AS by0,
 CAST(trunc((160 - det_id % 50) * (x1 - x0) / 160.0e0) AS BIGINT) + x0 - 40 AS bx1, CAST(trunc((288 - det_id % 70) * (y1 - y0) / 288.0e0) AS BIGINT) + y0 - 40 AS by1 FROM boxes""")
def b19(spark, d):
    """Outer boxes that start outside the image as well."""
    rows = R.boxes(spark, d).withColumns({n: c(n) - 40 for n in G.COORDS})
    rows = rows.withColumns({"m0": F.lit(10), "m1": F.lit(20), "m2": 160 - c("det_id") % 50, "m3": 288 - c("det_id") % 70})
    return rows.select(*ID, *[v.alias(k) for k, v in G.from_crop(("m0", "m1", "m2", "m3"), G.COORDS, 160, 288).items()])



@query("b20_round_region", "SELECT image_id, det_id, CAST(round_even(x0 / 2.0, 0) AS BIGINT) AS rx0, CAST(round_even(y0 / 2.0, 0) AS BIGINT) AS ry0, CAST(round_even(x1 / 2.0, 0) AS BIGINT) AS rx1, CAST(round_even(y1 / 2.0, 0) AS BIGINT) AS ry1 FROM boxes")
def b20(spark, d):
    return R.boxes(spark, d).select(*ID, *[G.whole(F.bround(c(n) / 2.0)).alias(f"r{n}") for n in G.COORDS])


@query("b21_surface_box_in_crop", "SELECT image_id, det_id, CAST(round_even((x1 - x0) * 0.5 * 160 / CAST(x1 - x0 + 8 AS DOUBLE), 0) AS BIGINT) AS tx, CAST(round_even((y1 - y0) * 0.5 * 288 / CAST(y1 - y0 + 8 AS DOUBLE), 0) AS BIGINT) AS ty FROM boxes")
def b21(spark, d):
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    return R.boxes(spark, d).select(*ID, G.whole(F.bround(w * 0.5 * 160 / (w + 8))).alias("tx"), G.whole(F.bround(h * 0.5 * 288 / (h + 8))).alias("ty"))


@query("b22_centre_crop", "SELECT image_id, det_id, least(x1 - x0, y1 - y0) AS side, CAST(floor((x1 - x0 - least(x1 - x0, y1 - y0)) / 2.0) AS BIGINT) AS off_x, CAST(floor((y1 - y0 - least(x1 - x0, y1 - y0)) / 2.0) AS BIGINT) AS off_y FROM boxes")
def b22(spark, d):
    return R.boxes(spark, d).select(*ID, *[v.alias(k) for k, v in G.centre_offsets(c("x1") - c("x0"), c("y1") - c("y0")).items()])


@query("b23_max_resolution", "SELECT image_id, det_id, CAST(trunc((x1 - x0) / greatest((x1 - x0) / 100.0, (y1 - y0) / 100.0, 1.0)) AS BIGINT) AS new_w, CAST(trunc((y1 - y0) / greatest((x1 - x0) / 100.0, (y1 - y0) / 100.0, 1.0)) AS BIGINT) AS new_h FROM boxes")
def b23(spark, d):
    return R.boxes(spark, d).select(*ID, *[v.alias(k) for k, v in G.max_resolution(c("x1") - c("x0"), c("y1") - c("y0"), 100).items()])


@query("b24_centred_mask", "SELECT image_id, y, x, v, NOT (x >= 2 AND x < 6 AND y >= 2 AND y < 6) AS keep FROM pixels")
def b24(spark, d):
    x0, y0, x1, y1 = G.centred_mask(8)
    return R.pixels(spark, d).withColumn("keep", ~((c("x") >= x0) & (c("x") < x1) & (c("y") >= y0) & (c("y") < y1)))


@query("b24_random_mask", "SELECT vec_id AS image_id, x0, y0, x0 + 32 AS x1, y0 + 24 AS y1 FROM (SELECT vec_id, CAST(floor(CAST('0x' || substr(md5(vec_id || '-x'), 1, 5) AS BIGINT) / 1048576.0e0 * 32) AS BIGINT) AS x0, CAST(floor(CAST('0x' || substr(md5(vec_id || '-y'), 1, 5) AS BIGINT) / 1048576.0e0 * 24) AS BIGINT) AS y0 FROM embeddings) q")
def b24r(spark, d):
    return R.images(spark, d).select("image_id", *[v.alias(k) for k, v in G.random_mask(64, 48, c("image_id").cast("string")).items()])


@query("b25_pose_crop", """WITH q AS (SELECT *, x1 - x0 AS w_, y1 - y0 AS h_, CAST(256 / CAST(192 AS DOUBLE) AS DOUBLE) * (x1 - x0) / (y1 - y0) AS f_ FROM boxes),
r AS (SELECT *, CAST(trunc(round_even(h_ * f_, 0) / 2.0) AS BIGINT) AS ly, CAST(trunc(round_even(w_ / f_, 0) / 2.0) AS BIGINT) AS lx, y0 + CAST(floor(h_ / 2.0) AS BIGINT) AS my, x0 + CAST(floor(w_ / 2.0) AS BIGINT) AS mx FROM q)
SELECT image_id, det_id, CASE WHEN f_ > 1 THEN x0 ELSE mx - lx END AS x0, CASE WHEN f_ > 1 THEN my - ly ELSE y0 END AS y0, CASE WHEN f_ > 1 THEN x1 ELSE mx + lx END AS x1, CASE WHEN f_ > 1 THEN my + ly ELSE y1 END AS y1 FROM r""")
def b25(spark, d):
    return G.pose_crop(R.boxes(spark, d), W, H).select(*BOX)
