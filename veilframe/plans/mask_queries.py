"""Queries of the mask operators (M1-M21) over 8x8 images; a mask is ``v >= 128``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import contours as C
from ..operators import lists as L
from ..operators import masks as M

c = F.col
HIT = "(v >= 128)"


def masks(spark, d):
    return R.pixels(spark, d).withColumn("hit", c("v") >= 128)


def next_image(df):
    """The mask of image i + 1 under the id of image i."""
    return df.withColumn("image_id", c("image_id") - 1)


SMALL = "SELECT image_id, image_id % 5 AS x0, image_id % 3 AS y0, image_id % 5 + 3 AS x1, image_id % 3 + 4 AS y1 FROM"


def with_box(df):
    i = c("image_id")
    return df.withColumns({"x0": i % 5, "y0": i % 3, "x1": i % 5 + 3, "y1": i % 3 + 4})


@query("m01_box_mask", "SELECT image_id, y, x, (x >= image_id % 5 AND x < image_id % 5 + 3 AND y >= image_id % 3 AND y < image_id % 3 + 4) AS hit FROM pixels")
def m01(spark, d):
    p = with_box(R.pixels(spark, d))
    return p.select("image_id", "y", "x", M.box_mask(p))


@query("m02_tight_box", "SELECT image_id, coalesce(min(x) FILTER (v >= 240), 0) AS x0, coalesce(min(y) FILTER (v >= 240), 0) AS y0, coalesce(max(x) FILTER (v >= 240) + 1, 8) AS x1, coalesce(max(y) FILTER (v >= 240) + 1, 8) AS y1 FROM pixels GROUP BY image_id")
def m02(spark, d):
    return M.tight_box(R.pixels(spark, d).withColumn("hit", c("v") >= 240))


@query("m03_mask_area", f"SELECT image_id, count(*) FILTER {HIT} AS area FROM pixels GROUP BY image_id")
def m03(spark, d):
    return masks(spark, d).groupBy("image_id").agg(F.count_if("hit").alias("area"))


#: The polygons have level upper and lower edges, so a row of cells is filled between its two slanted edges; edges are drawn cell by cell.
@query("m04_polygon_fill", """WITH p AS MATERIALIZED (SELECT image_id, det_id, CAST(floor(x0 / 40.0) AS BIGINT) AS a, CAST(floor(y0 / 40.0) AS BIGINT) AS t, CAST(floor(x1 / 40.0) AS BIGINT) AS b, CAST(floor(y1 / 40.0) AS BIGINT) AS l, det_id % 3 AS s FROM boxes),
 e AS (SELECT image_id, det_id, a + s AS ax, t AS ay, b + s AS bx, t AS by_ FROM p UNION ALL SELECT image_id, det_id, b + s, t, b, l FROM p UNION ALL SELECT image_id, det_id, b, l, a, l FROM p UNION ALL SELECT image_id, det_id, a, l, a + s, t FROM p),
 n AS (SELECT *, greatest(abs(bx - ax), abs(by_ - ay), 1) AS n FROM e),
 edge AS (SELECT image_id, det_id, CAST(floor(ax + (bx - ax) * i / CAST(n AS DOUBLE) + 0.5) AS BIGINT) AS x, CAST(floor(ay + (by_ - ay) * i / CAST(n AS DOUBLE) + 0.5) AS BIGINT) AS y FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM n)),
 fill AS (SELECT image_id, det_id, x, y FROM (SELECT *, unnest(range(0, 16)) AS x FROM (SELECT *, unnest(range(t, l)) AS y FROM p WHERE l > t)) WHERE x >= (s * -1.0) * (y - t) / (l - t) + a + s AND x < (s * -1.0) * (y - t) / (l - t) + b + s),
 cells AS (SELECT DISTINCT image_id, det_id, x, y FROM (SELECT image_id, det_id, x, y FROM edge UNION ALL SELECT image_id, det_id, x, y FROM fill) WHERE x >= 0 AND x < 16 AND y >= 0 AND y < 12)
SELECT p.image_id, p.det_id, count(x) AS n, CAST(coalesce(sum(16 * y + x), 0) AS BIGINT) AS places FROM p LEFT JOIN cells USING (image_id, det_id) GROUP BY p.image_id, p.det_id""")
def m04(spark, d):
    """Filled cells of each 16 x 12 mask, and the sum of their places."""

    @F.arrow_udf("struct<n: bigint, places: bigint>")
    def summary(packed: pa.Array) -> pa.Array:
        bits = np.unpackbits(L.byte_rows(packed), axis=1)
        return pa.StructArray.from_arrays([pa.array(np.count_nonzero(bits, axis=1)), pa.array((bits @ np.arange(192.0)).astype(np.int64))], ["n", "places"])

    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    s = c("det_id") % 3
    x0, y0, x1, y1 = (F.floor(c(n) / 40.0) for n in ("x0", "y0", "x1", "y1"))
    rows = R.boxes(spark, d).select("image_id", "det_id", summary(M.polygon_udf(16, 12)(F.array(p(x0 + s, y0), p(x1 + s, y0), p(x1, y1), p(x0, y1)))).alias("m"))
    return rows.select("image_id", "det_id", c("m")["n"].alias("n"), c("m")["places"].alias("places"))


@query("m05_dilate", f"SELECT o.image_id, o.y, o.x, bool_or(i.v >= 128) AS hit FROM pixels o JOIN pixels i ON i.image_id = o.image_id AND (i.x - o.x) * (i.x - o.x) + (i.y - o.y) * (i.y - o.y) <= 4 GROUP BY o.image_id, o.y, o.x")
def m05(spark, d):
    return M.dilate(masks(spark, d), M.disk(2), 8, 8)


@query("m06_erode", """WITH r AS (SELECT image_id, y, x, v, unnest(range(-1, 2)) AS dy FROM pixels), s AS (SELECT image_id, y, x, dy, unnest(range(-1, 2)) AS dx FROM r),
 t AS (SELECT image_id, y, x, CASE WHEN y + dy < 0 THEN -(y + dy) WHEN y + dy > 7 THEN 14 - (y + dy) ELSE y + dy END AS sy, CASE WHEN x + dx < 0 THEN -(x + dx) WHEN x + dx > 7 THEN 14 - (x + dx) ELSE x + dx END AS sx FROM s)
SELECT t.image_id, t.y, t.x, bool_and(p.v >= 100) AS hit FROM t JOIN pixels p ON p.image_id = t.image_id AND p.y = t.sy AND p.x = t.sx GROUP BY t.image_id, t.y, t.x""")
def m06(spark, d):
    return M.erode(R.pixels(spark, d).withColumn("hit", c("v") >= 100), M.square(1), 8, 8)


@query("m07_strip_padding", f"SELECT image_id, y, x, {HIT} AND NOT (x < floor((image_id % 7) * 0.5) OR y < floor((image_id % 9) * 0.5) OR x >= 8 - floor((image_id % 4) * 0.5) OR y >= 8 - floor((image_id % 6) * 0.5)) AS hit FROM pixels")
def m07(spark, d):
    pads = {"pad_left": c("image_id") % 7, "pad_top": c("image_id") % 9, "pad_right": c("image_id") % 4, "pad_bottom": c("image_id") % 6}
    return masks(spark, d).select("image_id", "y", "x", M.strip_padding(c("hit"), pads, F.lit(0.5), 8, 8).alias("hit"))


@query("m08_mask_iou", "SELECT image_id, count(*) FILTER (a >= 128 AND b >= 128) AS n_and, count(*) FILTER (a >= 128 OR b >= 128) AS n_or, CASE WHEN count(*) FILTER (a >= 128 OR b >= 128) > 0 THEN count(*) FILTER (a >= 128 AND b >= 128) / CAST(count(*) FILTER (a >= 128 OR b >= 128) AS DOUBLE) END AS iou FROM pairs GROUP BY image_id")
def m08(spark, d):
    return M.mask_iou(masks(spark, d), next_image(masks(spark, d)), ["image_id"])


@query("m09_merge_masks", "SELECT image_id, y, x, (a >= 128 OR b >= 128) AS hit FROM pairs")
def m09(spark, d):
    return R.pairs(spark, d).select("image_id", "y", "x", ((c("a") >= 128) | (c("b") >= 128)).alias("hit"))


@query("m10_polarity", f"SELECT image_id, y, x, NOT {HIT} AS keep FROM pixels")
def m10(spark, d):
    return masks(spark, d).select("image_id", "y", "x", (~c("hit")).alias("keep"))


@query("m11_pack_bits", f"SELECT image_id, string_agg(lpad(upper(format('{{:x}}', b)), 2, '0'), '' ORDER BY y) AS packed FROM (SELECT image_id, y, CAST(sum(CASE WHEN {HIT} THEN 1 << (7 - x) ELSE 0 END) AS BIGINT) AS b FROM pixels GROUP BY image_id, y) q GROUP BY image_id")
def m11(spark, d):
    return M.pack_bits(masks(spark, d))


@query("m11_unpack_bits", f"SELECT image_id, y, x, {HIT} AS hit FROM pixels")
def m11b(spark, d):
    return M.unpack_bits(M.pack_bits(masks(spark, d)))


@query("m12_resize_nearest", f"SELECT image_id, o.y, o.x, {HIT} AS hit FROM (SELECT unnest(range(0, 12)) AS y) oy JOIN (SELECT unnest(range(0, 12)) AS x) ox ON true JOIN (SELECT 1) one ON true JOIN pixels p ON p.y = CAST(floor(oy.y * 8 / 12.0) AS BIGINT) AND p.x = CAST(floor(ox.x * 8 / 12.0) AS BIGINT)".replace("o.y, o.x", "oy.y, ox.x"))
def m12(spark, d):
    return M.resize_nearest(masks(spark, d), 8, 12).select("image_id", "y", "x", "hit")


@query("m13_max_pool", "SELECT image_id, CAST(floor(y / 2.0) AS BIGINT) AS y, CAST(floor(x / 2.0) AS BIGINT) AS x, max(v) AS v FROM pixels GROUP BY ALL")
def m13(spark, d):
    return M.pool(R.pixels(spark, d), 2, F.max)


@query("m13_adaptive_max_pool", "SELECT image_id, t AS y, u AS x, max(v) AS v FROM pixels, (SELECT unnest(range(0, 3)) AS t) a, (SELECT unnest(range(0, 3)) AS u) b WHERE y >= floor(t * 8 / 3.0e0) AND y < ceil((t + 1) * 8 / 3.0e0) AND x >= floor(u * 8 / 3.0e0) AND x < ceil((u + 1) * 8 / 3.0e0) GROUP BY image_id, t, u")
def m13a(spark, d):
    return M.adaptive_pool(R.pixels(spark, d), 8, 3, F.max)


@query("m14_difference_mask", "SELECT image_id, y, x, abs(a - b) > 25 AS hit FROM pairs")
def m14(spark, d):
    return R.pairs(spark, d).select("image_id", "y", "x", (F.abs(c("a") - c("b")) > 25).alias("hit"))


@query("m15_binarise", "SELECT image_id, y, x, (a + b) / 2.0 > 0 AS hit FROM pairs")
def m15(spark, d):
    return R.pairs(spark, d).select("image_id", "y", "x", ((c("a") + c("b")) / 2.0 > 0).alias("hit"))


@query("m17_otsu", """WITH h AS (SELECT image_id, v, CAST(count(*) AS DOUBLE) AS n FROM pixels GROUP BY image_id, v),
 s AS (SELECT *, sum(n) OVER w AS n0, sum(n * v) OVER w AS s0, sum(n) OVER (PARTITION BY image_id) AS nt, sum(n * v) OVER (PARTITION BY image_id) AS st FROM h WINDOW w AS (PARTITION BY image_id ORDER BY v ROWS UNBOUNDED PRECEDING)),
 b AS (SELECT image_id, v, round(CASE WHEN nt - n0 > 0 THEN n0 * (nt - n0) * (s0 / n0 - (st - s0) / (nt - n0)) * (s0 / n0 - (st - s0) / (nt - n0)) ELSE 0 END, 6) AS between_ FROM s)
SELECT image_id, v AS threshold FROM b QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY between_ DESC, v) = 1""")
def m17(spark, d):
    return M.otsu(R.pixels(spark, d))


#: Regions that lie in no hole of another, by floods: regions by corners, the ground around all of them from the frame, the ground around each one alone. The area
#: inside a border through pixel centres is counted by squares of four pixels of the filled region: 1 for four, a half for three.
CONTOURS_SQL = """WITH RECURSIVE h AS MATERIALIZED (SELECT image_id, y, x, 8 * y + x AS id FROM pixels WHERE v > 150),
 near AS MATERIALIZED (SELECT a.image_id, a.id AS a, b.id AS b FROM h a JOIN h b ON b.image_id = a.image_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.id <> b.id),
 reach AS (SELECT image_id, id AS node, id AS top FROM h UNION SELECT r.image_id, n.b, r.top FROM reach r JOIN near n ON n.image_id = r.image_id AND n.a = r.node AND r.top < n.b),
 label AS MATERIALIZED (SELECT image_id, node, min(top) AS top FROM reach GROUP BY image_id, node),
 grid AS MATERIALIZED (SELECT y, x FROM (SELECT unnest(range(-1, 9)) AS y) a, (SELECT unnest(range(-1, 9)) AS x) b),
 side AS (SELECT * FROM (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) s(dy, dx)),
 ground AS MATERIALIZED (SELECT i.image_id, g.y, g.x FROM (SELECT DISTINCT image_id FROM h) i, grid g WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.image_id = i.image_id AND h.y = g.y AND h.x = g.x)),
 outside AS (SELECT image_id, y, x FROM ground WHERE y = -1 AND x = -1 UNION SELECT g.image_id, g.y, g.x FROM outside o, side s JOIN ground g ON g.image_id = o.image_id AND g.y = o.y + s.dy AND g.x = o.x + s.dx),
 outer_ AS MATERIALIZED (SELECT DISTINCT l.image_id, l.top FROM label l, side s JOIN outside o ON o.image_id = l.image_id AND o.y = l.node // 8 + s.dy AND o.x = l.node % 8 + s.dx),
 free AS MATERIALIZED (SELECT e.image_id, e.top, g.y, g.x FROM outer_ e, grid g WHERE NOT EXISTS (SELECT 1 FROM label l WHERE l.image_id = e.image_id AND l.top = e.top AND l.node // 8 = g.y AND l.node % 8 = g.x AND g.x >= 0 AND g.x < 8)),
 round_ AS (SELECT image_id, top, y, x FROM free WHERE y = -1 AND x = -1 UNION SELECT f.image_id, f.top, f.y, f.x FROM round_ r, side s JOIN free f ON f.image_id = r.image_id AND f.top = r.top AND f.y = r.y + s.dy AND f.x = r.x + s.dx),
 filled AS MATERIALIZED (SELECT e.image_id, e.top, g.y, g.x FROM outer_ e, grid g WHERE NOT EXISTS (SELECT 1 FROM round_ r WHERE r.image_id = e.image_id AND r.top = e.top AND r.y = g.y AND r.x = g.x)),
 square AS (SELECT image_id, top, count(*) AS n FROM (SELECT image_id, top, y - a AS y, x - b AS x FROM filled, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(a, b)) q GROUP BY image_id, top, y, x),
 inside AS (SELECT image_id, top, sum(CASE n WHEN 4 THEN 1.0e0 WHEN 3 THEN 0.5e0 ELSE 0 END) AS area FROM square GROUP BY image_id, top),
 found AS (SELECT f.image_id, f.top, CAST(min(f.x) AS INT) AS x0, CAST(min(f.y) AS INT) AS y0, CAST(max(f.x) + 1 AS INT) AS x1, CAST(max(f.y) + 1 AS INT) AS y1, any_value(i.area) AS area FROM filled f JOIN inside i ON i.image_id = f.image_id AND i.top = f.top GROUP BY f.image_id, f.top)"""


@query("m16_text_regions", CONTOURS_SQL + " SELECT image_id, x0, y0, x1, y1, area FROM found WHERE (x1 - x0) / CAST(y1 - y0 AS DOUBLE) > 1.1e0 AND (x1 - x0) / CAST(y1 - y0 AS DOUBLE) < 8 AND area > 1 AND area < 30 AND x1 - x0 > 2 AND x1 - x0 < 8 AND y1 - y0 > 1 AND y1 - y0 < 8")
def m16(spark, d):
    """With limits for images of 8 x 8; the published ones are the default."""
    limits = ((1.1, 8.0), (1, 30), (2, 8), (1, 8))
    return R.images(spark, d).select("image_id", F.inline(C.contours_udf(8, 8, 150, limits)("px")))


@query("m18_region_boxes", CONTOURS_SQL + " SELECT image_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY top) - 1 AS INT) AS region, x0, y0, x1, y1, area FROM found")
def m18(spark, d):
    rows = R.images(spark, d).select("image_id", F.posexplode(C.contours_udf(8, 8, 150)("px")).alias("region", "b"))
    return rows.select("image_id", "region", "b.*")


@query("m19_brush_mask")
def m19(spark, d):
    return R.images(spark, d).select("image_id", F.hex(M.brush_udf(32)(F.xxhash64("image_id"))).alias("mask"))


@query("m20_surface_mask", f"SELECT image_id, y, x, 1 - CAST({HIT} AS INT) - CAST((v >= 100 AND v < 128) AS INT) AS e FROM pixels")
def m20(spark, d):
    one = lambda b: b.cast("int")
    return R.pixels(spark, d).select("image_id", "y", "x", (1 - one(c("v") >= 128) - one((c("v") >= 100) & (c("v") < 128))).alias("e"))


@query("m21_mask_blend", """SELECT p.image_id, p.y, p.x, (b.m * 0.7e0 + CAST(p.v >= 128 AS INT) * 0.3e0) >= 0.5 AS hit FROM pixels p JOIN (SELECT image_id, CAST(floor(y / 2.0) AS BIGINT) AS y2, CAST(floor(x / 2.0) AS BIGINT) AS x2, avg(CAST(v >= 128 AS INT)) AS m FROM pixels GROUP BY ALL) b
 ON b.image_id = p.image_id AND b.y2 = CAST(floor(p.y / 2.0) AS BIGINT) AND b.x2 = CAST(floor(p.x / 2.0) AS BIGINT)""")
def m21(spark, d):
    from pyspark.sql import Window

    block = Window.partitionBy("image_id", F.floor(c("y") / 2), F.floor(c("x") / 2))
    m = masks(spark, d).withColumn("h", c("hit").cast("int"))
    return m.select("image_id", "y", "x", ((F.avg("h").over(block) * 0.7 + c("h") * 0.3) >= 0.5).alias("hit"))
