"""Queries of metrics (A1-A22) and latent operators (L1-L11)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import latent as L
from ..operators import lists
from ..operators import metrics as A
from ..operators import keypoints as K
from .keypoint_queries import SIGMA2, box_area, shaken
from .pixel_queries import list_sql
from ..operators.pixels import gaussian

c = F.col


@query("a01_mse", "SELECT image_id, round(avg(((a - b) / 255.0) * ((a - b) / 255.0)), 9) AS mse FROM pairs GROUP BY image_id")
def a01(spark, d):
    return A.mse(R.pairs(spark, d)).select("image_id", F.round("mse", 9).alias("mse"))


@query("a02_psnr_unit", "SELECT image_id, round(10 * log10(1 / avg(((a - b) / 255.0) * ((a - b) / 255.0))), 6) AS psnr FROM pairs GROUP BY image_id")
def a02(spark, d):
    return A.mse(R.pairs(spark, d)).select("image_id", F.round(A.psnr_unit(c("mse")), 6).alias("psnr"))


@query("a03_psnr_255", "SELECT round(avg(p), 6) AS psnr FROM (SELECT 20 * log10(255.0 / sqrt(avg(CAST((a - b) * (a - b) AS DOUBLE)) + 1e-10)) AS p FROM pairs GROUP BY image_id) q")
def a03(spark, d):
    return A.mse(R.pairs(spark, d), 1.0).agg(F.round(F.avg(A.psnr_255(c("mse"))), 6).alias("psnr"))


@query("a04_age", "SELECT image_id, round(avg(abs(a - b)), 9) AS age FROM pairs GROUP BY image_id")
def a04(spark, d):
    return A.age(R.pairs(spark, d)).select("image_id", F.round("age", 9).alias("age"))


@query("a05_l1_l2", "SELECT round(avg(l1), 6) AS l1, round(avg(r), 6) AS l2 FROM (SELECT avg(abs(a - b) / 255.0) AS l1, sqrt(avg(((a - b) / 255.0) * ((a - b) / 255.0))) AS r FROM pairs GROUP BY image_id) q")
def a05(spark, d):
    return A.l1_l2(R.pairs(spark, d)).select(F.round("l1", 6).alias("l1"), F.round("l2", 6).alias("l2"))


def ssim_sql(c1: str, c2: str, pairs: str = "pairs", size: int = 5, last: int = 3) -> str:
    w = list_sql(gaussian(size, 1.5))
    return f"""WITH t AS (SELECT image_id, y - dy AS wy, x - dx AS wx, {w}[dy + 1] * {w}[dx + 1] AS w, a, b FROM (SELECT *, unnest(range(0, {size})) AS dx FROM (SELECT *, unnest(range(0, {size})) AS dy FROM {pairs}) u) v),
 m AS (SELECT image_id, wy, wx, sum(w * a) AS ma, sum(w * b) AS mb, sum(w * a * a) AS aa, sum(w * b * b) AS bb, sum(w * a * b) AS ab FROM t WHERE wy >= 0 AND wy <= {last} AND wx >= 0 AND wx <= {last} GROUP BY image_id, wy, wx)
SELECT image_id, round(avg((2 * ma * mb + {c1}) / (ma * ma + mb * mb + {c1}) * (2 * (ab - ma * mb) + {c2}) / (aa - ma * ma + bb - mb * mb + {c2})), 6) AS ssim FROM m GROUP BY image_id"""


@query("a06_ssim", ssim_sql("6.5025e0", "58.5225e0"))
def a06(spark, d):
    return A.ssim(R.pairs(spark, d), 5).select("image_id", F.round("ssim", 6).alias("ssim"))


def pooled_sql(pairs: str) -> str:
    return f"(SELECT image_id, y // 2 AS y, x // 2 AS x, avg(a) AS a, avg(b) AS b FROM {pairs} p GROUP BY ALL)"


@query("a06_ssim_pooled", ssim_sql("6.5025e0", "58.5225e0", pooled_sql("pairs"), 3, 1))
def a06_pooled(spark, d):
    """Averaged over blocks of two, as of images of more than 384 pixels a side, then windows of three."""
    return A.ssim(R.pairs(spark, d), 3, factor=2).select("image_id", F.round("ssim", 6).alias("ssim"))


@query("a07_ssim_squared_constants", ssim_sql("(0.0001e0 * 255) * (0.0001e0 * 255)", "(0.0009e0 * 255) * (0.0009e0 * 255)"))
def a07(spark, d):
    return A.ssim(R.pairs(spark, d), 5, k1=0.01**2, k2=0.03**2).select("image_id", F.round("ssim", 6).alias("ssim"))


@query("a08_feature_means", "SELECT vec_id % 2 AS part, CAST(i - 1 AS INT) AS i, round(avg(e), 9) AS mean FROM features GROUP BY ALL")
def a08(spark, d):
    f = R.features(spark, d).withColumn("part", c("vec_id") % 2)
    return A.moments(f, "part")[0].select("part", "i", F.round("mean", 9).alias("mean"))


@query("a08_feature_covariances", "SELECT f.vec_id % 2 AS part, CAST(f.i - 1 AS INT) AS i, CAST(g.i - 1 AS INT) AS j, round(covar_samp(f.e, g.e), 9) AS cov FROM features f JOIN features g ON g.vec_id = f.vec_id AND g.i >= f.i GROUP BY ALL")
def a08c(spark, d):
    f = R.features(spark, d).withColumn("part", c("vec_id") % 2)
    return A.moments(f, "part")[1].select("part", "i", "j", F.round("cov", 9).alias("cov"))


#: The second group is A x + 0.1 of the first, with A symmetric and positive (2 on the diagonal, a half beside it, around): such a map is the optimal one between
#: the two Gaussians, so the trace of the root is that of A C, the sum of the covariances of x and A x by dimension, at any width.
def frechet_sql(rel: str) -> str:
    return f"""WITH x AS MATERIALIZED (SELECT vec_id, i, e FROM {rel}), p AS (SELECT a.i, a.e, 2 * a.e + 0.5e0 * (b.e + c.e) + 0.1e0 AS y FROM x a JOIN x b ON b.vec_id = a.vec_id AND b.i = 1 + (a.i % 64) JOIN x c ON c.vec_id = a.vec_id AND c.i = 1 + ((a.i + 62) % 64))
SELECT 'mapped' AS pair, round(sum(d), 6) AS distance FROM (SELECT (avg(e) - avg(y)) * (avg(e) - avg(y)) + var_samp(e) + var_samp(y) - 2 * covar_samp(e, y) AS d FROM p GROUP BY i) q"""


def mapped_pair(features):
    """Both groups, all dimensions."""
    n = F.size("vec")
    beside = lambda i, by: F.get("vec", (i + by + n) % n)
    y = F.transform("vec", lambda v, i: 2 * v + 0.5 * (beside(i, 1) + beside(i, -1)) + 0.1)
    return features.select(F.explode(F.array(F.struct(F.lit("x").alias("part"), c("vec").alias("vec")), F.struct(F.lit("y").alias("part"), y.alias("vec")))).alias("p")).select("p.*")


def frechet_row(spark, pair, features, first, second):
    return spark.range(1).select(F.lit(pair).alias("pair"), F.lit(round(A.frechet_distance(features, "part", first, second), 6)).alias("distance"))


@query("a08_frechet_distance", frechet_sql("features"))
def a08d(spark, d):
    return frechet_row(spark, "mapped", mapped_pair(R.features(spark, d)), "x", "y")


@query("a08_frechet_groups")
def a08g(spark, d):
    """Vectors of even and of odd numbers, all dimensions: two covariances that don't commute, tested against numpy."""
    return frechet_row(spark, "even-odd", R.features(spark, d).withColumn("part", c("vec_id") % 2), 0, 1)


@query("a10_normalised_frechet", frechet_sql("(SELECT vec_id, i, e / sqrt(sum(e * e) OVER (PARTITION BY vec_id)) AS e FROM features)"))
def a10(spark, d):
    """The same distance over features of length one, as of a text-image model; the model is the caller's, its features are a column."""
    return frechet_row(spark, "mapped", mapped_pair(R.features(spark, d).withColumn("vec", A.unit(c("vec")))), "x", "y")


@query("a09_feature_diversity", "SELECT round(avg(d), 6) AS diversity, count(*) AS n FROM (SELECT f.vec_id, sum((f.e - g.e) * (f.e - g.e)) AS d FROM features f JOIN features g ON g.vec_id = f.vec_id + 1 AND g.i = f.i WHERE f.vec_id % 2 = 0 GROUP BY f.vec_id) q")
def a09(spark, d):
    f = R.features(spark, d)
    two = f.filter("vec_id % 2 = 0").join(f.select((c("vec_id") - 1).alias("vec_id"), c("vec").alias("other")), "vec_id")
    return two.select(A.path_length(c("vec"), c("other"), 1.0).alias("d")).agg(F.round(F.avg("d"), 6).alias("diversity"), F.count("*").alias("n"))


@query("a11_path_length_trimmed", """WITH q AS (SELECT f.vec_id, round(sum((f.e - g.e) * (f.e - g.e)) / 1e-4, 6) AS v FROM features f JOIN features g ON g.vec_id = f.vec_id + 1 AND g.i = f.i GROUP BY f.vec_id),
 b AS (SELECT min(v) AS lo, max(v) AS hi FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r, count(*) OVER () AS n FROM q) z WHERE r IN (floor(0.01e0 * (n - 1)), ceil(0.99e0 * (n - 1))))
SELECT count(*) AS n, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std FROM q, b WHERE v >= lo AND v <= hi""")
def a11(spark, d):
    f = R.features(spark, d)
    two = f.join(f.select((c("vec_id") - 1).alias("vec_id"), c("vec").alias("other")), "vec_id")
    t = A.trimmed(two.select(F.round(A.path_length(c("vec"), c("other"), 1e-2), 6).alias("v")), "v", 0.01, 0.99)
    return t.select("n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query("a12_mean_oks", f"""WITH o AS (SELECT image_id, det_id, avg(CASE WHEN v > 0 THEN exp(-(CAST((det_id % 7) * (det_id % 7) + ((k + det_id) % 5) * ((k + det_id) % 5) AS DOUBLE) / {SIGMA2}[k + 1] / (CAST((x1 - x0) * (y1 - y0) AS DOUBLE) + 2.220446049250313e-16) / 2)) END) AS oks
 FROM (SELECT * REPLACE (CASE WHEN det_id % 7 <> 0 THEN v ELSE 0 END AS v) FROM kps) k GROUP BY image_id, det_id)
SELECT kind, round(avg(oks), 6) AS mean, count(oks) AS n FROM boxes JOIN o USING (image_id, det_id) GROUP BY kind""")
def a12(spark, d):
    """Every seventh detection has no visible joint, so no similarity."""
    def similarity(kps, det_id, *box):
        x, y, v = lists.fields(kps, "x", "y", "v")
        truth = lists.relisted(kps, x=x, y=y, v=pc.if_else(pa.array((np.asarray(det_id) % 7 != 0)[lists.parents(kps)]), v, 0))
        return K.similarities(shaken(kps, det_id), truth, box_area(*box))

    m = A.mean_of_present(R.boxes(spark, d).withColumn("oks", R.of_keypoints(similarity, "double")), "kind", c("oks"))
    return m.select("kind", F.round("mean", 6).alias("mean"), "n")


@query("a13_match_counters", "SELECT count(*) AS instances, count(*) FILTER (score > 0.5) AS matched, count(*) FILTER (score <= 0.5 AND kind = 'face') AS filtered FROM boxes")
def a13(spark, d):
    return A.counters(R.boxes(spark, d), matched=c("score") > 0.5, filtered=(c("score") <= 0.5) & (c("kind") == "face"))


@query("a14_box_statistics", "SELECT kind, round(avg(sqrt((x1 - x0) * (y1 - y0))), 6) AS mean_side, round(avg(x1 - x0), 6) AS mean_w, round(avg(y1 - y0), 6) AS mean_h, round(avg(CASE WHEN x1 - x0 > 160 AND y1 - y0 > 288 THEN 1.0 ELSE 0.0 END), 6) AS share_large FROM boxes GROUP BY kind")
def a14(spark, d):
    w, h = c("x1") - c("x0"), c("y1") - c("y0")
    large = F.when((w > 160) & (h > 288), 1.0).otherwise(0.0)
    return R.boxes(spark, d).groupBy("kind").agg(F.round(F.avg(F.sqrt(w * h)), 6).alias("mean_side"), F.round(F.avg(w), 6).alias("mean_w"), F.round(F.avg(h), 6).alias("mean_h"), F.round(F.avg(large), 6).alias("share_large"))


@query("a15_boxes_per_frame", "SELECT image_id, count(*) AS n, count(*) + 1 AS n_strict, string_agg(CAST(x0 AS VARCHAR), ',' ORDER BY det_id) AS xs, CAST(arg_min(x0, det_id) AS VARCHAR) || ',' || string_agg(CAST(x0 AS VARCHAR), ',' ORDER BY det_id) AS xs_strict FROM boxes GROUP BY image_id")
def a15(spark, d):
    """The boxes of a frame in order, plain and with the first one twice."""
    one = lambda strict: A.boxes_per_frame(R.boxes(spark, d), "image_id", "det_id", ["x0"], strict)
    text = F.array_join(F.transform("boxes", lambda p: p["x0"].cast("string")), ",")
    plain, strict = one(False).select("image_id", F.size("boxes").cast("long").alias("n"), text.alias("xs")), one(True).select("image_id", F.size("boxes").cast("long").alias("n_strict"), text.alias("xs_strict"))
    return plain.join(strict, "image_id")


@query("a16_running_average", "SELECT user_id, round(list_reduce(list(value ORDER BY ts, event_id), lambda a, x: a * 0.9e0 + x * 0.1e0), 6) AS ema FROM (SELECT user_id, ts, event_id, value FROM events UNION ALL SELECT user_id, ts, -1, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1) q GROUP BY user_id")
def a16(spark, d):
    e = A.ema(R.table(spark, d, "events"), "user_id", ["ts", "event_id"], "value", 0.9)
    return e.select("user_id", F.round("ema", 6).alias("ema"))


@query("a17_lloyd_step", """WITH t AS (SELECT vec_id AS entry, i, e FROM features WHERE vec_id < 10), q AS (SELECT f.vec_id, t.entry, round(sum((f.e - t.e) * (f.e - t.e)), 9) AS dist FROM features f JOIN t USING (i) GROUP BY f.vec_id, t.entry),
 n AS (SELECT vec_id, entry FROM q QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, entry) = 1)
SELECT n.entry, CAST(f.i - 1 AS INT) AS i, round(avg(f.e), 9) AS value, count(*) AS n FROM features f JOIN n USING (vec_id) GROUP BY ALL""")
def a17(spark, d):
    f = R.features(spark, d)
    start = [r["vec"] for r in f.filter("vec_id < 10").orderBy("vec_id").collect()]
    new, n, _ = A.lloyd_step(f, np.array(start))
    rows = spark.createDataFrame([(k, v.tolist(), int(m)) for k, (v, m) in enumerate(zip(new, n, strict=True)) if m], "entry long, vec array<double>, n long")
    return rows.select("entry", F.posexplode("vec").alias("i", "value"), "n").select("entry", "i", F.round("value", 9).alias("value"), "n")


@query("a17_k_means")
def a17_all(spark, d):
    """Centres from seeds to convergence: how many, how many vectors, and the objective."""
    centres, n, cost, rounds = A.k_means(R.features(spark, d), 16)
    return spark.createDataFrame([(len(centres), int(n.sum()), round(cost, 6), rounds)], "centres long, vectors long, objective double, rounds long")


@query("a18_standardise", "SELECT CAST(i - 1 AS INT) AS i, round(avg(e), 9) AS mean, round(1 / sqrt(var_pop(e)), 6) AS rstd FROM features GROUP BY i")
def a18(spark, d):
    return A.standardise_stats(R.features(spark, d)).select("i", F.round("mean", 9).alias("mean"), F.round("rstd", 6).alias("rstd"))


@query("a19_status_counters", "SELECT CASE WHEN score < 0.1 THEN 'no_region' WHEN score > 0.95 THEN 'error_passthrough' ELSE 'ok' END AS status, count(*) AS n FROM boxes GROUP BY ALL")
def a19(spark, d):
    status = F.when(c("score") < 0.1, "no_region").when(c("score") > 0.95, "error_passthrough").otherwise("ok")
    return A.status_counts(R.boxes(spark, d), status)


@query("a20_metric_report", "SELECT image_id, round(avg(((a - b) / 255.0) * ((a - b) / 255.0)), 9) AS mse, round(avg(abs(a - b)), 9) AS age FROM pairs GROUP BY image_id")
def a20(spark, d):
    r = A.report(R.pairs(spark, d), ["mse", "age"])
    return r.select("image_id", F.round("mse", 9).alias("mse"), F.round("age", 9).alias("age"))


@query("a21_distributed_reduce", "SELECT CAST(sum(v) AS BIGINT) AS total, count(*) AS n, count(DISTINCT image_id) AS images FROM pixels")
def a21(spark, d):
    per = R.pixels(spark, d).groupBy("image_id").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    return per.agg(F.sum("s").alias("total"), F.sum("n").alias("n"), F.count("*").alias("images"))


@query("a22_spherical_distance", """WITH n AS (SELECT vec_id, i, e / sqrt(sum(e * e) OVER (PARTITION BY vec_id)) AS u FROM features)
SELECT a.vec_id, round(2 * asin(sqrt(sum((a.u - b.u) * (a.u - b.u))) / 2) * asin(sqrt(sum((a.u - b.u) * (a.u - b.u))) / 2), 6) AS distance FROM n a JOIN n b ON b.vec_id = a.vec_id + 1 AND b.i = a.i GROUP BY a.vec_id""")
def a22(spark, d):
    f = R.features(spark, d)
    two = f.join(f.select((c("vec_id") - 1).alias("vec_id"), c("vec").alias("other")), "vec_id")
    return two.select("vec_id", F.round(A.spherical(c("vec"), c("other")), 6).alias("distance"))


# ---- latent vectors


@query("l01_seeded_normals")
def l01(spark, d):
    return R.features(spark, d).select("vec_id", F.get(L.normals(8)("vec_id"), F.lit(0)).alias("z0"))


@query("l02_truncate", "SELECT f.vec_id, round(sum((m.mean + (f.e - m.mean) * 0.7e0) * f.i), 6) AS weighted FROM features f JOIN (SELECT i, avg(e) AS mean FROM features GROUP BY i) m USING (i) GROUP BY f.vec_id")
def l02(spark, d):
    f = R.features(spark, d)
    mean = A.standardise_stats(f).agg(F.sort_array(F.collect_list(F.struct("i", "mean"))).alias("m")).select(F.transform("m", lambda m: m["mean"]).alias("centre"), F.lit(1).alias("one"))
    w = f.withColumn("one", F.lit(1)).join(F.broadcast(mean), "one").withColumn("w", L.truncate(c("vec"), c("centre"), F.lit(0.7)))
    return w.select("vec_id", F.round(F.aggregate(F.transform("w", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("weighted"))


@query("l03_multi_modal_truncate", "SELECT f.vec_id, round(sum((t.e + (f.e - t.e) * 0.5e0) * f.i), 6) AS weighted FROM features f JOIN features t ON t.vec_id = f.vec_id % 10 AND t.i = f.i GROUP BY f.vec_id")
def l03(spark, d):
    f = R.features(spark, d)
    centres = f.filter("vec_id < 10").select(c("vec_id").alias("centre"), "vec")
    w = L.multi_modal(f.select("vec_id", c("vec_id").alias("z_idx"), c("vec").alias("w")), centres, 10, 0.5)
    return w.select("vec_id", F.round(F.aggregate(F.transform("w", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("weighted"))


@query("l04_truncated_normals")
def l04(spark, d):
    z = R.features(spark, d).select("vec_id", L.normals(16, 1.0)("vec_id").alias("z"))
    return z.select("vec_id", (F.array_max(F.transform("z", F.abs)) < 1.0).alias("within"))


@query("l05_track_identity", "SELECT user_id AS video_id, count(*) AS n, count(DISTINCT event_type) AS identities FROM events GROUP BY user_id")
def l05(spark, d):
    """As many identities as tracks, however many frames."""
    e = R.table(spark, d, "events").withColumn("seed", L.track_seed(c("user_id"), c("event_type")))
    return e.groupBy(c("user_id").alias("video_id")).agg(F.count("*").alias("n"), F.count_distinct("seed").alias("identities"))


@query("l06_detection_cache", "SELECT doc_id, md5(text) AS digest, (doc_id > min(doc_id) OVER (PARTITION BY md5(text))) AS cached FROM documents")
def l06(spark, d):
    rows = R.table(spark, d, "documents").select(c("doc_id").alias("image_id"), c("text").alias("data"))
    first = rows.groupBy(F.md5("data").alias("digest")).agg(F.min("image_id").alias("first"))
    known = L.reuse_detections(rows, first)
    return known.join(first, "digest").select(c("image_id").alias("doc_id"), "digest", (c("cached") & (c("image_id") > c("first"))).alias("cached"))


@query("l07_frame_index", "SELECT a.event_id AS image_id, count(*) AS frame_no FROM events a JOIN events b ON b.user_id = a.user_id AND (b.ts < a.ts OR (b.ts = a.ts AND b.event_id <= a.event_id)) GROUP BY a.event_id")
def l07(spark, d):
    e = R.table(spark, d, "events").select(c("user_id").alias("video_id"), "ts", c("event_id").alias("image_id"))
    return L.frame_index(e, "video_id", ["ts", "image_id"]).select("image_id", "frame_no")


@query("l08_latest_frame_per_tick", "SELECT user_id AS video_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS tick, arg_max(event_id, {'t': ts, 'e': event_id}) AS image_id, count(*) - 1 AS dropped FROM events GROUP BY ALL")
def l08(spark, d):
    from ..streaming.frames import latest_per_tick

    return latest_per_tick(R.table(spark, d, "events").select(c("user_id").alias("video_id"), "ts", c("event_id").alias("image_id")), 3600)


@query("l09_frame_rate", "SELECT video_id, round(count(*) / greatest(1.0, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS DOUBLE)), 9) AS fps FROM frames GROUP BY video_id")
def l09(spark, d):
    span = F.max(F.unix_timestamp("ts")) - F.min(F.unix_timestamp("ts"))
    return R.frames(spark, d).groupBy("video_id").agg(F.round(F.count("*") / F.greatest(F.lit(1.0), span.cast("double")), 9).alias("fps"))


@query("l10_guidance", "SELECT f.vec_id, round(sum(((1 - 4.0e0) * f.e + 4.0e0 * g.e) * f.i), 6) AS guided, round(sum(((1 - 1.25e0) * f.e + 1.25e0 * g.e) * f.i), 6) AS nulled FROM features f JOIN features g ON g.vec_id = f.vec_id + 1 AND g.i = f.i GROUP BY f.vec_id")
def l10(spark, d):
    f = R.features(spark, d)
    two = f.join(f.select((c("vec_id") - 1).alias("vec_id"), c("vec").alias("other")), "vec_id")
    weigh = lambda v: F.round(F.aggregate(F.transform(v, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6)
    return two.select("vec_id", weigh(L.guide(c("vec"), c("other"), 4.0)).alias("guided"), weigh(L.nullify(c("vec"), c("other"), 1.25)).alias("nulled"))


@query("l11_text_direction", "SELECT f.vec_id, round(sum((f.e + t.e * 0.3e0) * f.i), 6) AS moved FROM features f JOIN features t ON t.vec_id = 0 AND t.i = f.i GROUP BY f.vec_id")
def l11(spark, d):
    f = R.features(spark, d).withColumn("one", F.lit(1))
    way = F.broadcast(f.filter("vec_id = 0").limit(1).select("one", c("vec").alias("direction")))
    moved = f.join(way, "one").withColumn("m", L.add_direction(c("vec"), c("direction"), 0.3))
    return moved.select("vec_id", F.round(F.aggregate(F.transform("m", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("moved"))


