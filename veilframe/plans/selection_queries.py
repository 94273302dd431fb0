"""Queries of filters, orders, limits and sets (F1-F16)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions import relations as R
from ..functions.registry import query
from ..operators import geometry as G
from ..operators import selection as S
from ..sources import scan
from ..operators.fusion import Fusion
from . import anonymize

c = F.col
ID = ("image_id", "det_id")


@query("f01_score_threshold", "SELECT image_id, det_id, score FROM boxes WHERE score >= 0.3")
def f01(spark, d):
    return R.boxes(spark, d).filter(c("score") >= 0.3).select(*ID, "score")


@query("f02_class_filter", "SELECT image_id, det_id, kind FROM boxes WHERE kind IN ('face', 'vehicle')")
def f02(spark, d):
    return R.boxes(spark, d).filter(c("kind").isin("face", "vehicle")).select(*ID, "kind")


@query("f03_annotation_filter", "SELECT image_id, det_id FROM boxes WHERE det_id % 5 <> 0 AND det_id % 7 <> 0 AND kind_rank = 2")
def f03(spark, d):
    flags = R.boxes(spark, d).withColumns({"iscrowd": (c("det_id") % 5 == 0).cast("int"), "ignore": (c("det_id") % 7 == 0).cast("int"), "category_id": c("kind_rank")})
    return flags.filter(S.usable_annotations(2)).select(*ID)


@query("f04_non_degenerate", "SELECT image_id, det_id FROM boxes WHERE x1 - det_id % 40 > x0 AND y1 - det_id % 60 > y0")
def f04(spark, d):
    return R.boxes(spark, d).withColumns({"x1": c("x1") - c("det_id") % 40, "y1": c("y1") - c("det_id") % 60}).filter(S.non_degenerate()).select(*ID)


@query("f05_refine_minimum", "SELECT image_id, det_id FROM (SELECT *, floor(greatest(x1 - x0, y1 - y0) * 1.7e0 / 2.0) AS r FROM boxes) q WHERE (2 * r) * (2 * r) >= 16384")
def f05(spark, d):
    s = R.boxes(spark, d).withColumns(G.expand_simple(0.7))
    return s.filter((c("sx1") - c("sx0")) * (c("sy1") - c("sy0")) >= 128 * 128).select(*ID)


@query("f06_area_rank", "SELECT image_id, det_id, row_number() OVER (PARTITION BY image_id ORDER BY (x1 - x0) * (y1 - y0), det_id) AS rising, row_number() OVER (PARTITION BY image_id ORDER BY (x1 - x0) * (y1 - y0) DESC, det_id) AS falling FROM boxes")
def f06(spark, d):
    up = S.area_rank(R.boxes(spark, d)).withColumnRenamed("area_rank", "rising")
    return S.area_rank(up, True).select(*ID, c("rising").cast("long"), c("area_rank").cast("long").alias("falling"))


@query("f07_paste_order", "SELECT image_id, det_id, row_number() OVER (PARTITION BY image_id ORDER BY CASE kind WHEN 'face' THEN 0 WHEN 'vehicle' THEN 1 WHEN 'person' THEN 2 ELSE 3 END, CASE WHEN kind = 'vehicle' THEN -((x1 - x0) * (y1 - y0)) ELSE (x1 - x0) * (y1 - y0) END, det_id) AS paste_order FROM boxes")
def f07(spark, d):
    return anonymize.paste_order(R.boxes(spark, d)).select(*ID, c("paste_order").cast("long"))


@query("f08_head_limit", "SELECT image_id, det_id FROM boxes ORDER BY image_id, det_id LIMIT 800")
def f08(spark, d):
    return R.boxes(spark, d).orderBy(*ID).limit(800).select(*ID)


@query("f09_batches", "SELECT image_id, det_id, CAST(floor((row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1) / 4.0) AS BIGINT) + 1 AS batch_no, CAST(ceil(count(*) OVER (PARTITION BY image_id) / 4.0) AS BIGINT) AS n_batches FROM boxes")
def f09(spark, d):
    return S.batches(R.boxes(spark, d), "image_id", ["det_id"], 4).select(*ID, "batch_no", "n_batches")


@query("f10_percentile_trim", "WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS r, count(*) OVER () AS n FROM events) z WHERE r IN (floor(0.05e0 * (n - 1)), ceil(0.95e0 * (n - 1)))) SELECT count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events, b WHERE value >= lo AND value <= hi")
def f10(spark, d):
    from ..operators.metrics import trimmed

    t = trimmed(R.table(spark, d, "events").select("value"), "value", 0.05, 0.95)
    return t.select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("f11_union_kinds", "SELECT image_id, det_id, kind FROM boxes")
def f11(spark, d):
    b = R.boxes(spark, d).select(*ID, "kind")
    parts = [b.filter(c("kind") == k) for k in anonymize.KIND_RANK]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@query("f12_set_difference", "SELECT vec_id FROM embeddings EXCEPT SELECT event_id FROM events WHERE event_id % 3 = 0")
def f12(spark, d):
    return R.table(spark, d, "embeddings").select("vec_id").subtract(R.table(spark, d, "events").filter("event_id % 3 = 0").select(c("event_id").alias("vec_id")))


@query("f13_trim_and_rejoin", "SELECT video_id, frame_no, frame_no >= 10 AND frame_no < 40 AS handled FROM frames")
def f13(spark, d):
    inside, rest = S.trim(R.frames(spark, d), 10, 40, c("frame_no"))
    return inside.withColumn("handled", F.lit(True)).unionByName(rest.withColumn("handled", F.lit(False))).select("video_id", "frame_no", "handled")


@query("f14_resample", "SELECT video_id, image_id FROM frames QUALIFY row_number() OVER (PARTITION BY video_id, floor(epoch_us(ts) / 1e6 * 0.0001e0) ORDER BY ts, image_id) = 1")
def f14(spark, d):
    return S.resample(R.frames(spark, d), 0.0001).select("video_id", "image_id")


@query("f15_update_identity", "SELECT b.image_id, b.det_id FROM boxes b WHERE NOT (b.score < 0.1)")
def f15(spark, d):
    b = R.boxes(spark, d)
    skip = b.filter("score < 0.1").select(*ID)
    return b.join(skip, list(ID), "left_anti").select(*ID)


@query("f16_index_before_filter", "SELECT image_id, det_id, idx FROM (SELECT image_id, det_id, score, row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS idx FROM boxes WHERE kind_rank = 0) q WHERE score < 0.8")
def f16(spark, d):
    return S.index_before_filter(R.boxes(spark, d).filter("kind_rank = 0"), "image_id", ["det_id"], c("score") < 0.8).select(*ID, "idx")


# ---- scans


URLS = "SELECT page_id, path, regexp_extract(path, '\\.([^./]+)$', 1) AS s FROM files"


@query("s01_image_suffixes", f"SELECT page_id, s IN ('jpg','jpeg','png','bmp','tiff','JPG','JPEG','PNG','BMP','TIFF') AS image FROM ({URLS}) q")
def s01(spark, d):
    return R.files(spark, d).select("page_id", scan.is_image(c("path")).alias("image"))


@query("s02_any_case_suffix", f"SELECT page_id FROM ({URLS}) q WHERE lower(s) IN ('jpg','jpeg','png','bmp','tiff')")
def s02(spark, d):
    return R.files(spark, d).filter(scan.is_image(c("path"), any_case=True)).select("page_id")


@query("s03_suffix_set", f"SELECT page_id FROM ({URLS}) q WHERE s IN ('html', 'jpg')")
def s03(spark, d):
    return R.files(spark, d).filter(scan.suffix(c("path")).isin("html", "jpg")).select("page_id")


@query("s04_mirror_path", "SELECT page_id, '/out/' || substr(replace(path, '://', '/'), strpos(replace(path, '://', '/'), '/') + 1) AS target FROM files")
def s04(spark, d):
    rows = R.files(spark, d).withColumn("p", F.concat(F.lit("/in/"), F.regexp_replace("path", "^[^:]*://", "")))
    return rows.select("page_id", scan.mirror_path(c("p"), "/in", "/out").alias("target"))


@query("s05_file_kind", f"SELECT page_id, CASE WHEN lower(s) IN ('jpg','jpeg','png','bmp','tiff') THEN 'image' WHEN lower(s) = 'mp4' THEN 'video' ELSE 'other' END AS kind FROM ({URLS}) q")
def s05(spark, d):
    return R.files(spark, d).select("page_id", scan.file_kind(c("path")).alias("kind"))


STEMS = "SELECT page_id, path, regexp_extract(path, '([^/]*?)(\\.[^./]*)?$', 1) AS stem FROM files"


@query("s06_natural_order", f"SELECT page_id, row_number() OVER (ORDER BY regexp_extract(stem, '^(.*?)([0-9]*)$', 1), coalesce(TRY_CAST('0' || regexp_extract(stem, '([0-9]*)$', 1) AS BIGINT), 0), path, page_id) - 1 AS pos FROM ({STEMS}) q")
def s06(spark, d):
    rows = R.files(spark, d).withColumn("k", scan.natural_key(c("path")))
    return scan.positions(rows, [c("k")["text"], c("k")["number"], c("k")["path"], c("page_id")]).select("page_id", "pos")


#: Where a pixel of the upright image lies in the stored one, by orientation.
_TURNS = ((1, "y", "x"), (2, "y", "7 - x"), (3, "7 - y", "7 - x"), (4, "7 - y", "x"), (5, "x", "y"), (6, "7 - x", "y"), (7, "7 - x", "7 - y"), (8, "x", "7 - y"))
_UPRIGHT = " UNION ALL ".join(f"SELECT image_id, y, x, {sy} AS sy, {sx} AS sx FROM pixels WHERE image_id % 8 + 1 = {o}" for o, sy, sx in _TURNS)


@query("s07_upright", f"SELECT u.image_id, u.y, u.x, p.v FROM ({_UPRIGHT}) u JOIN pixels p ON p.image_id = u.image_id AND p.y = u.sy AND p.x = u.sx")
def s07(spark, d):
    """Images whose orientation is read from an EXIF block and undone."""
    from ..sources import formats

    @F.pandas_udf("array<int>")
    def upright(image_id: pd.Series, px: pd.Series) -> pd.Series:
        out = []
        for i, p in zip(image_id, px, strict=True):
            turn = formats.exif_orientation(formats.exif_block(int(i) % 8 + 1))
            out.append(formats.orient(np.reshape(p, (8, 8)), turn).ravel().astype(np.int32))
        return pd.Series(out)

    rows = R.images(spark, d).select("image_id", F.posexplode(upright("image_id", "px")).alias("at", "v"))
    return rows.select("image_id", F.floor(c("at") / 8).cast("long").alias("y"), (c("at") % 8).cast("long").alias("x"), c("v").cast("long").alias("v"))


@query("s08_parse_yolo", "SELECT image_id, det_id, round(xc, 9) AS xc, round(yc, 9) AS yc, round(w, 9) AS w, round(h, 9) AS h FROM yolo")
def s08(spark, d):
    line = F.concat_ws(" ", c("kind_rank").cast("string"), *[c(n).cast("string") for n in ("xc", "yc", "w", "h")])
    return R.yolo(spark, d).select(*ID, line.alias("line")).select(*ID, *scan.parse_yolo(c("line"))).select(*ID, *[F.round(n, 9).alias(n) for n in ("xc", "yc", "w", "h")])


@query("s09_parse_polygon", """SELECT image_id, det_id, 3 + det_id % 3 AS n, x0 + det_id % 5 AS first_x, CASE det_id % 3 WHEN 2 THEN y0 + 9 ELSE y1 END AS last_y,
 2 * x1 + x0 + 2 * (det_id % 5) + CASE det_id % 3 WHEN 0 THEN 0 WHEN 1 THEN x0 ELSE 2 * x0 + 7 END AS sum_x FROM boxes""")
def s09(spark, d):
    """Polygons of three to five corners, by spaces or by commas."""
    s = c("det_id") % 5
    values = [c("x0") + s, c("y0"), c("x1") + s, c("y0"), c("x1"), c("y1"), c("x0"), c("y1"), c("x0") + 7, c("y0") + 9]
    some = F.slice(F.array(*[v.cast("string") for v in values]), F.lit(1), (6 + 2 * (c("det_id") % 3)).cast("int"))
    line = F.concat(F.when(c("det_id") % 2 == 0, F.array_join(some, ",")).otherwise(F.array_join(some, " ")), F.lit("##text 1 2"))
    p = R.boxes(spark, d).withColumn("p", scan.parse_polygon(line))
    xs = F.aggregate("p", F.lit(0).cast("long"), lambda a, q: a + q["x"])
    return p.select(*ID, F.size("p").cast("long").alias("n"), F.get("p", F.lit(0))["x"].cast("long").alias("first_x"), F.get("p", F.size("p") - 1)["y"].cast("long").alias("last_y"), xs.alias("sum_x"))


@query("s10_training_triples", "SELECT event_id, 's' || user_id || '-' || 'c' || event_type AS key FROM events")
def s10(spark, d):
    e = R.table(spark, d, "events")
    text = F.to_json(F.struct(F.concat(F.lit("s"), "user_id").alias("source_image"), F.concat(F.lit("c"), "event_type").alias("conditioning_image")))
    row = F.from_json(text, "source_image string, conditioning_image string, ground_truth string")
    return e.select("event_id", row.alias("r")).select("event_id", F.concat_ws("-", c("r")["source_image"], c("r")["conditioning_image"]).alias("key"))


@query("s11_detection_json", "SELECT CAST(image_id AS VARCHAR) AS image_id, CAST(row_number() OVER (PARTITION BY image_id ORDER BY det_id) - 1 AS INT) AS pos, CAST(x0 AS DOUBLE) AS x0, CAST(y1 AS DOUBLE) AS y1, CAST(det_id % 17 AS INT) AS keypoint_index FROM boxes WHERE kind = 'face'")
def s11(spark, d):
    b = R.boxes(spark, d).filter("kind = 'face'").withColumn("b", F.array(*[c(n).cast("double") for n in G.COORDS]))
    g = b.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("det_id", "b"))).alias("v"))
    doc = F.struct(F.transform("v", lambda v: v["b"]).alias("boxes"), F.transform("v", lambda v: (v["det_id"] % 17).cast("int")).alias("keypoint_indices"))
    rows = g.select(F.to_json(F.create_map(c("image_id").cast("string"), doc)).alias("value"))
    return scan.detection_rows(rows).select("image_id", "pos", "x0", "y1", "keypoint_index")


@query("s12_mask_decode", "SELECT image_id, count(*) FILTER (v >= 128) AS area, CAST(coalesce(sum(8 * y + x) FILTER (v >= 128), 0) AS BIGINT) AS places, 12 AS polygon_area FROM pixels GROUP BY image_id")
def s12(spark, d):
    """Masks as run lengths, column by column, plain and as text, and as polygons, decoded to bits."""
    from ..operators import masks as M

    @F.pandas_udf("struct<area: bigint, places: bigint, polygon_area: int>")
    def decode(px: pd.Series) -> pd.DataFrame:
        rows = []
        for p in px:
            runs = M.encode_runs(np.reshape(p, (8, 8)) >= 128)
            plain, text = M.decode_mask({"size": [8, 8], "counts": runs}, 8, 8), M.decode_mask({"size": [8, 8], "counts": M.runs_to_text(runs)}, 8, 8)
            both = plain & text
            rows.append((int(both.sum()), int(np.flatnonzero(both).sum()), int(M.decode_mask([[1, 1, 4, 1, 4, 3, 1, 3]], 8, 8).sum())))
        return pd.DataFrame(rows, columns=["area", "places", "polygon_area"])

    return R.images(spark, d).select("image_id", decode("px").alias("m")).select("image_id", "m.*")


@query("s13_images_with_persons", "SELECT f.image_id, b.det_id FROM (SELECT DISTINCT image_id FROM boxes) f LEFT JOIN (SELECT * FROM boxes WHERE det_id % 5 <> 0 AND kind_rank = 0 AND score > 0.9) b USING (image_id)")
def s13(spark, d):
    b = R.boxes(spark, d)
    ann = b.withColumns({"iscrowd": ((c("det_id") % 5 == 0) | (c("score") <= 0.9)).cast("int"), "category_id": c("kind_rank")})
    return scan.with_persons(b.select("image_id").distinct(), ann).select("image_id", "det_id")


@query("s14_tar_shards", "SELECT image_id, image_id % 5 AS label, CAST(sum(v * (8 * y + x + 1)) AS BIGINT) AS weighted FROM pixels GROUP BY image_id")
def s14(spark, d):
    """Images written to tar shards as PNG with a text beside, read back by byte ranges and decoded by suffix."""
    from ..functions.storage import scratch
    from ..sources import formats, sinks, tar_source

    images = R.images(spark, d)
    # a task holds one shard, so there are more of them where there are more images
    count = max(7, -(-images.count() // 5_000))
    shards = formats.write_tar(images.select(c("image_id").cast("string").alias("key"), formats.png_of("px", 8, 8).alias("png"), (c("image_id") % 5).cast("string").alias("cls")), count)
    at = scratch(spark, "tar")
    sinks.write_files(shards, at, "path", "content").write.format("noop").mode("overwrite").save()
    members = tar_source.tar_members(spark, at, 32 << 10)
    images, labels = tar_source.decoded_members(members, "png"), tar_source.decoded_members(members, "cls")
    weighted = F.aggregate(F.transform(c("value")["px"], lambda v, i: v * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    both = images.select("key", weighted.alias("weighted")).join(labels.select("key", c("value").alias("label")), "key")
    return both.select(c("key").cast("long").alias("image_id"), "label", "weighted")


@query("s15_positional_zip", "SELECT a.vec_id, b.page_id FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings) a JOIN (SELECT page_id, row_number() OVER (ORDER BY page_id DESC) AS r FROM pages) b USING (r)")
def s15(spark, d):
    a, b = R.table(spark, d, "embeddings").select("vec_id"), R.table(spark, d, "pages").select("page_id")
    return scan.zip_positions(a, [c("vec_id")], b, [c("page_id").desc()]).select("vec_id", "page_id")


@query("s16_head_share", "SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS r, count(*) OVER () AS n FROM events) q WHERE r <= greatest(1, CAST(floor(n * 0.15e0) AS BIGINT))")
def s16(spark, d):
    return scan.head_share(R.table(spark, d, "events"), [c("ts"), c("event_id")], 0.15).select("event_id")


@query("s17_exclusion_list", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def s17(spark, d):
    out = R.table(spark, d, "labels").filter("quality = 0").select(c("doc_id").alias("event_id"))
    return R.table(spark, d, "events").join(out, "event_id", "left_anti").select("event_id")


@query("s18_zip_limited", "SELECT a.event_id, b.doc_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS r FROM events) a JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS r FROM documents) b USING (r) WHERE r <= 800")
def s18(spark, d):
    a, b = R.table(spark, d, "events").select("event_id"), R.table(spark, d, "documents").select("doc_id")
    return scan.zip_positions(a, [c("event_id")], b, [c("doc_id").desc()], 800).select("event_id", "doc_id")


@query("s19_match_names", "SELECT l.doc_id, l.quality, d.lang FROM labels l JOIN documents d USING (doc_id)")
def s19(spark, d):
    return scan.match_names(R.table(spark, d, "labels").select("doc_id", "quality"), R.table(spark, d, "documents").select("doc_id", "lang"), "doc_id")


@query("s20_mask_path", "SELECT page_id, regexp_replace(path, '(\\.[^./]*)$', '_mask\\1') AS mask FROM files")
def s20(spark, d):
    return R.files(spark, d).select("page_id", scan.mask_path(c("path")).alias("mask"))


@query("s21_frame_metadata", "SELECT video_id, count(*) AS n_frames, min(ts) AS first_ts, max(ts) AS last_ts FROM frames GROUP BY video_id")
def s21(spark, d):
    return R.frames(spark, d).groupBy("video_id").agg(F.count("*").alias("n_frames"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("s22_frame_stream", """WITH n AS (SELECT ts, event_id, user_id, ntile(4) OVER (ORDER BY ts, event_id) AS file FROM events), f AS (SELECT file, count(*) AS n FROM n GROUP BY file)
SELECT user_id AS video_id, count(*) AS n, max(event_id) AS last, 3 AS dropped FROM n WHERE file = 4 GROUP BY user_id""")
def s22(spark, d):
    """Four files wait: one trigger reads the newest and passes over three."""
    from ..functions.storage import scratch
    from ..sources.live import latest_frames

    at = scratch(spark, "frames")
    rows = R.table(spark, d, "events").select(c("user_id").alias("video_id"), c("ts").cast("timestamp").alias("ts"), c("event_id").alias("image_id"))
    rows = scan.positions(rows, [c("ts"), c("image_id")])
    n = rows.count()
    # as ntile deals: the first files have a row more where four doesn't divide the count
    first = [k * (n // 4) + min(k, n % 4) for k in range(5)]
    for k in range(4):
        part = rows.filter((c("pos") >= first[k]) & (c("pos") < first[k + 1])).drop("pos")
        part.coalesce(1).write.parquet(f"{at}/batch-{k}")
    from ..sources.sinks import gather_files

    gather_files(spark, [f"{at}/batch-{k}" for k in range(4)], f"{at}/in")
    stream = latest_frames(spark, f"{at}/in", "video_id long, ts timestamp, image_id long").writeStream.format("parquet").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start(f"{at}/out")
    stream.awaitTermination()
    seen = spark.read.schema("video_id long, ts timestamp, image_id long, dropped long").parquet(f"{at}/out")
    return seen.groupBy("video_id").agg(F.count("*").alias("n"), F.max("image_id").alias("last"), F.max("dropped").alias("dropped"))


@query("s23_numeric_stem", f"SELECT page_id, TRY_CAST(NULLIF(regexp_extract(stem, '([0-9]+)$', 1), '') AS BIGINT) AS n FROM ({STEMS}) q")
def s23(spark, d):
    return R.files(spark, d).select("page_id", F.try_to_number(scan.stem(c("path")), F.lit("9" * 18)).cast("long").alias("n"))


# ---- sinks


NEW = "SELECT image_id, min(det_id) AS new FROM boxes WHERE score > 0.9 GROUP BY image_id"


def results(spark, d):
    """Every tenth image has no result row at all."""
    from ..sources import sinks

    images = R.boxes(spark, d).select("image_id").distinct().withColumn("orig", c("image_id"))
    b = R.boxes(spark, d).filter("image_id % 10 <> 0").groupBy("image_id").agg(F.min(F.when(c("score") > 0.9, c("det_id"))).alias("new"), F.when(F.min("score") > 0.05, F.lit("failed")).alias("error"))
    return sinks, images, b


STATUS = "SELECT image_id, image_id AS orig, image_id % 10 = 0 AS missing, min(det_id) FILTER (score > 0.9 AND image_id % 10 <> 0) AS new, CASE WHEN min(score) > 0.05 AND image_id % 10 <> 0 THEN 'failed' END AS error FROM boxes GROUP BY image_id"


@query("k01_detected_only", f"SELECT image_id, new AS out FROM ({STATUS}) q WHERE new IS NOT NULL")
def k01(spark, d):
    sinks, images, b = results(spark, d)
    return sinks.with_results(images, b, "image_id", "orig", F.lit(-1), "detected_only").select("image_id", "out")


@query("k02_untouched_frames", f"SELECT image_id, coalesce(new, orig) AS out FROM ({STATUS}) q")
def k02(spark, d):
    sinks, images, b = results(spark, d)
    return sinks.with_results(images, b, "image_id", "orig", F.lit(-1), "passthrough").select("image_id", "out")


@query("k03_status", f"SELECT image_id, CASE WHEN new IS NOT NULL THEN 'ok' WHEN error IS NOT NULL THEN 'error' WHEN missing THEN 'missing' ELSE 'no_region' END AS status, CASE WHEN new IS NOT NULL THEN new WHEN error IS NOT NULL OR missing THEN -1 ELSE orig END AS out FROM ({STATUS}) q")
def k03(spark, d):
    sinks, images, b = results(spark, d)
    return sinks.with_results(images, b, "image_id", "orig", F.lit(-1)).select("image_id", "status", "out")


@query("k04_skip_errors", f"SELECT image_id, coalesce(new, orig) AS out FROM ({STATUS}) q WHERE new IS NOT NULL OR (error IS NULL AND NOT missing)")
def k04(spark, d):
    sinks, images, b = results(spark, d)
    return sinks.with_results(images, b, "image_id", "orig", F.lit(-1), "skip_errors").select("image_id", "out")


@query("k05_resume", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents)")
def k05(spark, d):
    from ..sources import sinks

    done = R.table(spark, d, "documents").select(c("doc_id").alias("event_id"))
    return sinks.still_to_do(R.table(spark, d, "events").select("event_id"), done, "event_id")


@query("k06_side_by_side", "SELECT image_id, y, x, v FROM pixels UNION ALL SELECT image_id, y, x + 8, 255 - v FROM pixels")
def k06(spark, d):
    from ..operators.pixels import side_by_side

    p = R.pixels(spark, d)
    return side_by_side(p, p.withColumn("v", 255 - c("v")), 8)


@query("k07_png_round_trip", "SELECT image_id, CAST(sum(v * (8 * y + x + 1)) AS BIGINT) AS weighted, CAST(sum(255 - v) AS BIGINT) AS inverted FROM pixels GROUP BY image_id")
def k07(spark, d):
    """What is read back from the bytes of a grey and of a colour PNG."""
    from ..sources import formats

    @F.pandas_udf("struct<weighted: bigint, inverted: bigint>")
    def back(px: pd.Series) -> pd.DataFrame:
        rows = []
        for p in px:
            im = np.reshape(p, (8, 8)).astype(np.uint8)
            grey = formats.decode_png(formats.encode_png(im, 0))[:, :, 0].astype(np.int64)
            colour = formats.decode_png(formats.encode_png(np.stack([im, im, 255 - im], 2)))
            rows.append((int((grey.ravel() * np.arange(1, 65)).sum()), int(colour[:, :, 2].sum(dtype=np.int64))))
        return pd.DataFrame(rows, columns=["weighted", "inverted"])

    return R.images(spark, d).select("image_id", back("px").alias("b")).select("image_id", "b.*")


@query("k08_shard_numbers", """WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce(strlen(text), 0) AS size, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
 t AS MATERIALIZED (SELECT pos, size, CAST(sum(size) OVER (ORDER BY pos) AS BIGINT) AS upto FROM d), n AS MATERIALIZED (SELECT a.pos, least(a.pos + 30, coalesce(min(b.pos) + 1, 9223372036854775807)) AS next FROM t a LEFT JOIN t b ON b.upto >= a.upto - a.size + 50000 AND b.pos >= a.pos AND b.pos < a.pos + 30 GROUP BY a.pos),
 s AS (SELECT CAST(0 AS BIGINT) AS first, CAST(0 AS BIGINT) AS shard UNION ALL SELECT n.next, s.shard + 1 FROM s JOIN n ON n.pos = s.first),
 e AS (SELECT shard, first, lead(first, 1, 9223372036854775807) OVER (ORDER BY shard) AS stop FROM s)
SELECT d.doc_id, e.shard, z.size FROM d JOIN e ON d.pos >= e.first AND d.pos < e.stop, (VALUES (64), (128)) z(size)""")
def k08(spark, d):
    """Shards of at most 30 texts, closed once they have 50,000 bytes, fanned out to two resolutions."""
    from ..sources.shards import shard_numbers

    docs = R.table(spark, d, "documents").select("doc_id", F.octet_length("text").alias("n_bytes"))
    numbered = shard_numbers(docs, [c("doc_id")], c("n_bytes"), 50_000, 30, block=100, group=4)
    return numbered.select("doc_id", "shard", F.explode(F.array(F.lit(64), F.lit(128))).alias("size"))


@query("k09_result_map", "SELECT image_id, '[' || string_agg('[' || x0 || ',' || y0 || ',' || x1 || ',' || y1 || ']', ',' ORDER BY x0, y0, x1, y1) || ']' AS json FROM boxes WHERE kind = 'face' GROUP BY image_id")
def k09(spark, d):
    from ..sources import sinks

    return sinks.result_map(R.boxes(spark, d).filter("kind = 'face'"), "image_id", list(G.COORDS))


@query("k10_cache_key", "SELECT doc_id, md5(text) AS digest, count(*) OVER (PARTITION BY md5(text)) AS n_found FROM documents")
def k10(spark, d):
    """Detections are written by the digest of their image and found again by it."""
    from ..functions.storage import scratch
    from ..sources import sinks

    docs = R.table(spark, d, "documents").select("doc_id", F.md5("text").alias("digest"))
    path = scratch(spark, "detections")
    sinks.cache_detections(docs.groupBy("digest").agg(F.count("*").alias("n_found")), path)
    return docs.join(spark.read.parquet(path), "digest").select("doc_id", "digest", "n_found")


@query("k11_passthrough_union", f"SELECT image_id, new IS NOT NULL AS changed FROM ({STATUS}) q")
def k11(spark, d):
    sinks, images, b = results(spark, d)
    hit = b.filter("new is not null").select("image_id")
    return hit.withColumn("changed", F.lit(True)).unionByName(images.join(hit, "image_id", "left_anti").select("image_id", F.lit(False).alias("changed")))


@query("k12_label_text", "SELECT image_id, string_agg('0 ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1, chr(10) ORDER BY det_id) AS text FROM boxes GROUP BY image_id")
def k12(spark, d):
    from ..sources import sinks

    return sinks.label_lines(R.boxes(spark, d).withColumn("cls", F.lit(0)), "image_id", "det_id", ["cls", *G.COORDS])


# ---- kernels on whole images, and the whole plan


def kernel(name: str, f, width=8, sql: str | None = None):
    """A query that applies an image kernel to each 8x8 image: the first channel of the result, pixel by pixel. width: a number, or a
    function from the image's id column."""

    @query(name, sql)
    def run(spark, d):
        @F.pandas_udf("array<int>")
        def pixels(image_id: pd.Series, px: pd.Series) -> pd.Series:
            out = []
            for i, p in zip(image_id, px, strict=True):
                im = np.repeat(np.reshape(p, (8, 8, 1)), 3, axis=2).astype(np.uint8)
                out.append(np.ascontiguousarray(f(im, int(i))[:, :, 0]).ravel().astype(np.int32))
            return pd.Series(out)

        rows = R.images(spark, d).select("image_id", F.posexplode(pixels("image_id", "px")).alias("at", "v"))
        w = width(c("image_id")) if callable(width) else F.lit(width)
        return rows.select("image_id", F.floor(c("at") / w).cast("long").alias("y"), (c("at") % w).cast("long").alias("x"), c("v").cast("long").alias("v"))

    return run


def cubic_sql(sizes: str) -> str:
    """(n, o, t, s, w): weights of bicubic resampling from n to o cells, for the pairs (n, o)."""
    d = "abs(s - ((t + 0.5e0) * n / o - 0.5e0)) / greatest(1.0, n / CAST(o AS DOUBLE))"
    return f"""(SELECT n, o, t, s, w / sum(w) OVER (PARTITION BY n, o, t) AS w FROM (SELECT n, o, t, s, CASE WHEN d <= 1 THEN 1.5e0 * d * d * d - 2.5e0 * d * d + 1 WHEN d < 2 THEN -0.5e0 * d * d * d + 2.5e0 * d * d - 4 * d + 2 ELSE 0.0 END AS w
 FROM (SELECT *, {d} AS d FROM (SELECT *, unnest(range(0, n)) AS s FROM (SELECT *, unnest(range(0, o)) AS t FROM (VALUES {sizes}) z(n, o)) a) b) e) g)"""


def byte_sql(value: str) -> str:
    return f"CAST(least(255, greatest(0, round_even(round({value}, 6), 0))) AS BIGINT)"


def resized_sql(rel: str, n: str, rows: str, cols: str, weights: str) -> str:
    """rel(image_id, y, x, v) of n x n pixels resampled; n, rows and cols are expressions over the image's id."""
    return f"""(SELECT p.image_id, a.t AS y, b.t AS x, {byte_sql("sum(a.w * b.w * p.v)")} AS v FROM {rel} p JOIN {weights} a ON a.n = {n} AND a.o = {rows} AND a.s = p.y JOIN {weights} b ON b.n = {n} AND b.o = {cols} AND b.s = p.x GROUP BY p.image_id, a.t, b.t)"""


def warped_sql(rel: str, inverse: tuple[float, ...], fill: int) -> str:
    """The image at inverse * (x, y), linearly, with a value outside."""
    a, b, e, f, g, h = inverse
    at = f"(SELECT image_id, y, x, {a}e0 * x + {b}e0 * y + {e}e0 AS sx, {f}e0 * x + {g}e0 * y + {h}e0 AS sy FROM {rel})"
    taps = f"(SELECT *, floor(sx) + i AS tx, floor(sy) + j AS ty, (CASE i WHEN 0 THEN 1 - (sx - floor(sx)) ELSE sx - floor(sx) END) * (CASE j WHEN 0 THEN 1 - (sy - floor(sy)) ELSE sy - floor(sy) END) AS w FROM (SELECT *, unnest([0, 0, 1, 1]) AS i, unnest([0, 1, 0, 1]) AS j FROM {at}))"
    return f"(SELECT t.image_id, t.y, t.x, {byte_sql(f'sum(t.w * coalesce(p.v, {fill}))')} AS v FROM {taps} t LEFT JOIN {rel} p ON p.image_id = t.image_id AND p.y = t.ty AND p.x = t.tx GROUP BY t.image_id, t.y, t.x)"


#: Gains of the four bands, by the remainder of the image's id.
_GAINS = ([1.0, 1.0, 1.0, 1.0], [1.0, 2.0, 0.5, 1.0], [0.8, 1.0, 1.5, 3.0])


def _listed(values) -> str:
    return "[" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]"


def mirrored_sql(rel: str, axis: str, weight: str, size: int) -> str:
    """8x8 images filtered along an axis, mirrored at the border; weight is an expression over p and the tap k."""
    other, at = "x" if axis == "y" else "y", f"(((p.{axis} + k - {size // 2}) % 14 + 14) % 14)"
    taps = f"(SELECT p.image_id, p.{other}, p.{axis}, {weight} AS w, CASE WHEN {at} >= 8 THEN 14 - {at} ELSE {at} END AS src FROM (SELECT *, unnest(range(0, {size})) AS k FROM {rel} e) p)"
    return f"(SELECT t.image_id, t.{other}, t.{axis}, sum(t.w * s.v) AS v FROM {taps} t JOIN {rel} s ON s.image_id = t.image_id AND s.{other} = t.{other} AND s.{axis} = t.src GROUP BY ALL)"


def _kernels() -> None:
    from ..operators import kernels as K

    turn = np.array([[0.8, -0.6, 2.0], [0.6, 0.8, -1.0]])
    flat = "(SELECT image_id, y, x, 128 AS v FROM pixels)"
    back = (0.8, -0.6, 2.0, 0.6, 0.8, -1.0)
    kernel(
        "x11_stitch_background", lambda im, i: K.stitch_background(im, [((1, 1, 5, 5), im[:4, :4]), ((3, 3, 7, 7), im[4:, 4:])], True),
        sql="SELECT p.image_id, p.y, p.x, CASE WHEN p.y >= 1 AND p.y < 5 AND p.x >= 1 AND p.x < 5 THEN a.v WHEN p.y >= 3 AND p.y < 7 AND p.x >= 3 AND p.x < 7 THEN b.v ELSE p.v END AS v FROM pixels p LEFT JOIN pixels a ON a.image_id = p.image_id AND a.y = p.y - 1 AND a.x = p.x - 1 LEFT JOIN pixels b ON b.image_id = p.image_id AND b.y = p.y + 1 AND b.x = p.x + 1",
    )
    kernel("x12_align_warp", lambda im, i: K.warp(im, turn, 8, 8), sql=f"SELECT * FROM {warped_sql('pixels', (0.8, 0.6, -1.0, -0.6, 0.8, 2.0), 255)} w")
    kernel("x13_paste_back", lambda im, i: K.paste_back(K.mask_out(im), im, turn), sql=f"SELECT p.image_id, p.y, p.x, CASE WHEN a.v = b.v THEN a.v ELSE p.v END AS v FROM pixels p JOIN {warped_sql(flat, back, 0)} a USING (image_id, y, x) JOIN {warped_sql(flat, back, 255)} b USING (image_id, y, x)")
    kernel("x15_resize_policy", lambda im, i: K.resize(im, 5, 5 + i % 3), lambda i: 5 + i % 3, sql=f"SELECT * FROM {resized_sql('pixels', '8', '5', '5 + p.image_id % 3', cubic_sql('(8, 5), (8, 6), (8, 7)'))} r")
    kernel("x23_resize_steps", lambda im, i: K.resize_steps(im, [4 + i % 3, 8]), sql=f"WITH small AS MATERIALIZED {resized_sql('pixels', '8', '4 + p.image_id % 3', '4 + p.image_id % 3', cubic_sql('(8, 4), (8, 5), (8, 6)'))} SELECT * FROM {resized_sql('small', '4 + p.image_id % 3', '8', '8', cubic_sql('(4, 8), (5, 8), (6, 8)'))} r")
    kernel("x24_augment", lambda im, i: K.augment(im, i))
    bands = [K.band_filters().tolist()[k] for k in range(4)]
    weight = "CASE p.image_id % 3 " + " ".join(f"WHEN {k} THEN {_listed((np.array(_GAINS[k]) @ np.array(bands)).tolist())}[k + 1]" for k in range(3)) + " END"
    kernel("x24_filter_bands", lambda im, i: K.to_bytes(K.filter_bands(im, _GAINS[i % 3])), sql=f"SELECT image_id, y, x, {byte_sql('v')} AS v FROM {mirrored_sql(mirrored_sql('pixels', 'x', weight, len(bands[0])), 'y', weight, len(bands[0]))} b")
    kernel("x24_cut_out", lambda im, i: K.cut_out(im, i % 5 / 5, i % 7 / 7), sql="SELECT image_id, y, x, CASE WHEN abs((x + 0.5e0) / 8 - (image_id % 5) / 5.0e0) < 0.25e0 AND abs((y + 0.5e0) / 8 - (image_id % 7) / 7.0e0) < 0.25e0 THEN 128 ELSE v END AS v FROM pixels")
    joints = lambda i: [(i % 8, i % 5, 1), (i % 7, 3 + i % 5, i % 2), (i % 3, 7, 1)]
    kernel("x26_draw_points", lambda im, i: K.draw_points(im, joints(i), 1), sql="SELECT image_id, y, x, CASE WHEN abs(x - image_id % 8) + abs(y - image_id % 5) <= 1 OR (image_id % 2 = 1 AND abs(x - image_id % 7) + abs(y - 3 - image_id % 5) <= 1) OR abs(x - image_id % 3) + abs(y - 7) <= 1 THEN 255 ELSE v END AS v FROM pixels")
    kernel("x26_draw_lines", lambda im, i: K.draw_lines(im, [(1, i % 8, 1), (6, i % 8, 1), (1, 7, i % 2)], [(0, 1), (0, 2)], (255, 255, 255)), sql="SELECT image_id, y, x, CASE WHEN (y = image_id % 8 AND x >= 1 AND x <= 6) OR (image_id % 2 = 1 AND x = 1 AND y >= image_id % 8) THEN 255 ELSE v END AS v FROM pixels")
    kernel("x26_draw_mask", lambda im, i: K.draw_mask(im, im[:, :, 0] % 3 == i % 3, 0.25), sql=f"SELECT image_id, y, x, CASE WHEN v % 3 = image_id % 3 THEN {byte_sql('v * 0.75e0 + 63.75e0')} ELSE v END AS v FROM pixels")
    kernel("x26_draw_surface", lambda im, i: K.draw_surface(im, im[:, :, 0] % 5, np.arange(20.0).reshape(5, 4), im[:, :, 0] > 99), sql=f"SELECT image_id, y, x, CASE WHEN v > 99 THEN {byte_sql('v * 0.3e0 + 0.7e0 * ' + byte_sql('(v % 5) * 63.75e0'))} ELSE v END AS v FROM pixels")
    kernel("x26_draw", lambda im, i: K.image_grid([K.draw_boxes(im, [(1, 1, 6, 6)]), im], 2), 18, sql="SELECT image_id, y, x, CASE WHEN y >= 1 AND y <= 5 AND x >= 1 AND x <= 5 AND (y IN (1, 5) OR x IN (1, 5)) THEN 255 ELSE v END AS v FROM pixels UNION ALL SELECT image_id, y, x + 10, v FROM pixels UNION ALL SELECT image_id, y, 8 + x, 0 FROM pixels WHERE x < 2")


_kernels()

#: The fusion plan in SQL, as published: score filter, persons matched by masks, faces inside dilated boxes removed, boxes expanded, filtered, ordered.
from .geometry_queries import sql_background, sql_ratio, sql_share, sql_simple  # noqa: E402
from .matching_queries import fold_sql, mask_pair_sql  # noqa: E402

_PEOPLE_SQL = """(SELECT m.image_id, m.o_det_id AS det_id, 'person_cse' AS kind, 3 AS kind_rank, least(p.x0, q.x0, o.x0) AS x0, least(p.y0, q.y0, o.y0) AS y0, greatest(p.x1, q.x1, o.x1) AS x1, greatest(p.y1, q.y1, o.y1) AS y1,
  least(p.x0, q.x0) AS mx0, least(p.y0, q.y0) AS my0, greatest(p.x1, q.x1) AS mx1, greatest(p.y1, q.y1) AS my1, p.n + q.n - i.n AS area_
 FROM m JOIN size p ON p.image_id = m.image_id AND p.det_id = m.det_id JOIN size q ON q.image_id = m.image_id AND q.det_id = m.o_det_id JOIN both_ i ON i.image_id = m.image_id AND i.det_id = m.det_id JOIN boxes o ON o.image_id = m.image_id AND o.det_id = m.o_det_id
 UNION ALL SELECT image_id, det_id, kind, 2, x0, y0, x1, y1, x0, y0, x1, y1, n FROM size WHERE kind = 'person' AND score >= 0.3 AND (image_id, det_id) NOT IN (SELECT (image_id, det_id) FROM m))"""
#: Sides of the dilated mask in the crop of 288 x 160 pixels: sampled, grown by the disk's radius, cleared in the padding.
_REACH_SQL = """SELECT *, x0 + greatest(greatest(0, -x0) * 288 // (y1 - y0), CAST(ceil((mx0 - x0) * 160 / CAST(x1 - x0 AS DOUBLE)) AS BIGINT) - 4) * (x1 - x0) // 160 AS rx0,
 y0 + greatest(greatest(0, -y0) * 288 // (y1 - y0), CAST(ceil((my0 - y0) * 288 / CAST(y1 - y0 AS DOUBLE)) AS BIGINT) - 4) * (y1 - y0) // 288 AS ry0,
 x0 + least(160 - greatest(0, x1 - 640) * 288 // (y1 - y0), CAST(ceil((mx1 - x0) * 160 / CAST(x1 - x0 AS DOUBLE)) AS BIGINT) + 4) * (x1 - x0) // 160 AS rx1,
 y0 + least(288 - greatest(0, y1 - 480) * 288 // (y1 - y0), CAST(ceil((my1 - y0) * 288 / CAST(y1 - y0 AS DOUBLE)) AS BIGINT) + 4) * (y1 - y0) // 288 AS ry1 FROM grown"""
FUSED_SQL = f"""WITH m AS MATERIALIZED (SELECT * FROM {fold_sql(f"(SELECT * FROM {mask_pair_sql('person', 'person_cse', score=0.3)} p WHERE inter / CAST(areas - inter AS DOUBLE) >= 0.4) p", 'det_id, o_det_id')}),
size AS MATERIALIZED (SELECT image_id, det_id, kind, max(score) AS score, CAST(sum(b - a) AS BIGINT) AS n, min(a % 640) AS x0, min(y) AS y0, max((b - 1) % 640) + 1 AS x1, max(y) + 1 AS y1 FROM mask_rows WHERE kind IN ('person', 'person_cse') GROUP BY image_id, det_id, kind),
both_ AS MATERIALIZED (SELECT m.image_id, m.det_id, CAST(sum(greatest(0, least(p.b, q.b) - greatest(p.a, q.a))) AS BIGINT) AS n FROM m JOIN mask_rows p ON p.image_id = m.image_id AND p.det_id = m.det_id JOIN mask_rows q ON q.image_id = m.image_id AND q.det_id = m.o_det_id AND q.y = p.y GROUP BY m.image_id, m.det_id),
grown AS MATERIALIZED (SELECT * FROM {sql_background(sql_ratio(sql_share(_PEOPLE_SQL, 0.1), 1.8), 'area_', 0.3)} q
 WHERE (least(x1, 640) - greatest(0, x0)) * (least(480, y1) - greatest(0, y0)) / CAST((x1 - x0) * (y1 - y0) AS DOUBLE) >= 0 AND (y1 - y0) / CAST(x1 - x0 AS DOUBLE) > 0 AND (y1 - y0) / CAST(x1 - x0 AS DOUBLE) < 99999 AND (x1 - x0) * (y1 - y0) >= 1024),
reach AS MATERIALIZED ({_REACH_SQL}),
parts AS (SELECT image_id, det_id, kind, kind_rank, x0, y0, x1, y1, area_ AS size_ FROM grown
 UNION ALL SELECT image_id, det_id, kind, 1, x0, y0, x1, y1, -((x1 - x0) * (y1 - y0)) FROM boxes WHERE kind = 'vehicle' AND score >= 0.3
 UNION ALL SELECT image_id, det_id, kind, 0, sx0, sy0, sx1, sy1, size_ FROM (SELECT *, (x1 - x0) * (y1 - y0) AS size_, {sql_simple(0.4)} FROM boxes f WHERE kind = 'face' AND score >= 0.3
  AND NOT EXISTS (SELECT 1 FROM reach r WHERE r.image_id = f.image_id AND r.rx0 < f.x0 AND r.ry0 < f.y0 AND r.rx1 > f.x1 AND r.ry1 > f.y1)) q)
SELECT image_id, det_id, kind, x0, y0, x1, y1, row_number() OVER (PARTITION BY image_id ORDER BY kind_rank, size_, det_id) AS paste_order FROM parts"""


@query("plan_fused_regions", FUSED_SQL)
def plan_fused(spark, d):
    """Only boxes are shuffled and go to workers; the masks of persons are made there."""
    def person_runs(fields: dict[str, pa.Array]) -> list:
        out = [None] * len(fields["kind"])
        at = np.flatnonzero(pc.is_in(fields["kind"], value_set=pa.array(["person", "person_cse"])))
        made = R.mask_rows(*[fields[n].take(pa.array(at)) for n in G.COORDS])
        ends, values = made.offsets.to_numpy(), made.values.to_numpy()
        for k, i in enumerate(at):
            out[i] = values[ends[k] : ends[k + 1]]
        return out

    o = Fusion(published=True)
    rows = anonymize.by_image(R.boxes(spark, d).filter(c("score") >= o.score_threshold), R.WIDTH, R.HEIGHT)
    f = anonymize.fuse_rows(rows, o, holes=False, made=person_runs, names=("det_id", "kind", *G.COORDS, "paste_order")).select("image_id", F.inline("regions"))
    return f.select(*ID, "kind", *G.COORDS, c("paste_order").cast("long"))


@query("plan_region_report", f"SELECT kind, count(*) AS n, CAST(sum(paste_order) AS BIGINT) AS orders, CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) AS area FROM ({FUSED_SQL}) q GROUP BY kind")
def plan_report(spark, d):
    f = plan_fused(spark, d)
    return f.groupBy("kind").agg(F.count("*").alias("n"), F.sum("paste_order").alias("orders"), F.sum((c("x1") - c("x0")) * (c("y1") - c("y0"))).alias("area"))


@query("plan_redact_images")
def plan_redact(spark, d):
    """Detect bright regions in the 8x8 images, fuse, blur: a digest and a status an image."""
    @F.pandas_udf("binary")
    def to_bytes(px: pd.Series) -> pd.Series:
        return pd.Series([bytes(int(v) for v in p for _ in range(3)) for p in px])

    im = R.images(spark, d).select("image_id", F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("n_channels"), to_bytes("px").alias("data"))
    out = anonymize.anonymise(im, anonymize.bright_regions(150), "blur", 0.1, size=5)
    return out.select("image_id", "status", F.md5("data").alias("digest"))


