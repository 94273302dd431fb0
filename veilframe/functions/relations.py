"""Relations that stand for images, detections, masks, frames and features, derived from the test tables.

Each has a DataFrame form and, for the oracles, a DuckDB form.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.runs import row_masks
from .columns import held

WIDTH, HEIGHT = 640, 480

BOXES = """SELECT image_id, det_id, kind, kind_rank, score, x0, y0, x0 + bw AS x1, y0 + bh AS y1 FROM (
 SELECT image_id, det_id, kind, kind_rank, score, bw, bh, (p*31 + n*17) % (641 - bw) AS x0, (s*29 + p*3) % (481 - bh) AS y0 FROM (
  SELECT image_id, det_id, p, s, n, (p + s) % 4 AS kind_rank,
    CASE (p + s) % 4 WHEN 0 THEN 'face' WHEN 1 THEN 'vehicle' WHEN 2 THEN 'person' ELSE 'person_cse' END AS kind,
    CAST((p*11 + s*7) % 100 AS DOUBLE) / 100.0 AS score,
    CASE WHEN (p + s) % 4 = 0 THEN 8 + (p*7 + n*3) % 24 ELSE 40 + (p*7 + n*3) % 260 END AS bw,
    CASE WHEN (p + s) % 4 = 0 THEN 8 + (s*13 + n*5) % 24 ELSE 60 + (s*13 + n*5) % 300 END AS bh FROM (
   SELECT CAST(floor(l_orderkey / 5.0) AS BIGINT) AS image_id, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n,
     CAST(row_number() OVER (PARTITION BY CAST(floor(l_orderkey / 5.0) AS BIGINT) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS BIGINT) AS det_id
   FROM {lineitem}) q0) q1) q2"""
# Five orders are an image, so there are about twenty detections an image whatever the scale.

RELATIONS: dict[str, str] = {
    "boxes": BOXES.format(lineitem="lineitem"),
    "frames": "SELECT user_id AS video_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS frame_no, ts, event_id AS image_id FROM events",
    "pixels": "SELECT vec_id AS image_id, CAST(floor((i-1)/8.0) AS BIGINT) AS y, CAST((i-1)%8 AS BIGINT) AS x, CAST(least(255, greatest(0, floor((CAST(embedding[i] AS DOUBLE)+0.5)*255.0))) AS BIGINT) AS v FROM (SELECT vec_id, embedding, unnest(range(1,65)) AS i FROM embeddings) q",
    "pairs": "SELECT a.image_id, a.y, a.x, a.v AS a, b.v AS b FROM pixels a JOIN pixels b ON b.image_id = a.image_id + 1 AND b.y = a.y AND b.x = a.x",
    "yolo": "SELECT *, (x0 + x1) / 2.0 / 640 AS xc, (y0 + y1) / 2.0 / 480 AS yc, (x1 - x0) / 640.0 AS w, (y1 - y0) / 480.0 AS h FROM boxes",
    "kps": "SELECT image_id, det_id, x0, y0, x1, y1, k, x0 - 10 + (det_id*7 + k*13) % (x1-x0+20) AS px, y0 - 10 + (det_id*11 + k*17) % (y1-y0+20) AS py, (det_id + k) % 3 AS v FROM (SELECT *, unnest(range(0, 17)) AS k FROM boxes) q",
    "features": "SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS e, label FROM (SELECT vec_id, label, embedding, unnest(range(1,65)) AS i FROM embeddings) q",
    "mask_rows": "SELECT image_id, det_id, kind, score, y, y * 640 + CASE WHEN y - y0 < (y1 - y0) // 3 THEN x0 + (x1 - x0) // 4 ELSE x0 END AS a, y * 640 + CASE WHEN y - y0 < (y1 - y0) // 3 THEN x1 - (x1 - x0) // 4 ELSE x1 END AS b FROM (SELECT *, unnest(range(y0, y1 - (y1 - y0) // 8)) AS y FROM boxes) q",
    "files": "SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '.jpg') AS path, url FROM pages",
}
_NEEDS = {"pairs": ["pixels"], "yolo": ["boxes"], "kps": ["boxes"], "mask_rows": ["boxes"]}


def with_relations(sql: str) -> str:
    """The SQL with those relations that it names defined before it."""
    used = [n for n in RELATIONS if re.search(rf"\b{n}\b", sql)]
    wanted = {x for n in used for x in [n, *_NEEDS.get(n, [])]}
    heads = ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in RELATIONS.items() if n in wanted)
    if not heads:
        return sql
    sql = sql.strip()
    if sql[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {heads},\n{sql[15:]}"
    return f"WITH {heads},\n{sql[5:]}" if sql[:5].upper() == "WITH " else f"WITH {heads}\n{sql}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What the detections of an image are numbered by.
BOX_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As BOXES. Rows are dealt by image_id itself, so joins and windows by image need no other exchange; coordinates are held, as filters on them would be
    pushed down as copies of copies."""
    c = F.col
    rows = table(spark, sf_dir, "lineitem").select(F.floor(c("l_orderkey") / 5.0).cast("long").alias("image_id"), *BOX_ORDER)
    rows = rows.withColumn("det_id", F.row_number().over(Window.partitionBy("image_id").orderBy(*BOX_ORDER)).cast("long"))
    p, s, n = c("l_partkey"), c("l_suppkey"), c("l_linenumber").cast("long")
    rows = rows.select("image_id", "det_id", p.alias("p"), s.alias("s"), n.alias("n"), ((p + s) % 4).alias("kind_rank"))
    p, s, n, face = c("p"), c("s"), c("n"), c("kind_rank") == 0
    size = {"bw": (p * 7 + n * 3, 8, 40, 260), "bh": (s * 13 + n * 5, 8, 60, 300)}
    rows = rows.withColumns({k: held(F.when(face, small + v % 24).otherwise(large + v % most)) for k, (v, small, large, most) in size.items()})
    rows = rows.withColumns({"x0": held((p * 31 + n * 17) % (641 - c("bw"))), "y0": held((s * 29 + p * 3) % (481 - c("bh")))})
    rows = rows.withColumns({"x1": held(c("x0") + c("bw")), "y1": held(c("y0") + c("bh"))})
    kind = F.when(face, "face").when(c("kind_rank") == 1, "vehicle").when(c("kind_rank") == 2, "person").otherwise("person_cse")
    score = ((p * 11 + s * 7) % 100).cast("double") / 100.0
    return rows.select("image_id", "det_id", kind.alias("kind"), "kind_rank", score.alias("score"), "x0", "y0", "x1", "y1")


def mask_runs(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Runs of a detection's mask: the upper third narrower by a quarter on each side, the lowest eighth missing."""
    h, w = y1 - y0, x1 - x0
    third, quarter, rows = F.floor(h / 3.0), F.floor(w / 4.0), h - F.floor(h / 8.0)
    place = lambda row, x: (y0 + row) * WIDTH + x0 + x
    column = lambda first, last, x: F.sequence(place(first, x), place(last - 1, x), F.lit(WIDTH).cast("long"))
    # no box is as wide as the image, so in order starts and ends take turns
    return F.sort_array(F.concat(column(F.lit(0), third, quarter), column(F.lit(0), third, w - quarter), column(third, rows, F.lit(0)), column(third, rows, w)))


def mask_rows(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """``mask_runs`` of many boxes at once, for workers that merge runs: only boxes go there."""
    return row_masks(x0, y0, x1, y1, WIDTH, lambda h, w: (h - h // 8, h // 3, w // 4))


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """boxes with the pixels of their masks; the runs are made where they are merged (``mask_rows``), as they take fifty times the bytes of a box."""
    c = F.col
    h, w = c("y1") - c("y0"), c("x1") - c("x0")
    third, quarter, rows = F.floor(h / 3.0), F.floor(w / 4.0), h - F.floor(h / 8.0)
    return boxes(spark, sf_dir).withColumn("mask_area", third * (w - 2 * quarter) + (rows - third) * w)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events")
    return rows.select(F.col("user_id").alias("video_id"), F.row_number().over(order).cast("long").alias("frame_no"), "ts", F.col("event_id").alias("image_id"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("i", "e"))
    value = F.least(F.lit(255), F.greatest(F.lit(0), F.floor((F.col("e").cast("double") + 0.5) * 255.0)))
    return rows.select("image_id", F.floor(F.col("i") / 8.0).cast("long").alias("y"), (F.col("i") % 8).cast("long").alias("x"), value.cast("long").alias("v"))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, px: the 64 grey values of an 8x8 image in row order."""
    value = lambda e: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((e.cast("double") + 0.5) * 255.0))).cast("long")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.transform("embedding", value).alias("px"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of image i beside those of image i + 1: images are joined whole, then taken apart."""
    left = images(spark, sf_dir)
    right = left.select((F.col("image_id") - 1).alias("image_id"), F.col("px").alias("other"))
    both = left.join(right, "image_id").select("image_id", F.posexplode(F.arrays_zip("px", "other")).alias("i", "p"))
    return both.select("image_id", F.floor(F.col("i") / 8.0).alias("y"), (F.col("i") % 8).cast("long").alias("x"), F.col("p")["px"].alias("a"), F.col("p")["other"].alias("b"))


def yolo(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return boxes(spark, sf_dir).withColumns(
        {"xc": (c("x0") + c("x1")) / 2.0 / 640, "yc": (c("y0") + c("y1")) / 2.0 / 480, "w": (c("x1") - c("x0")) / 640.0, "h": (c("y1") - c("y0")) / 480.0}
    )


def joints(det_id: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """17 keypoints (x, y, v) of many boxes at once, as ``kps`` in SQL."""
    n = len(det_id)
    row, k = pa.array(np.repeat(np.arange(n), 17)), pa.array(np.tile(np.arange(17), n))
    rest = lambda v, by: pc.subtract(v, pc.multiply(pc.divide(v, by), by))
    det = det_id.take(row)

    def along(first: pa.Array, last: pa.Array, one: int, other: int) -> pa.Array:
        span, start = pc.add(pc.subtract(last, first), 20).take(row), pc.subtract(first, 10).take(row)
        return pc.add(start, rest(pc.add(pc.multiply(det, one), pc.multiply(k, other)), span))

    points = pa.StructArray.from_arrays([along(x0, x1, 7, 13), along(y0, y1, 11, 17), rest(pc.add(det, k), pa.scalar(3, pa.int64()))], ["x", "y", "v"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 17), points)


def keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """boxes with kps: array of 17 (x, y, v)."""
    points = F.arrow_udf(joints, "array<struct<x: bigint, y: bigint, v: bigint>>")
    return boxes(spark, sf_dir).withColumn("kps", points("det_id", "x0", "y0", "x1", "y1"))


def of_keypoints(use: Callable[..., pa.Array], returns: str) -> Column:
    """use(kps, det_id, x0, y0, x1, y1) of a batch of ``boxes``, whose keypoints are made where they are used: they take ten times the bytes of a box."""

    @F.arrow_udf(returns)
    def made(det_id: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        return use(joints(det_id, x0, y0, x1, y1), det_id, x0, y0, x1, y1)

    return made("det_id", "x0", "y0", "x1", "y1")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", F.transform("embedding", lambda e: e.cast("double")).alias("vec"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", ".jpg")
    return table(spark, sf_dir, "pages").select("page_id", path.alias("path"), "url")
