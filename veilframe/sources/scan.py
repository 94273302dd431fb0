"""Scans: files by suffix, label texts, JSON annotations, aligned side tables. All declared schemas, no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import let
from ..functions.storage import cut

c = F.col
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tiff")
VIDEO_SUFFIXES = ("mp4",)


def image_files(spark: SparkSession, folder: str, recursive: bool = False, suffixes=IMAGE_SUFFIXES) -> DataFrame:
    """binaryFile scan of image files: each suffix in lower and in upper case, not mixed."""
    names = ",".join([*suffixes, *(s.upper() for s in suffixes)])
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{names}}}").option("recursiveFileLookup", recursive).load(folder)


def suffix(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([^./]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def is_image(path: Column, any_case: bool = False, suffixes=IMAGE_SUFFIXES) -> Column:
    if any_case:
        return F.lower(suffix(path)).isin(*suffixes)
    return suffix(path).isin(*suffixes, *(s.upper() for s in suffixes))


def file_kind(path: Column) -> Column:
    s = F.lower(suffix(path))
    return F.when(s.isin(*IMAGE_SUFFIXES), "image").when(s.isin(*VIDEO_SUFFIXES), "video").otherwise("other")


def mirror_path(path: Column, source: str, target: str) -> Column:
    """The same relative path below another folder."""
    return F.concat(F.lit(target.rstrip("/") + "/"), F.substr(path, F.lit(len(source.rstrip("/")) + 2)))


def natural_key(path: Column) -> Column:
    """Sorts by the text before the last number of the stem, then by that number, then by the path."""
    return F.struct(
        F.regexp_extract(stem(path), r"^(.*?)([0-9]*)$", 1).alias("text"),
        F.try_to_number(F.concat(F.lit("0"), F.regexp_extract(stem(path), r"([0-9]*)$", 1)), F.lit("9" * 19)).cast("long").alias("number"),
        path.alias("path"),
    )


def numeric_stem(path: Column) -> Column:
    """The whole number after the last underscore, or the stem itself."""
    return F.regexp_extract(stem(path), r"([0-9]+)$", 1).cast("long")


def parse_yolo(line: Column) -> list[Column]:
    """``cls xc yc w h``: the class token is dropped."""
    parts = F.split(F.btrim(line), r"\s+")
    return [F.get(parts, F.lit(i)).cast("double").alias(n) for i, n in enumerate(("xc", "yc", "w", "h"), 1)]


def parse_polygon(line: Column) -> Column:
    """Whole numbers before ``##``, by spaces or else by commas, as points."""
    head = F.btrim(F.substring_index(line, "##", 1))
    values = F.split(head, "[ ,]+").cast("array<int>")
    point = lambda v, i: F.struct(F.get(v, i).alias("x"), F.get(v, i + 1).alias("y"))
    return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.size(v) - 2, F.lit(2)), lambda i: point(v, i)))


def yolo_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Label files, one detection a line: path, xc, yc, w, h."""
    rows = spark.read.text(folder).select(c("_metadata.file_path").alias("path"), "value").filter(F.btrim("value") != "")
    return rows.select("path", *parse_yolo(c("value")))


def training_triples(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of source, conditioning and ground-truth image, with their composite key."""
    rows = spark.read.schema("source_image string, conditioning_image string, ground_truth string").option("mode", "FAILFAST").json(path)
    return rows.withColumn("key", F.concat_ws("-", "source_image", "conditioning_image"))


def frame_boxes(text: Column) -> Column:
    """``{"frame": [[x0, y0, x1, y1], ...]}`` as a map."""
    return F.from_json(text, "map<string, array<array<double>>>")


def detection_rows(json_rows: DataFrame, text: str = "value") -> DataFrame:
    """``{image: {boxes, keypoint_indices}}`` -> image_id, pos, x0..y1, keypoint_index."""
    schema = "map<string, struct<boxes: array<array<double>>, keypoint_indices: array<int>>>"
    rows = json_rows.select(F.explode(F.from_json(c(text), schema)).alias("image_id", "d"))
    rows = rows.select("image_id", F.posexplode(F.arrays_zip(c("d")["boxes"].alias("b"), c("d")["keypoint_indices"].alias("k"))).alias("pos", "r"))
    return rows.select("image_id", "pos", *[F.get(c("r")["b"], F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))], c("r")["k"].alias("keypoint_index"))


COCO_SCHEMA = (
    "images array<struct<id: long, file_name: string, height: int, width: int>>, "
    "annotations array<struct<id: long, image_id: long, category_id: int, iscrowd: int, ignore: int, keypoints: array<double>, segmentation: string>>"
)


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) of a COCO file."""
    doc = spark.read.schema(COCO_SCHEMA).option("multiLine", True).json(path)
    return doc.select(F.inline("images")), doc.select(F.inline("annotations"))


def with_persons(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every image, with its non-crowd annotations of category 0 or NULL where it has none."""
    kept = annotations.filter((c("iscrowd") == 0) & (c("category_id") == 0))
    return images.join(kept, "image_id", "left")


def positions(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """Whole positions from 0 in the given total order, without one task that sorts all rows. Rows are range-partitioned,
    sorted within a partition and written to the shared folder with their place (partition, row); positions are then
    read off the stored places, so both sides of the join below see the same ones, however often they are planned."""
    place = F.monotonically_increasing_id()
    stored = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    sizes = stored.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    # one row a partition
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = c("_before") + c("_place").bitwiseAND((1 << 33) - 1)
    return stored.withColumn("_p", part).join(F.broadcast(shift), "_p").withColumn(name, at.cast("long")).drop("_p", "_place", "_before")


def zip_positions(a: DataFrame, a_order: list[Column], b: DataFrame, b_order: list[Column], limit: int | None = None) -> DataFrame:
    """Rows of two tables side by side by position; the shorter one ends it, or the limit."""
    left, right = positions(a, a_order), positions(b, b_order)
    out = left.join(right, "pos")
    return out if limit is None else out.filter(c("pos") < limit)


def head_share(df: DataFrame, order: list[Column], share: float) -> DataFrame:
    """The first max(1, int(n * share)) rows for a share between 0 and 1, else all."""
    if not 0 < share < 1:
        return df
    n = max(1, int(df.count() * share))
    return positions(df, order, "_pos").filter(c("_pos") < n).drop("_pos")


def match_names(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Inner join on names; a name of a that b lacks is an error."""
    missing = a.join(b, on, "left_anti").limit(1).count()
    if missing:
        raise FileNotFoundError(f"a file of the first folder has no {on} in the second")
    return a.join(b, on)


def mask_path(path: Column) -> Column:
    """``<stem>_mask.<suffix>`` beside an image."""
    return F.regexp_replace(path, r"(\.[^./]*)$", "_mask$1")
