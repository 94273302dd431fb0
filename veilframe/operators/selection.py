"""Filters, orders, limits, batches and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def non_degenerate() -> Column:
    return (c("x1") > c("x0")) & (c("y1") > c("y0"))


def usable_annotations(category: int = 0) -> Column:
    return (c("iscrowd") == 0) & (c("ignore") == 0) & (c("category_id") == category)


def area_rank(df: DataFrame, descending: bool = False) -> DataFrame:
    """Place by area within an image, ties by det_id."""
    area = (c("x1") - c("x0")) * (c("y1") - c("y0"))
    w = Window.partitionBy("image_id").orderBy(area.desc() if descending else area.asc(), "det_id")
    return df.withColumn("area_rank", F.row_number().over(w))


def batches(df: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """1-based batch number of each row of a key, and the number of batches."""
    w = Window.partitionBy(key)
    n = F.row_number().over(w.orderBy(*order))
    total = F.count("*").over(w)
    return df.withColumn("batch_no", (F.floor((n - 1) / size) + 1).cast("long")).withColumn("n_batches", F.ceil(total / size).cast("long"))


def trim(frames: DataFrame, start, end, seconds: Column) -> tuple[DataFrame, DataFrame]:
    """(frames of [start, end), the untouched rest)."""
    inside = (seconds >= start) & (seconds < end)
    return frames.filter(inside), frames.filter(~inside)


def resample(frames: DataFrame, fps: float) -> DataFrame:
    """The first frame of each 1 / fps of a second."""
    bucket = F.floor(F.unix_micros(c("ts").cast("timestamp")) / 1e6 * fps)
    w = Window.partitionBy("video_id", bucket).orderBy("ts", "image_id")
    return frames.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def index_before_filter(df: DataFrame, key: str, order: list[str], keep: Column, name: str = "idx") -> DataFrame:
    """The running index counts all rows, also those that ``keep`` then drops."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("long")).filter(keep)
