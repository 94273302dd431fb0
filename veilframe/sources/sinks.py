"""Sinks: what is written for each input, under which name, and what happens to inputs without a result.

Fail-closed by default: an input whose result is missing is written fully masked, with its status; an original passes only where
a result row says that nothing was found. Copying others through has to be asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import stem, suffix

c = F.col


def output_name(path: Column, prefix: str = "", ending: str = "", new_suffix: str | None = None) -> Column:
    """<prefix><stem><ending>.<suffix>"""
    last = F.lit(new_suffix) if new_suffix else suffix(path)
    return F.concat(F.lit(prefix), stem(path), F.lit(ending), F.lit("."), last)


def with_results(inputs: DataFrame, results: DataFrame, key: str, value: str, masked: Column, mode: str = "closed") -> DataFrame:
    """inputs(key, value) LEFT JOIN results(key, new, error): adds ``out`` and ``status``.

    status: ``ok``, ``error``, ``no_region`` (a result row without new and error: looked at, nothing found) or ``missing`` (no
    result row at all, so nobody knows). mode: ``closed`` (only inputs that were looked at without a find pass, the rest is
    masked), ``passthrough`` (no result: the original), ``detected_only`` (only inputs with a result), ``skip_errors`` (rows
    with an error or without a result row go, inputs without a region pass)."""
    rows = inputs.join(results.withColumn("_seen", F.lit(True)), key, "left")
    status = F.when(c("new").isNotNull(), "ok").when(c("error").isNotNull(), "error").when(c("_seen"), "no_region").otherwise("missing")
    rows = rows.withColumn("status", status).drop("_seen")
    if mode == "detected_only":
        return rows.filter("status = 'ok'").withColumn("out", c("new"))
    if mode == "skip_errors":
        return rows.filter("status in ('ok', 'no_region')").withColumn("out", F.coalesce("new", value))
    if mode == "passthrough":
        passed = F.when(c("status").isin("error", "missing"), F.concat("status", F.lit("_passthrough"))).otherwise(c("status"))
        return rows.withColumn("out", F.coalesce("new", value)).withColumn("status", passed)
    if mode != "closed":
        raise ValueError(mode)
    return rows.withColumn("out", F.when(c("status") == "ok", c("new")).when(c("status") == "no_region", c(value)).otherwise(masked))


def still_to_do(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: inputs whose output is not there yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def write_files(rows: DataFrame, folder: str, name: str = "name", data: str = "data") -> DataFrame:
    """Writes each row's bytes to folder/name; returns name and size. folder: a path or URI (file, hdfs, s3, gs) that all executors share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        for batch in batches:
            for n, content in zip(batch["name"], batch["data"], strict=True):
                part = f"{root}/.{n}.{uuid.uuid4().hex}.part"
                with files.open_output_stream(part) as f:
                    f.write(content)
                files.move(part, f"{root}/{n}")  # a task that runs twice leaves one whole file
            yield pd.DataFrame({"name": batch["name"], "size": batch["data"].map(len)})

    return rows.select(c(name).alias("name"), c(data).alias("data")).mapInPandas(run, "name string, size long")


def write_shards(samples: DataFrame, folder: str, sizes: list[int], max_records: int = 3000) -> None:
    """One copy a resolution, at most max_records samples a file, a folder for each size."""
    fanned = samples.withColumn("size", F.explode(F.array(*[F.lit(s) for s in sizes])))
    fanned.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("size").parquet(folder)


def result_map(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """key -> JSON list of the values of its rows; one JSON document a key, so that no task holds all keys."""
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*values))).alias("v"))
    return listed.select(key, F.to_json(F.transform("v", lambda r: F.array(*[r[n] for n in values]))).alias("json"))


def label_lines(rows: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """key -> the text of its label file, one line a row."""
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, F.concat_ws(" ", *[c(v).cast("string") for v in values]).alias("line")))).alias("v"))
    return listed.select(key, F.array_join(F.transform("v", lambda r: r["line"]), "\n").alias("text"))


def cache_detections(detections: DataFrame, path: str) -> None:
    """Detections by the digest of their image, compressed, appended to a table."""
    detections.write.mode("append").option("compression", "zstd").parquet(path)


def gather_files(spark: SparkSession, folders: list[str], target: str, suffix: str = ".parquet") -> list[str]:
    """Moves the files of folders, as writers leave them, into one, numbered in order: whole files appear one after the other, as from a camera."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(conf)
    files.mkdirs(path(target))
    names = []
    for folder in folders:
        for name in sorted(s.getPath().getName() for s in files.listStatus(path(folder))):
            if name.endswith(suffix) and name[0] not in "._":
                names.append(f"frame-{len(names):06d}{suffix}")
                files.rename(path(f"{folder}/{name}"), path(f"{target}/{names[-1]}"))
    return names
