"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Every row gets a place: (input partition, ordinal in it), stored with the row's id, size and
   checksum in the shared folder, so that all later steps and all retries see the same places.
2. From the partition sizes alone, a matrix of partition-to-shard counts is drawn: row by row,
   multivariate hypergeometric over the room left in the shards. Its sums are exact at every size; the law is numpy's below
   ``EXACT_BELOW`` rows, and beyond it the same law cut at twelve standard deviations and computed in double precision.
3. Local permutation: a partition's rows get its row of shard labels in random order.
4. Exchange, and a second permutation inside each shard: a random key orders the shard's rows. A shard
   is cut into key ranges of about ``bucket_rows`` rows, each ranked by itself and shifted by the counts of
   the ranges before it, so no task holds a shard.

Texts never move; a row of about 50 bytes does. Partitions are put together until there are at most
``max_parts`` of them, which bounds the matrix; it is sent to the workers by value. The counts of shards
are the law: ``rows``, at most one apart.

Defined results: null text has no bytes (size 16) and checksum 0; null ids and repeated rows are rows like
others; with fewer rows than shards some shards are empty; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_of

PLACE_BITS = 33
EXACT_BELOW = 100_000_000


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One hypergeometric variate. numpy's generator is used below its limits; above, the
    distribution function is inverted over twelve standard deviations about the mean."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < EXACT_BELOW:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * good / total
    sd = math.sqrt(mean * (bad / total) * ((total - n) / max(1, total - 1))) + 1
    low, high = max(0, n - bad, int(mean - 12 * sd)), min(n, good, int(mean + 12 * sd) + 1)
    k = np.arange(low, high, dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(step)])
    mass = np.exp(logs - logs.max())
    return int(low + np.searchsorted(np.cumsum(mass), rng.random() * mass.sum()))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """counts[p, s] of rows that go from partition p to shard s; rows sum to the sizes, columns to the
    shard sizes, and the law is that of cutting a uniformly shuffled deck."""
    total = sum(sizes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng([seed, 1])
    out = np.zeros((len(sizes), shards), np.int64)
    for p, left in enumerate(sizes):
        free = sum(room)
        for s in range(shards):
            free -= room[s]
            k = draw_hypergeometric(rng, room[s], free, left)
            out[p, s] = k
            room[s] -= k
            left -= k
    return out


def shard(docs: DataFrame, shards: int = 40, seed: int = 17, bucket_rows: int = 100_000, max_parts: int = 4096) -> DataFrame:
    """docs(doc_id, text) -> doc_id, size, text_crc32, shard, slot (from 0 without gaps in each shard)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text_of()).cast("long") + 16).alias("size"),
            F.crc32(text_of().cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    counted = base.groupBy(F.shiftright("place", PLACE_BITS).alias("p")).count().collect()  # one row a partition
    rows_of = {r["p"]: r["count"] for r in counted}
    total = sum(rows_of.values())
    # neighbouring partitions share a row of the matrix where there are too many of them
    order = sorted(rows_of)
    width = max(1, -(-len(order) // max_parts))
    group_of, offset_of, sizes = {}, {}, []
    for i, p in enumerate(order):
        if i % width == 0:
            sizes.append(0)
        group_of[p], offset_of[p] = len(sizes) - 1, sizes[-1]
        sizes[-1] += rows_of[p]
    matrix = communication_matrix(sizes, shards, seed)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            place = batch.column(3).to_numpy()
            part, ordinal = place >> PLACE_BITS, place & ((1 << PLACE_BITS) - 1)
            to = np.zeros(len(place), np.int32)
            key = np.zeros(len(place), np.int64)
            for p in np.unique(part):
                g = group_of[int(p)]
                if g not in held:
                    held.clear()
                    rng = np.random.default_rng([seed, 2, g])
                    labels = rng.permutation(np.repeat(np.arange(shards, dtype=np.int16), matrix[g]))
                    held[g] = labels, rng.integers(0, 1 << 62, len(labels))
                here = part == p
                at = ordinal[here] + offset_of[int(p)]
                to[here], key[here] = held[g][0][at], held[g][1][at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to), pa.array(key)], names=[*batch.schema.names, "shard", "key"])

    labelled = base.mapInArrow(label, f"doc_id {kind}, size bigint, text_crc32 bigint, place bigint, shard int, key bigint")
    buckets = max(1, -(-total // (shards * bucket_rows)))
    labelled = labelled.withColumn("bucket", (F.col("key") / F.lit((1 << 62) / buckets)).cast("int"))
    counts = labelled.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("key", "place"))
    return (
        labelled.withColumn("rank", rank)
        .join(counts, ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"))
    )


def document_shards(documents: DataFrame) -> DataFrame:
    return shard(documents).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
