"""Shards bounded by bytes and by samples, cut one after the other in a total order, without one task that walks all samples.

Where a shard ends depends on where it began, so cutting is a chain of jumps. Samples are taken in blocks of consecutive positions. For each place where
a shard may begin in a block (a shard reaches at most ``max_records`` samples into the next one) a task finds where the chain from there leaves
the block, and how many shards that takes: the block's jump function. Functions of ``GROUP`` blocks are composed in one task, those of the groups on the
driver (some ten bytes a sample that a shard may hold, a group of 16 million samples), and back down each block learns where its first shard begins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from .scan import positions

c = F.col
MAX_BYTES, MAX_RECORDS = 200 << 20, 3000
#: Samples of a block at least, and blocks of a group.
BLOCK, GROUP = 1 << 16, 256


def jumps(sizes: np.ndarray, max_bytes: int, max_records: int) -> np.ndarray:
    """For each sample where a shard that begins with it ends: after the sample that brings it to max_bytes, or max_records of them."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.searchsorted(total, total[:-1] + max_bytes, "left")
    return np.minimum(np.maximum(ends, np.arange(len(sizes)) + 1), np.arange(len(sizes)) + max_records)


def jump_function(sizes: np.ndarray, own: int, max_bytes: int, max_records: int) -> tuple[np.ndarray, np.ndarray]:
    """sizes: of a block's ``own`` samples and those that follow -> for each place from 0 up to max_records (as far as the block goes) where, counted from its
    end, the chain of shards goes on, and how many shards began in it. At the end of all samples a place may lie past them."""
    end = jumps(sizes, max_bytes, max_records)
    leaves, count = np.zeros(own, np.int64), np.zeros(own, np.int64)
    for i in range(own - 1, -1, -1):
        inside = end[i] < own
        leaves[i] = leaves[end[i]] if inside else end[i] - own
        count[i] = 1 + (count[end[i]] if inside else 0)
    return leaves[:max_records], count[:max_records]


def through(function: tuple[np.ndarray, np.ndarray], place: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at a block's start -> (places at its end, shards that began in it). A place past the block's samples stays as far past its end."""
    leaves, count = function
    inside = place < own
    at = np.where(inside, np.minimum(place, len(leaves) - 1), 0)
    return np.where(inside, leaves[at], place - own), np.where(inside, count[at], 0)


def _blocks(ranked: DataFrame, block: int, max_records: int) -> DataFrame:
    """Each block's samples, and those of the next that a shard of it may reach."""
    own = F.floor(c("pos") / block).cast("bigint")
    rows = ranked.select("pos", "size", own.alias("own"))
    early = (c("pos") % block < max_records) & (c("own") > 0)
    return rows.withColumn("block", F.explode(F.when(early, F.array(c("own"), c("own") - 1)).otherwise(F.array("own"))))


def shard_numbers(samples: DataFrame, order: list[Column], size: Column, max_bytes: int = MAX_BYTES, max_records: int = MAX_RECORDS, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """Adds pos, the sample's place in the order, and shard, from 0: a new shard begins once the open one has max_bytes or max_records. Null sizes are 0. The order
    has to be total for a result that doesn't depend on how rows lie."""
    if max_records < 1 or max_bytes < 1:
        raise ValueError("a shard holds at least a sample")
    block = max(block, max_records)
    ranked = cut(positions(samples.withColumn("_size", F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))), order))
    rows = _blocks(ranked.select("pos", c("_size").alias("size")), block, max_records)
    schema = "block bigint, own bigint, leaves array<bigint>, count array<bigint>"

    def function(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        number = table.column("block")[0].as_py()
        mine = int((table.column("own").to_numpy() == number).sum())
        leaves, count = jump_function(table.column("size").to_numpy(), mine, max_bytes, max_records)
        return pa.table({"block": [number], "own": [mine], "leaves": pa.array([leaves.tolist()], pa.list_(pa.int64())), "count": pa.array([count.tolist()], pa.list_(pa.int64()))})

    functions = cut(rows.groupBy("block").applyInArrow(function, schema).withColumn("grp", F.floor(c("block") / group).cast("bigint")))

    def listed(table: pa.Table):
        table = table.sort_by("block")
        return [(r["block"], r["own"], (np.array(r["leaves"], np.int64), np.array(r["count"], np.int64))) for r in table.to_pylist()]

    def compose(table: pa.Table) -> pa.Table:
        place, begun = np.arange(max_records), np.zeros(max_records, np.int64)
        for _, own, f in listed(table):
            place, more = through(f, place, own)
            begun = begun + more
        return pa.table({"grp": table.column("grp")[:1], "leaves": pa.array([place.tolist()], pa.list_(pa.int64())), "count": pa.array([begun.tolist()], pa.list_(pa.int64()))})

    place, begun, entries = 0, 0, []
    for r in functions.groupBy("grp").applyInArrow(compose, "grp bigint, leaves array<bigint>, count array<bigint>").orderBy("grp").toLocalIterator():
        entries.append((r["grp"], int(place), int(begun)))
        place, begun = r["leaves"][place], begun + r["count"][place]
    starts = samples.sparkSession.createDataFrame(entries, "grp bigint, place bigint, begun bigint")

    def descend(table: pa.Table) -> pa.Table:
        place, begun, out = np.array([table.column("place")[0].as_py()]), table.column("begun")[0].as_py(), []
        for number, own, f in listed(table):
            out.append((number, int(place[0]), begun))
            place, more = through(f, place, own)
            begun += int(more[0])
        return pa.table(dict(zip(("block", "place", "begun"), map(list, zip(*out, strict=True)), strict=True)))

    entered = functions.join(F.broadcast(starts), "grp").groupBy("grp").applyInArrow(descend, "block bigint, place bigint, begun bigint")

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        mine = int((table.column("own").to_numpy() == table.column("block")[0].as_py()).sum())
        end = jumps(table.column("size").to_numpy(), max_bytes, max_records)
        at, begins = table.column("place")[0].as_py(), np.zeros(mine, np.int64)
        while at < mine:
            begins[at] = 1
            at = int(end[at])
        shard = table.column("begun")[0].as_py() - 1 + np.cumsum(begins)
        return pa.table({"pos": table.column("pos").slice(0, mine), "shard": shard})

    numbered = rows.join(F.broadcast(entered), "block").groupBy("block").applyInArrow(number, "pos bigint, shard bigint")
    return ranked.drop("_size").join(numbered, "pos")
