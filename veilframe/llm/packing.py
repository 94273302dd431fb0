"""Best-fit packing with conflict constraints.

Documents are packed into bins of ``capacity`` code points. A bin never holds two pieces of one source
nor two of one duplicate cluster. Pieces are taken largest first; open bins are kept in order of their
residual room, each with a bitmap of its sources and one of its clusters. The search starts at the
successor of the piece's size and goes on until the first, so tightest, compatible bin; if there is none, a bin
is opened. Each of the 60 commonest sources and clusters of a group has a bit of its own; rarer ones share
bits, and where a shared bit is set the bin's exact set decides.

Packing is sequential, so pieces are dealt into groups that are packed by themselves. Group numbers come from
stored row places, round robin: groups have at most ``group_rows`` pieces whatever the ids, sources or
clusters are. Only ids and sizes move. Texts longer than a bin are cut into pieces of the capacity and a rest.

Defined results: null and empty texts are one piece of size 0 (in the bin that best fits it); a null source
is in conflict with nothing, nor is the cluster of an empty text; repeated rows are packed each, never two copies
in one bin; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

OWN_BITS = 60
SHARED_BITS = 4


def bits_of(keys: list) -> tuple[np.ndarray, np.ndarray]:
    """For each key its bit (0 for None and for keys that occur once, which meet no other) and whether it is its own."""
    counts = Counter(k for k in keys if k is not None)
    ranked = sorted((k for k, c in counts.items() if c > 1), key=lambda k: (-counts[k], str(k)))
    bit = {k: (1 << i if i < OWN_BITS else 1 << (OWN_BITS + i % SHARED_BITS)) for i, k in enumerate(ranked)}
    own = {k for k in ranked[:OWN_BITS]}
    return np.array([bit.get(k, 0) for k in keys], np.uint64), np.array([k in own or k not in bit for k in keys], bool)


def best_fit(sizes: np.ndarray, sources: list, clusters: list, capacity: int, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset in the bin of each piece, for pieces taken largest first (ties in the given order)."""
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable") if order is None else order
    s_bit, s_own = bits_of(sources)
    c_bit, c_own = bits_of(clusters)
    room, has_s, has_c, number = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.int64)
    members: dict[int, tuple[set, set]] = {}  # exact keys of bins, of the shared bits only
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    bins = 0  # open and full ones; the arrays hold them in order of their room
    for i in order:
        size, sb, cb = int(sizes[i]), s_bit[i], c_bit[i]
        at, found = int(np.searchsorted(room[:bins], size)), -1
        step = 64
        while at < bins and found < 0:
            end = min(bins, at + step)
            hit_s, hit_c = (has_s[at:end] & sb) != 0, (has_c[at:end] & cb) != 0
            if not s_own[i]:
                hit_s = np.array([h and sources[i] in members[b][0] for h, b in zip(hit_s, number[at:end], strict=True)], bool)
            if not c_own[i]:
                hit_c = np.array([h and clusters[i] in members[b][1] for h, b in zip(hit_c, number[at:end], strict=True)], bool)
            free = ~(hit_s | hit_c)
            first = int(free.argmax())
            if free[first]:
                found = at + first
            at, step = end, step * 4
        if found < 0:
            b, left, was_s, was_c, found = bins, capacity, np.uint64(0), np.uint64(0), bins
            members[b] = (set(), set())
            bins += 1
        else:
            b, left, was_s, was_c = int(number[found]), int(room[found]), has_s[found], has_c[found]
        where[i], offset[i] = b, capacity - left
        if not s_own[i]:
            members[b][0].add(sources[i])
        if not c_own[i]:
            members[b][1].add(clusters[i])
        # equal rooms stand in order of their bin's number
        low, high = (int(np.searchsorted(room[:found], left - size, side)) for side in ("left", "right"))
        to = low + int(np.searchsorted(number[low:high], b))
        for values, value in ((room, left - size), (has_s, was_s | sb), (has_c, was_c | cb), (number, b)):
            values[to + 1 : found + 1] = values[to:found].copy()
            values[to] = value
    return where, offset


def pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """docs(doc_id, text, source[, cluster]) -> doc_id, source, cluster, piece, start, size."""
    rows = docs.withColumn("__n", F.length(text_of()).cast("long"))
    cluster = F.col("cluster").cast("string") if "cluster" in docs.columns else F.when(F.col("__n") > 0, F.md5(F.col("text")))
    count = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("__n") / capacity))
    return rows.select("doc_id", "source", cluster.alias("cluster"), "__n", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece")).select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"), F.least(F.lit(capacity).cast("long"), F.col("__n") - F.col("piece") * capacity).alias("size")
    )


def pack(docs: DataFrame, capacity: int = 16_384, group_rows: int = 20_000) -> DataFrame:
    """docs(doc_id, text, source[, cluster]) -> doc_id, piece, start, size, bin_id, bin_offset, source,
    cluster. cluster: the documents that count as copies of each other (default: equal texts)."""
    kind = {f.name: f.dataType.simpleString() for f in docs.schema}
    found = cut(pieces(docs, capacity).withColumn("place", F.monotonically_increasing_id()))
    sizes = found.groupBy(F.shiftright("place", 33).alias("p")).count().collect()  # one row a task that wrote
    total, first = 0, {}
    for r in sorted(sizes, key=lambda r: r["p"]):
        first[r["p"]] = total
        total += r["count"]
    groups = max(1, -(-total // group_rows))
    spark = docs.sparkSession
    starts = F.broadcast(spark.createDataFrame(list(first.items()) or [(0, 0)], "p long, first long"))  # one row a task
    rank = F.col("first") + F.col("place").bitwiseAND((1 << 33) - 1)
    dealt = found.join(starts, F.shiftright("place", 33) == F.col("p")).withColumn("rank", rank).withColumn("g", F.col("rank") % groups)
    schema = f"doc_id {kind['doc_id']}, piece bigint, start bigint, size bigint, bin_id bigint, bin_offset bigint, source {kind['source']}, cluster string"

    def run(table: pa.Table) -> pa.Table:  # at most group_rows pieces
        table = table.sort_by([("size", "descending"), ("rank", "ascending")])
        g = table.column("g")[0].as_py()
        sizes = table.column("size").to_numpy()
        bins, offset = best_fit(sizes, table.column("source").to_pylist(), table.column("cluster").to_pylist(), capacity, np.arange(len(sizes)))
        out = table.append_column("bin_id", pa.array(bins + (g << 32))).append_column("bin_offset", pa.array(offset))
        return out.select(["doc_id", "piece", "start", "size", "bin_id", "bin_offset", "source", "cluster"])

    return dealt.select("doc_id", "piece", "start", "size", "source", "cluster", "rank", "g").groupBy("g").applyInArrow(run, schema)
