"""Tracks over a clip: detections of neighbouring frames are matched, matches are chained, chains are joined over gaps.

Matching is done twice, the second time with boxes moved on by the velocity that the first gave (constant velocity), so tracks that cross keep their own.
A chain that ends is joined to one that starts up to ``max_gap`` frames later where its moved box overlaps that one's first box, if each is the other's
best (shortest gap, then greatest overlap).

What a detection carries on is settled by a few frames before it. So a video is cut into blocks of frames, each with as many frames before it as that takes;
detections are dealt out once, by block, and a worker matches blocks whole, all their frames at once. No task holds a video. Where tracks reach over
blocks, what each block hands on is chained by pointer jumping: each round doubles how far back a pointer reaches, and one that has reached its
chain's first leaves.

Defined results: frames without detections are gaps; a null video is a video of its own; repeated (video, frame, det_id) are an error of the caller and
share a track; detections without a frame or a number have none; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import Cut

c = F.col
KEY = ("video_id", "frame_no", "det_id")
BOX = ("x0", "y0", "x1", "y1")
#: Frames of a block, and pairs of boxes that are measured at once.
BLOCK, PAIRS = 128, 1 << 18


def overlaps(at: np.ndarray, boxes: np.ndarray, other_at: np.ndarray, others: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other row, IoU) of the boxes that stand at the same place and overlap by the threshold at least, row by row. Places are sorted."""
    low, high = np.searchsorted(other_at, at, "left"), np.searchsorted(other_at, at, "right")
    ends = np.cumsum(high - low)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    first = 0
    while first < len(at):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PAIRS, "right")))
        n = (high - low)[first:last]
        i = np.repeat(np.arange(first, last), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n - low[first:last], n)
        for low_side, high_side in ((0, 2), (1, 3)):
            near = (boxes[low_side][i] < others[high_side][j]) & (others[low_side][j] < boxes[high_side][i])
            i, j = i[near], j[near]
        (x0, y0, x1, y1), (u0, v0, u1, v1) = (b[i] for b in boxes), (b[j] for b in others)
        both = (np.minimum(x1, u1) - np.maximum(x0, u0)) * (np.minimum(y1, v1) - np.maximum(y0, v0))
        iou = np.round(both / ((x1 - x0) * (y1 - y0) + (u1 - u0) * (v1 - v0) - both), 12)
        enough = iou >= threshold
        found.append((i[enough], j[enough], iou[enough]))
        first = last
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def bests(of: np.ndarray, n: int) -> np.ndarray:
    """Whether each pair of an ordered list is the first of its side. n: rows of the side."""
    first = np.empty(n, np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    return first[of] == np.arange(len(of))


def frame_matches(at: np.ndarray, boxes: np.ndarray, expected: np.ndarray, threshold: float) -> np.ndarray:
    """The row of the frame before that each row carries on, -1 for none: best overlap first, each side once. A pair that is the first of both its sides is
    taken, those that share a side with it go, until none is left."""
    out = np.full(len(at), -1)
    i, j, iou = overlaps(at - 1, boxes, at, expected, threshold)
    order = np.argsort(-iou, kind="stable")
    i, j = i[order], j[order]
    while len(i):
        taken = bests(i, len(at)) & bests(j, len(at))
        out[i[taken]] = j[taken]
        gone = np.zeros(len(at), bool)
        gone[j[taken]] = True
        left = (out[i] < 0) & ~gone[j]
        i, j = i[left], j[left]
    return out


def velocities(boxes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How far each centre came from that of the row it carries on, as moves of the four sides; 0 without one."""
    centre = (boxes[:2] + boxes[2:]) / 2
    return np.tile(np.where(before >= 0, centre - centre[:, before], 0.0), (2, 1))


def gap_links(at: np.ndarray, boxes: np.ndarray, speed: np.ndarray, before: np.ndarray, max_gap: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows that start a chain, rows that end one) of those that are each other's best over gaps."""
    starts, ended = np.flatnonzero(before < 0), np.ones(len(at), bool)
    ended[before[before >= 0]] = False
    ends = np.flatnonzero(ended)
    i, j = [], []
    for gap in range(2, max_gap + 2):
        a, b, iou = overlaps(at[starts] - gap, boxes[:, starts], at[ends], boxes[:, ends] + speed[:, ends] * gap, threshold)
        order = np.argsort(-iou, kind="stable")
        i.append(starts[a[order]]), j.append(ends[b[order]])
    if not i:
        return starts[:0], ends[:0]
    i, j = np.concatenate(i), np.concatenate(j)
    both = bests(i, len(at)) & bests(j, len(at))
    return i[both], j[both]


def roots(at: np.ndarray, boxes: np.ndarray, own: np.ndarray, threshold: float, max_gap: int, gap_threshold: float) -> np.ndarray:
    """The row that each row's track is known from: its first, or the last one that is not the block's own. at: block and frame as one number, sorted."""
    first = frame_matches(at, boxes, boxes, threshold)
    before = frame_matches(at, boxes, boxes + velocities(boxes, first), threshold)
    start, end = gap_links(at, boxes, velocities(boxes, before), before, max_gap, gap_threshold)
    before[start] = end
    to = np.where(own & (before >= 0), before, np.arange(len(at)))
    while (to[to] != to).any():
        to = to[to]
    return to


def chain_firsts(links: DataFrame) -> DataFrame:
    """links(KEY, p_frame, p_det; null for a first one), each named as predecessor once at most -> KEY, first_frame, first_det of its chain."""
    done = c("p_frame").isNull()
    now = Cut(links.select(*KEY, F.coalesce("p_frame", "frame_no").alias("to_frame"), F.coalesce("p_det", "det_id").alias("to_det"), done.alias("done")))
    while now.df.filter(~c("done")).limit(1).count():
        at = now.df.select("video_id", c("frame_no").alias("to_frame"), c("det_id").alias("to_det"), c("to_frame").alias("n_frame"), c("to_det").alias("n_det"), c("done").alias("n_done"))
        # done ones aren't looked up from, so a first one is asked by its follower only, and then by those that pointed there
        going = now.df.filter(~c("done")).join(at, ["video_id", "to_frame", "to_det"])
        going = going.select(*KEY, c("n_frame").alias("to_frame"), c("n_det").alias("to_det"), c("n_done").alias("done"))
        new = Cut(now.df.filter("done").unionByName(going))
        now.drop()
        now = new
    return now.df.select(*KEY, c("to_frame").alias("first_frame"), c("to_det").alias("first_det"))


def block_tracks(detections: DataFrame, threshold: float, max_gap: int, gap_threshold: float, block: int) -> DataFrame:
    """KEY, to_frame, to_det, done of each detection: the first of its track where that lies in its block, else (not done) the last one before the block."""
    reach = max_gap + 3  # links look back over the gap, and at what ends there by the velocity of matches with moved boxes
    block = max(block, reach)
    rows = detections.select("video_id", *[c(n).cast("long") for n in KEY[1:]], *[c(n).cast("double") for n in BOX]).filter("frame_no IS NOT NULL AND det_id IS NOT NULL")
    place = F.pmod("frame_no", F.lit(block))
    start = c("frame_no") - place
    rows = rows.withColumn("block", F.explode(F.when(place >= block - reach, F.array(start, start + block)).otherwise(F.array(start))))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("video_id", "block").orderBy(*KEY[1:], *BOX)))
    schema = "video_id " + detections.schema["video_id"].dataType.simpleString() + ", frame_no long, det_id long, to_frame long, to_det long, done boolean"

    def tracked(table: pa.Table) -> pa.RecordBatch:
        frame, det, start, place = (table.column(n).to_numpy() for n in ("frame_no", "det_id", "block", "place"))
        boxes = np.array([table.column(n).to_numpy() for n in BOX])
        # a block's frames are fewer than its share of the numbers by ``reach``, so none is next to another block's
        at = np.cumsum(place == 1) * (block + 2 * reach) + frame - start + reach
        own = frame >= start
        new = np.r_[True, (np.diff(at) != 0) | (np.diff(det) != 0)]  # the first of those that repeat an id
        some, rows = np.flatnonzero(new), np.flatnonzero(own)
        to = some[roots(at[some], boxes[:, some], own[some], threshold, max_gap, gap_threshold)][(np.cumsum(new) - 1)[rows]]
        out = [table.column("video_id").combine_chunks().take(pa.array(rows)), *map(pa.array, (frame[rows], det[rows], frame[to], det[to], own[to]))]
        return pa.RecordBatch.from_arrays(out, names=["video_id", "frame_no", "det_id", "to_frame", "to_det", "done"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # of the block that is not read to its end yet, and whole ones before it
        for batch in batches:
            begins = np.flatnonzero(batch.column("place").to_numpy() == 1)
            if len(begins) and (kept or begins[-1]):
                yield tracked(pa.Table.from_batches([*kept, batch.slice(0, begins[-1])]))
                kept, batch = [], batch.slice(begins[-1])
            kept.append(batch)
        if kept and sum(b.num_rows for b in kept):
            yield tracked(pa.Table.from_batches(kept))

    return rows.mapInArrow(run, schema)


def tracks(detections: DataFrame, threshold: float = 0.3, max_gap: int = 5, gap_threshold: float = 0.1, block: int = BLOCK) -> DataFrame:
    """detections(KEY, BOX) -> KEY, track_frame, track_det: the first detection of each one's track. block: frames of a video that are tracked together."""
    found = Cut(block_tracks(detections, threshold, max_gap, gap_threshold, block)).df
    whole = found.select(*KEY, c("to_frame").alias("track_frame"), c("to_det").alias("track_det"), "done")
    going = found.filter(~c("done"))
    if not going.limit(1).count():
        return whole.drop("done")
    # what blocks hand on: each row that a later block points to, by where it points itself
    found, going = (v.withColumn("video_id", F.struct("video_id")) for v in (found, going))
    handed = going.select("video_id", c("to_frame").alias("frame_no"), c("to_det").alias("det_id")).distinct().join(found.dropDuplicates(KEY), list(KEY))
    before = lambda n: F.when(~c("done"), c(n))
    chains = chain_firsts(handed.select(*KEY, before("to_frame").alias("p_frame"), before("to_det").alias("p_det")))
    first = handed.filter("done").select("video_id", c("frame_no").alias("first_frame"), c("det_id").alias("first_det"), c("to_frame").alias("track_frame"), c("to_det").alias("track_det"))
    of = chains.join(first, ["video_id", "first_frame", "first_det"]).select("video_id", c("frame_no").alias("to_frame"), c("det_id").alias("to_det"), "track_frame", "track_det")
    later = going.join(of, ["video_id", "to_frame", "to_det"]).select(c("video_id")["video_id"].alias("video_id"), "frame_no", "det_id", "track_frame", "track_det")
    return whole.filter("done").drop("done").unionByName(later)


def track_seed(track_frame: Column, track_det: Column) -> Column:
    """The latent seed of a track: of its video and its first detection alone, so it lasts for the clip."""
    return F.conv(F.substr(F.md5(F.concat_ws(":", F.coalesce(c("video_id").cast("string"), F.lit("")), track_frame, track_det)), F.lit(1), F.lit(8)), 16, 10).cast("long")
