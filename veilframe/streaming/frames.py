"""Frames as a stream: latest-frame-only reading, identities that last for a clip, late frames by watermark."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.live import latest_frames

c = F.col
FRAME_SCHEMA = "video_id long, track string, ts timestamp, image_id long"


def latest_per_tick(frames: DataFrame, seconds: int) -> DataFrame:
    """Batch model of a reader without a buffer: of the frames that arrive within a tick only the newest is handled."""
    tick = F.floor(F.unix_timestamp("ts") / seconds).cast("long")
    g = frames.groupBy("video_id", tick.alias("tick"))
    return g.agg(F.max_by("image_id", F.struct("ts", "image_id")).alias("image_id"), (F.count("*") - 1).alias("dropped"))


def frame_stream(spark: SparkSession, path: str, latest_only: bool = False, schema: str = FRAME_SCHEMA) -> DataFrame:
    """Parquet files of frames as they arrive, one a trigger. latest_only: the newest alone, with the count of those passed over, which are never read."""
    if latest_only:
        return latest_frames(spark, path, schema)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def windowed_counts(frames: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Frames per video and window; windows close once the watermark has passed them."""
    return frames.withWatermark("ts", delay).groupBy(F.window("ts", window), "video_id").agg(F.count("*").alias("n"))


IDENTITY_SCHEMA = "video_id long, track string, identity long, first_image long, n long"
IDENTITY_STATE = "identity long, first_image long, n long"


def track_identities(frames: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """Stateful: each (video, track) keeps one identity, that of its first frame, for as long as it is seen."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["ts", "image_id"])
        identity, first, n = state.get if state.exists else (int(rows["identity"].iloc[0]), int(rows["image_id"].iloc[0]), 0)
        n += len(rows)
        state.update((identity, first, n))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame({"video_id": [key[0]], "track": [key[1]], "identity": [identity], "first_image": [first], "n": [n]})

    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    keyed = frames.withColumn("identity", F.pmod(F.xxhash64("video_id", "track"), F.lit(1 << 31)))
    return keyed.groupBy("video_id", "track").applyInPandasWithState(step, IDENTITY_SCHEMA, IDENTITY_STATE, "update", kind)


def identities_batch(frames: DataFrame) -> DataFrame:
    """What track_identities holds after all frames, as one aggregation."""
    keyed = frames.withColumn("identity", F.pmod(F.xxhash64("video_id", "track"), F.lit(1 << 31)))
    return keyed.groupBy("video_id", "track").agg(F.min("identity").alias("identity"), F.min_by("image_id", F.struct("ts", "image_id")).alias("first_image"), F.count("*").alias("n"))


TRACK_SCHEMA = "video_id {kind}, frame_no long, det_id long, track long"
TRACK_STATE = "last_frame long, next_track long, tracks string"


class LiveTracks:
    """Live tracks of one video: each with its last box, velocity and frame. Boxes are expected at constant velocity; of the overlaps with a frame's boxes
    the greatest come first; a track that isn't seen for more than max_age frames ends."""

    def __init__(self, last_frame: int = -1, next_track: int = 0, tracks: list | None = None, threshold: float = 0.3, max_age: int = 5):
        self.last_frame, self.next_track, self.tracks, self.threshold, self.max_age = last_frame, next_track, tracks or [], threshold, max_age

    def step(self, frame: int, boxes: list[tuple[int, float, float, float, float]]) -> list[tuple[int, int]]:
        """boxes: (det_id, x0, y0, x1, y1) -> (det_id, track). A frame that isn't later than the newest is passed over."""
        if frame <= self.last_frame:
            return []
        self.last_frame = frame
        self.tracks = [t for t in self.tracks if frame - t["frame"] <= self.max_age + 1]
        pairs = []
        for k, t in enumerate(self.tracks):
            ahead = frame - t["frame"]
            at = [v + t["v"][i % 2] * ahead for i, v in enumerate(t["box"])]
            for det, *b in boxes:
                w, h = min(at[2], b[2]) - max(at[0], b[0]), min(at[3], b[3]) - max(at[1], b[1])
                if w > 0 and h > 0:
                    score = w * h / ((at[2] - at[0]) * (at[3] - at[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h)
                    if score >= self.threshold:
                        pairs.append((-round(score, 12), det, t["track"], k))
        of, taken = {}, set()
        for _, det, _, k in sorted(pairs):
            if det not in of and k not in taken:
                of[det] = k
                taken.add(k)
        out = []
        for det, *b in sorted(boxes):
            if det in of:
                t = self.tracks[of[det]]
                ahead = frame - t["frame"]
                t["v"] = [(b[i] + b[i + 2] - t["box"][i] - t["box"][i + 2]) / 2 / ahead for i in (0, 1)]
                t["box"], t["frame"] = list(b), frame
            else:
                t = {"track": self.next_track, "box": list(b), "v": [0.0, 0.0], "frame": frame}
                self.next_track += 1
                self.tracks.append(t)
            out.append((det, t["track"]))
        return out


def track_stream(frames: DataFrame, threshold: float = 0.3, max_age: int = 5, timeout_ms: int | None = None) -> DataFrame:
    """Stateful tracks: frames(video_id, frame_no, boxes array<struct<det_id, x0, y0, x1, y1>>), one row a frame, also where it has no boxes -> TRACK_SCHEMA. The
    state of a video is its live tracks; a null list is a frame without boxes."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, following, tracks = state.get if state.exists else (-1, 0, "[]")
        live = LiveTracks(last, following, json.loads(tracks), threshold, max_age)
        rows = pd.concat(list(batches)).sort_values("frame_no")
        out = []
        for frame, boxes in zip(rows["frame_no"], rows["boxes"], strict=True):
            listed = [] if boxes is None else [(b["det_id"], b["x0"], b["y0"], b["x1"], b["y1"]) for b in boxes]
            out += [(key[0], int(frame), det, track) for det, track in live.step(int(frame), listed)]
        state.update((live.last_frame, live.next_track, json.dumps(live.tracks)))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=["video_id", "frame_no", "det_id", "track"])

    box = "array<struct<det_id: bigint, x0: double, y0: double, x1: double, y1: double>>"
    rows = frames.select("video_id", c("frame_no").cast("long").alias("frame_no"), c("boxes").cast(box).alias("boxes"))
    kind = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    schema = TRACK_SCHEMA.format(kind=frames.schema["video_id"].dataType.simpleString())
    return rows.groupBy("video_id").applyInPandasWithState(step, schema, TRACK_STATE, "append", kind)
