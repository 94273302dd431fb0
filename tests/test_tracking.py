"""Tracks over planted clips (crossings, gaps, new and lost objects) against a slow tracker, in batch and as a stream, and the video plan."""

import collections

import numpy as np
import pytest

from veilframe.operators import tracking
from veilframe.plans import anonymize
from veilframe.streaming.frames import LiveTracks, track_stream

SCHEMA = "video_id long, frame_no long, det_id long, x0 double, y0 double, x1 double, y1 double"


def clip(video=1):
    """Objects by constant velocity; (first frame, last frame, x, y, vx, vy, side, frames in which it isn't seen)."""
    objects = [
        (0, 19, 0, 50, 8, 0, 20, ()),  # crosses the next one half-way
        (0, 19, 160, 55, -8, 0, 20, ()),
        (0, 19, 20, 150, 5, 3, 24, (7, 8, 9)),  # hidden for three frames
        (4, 12, 300, 10, 0, 6, 16, (8,)),
        (15, 19, 300, 30, 0, 6, 16, ()),  # another one, later, near where that one was
        (0, 3, 400, 400, 1, 1, 30, ()),
    ]
    rows, truth = [], {}
    for frame in range(20):
        seen = [k for k, o in enumerate(objects) if o[0] <= frame <= o[1] and frame not in o[7]]
        for det, k in enumerate(sorted(seen, key=lambda k: (k * 7 + frame) % 5)):
            first, _, x, y, vx, vy, side, _ = objects[k]
            x, y = x + vx * (frame - first), y + vy * (frame - first)
            rows.append((video, frame, det, float(x), float(y), float(x + side), float(y + side)))
            truth[(video, frame, det)] = k
    return rows, truth


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    return round(w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h), 12)


def slow_tracks(rows, threshold=0.3, max_gap=5, gap_threshold=0.1):
    """Frame by frame, in plain loops."""
    frames = collections.defaultdict(dict)
    for v, f, det, *box in rows:
        frames[v, f][det] = box

    def matched(expected):
        out = {}
        for (v, f), now in frames.items():
            before = frames.get((v, f - 1), {})
            pairs = sorted((-overlap(now[i], expected[v, f - 1, j]), i, j) for i in now for j in before if overlap(now[i], expected[v, f - 1, j]) >= threshold)
            left, right = set(), set()
            for _, i, j in pairs:
                if i not in left and j not in right:
                    left.add(i)
                    right.add(j)
                    out[v, f, i] = (v, f - 1, j)
        return out

    boxes = {(v, f, i): b for (v, f), now in frames.items() for i, b in now.items()}

    def speed(matches, k):
        if k not in matches:
            return 0.0, 0.0
        a, b = boxes[k], boxes[matches[k]]
        return (a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2

    def ahead(matches, k, by):
        vx, vy = speed(matches, k)
        x0, y0, x1, y1 = boxes[k]
        return [x0 + vx * by, y0 + vy * by, x1 + vx * by, y1 + vy * by]

    first = matched(boxes)
    links = matched({k: ahead(first, k, 1) for k in boxes})
    ends = [k for k in boxes if k not in set(links.values())]
    starts = [k for k in boxes if k not in links]
    pairs = []
    for e in ends:
        for s in starts:
            gap = s[1] - e[1]
            if s[0] == e[0] and 2 <= gap <= max_gap + 1:
                score = overlap(boxes[s], ahead(links, e, gap))
                if score >= gap_threshold:
                    pairs.append((gap, -score, s[1:], e[1:], s, e))
    for s, e in {(p[4], p[5]) for p in pairs if p == min(q for q in pairs if q[4] == p[4]) and p == min(q for q in pairs if q[5] == p[5])}:
        links[s] = e
    out = {}
    for k in boxes:
        at = k
        while at in links:
            at = links[at]
        out[k] = at[1:]
    return out


def batch_tracks(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {(r.video_id, r.frame_no, r.det_id): (r.track_frame, r.track_det) for r in tracking.tracks(frame, **options).collect()}


def test_planted_clip(spark):
    rows, truth = clip()
    got = batch_tracks(spark, rows)
    assert got == slow_tracks(rows)
    names = collections.defaultdict(set)
    for k, obj in truth.items():
        names[obj].add(got[k])
    assert all(len(v) == 1 for v in names.values())
    assert len({next(iter(v)) for v in names.values()}) == 6


@pytest.mark.parametrize("seed", range(2))
def test_crowded_clips_equal_slow_tracker(spark, seed):
    """Boxes that wander, vanish and come back, in two videos and one without a name."""
    rng = np.random.default_rng(seed)
    rows = []
    for video in (1, 2, None):
        at = rng.integers(0, 120, (7, 2)).astype(float)
        for frame in range(14):
            at += rng.integers(-6, 7, at.shape)
            for k, (x, y) in enumerate(at):
                if rng.random() < 0.8:
                    rows.append((video, frame, k, float(x), float(y), float(x + 25), float(y + 20 + k)))
    assert batch_tracks(spark, rows) == slow_tracks(rows)
    assert batch_tracks(spark, rows, threshold=0.5, max_gap=1) == slow_tracks(rows, 0.5, 1)


def test_long_chain_and_nothing(spark):
    rows = [(1, f, 0, 0.0, 0.0, 9.0, 9.0) for f in range(300)]
    assert set(batch_tracks(spark, rows).values()) == {(0, 0)}
    assert batch_tracks(spark, []) == {}


def test_stream_equals_one_pass(spark, tmp_path):
    """One state a video: the same tracks whatever comes together in a micro-batch; late frames are passed over; planted objects keep their tracks."""
    rows, truth = clip(1)
    more, truth_2 = clip(2)
    per_frame = collections.defaultdict(list)
    for v, f, det, *box in rows + more:
        per_frame[v, f].append((det, *box))
    box = "array<struct<det_id: bigint, x0: double, y0: double, x1: double, y1: double>>"
    schema = f"video_id long, frame_no long, boxes {box}"
    for n, (low, high) in enumerate([(0, 6), (6, 7), (7, 20), (3, 4)]):  # the last one is late
        part = [(v, f, b) for (v, f), b in per_frame.items() if low <= f < high]
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    query = track_stream(stream).writeStream.format("memory").queryName("live_tracks").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.video_id, r.frame_no, r.det_id): r.track for r in spark.table("live_tracks").collect()}
    want = {}
    for v in (1, 2):
        live = LiveTracks()
        for f in range(20):
            want |= {(v, f, det): t for det, t in live.step(f, per_frame[v, f])}
    assert got == want
    for v, t in ((1, truth), (2, truth_2)):
        names = collections.defaultdict(set)
        for k, obj in t.items():
            names[obj].add(got[k])
        assert all(len(x) == 1 for x in names.values()), (v, names)
        assert len({next(iter(x)) for x in names.values()}) == 6


def bright(image):
    if (image[0, 0] == 77).all():
        raise ValueError("lost")
    return anonymize.bright_regions(150)(image)


@anonymize.region_generator
def by_identity(region):
    return np.full_like(region.condition, int(abs(region.z[0]) * 1000) % 100 + 1)


def test_video_plan_keeps_identities(spark):
    """Two bright squares move, one is hidden for two frames: each keeps what its latent vector makes; frames without boxes pass, failed ones are masked."""
    rows = []
    for video in ("a", "b"):
        for frame in range(8):
            im = np.zeros((40, 80, 3), np.uint8)
            if frame != 7:
                im[5:15, 4 * frame + 2 : 4 * frame + 12] = 250
                if frame not in (3, 4):
                    im[25:35, 60 - 4 * frame : 70 - 4 * frame] = 250
            if video == "b" and frame == 2:
                im[0, 0] = 77
            rows.append((f"{video}{frame}", video, frame, *im.shape, bytearray(im.tobytes())))
    frames = spark.createDataFrame(rows, "image_id string, video_id string, frame_no long, height int, width int, n_channels int, data binary")
    out = {r.image_id: r for r in anonymize.anonymise_video(frames, bright, by_identity, 0.1).collect()}
    see = {k: np.frombuffer(bytes(r.data), np.uint8).reshape(40, 80, 3) for k, r in out.items()}
    for video in ("a", "b"):
        high, low = set(), set()
        for frame in range(7):
            if (video, frame) == ("b", 2):
                assert out["b2"].status == "error_masked"
                assert (see["b2"] == 128).all()
                continue
            assert out[f"{video}{frame}"].status == "ok"
            high.add(int(see[f"{video}{frame}"][10, 4 * frame + 6, 0]))
            if frame not in (3, 4):
                low.add(int(see[f"{video}{frame}"][30, 64 - 4 * frame, 0]))
        assert len(high) == len(low) == 1
        assert high != low
        assert out[f"{video}7"].status == "no_region"
        assert (see[f"{video}7"] == 0).all()
    assert see["a0"][10, 6, 0] != see["b0"][10, 6, 0]


@pytest.mark.parametrize("block", [1, 9, 20])
def test_tracks_reach_over_blocks(spark, block):
    """However frames are cut into blocks, tracks are those of the slow tracker; crossing blocks of eight frames or more, with gaps at their edges; repeated rows share one."""
    rng = np.random.default_rng(block)
    rows = []
    for video in (5, None):
        at = rng.integers(0, 90, (6, 2)).astype(float)
        for frame in range(-3, 60):
            at += rng.integers(-5, 6, at.shape)
            for k, (x, y) in enumerate(at):
                if rng.random() < 0.75:
                    rows.append((video, frame, k, float(x), float(y), float(x + 25), float(y + 20 + k)))
    assert batch_tracks(spark, rows + rows[:5], block=block) == slow_tracks(rows)


def test_tracks_deal_detections_once(spark):
    """One exchange of boxes by image and one by clip, no join: what is shuffled does not grow with pairs, chains or rounds."""
    frame = spark.createDataFrame(clip()[0], SCHEMA)
    plan = tracking.block_tracks(frame, 0.3, 5, 0.1, tracking.BLOCK)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan
    assert "Join" not in tracking.tracks(frame)._jdf.queryExecution().executedPlan().toString()
