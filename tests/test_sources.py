"""The live source, tar byte ranges, detectors in SQL, and contours against floods."""

import io
import tarfile
import time

import numpy as np
import pytest

from veilframe.functions.storage import LIVE, free
from veilframe.operators import contours
from veilframe.plans import anonymize
from veilframe.sources import formats, tar_source
from veilframe.sources.live import latest_frames
from veilframe.sources.shards import shard_numbers


def test_latest_frame_only(spark, tmp_path):
    """Three files wait: the first trigger reads the last one and counts two; two more come, the next reads the last of those; nothing new gives nothing."""
    folder = tmp_path / "in"
    folder.mkdir()

    def arrive(k):
        spark.createDataFrame([(1, 10 * k), (2, 10 * k + 1)], "video_id long, image_id long").toPandas().to_parquet(tmp_path / f"{k}.tmp")
        time.sleep(0.02)
        (tmp_path / f"{k}.tmp").rename(folder / f"{k}.parquet")

    def trigger():
        stream = latest_frames(spark, f"file://{folder}", "video_id long, image_id long").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        stream.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("video_id long, image_id long, dropped long").parquet(str(tmp_path / "out")).collect())

    for k in (1, 2, 3):
        arrive(k)
    first = [(1, 30, 2), (2, 31, 2)]
    assert trigger() == first
    assert trigger() == first
    (folder / "1.parquet").write_bytes(b"broken")  # the backlog is never opened
    for k in (4, 5):
        arrive(k)
    assert trigger() == sorted([*first, (1, 50, 1), (2, 51, 1)])


def tar_of(path, n, rng):
    with tarfile.open(path, "w") as tar:
        for k in range(n):
            for suffix in ("png", "cls", "note.txt"):
                data = rng.bytes(int(rng.integers(0, 3000))) if suffix == "png" else str(k).encode()
                name = f"dir.d/{'long' * 40 if k % 7 == 0 else ''}k{k:04d}.{suffix}"  # long names take headers of their own
                info = tarfile.TarInfo(name)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))


def test_ranges_are_longer_where_there_are_many_bytes(tmp_path, monkeypatch):
    """Short ranges stay as asked for while they are few; beyond TASKS they grow with the input, up to SPLIT_BYTES, and each sample is in one of them."""
    tar_of(tmp_path / "a-000.tar", 90, np.random.default_rng(3))
    reader = tar_source.TarReader(f"file://{tmp_path}", 2048)
    size = (tmp_path / "a-000.tar").stat().st_size
    many = len(reader.partitions())
    monkeypatch.setattr(tar_source, "TASKS", 8)
    few = reader.partitions()
    assert 1 < len(few) <= 8 < many
    assert [p.start for p in few] == [0, *[p.end for p in few[:-1]]]
    assert few[-1].end == size
    with tarfile.open(tmp_path / "a-000.tar") as tar:
        want = [m.name for m in tar if m.isfile()]
    assert [f"{key}.{member}" for p in few for _, key, member, _ in reader.read(p)] == want
    assert reader.range_bytes(1 << 50) == tar_source.SPLIT_BYTES
    assert tar_source.TarReader("file:///none", 1 << 40).range_bytes(1 << 50) == 1 << 40


def test_one_large_tar_is_read_by_many_tasks(spark, tmp_path):
    rng = np.random.default_rng(2)
    tar_of(tmp_path / "a-000.tar", 120, rng)
    tar_of(tmp_path / "a-001.tar", 3, rng)
    want = []
    for name in ("a-000.tar", "a-001.tar"):
        with tarfile.open(tmp_path / name) as tar:
            want += [(f"file://{tmp_path}/{name}", *tar_source.split_name(m.name), tar.extractfile(m).read()) for m in tar if m.isfile()]
    for path in (f"file://{tmp_path}", f"file://{tmp_path}/a-{{000..001}}.tar"):
        rows = tar_source.tar_members(spark, path, 20_000)
        assert rows.rdd.getNumPartitions() > 8
        assert sorted((r.shard, r.key, r.member, bytes(r.data)) for r in rows.collect()) == sorted(want)
    # a sample's members are in one range
    whole = tar_source.tar_members(spark, f"file://{tmp_path}", 20_000).selectExpr("shard", "key", "spark_partition_id() AS p").distinct()
    assert whole.count() == 123
    assert tar_source.tar_members(spark, f"file://{tmp_path}").rdd.getNumPartitions() == 2
    labels = {(r.shard, r.key): r.value for r in tar_source.decoded_members(rows, "cls").collect()}
    assert len(labels) == 123
    assert all(int(key[1][-4:]) == v for key, v in labels.items())
    assert tar_source.decoded_members(rows, "txt").filter("value is null").count() == 0
    with pytest.raises(Exception, match="FileNotFound"):
        tar_source.tar_members(spark, f"file://{tmp_path}/none.tar").collect()


def test_decoders_by_suffix(spark):
    array = io.BytesIO()
    np.save(array, np.array([[1.5, 2.0]]))
    rows = [("s", "k", "npy", bytearray(array.getvalue())), ("s", "k", "json", bytearray(b'{"b": 1, "a": 2}')), ("s", "k", "x.cls", bytearray(b"7"))]
    members = spark.createDataFrame(rows, tar_source.SCHEMA)
    assert tar_source.decoded_members(members, "npy").first().value == [1.5, 2.0]
    assert tar_source.decoded_members(members, "json").first().value == '{"a": 2, "b": 1}'
    assert tar_source.decoded_members(members, "cls").first().value == 7
    with pytest.raises(KeyError):
        tar_source.decoded_members(members, "tiff")


def test_detectors_in_sql(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(5):
        im = rng.integers(0, 90, (20, 30, 3)).astype(np.uint8)
        for k in range(i):
            im[2 + 3 * k : 4 + 3 * k, 5 * k : 5 * k + 4] = 250
        rows.append((i, *im.shape, bytearray(im.tobytes())))
    images = spark.createDataFrame(rows, anonymize.IMAGE_SCHEMA)
    images.createOrReplaceTempView("images_of_test")
    anonymize.register_sql_detector(spark, "bright_boxes", anonymize.bright_regions(200))
    got = spark.sql("SELECT i.image_id, d.* FROM images_of_test i, LATERAL bright_boxes(i.height, i.width, i.n_channels, i.data) d WHERE d.score > 0.5")
    want = anonymize.detect(images, anonymize.bright_regions(200), 0.5)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 10
    with pytest.raises(Exception, match="takes height"):
        spark.sql("SELECT * FROM bright_boxes('a', 1, 1, X'00')").collect()


def test_scratch_folders_are_freed(spark):
    from veilframe.plans import catalog

    free()
    catalog.QUERIES["s22_frame_stream"](spark, "/root/testdata/sf0.001").collect()
    assert any("frames-" in path for path in LIVE)
    free()
    assert not LIVE


def flood(free_pixels, start, corners):
    seen, todo = {start}, [start]
    while todo:
        y, x = todo.pop()
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                to = (y + dy, x + dx)
                if (dy or dx) and (corners or not (dy and dx)) and to in free_pixels and to not in seen:
                    seen.add(to)
                    todo.append(to)
    return seen


def slow_contours(mask):
    """By floods: (box, area by squares of four pixels of the filled region) of the regions that the ground around the image touches, and all boxes."""
    h, w = mask.shape
    hits = {(int(y), int(x)) for y, x in zip(*np.nonzero(mask), strict=True)}
    frame = {(y, x) for y in range(-1, h + 1) for x in range(-1, w + 1)}
    outside = flood(frame - hits, (-1, -1), False)
    found, everything, left = [], [], set(hits)
    while left:
        region = flood(hits, min(left), True)
        left -= region
        box = (min(x for _, x in region), min(y for y, _ in region), max(x for _, x in region) + 1, max(y for y, _ in region) + 1)
        everything.append(box)
        if any((y + dy, x + dx) in outside for y, x in region for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0))):
            filled = frame - flood(frame - region, (-1, -1), False)
            n = [sum((y + a, x + b) in filled for a in (0, 1) for b in (0, 1)) for y in range(-1, h) for x in range(-1, w)]
            found.append((box, n.count(4) + n.count(3) / 2))
    return found, everything


@pytest.mark.parametrize("seed", range(60))
def test_contours_equal_floods(seed):
    rng = np.random.default_rng(seed)
    mask = rng.random((int(rng.integers(1, 14)), int(rng.integers(1, 14)))) < rng.choice([0.2, 0.45, 0.6, 0.85])
    found, everything = slow_contours(mask)
    got = contours.external_contours(mask)
    assert [(contours.contour_box(p), contours.contour_area(p)) for p in got] == found
    assert contours.region_boxes(mask) == everything
    assert all(mask[y, x] for p in got for x, y in p)


def test_ring_with_a_blob_is_one_region():
    mask = np.zeros((40, 60), bool)
    mask[5:35, 5:55] = True
    mask[10:30, 10:50] = False
    mask[15:20, 20:40] = True
    assert [contours.contour_box(p) for p in contours.external_contours(mask)] == [(5, 5, 55, 35)]
    assert contours.contour_area(contours.external_contours(mask)[0]) == 49 * 29
    assert len(contours.region_boxes(mask)) == 2


def test_text_regions_go_by_the_area_inside_the_border():
    """A solid line of text stays; a thin zigzag of the same box, whose border holds almost nothing, goes."""
    mask = np.zeros((120, 200), bool)
    mask[10:30, 10:70] = True
    for x in range(60):
        mask[60 + abs(x % 38 - 19), 10 + x] = True
    assert contours.text_regions(mask) == [(10, 10, 70, 30, 59.0 * 19)]
    thin = contours.external_contours(mask)[1]
    assert contours.contour_box(thin) == (10, 60, 70, 80)
    assert contours.contour_area(thin) == 0


def test_linear_histogram_map(spark):
    """Against the quantile map by interpolation, on images of different sizes."""
    from veilframe.operators import pixels

    rng = np.random.default_rng(11)
    a, b = rng.integers(40, 90, (9, 7)), rng.integers(0, 256, (12, 5)) // 3 * 3
    frame = lambda m: spark.createDataFrame([(1, y, x, int(v)) for (y, x), v in np.ndenumerate(m)], "image_id long, y long, x long, v long")
    got = {(r.y, r.x): r.v for r in pixels.histogram_match(frame(a), frame(b)).collect()}
    values, counts = np.unique(a, return_counts=True)
    others, n = np.unique(b, return_counts=True)
    want = dict(zip(values.tolist(), np.interp(np.cumsum(counts) / a.size, np.cumsum(n) / b.size, others), strict=True))
    assert all(got[y, x] == pytest.approx(want[int(v)], abs=1e-9) for (y, x), v in np.ndenumerate(a))


def serial_shards(sizes, max_bytes, max_records):
    out, shard, count, total = [], -1, max_records, 0
    for size in sizes:
        if count >= max_records or total >= max_bytes:
            shard, count, total = shard + 1, 0, 0
        out.append(shard)
        count, total = count + 1, total + (size or 0)
    return out


@pytest.mark.parametrize(("n", "max_bytes", "max_records", "block", "group"), [(500, 900, 7, 20, 3), (500, 50, 1000, 10, 2), (333, 10**9, 9, 9, 4), (64, 1, 5, 5, 1), (5, 100, 3000, 10, 2), (0, 10, 10, 10, 2)])
def test_shards_equal_serial_cutting(spark, n, max_bytes, max_records, block, group):
    """At any partitioning, with empty, missing and oversized samples."""
    rng = np.random.default_rng(n)
    sizes = [None if v < 8 else 0 if v < 16 else 5000 if v > 190 else int(v) for v in rng.integers(0, 200, n)]
    frame = spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "k long, size long").repartition(7)
    got = shard_numbers(frame, [frame["k"]], frame["size"], max_bytes, max_records, block, group)
    assert [r.shard for r in got.orderBy("k").collect()] == serial_shards(sizes, max_bytes, max_records)
    assert [r.pos for r in got.orderBy("k").collect()] == list(range(n))


def test_tar_by_shard_numbers(spark):
    frame = spark.createDataFrame([(f"k{k:03d}", b"x" * 50) for k in range(25)], "key string, bin binary")
    numbered = shard_numbers(frame, [frame["key"]], frame["bin"].isNotNull().cast("long") * 50, 200, 100)
    tars = formats.write_tar(numbered.select("key", "bin", "shard"))
    members = {r.path: tarfile.open(fileobj=io.BytesIO(bytes(r.content))).getnames() for r in tars.collect()}
    assert {k: len(v) for k, v in members.items()} == {f"shard-{k:06d}.tar": 4 if k < 6 else 1 for k in range(7)}
    assert members["shard-000001.tar"] == [f"k{k:03d}.bin" for k in range(4, 8)]
