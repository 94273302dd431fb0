"""Hand-computed values, properties, formats and streams."""

import io
import struct
import tarfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from veilframe.functions import registry
from veilframe.functions import relations as R
from veilframe.operators import contours, geometry as G
from veilframe.operators import kernels, keypoints, masks, matching, metrics
from veilframe.operators import pixels as X
from veilframe.plans import anonymize
from veilframe.sources import formats, scan, sinks
from veilframe.streaming import frames


@pytest.mark.parametrize(
    ("start", "end", "target", "limit", "want"),
    [(10, 20, 20, 100, (5, 25)), (10, 20, 13, 100, (9, 22)), (2, 12, 20, 100, (0, 20)), (90, 98, 20, 100, (80, 100)), (1, 9, 30, 20, (-10, 20)), (0, 10, 40, 20, (-15, 25)), (3, 5, 1, 10, (4, 5))],
)
def test_expand_axis(spark, start, end, target, limit, want):
    df = spark.createDataFrame([(start, end)], "s long, e long")
    r = G.expand_axis(df, "s", "e", F.lit(target), limit).first()
    assert (r.s, r.e) == want and r.e - r.s == target


def test_expand_square_contains_box(spark):
    rows = G.expand_square(R.boxes(spark, SMALL), 0.35, 640, 480).filter("ex0 is not null").collect()
    assert rows
    for r in rows:
        assert r.ex1 - r.ex0 == r.ey1 - r.ey0
        assert r.ex0 <= r.x0 and r.ey0 <= r.y0 and r.ex1 >= r.x1 and r.ey1 >= r.y1 and r.ex0 >= 0 and r.ex1 <= 640 and r.ey1 <= 480


def test_greedy_is_one_to_one(spark):
    b = R.boxes(spark, "/root/testdata/sf0.01")
    m = matching.match_in_order(b.filter("kind = 'person'"), b.filter("kind = 'person_cse'"), 0.1).collect()
    assert len({(r.image_id, r.det_id) for r in m}) == len(m) == len({(r.image_id, r.o_det_id) for r in m})


def test_flip_map_is_an_involution():
    m = keypoints.flip_map()
    assert [m[i] for i in m] == list(range(17)) and m[0] == 0 and m[1] == 2
    assert keypoints.flip_map(keypoints.FACE_JOINTS) == [0, 2, 1, 4, 3, 6, 5]


def test_similarity_fit():
    rng = np.random.default_rng(0)
    p = rng.random((9, 2))
    a = 0.7
    m = np.array([[2 * np.cos(a), -2 * np.sin(a), 3], [2 * np.sin(a), 2 * np.cos(a), -1]])
    assert np.allclose(keypoints.similarity_fit(p, p @ m[:, :2].T + m[:, 2]), m)
    assert np.isnan(keypoints.similarity_fit(np.ones((3, 2)), p[:3])).all()


def test_polygons_and_regions():
    m = masks.fill_polygons([[(1, 1), (4, 1), (4, 3), (1, 3)]], 7, 6)
    assert m.sum() == 12 and m[1:4, 1:5].all()
    m[5, 6] = True
    assert contours.region_boxes(m) == [(1, 1, 5, 4), (6, 5, 7, 6)]


def test_frechet():
    a, b = np.array([[2.0, 0.3], [0.3, 1.0]]), np.array([[1.0, 0.0], [0.0, 3.0]])
    assert metrics.frechet(np.zeros(2), a, np.zeros(2), a) == pytest.approx(0, abs=1e-9)
    values, vectors = np.linalg.eig(a @ b)
    want = 2.0 + np.trace(a + b) - 2 * np.sqrt(values).sum()
    assert metrics.frechet(np.zeros(2), a, np.ones(2), b) == pytest.approx(want)


def test_kernels_leave_the_rest_alone():
    im = np.random.default_rng(1).integers(0, 256, (40, 50, 3)).astype(np.uint8)
    for name, f in kernels.GENERATORS.items():
        out = kernels.redact(im, [(5, 6, 20, 30)], f)
        keep = np.ones((40, 50), bool)
        keep[6:30, 5:20] = False
        assert (out[keep] == im[keep]).all(), name
        if name != "identity":
            assert (out[~keep] != im[~keep]).any(), name
    once = kernels.redact(im, [(0, 0, 9, 9)], kernels.mask_out)
    assert (kernels.redact(once, [(0, 0, 9, 9)], kernels.mask_out) == once).all()
    assert (kernels.redact(im, [(60, 60, 80, 80), (3, 3, 3, 9)], kernels.mask_out) == im).all()


def test_relation_and_kernel_blur_agree(spark):
    from veilframe.operators import pixels

    im = np.random.default_rng(2).integers(0, 256, (8, 8)).astype(np.uint8)
    rows = [(1, y, x, int(im[y, x])) for y in range(8) for x in range(8)]
    df = spark.createDataFrame(rows, "image_id long, y long, x long, v long")
    got = np.zeros((8, 8))
    for r in pixels.blur(df, 5, 1.2, 8, 8).collect():
        got[r.y, r.x] = r.v
    assert np.abs(got - kernels.gaussian_blur(im[:, :, None], 5, 1.2)[:, :, 0]).max() <= 0.51
    for r in pixels.pixelate(df, 3, 8, 8).collect():
        got[r.y, r.x] = r.v
    assert np.abs(got - kernels.pixelate(im[:, :, None], 3)[:, :, 0]).max() <= 0.51


def test_warp_and_resize():
    im = np.random.default_rng(3).integers(0, 256, (12, 10, 3)).astype(np.uint8)
    same = np.array([[1.0, 0, 0], [0, 1, 0]])
    assert (kernels.warp(im, same, 12, 10) == im).all()
    assert (kernels.resize(im, 12, 10) == im).all() or kernels.resize(im, 12, 10).shape == im.shape
    assert (kernels.resize(np.full((9, 9, 1), 77, np.uint8), 4, 5, "face") == 77).all()
    shift = np.array([[1.0, 0, 2], [0, 1, 0]])
    assert (kernels.warp(im, shift, 12, 10)[:, 2:] == im[:, :-2]).all()


def test_png_filters_and_exif():
    im = np.random.default_rng(4).integers(0, 256, (9, 11, 3)).astype(np.uint8)
    assert (formats.decode_png(formats.encode_png(im)) == im).all()
    tiff = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + struct.pack("<HHIH", 0x0112, 3, 1, 6) + b"\0\0" + b"\0" * 4
    jpeg = b"\xff\xd8\xff\xe1" + struct.pack(">H", len(tiff) + 8) + b"Exif\0\0" + tiff + b"\xff\xd9"
    assert formats.exif_orientation(jpeg) == 6 and formats.exif_orientation(b"\xff\xd8\xff\xd9") == 1
    assert formats.orient(im, 6).shape == (11, 9, 3)
    assert (formats.orient(formats.orient(im, 6), 8) == im).all()
    assert formats.brace_range("a-{008..010}.tar") == ["a-008.tar", "a-009.tar", "a-010.tar"]


def test_tar_shards(spark):
    blob = io.BytesIO()
    with tarfile.open(fileobj=blob, mode="w") as tar:
        for name, data in (("k1.image.png", b"x"), ("k1.txt", b"yy"), ("k2.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    rows = formats.tar_samples(spark.createDataFrame([("s", bytearray(blob.getvalue()))], "path string, content binary")).collect()
    assert [(r.key, r.member, bytes(r.data)) for r in rows] == [("k1", "image.png", b"x"), ("k1", "txt", b"yy"), ("k2", "txt", b"")]


def test_image_scan_and_labels(spark, tmp_path):
    for name in ("a.jpg", "b.PNG", "c.Jpg", "d.txt", "e.tiff"):
        (tmp_path / name).write_bytes(b"1")
    found = {r.path.rpartition("/")[2] for r in scan.image_files(spark, str(tmp_path)).select("path").collect()}
    assert found == {"a.jpg", "b.PNG", "e.tiff"}
    labels = tmp_path / "labels"
    labels.mkdir()
    (labels / "v_1.txt").write_text("0 0.5 0.25 0.1 0.2\n\n3 1 1 0 0\n")
    assert sorted(tuple(r)[1:] for r in scan.yolo_labels(spark, str(labels)).collect()) == [(0.5, 0.25, 0.1, 0.2), (1.0, 1.0, 0.0, 0.0)]


def test_coco_and_cityscapes(spark, tmp_path):
    p = tmp_path / "ann.json"
    p.write_text('{"images": [{"id": 1, "file_name": "a"}, {"id": 2, "file_name": "b"}],\n "annotations": [{"id": 9, "image_id": 1, "category_id": 0, "iscrowd": 0}, {"id": 10, "image_id": 1, "category_id": 0, "iscrowd": 1}]}')
    images, annotations = scan.coco(spark, str(p))
    got = scan.with_persons(images.withColumnRenamed("id", "image_id"), annotations).select("image_id", annotations["id"]).collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, 9), (2, None)]


def test_match_names_reports_missing(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "name string"), spark.createDataFrame([("x",)], "name string")
    with pytest.raises(FileNotFoundError):
        scan.match_names(a, b, "name")


def test_sink_files_resume_and_shards(spark, tmp_path):
    rows = spark.createDataFrame([("a.bin", bytearray(b"12")), ("b.bin", bytearray(b""))], "name string, data binary")
    assert {(r.name, r.size) for r in sinks.write_files(rows, str(tmp_path / "out")).collect()} == {("a.bin", 2), ("b.bin", 0)}
    assert (tmp_path / "out/a.bin").read_bytes() == b"12"
    assert [r.name for r in sinks.still_to_do(rows, rows.filter("name = 'a.bin'"), "name").collect()] == ["b.bin"]
    sinks.write_shards(rows, str(tmp_path / "shards"), [64, 128], 1)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 4
    named = rows.select(sinks.output_name(F.lit("/x/y.z.png"), "anon_", "_blurred", "jpg").alias("n")).first().n
    assert named == "anon_y.z_blurred.jpg"


def test_redaction_fails_closed(spark):
    im = spark.createDataFrame([(i, 2, 2, 1, bytearray(bytes([i, 2, 3, 4]))) for i in range(1, 6)], anonymize.IMAGE_SCHEMA)
    boxes = spark.createDataFrame([(1, 1, 0, 0, 2, 2), (4, 1, 0, 0, 2, 2), (5, 1, 0, 0, 2, 2)], "image_id long, paste_order int, x0 long, y0 long, x1 long, y1 long")
    looked_at = spark.createDataFrame([(1, None), (2, None), (4, "lost"), (5, None)], "image_id long, error string")  # 3 never came back

    def broken(crop):
        if crop[0, 0, 0] == 1:
            raise RuntimeError("no")
        return np.zeros_like(crop)

    got = {r.image_id: (bytes(r.data), r.status) for r in anonymize.redact(im, boxes, looked_at, broken).collect()}
    grey = b"\x80" * 4
    assert got == {1: (grey, "error_masked"), 2: (b"\2\2\3\4", "no_region"), 3: (grey, "missing_masked"), 4: (grey, "error_masked"), 5: (b"\0" * 4, "ok")}
    assert anonymize.redact(im.limit(0), boxes, looked_at, broken).count() == 0


def test_results_fail_closed(spark):
    inputs = spark.createDataFrame([(i, f"o{i}") for i in range(4)], "id long, orig string")
    results = spark.createDataFrame([(0, "n0", None), (1, None, "bad"), (2, None, None)], "id long, new string, error string")
    see = lambda mode: {r.id: (r.status, r.out) for r in sinks.with_results(inputs, results, "id", "orig", F.lit("MASK"), mode).collect()}
    assert see("closed") == {0: ("ok", "n0"), 1: ("error", "MASK"), 2: ("no_region", "o2"), 3: ("missing", "MASK")}
    assert see("passthrough") == {0: ("ok", "n0"), 1: ("error_passthrough", "o1"), 2: ("no_region", "o2"), 3: ("missing_passthrough", "o3")}
    assert see("skip_errors") == {0: ("ok", "n0"), 2: ("no_region", "o2")} and see("detected_only") == {0: ("ok", "n0")}


def plan_by_hand(image, boxes, generator):
    """Faces, without the plan: by rising area, each made from the square of 1.4 times its longer side as far as the image goes, pasted in its box."""
    h, w = image.shape[:2]
    out = image.copy()
    for _, _, (x0, y0, x1, y1) in sorted(((x1 - x0) * (y1 - y0), k, (x0, y0, x1, y1)) for k, (x0, y0, x1, y1) in enumerate(boxes)):
        r = int(max(x1 - x0, y1 - y0) * 1.4 // 2)
        xc, yc = x0 + (x1 - x0) // 2, y0 + (y1 - y0) // 2
        left, top, right, low = max(0, xc - r), max(0, yc - r), min(w, xc + r), min(h, yc + r)
        new = generator(out[top:low, left:right])
        a, b, c, d = max(x0, left), max(y0, top), min(x1, right), min(y1, low)
        out[b:d, a:c] = new[b - top : d - top, a - left : c - left]
    return out


def test_plan_on_images_of_all_sizes(spark):
    """Against a plan by hand, image by image: sizes differ, so a foreign frame would show."""
    rng = np.random.default_rng(5)
    images = {}
    for i in range(12):
        im = rng.integers(0, 90, (int(rng.integers(12, 60)), int(rng.integers(12, 60)), 3)).astype(np.uint8)
        for _ in range(i % 4):
            y, x = int(rng.integers(0, im.shape[0] - 6)), int(rng.integers(0, im.shape[1] - 6))
            im[y : y + 5, x : x + 4] = 250
        images[i] = im
    df = spark.createDataFrame([(i, *im.shape, bytearray(im.tobytes())) for i, im in images.items()], anonymize.IMAGE_SCHEMA)
    find = anonymize.bright_regions(150)
    got = {r.image_id: r for r in anonymize.anonymise(df, find, kernels.mask_out, 0.1).collect()}
    for i, im in images.items():
        boxes = [f[2:] for f in find(im) if f[1] >= 0.1]
        want = plan_by_hand(im, [tuple(map(int, b)) for b in boxes], kernels.mask_out)
        assert got[i].status == ("ok" if boxes else "no_region")
        assert (np.frombuffer(bytes(got[i].data), np.uint8).reshape(im.shape) == want).all(), i

    def fails(image):
        if image.shape == images[3].shape:
            raise ValueError("lost")
        return find(image)

    assert {r.image_id: r.status for r in anonymize.anonymise(df, fails, kernels.mask_out, 0.1).collect()}[3] == "error_masked"


MASK = np.zeros((8, 6), bool)
MASK[2:5, 1:4] = True
SURFACE = np.where(MASK, 7, -1)


def find_person(image):
    return [anonymize.Found("person", 0.9, 4, 5, 10, 13, MASK, [(5.0, 6.0, 1.0)], [(4.5, 5.5)], SURFACE)]


@anonymize.region_generator
def from_region(region):
    if region.z.shape != (512,) or not 9 <= region.mask.sum() <= 16 or not (region.condition[region.mask] == 127).all() or len(region.keypoints) != 1:
        raise ValueError("not the region that was found")
    return np.full_like(region.condition, int(abs(region.z[0]) * 50) + 11)


def test_details_reach_the_generator(spark):
    """Masks, keypoints, landmarks and surfaces go through the plan; pasting is by mask, latent vectors depend on the detection alone."""
    im = np.full((20, 30, 3), 10, np.uint8)
    df = spark.createDataFrame([(1, 20, 30, 3, bytearray(im.tobytes()))], anonymize.IMAGE_SCHEMA)
    d = anonymize.detect(df, find_person).first()
    assert np.unpackbits(np.frombuffer(bytes(d.mask), np.uint8), count=48).reshape(8, 6).astype(bool).tolist() == MASK.tolist()
    assert (np.frombuffer(bytes(d.surface), "<u2").reshape(8, 6).astype(int) - 1 == SURFACE).all() and d.landmarks[0].x == 4.5
    out = [bytes(anonymize.anonymise(df, find_person, from_region).first().data) for _ in range(2)]
    new = np.frombuffer(out[0], np.uint8).reshape(20, 30, 3)
    changed = (new != 10).all(2)
    # the disk of the dilation is less than a pixel wide here: nearest neighbours may add a pixel at the right and below
    assert out[0] == out[1] and changed[7:10, 5:8].all() and not changed[:7].any() and not changed[:, :5].any() and not changed[11:].any() and not changed[:, 9:].any()


def test_registry_and_config():
    r = registry.Registry("thing")
    r.register("a")(lambda x=1: x)
    assert r.build({"type": "a", "x": 3}) == 3 and r.names() == ["a"]
    with pytest.raises(KeyError):
        r.register("a")(lambda: 0)
    with pytest.raises(KeyError):
        r.get("b")
    assert registry.option_overrides("a.b=1,c.d 2,e=x") == {"a.b": 1.0, "c.d": 2.0, "e": "x"}
    assert registry.apply_overrides({"a": {"b": 0, "c": 5}}, "a.b=1") == {"a": {"b": 1.0, "c": 5}}
    with pytest.raises(KeyError):
        registry.merge_config({"a": 1}, {"z": 1}, known_only=True)


def frame_rows(spark):
    return R.table(spark, SMALL, "events").select(
        F.col("user_id").alias("video_id"), F.col("event_type").alias("track"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("image_id")
    )


def test_stream_identities_equal_batch(spark, tmp_path):
    rows = frame_rows(spark)
    rows.repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = frames.track_identities(frames.frame_stream(spark, str(tmp_path / "in")))
    seen: list[pd.DataFrame] = []
    q = stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, _: seen.append(df.toPandas())).trigger(availableNow=True).start()
    q.awaitTermination(180)
    last = pd.concat(seen).groupby(["video_id", "track"]).last().reset_index()
    want = frames.identities_batch(rows).toPandas()
    a = last.sort_values(["video_id", "track"])[["identity", "n"]].to_numpy().tolist()
    assert a == want.sort_values(["video_id", "track"])[["identity", "n"]].to_numpy().tolist()


def test_stream_windows_with_watermark(spark, tmp_path):
    rows = frame_rows(spark)
    rows.write.parquet(str(tmp_path / "in"))
    q = frames.windowed_counts(frames.frame_stream(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert spark.table("windows").agg(F.sum("n")).first()[0] == rows.count()


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("partitions", ["7", "200"])
def test_positions_over_many_partitions(spark, tmp_path, adaptive, partitions):
    n = 400_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n).alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("wide"))
    rows.repartition(16).write.parquet(str(tmp_path / "rows"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = scan.positions(spark.read.parquet(str(tmp_path / "rows")), [F.col("id")])
        assert got.agg(F.count("*"), F.count_if(F.col("pos") == F.col("id")), F.count_distinct("wide")).first()[:] == (n, n, n)
        a, b = spark.range(n).select("id"), spark.range(1000).select(F.col("id").alias("other"))
        zipped = scan.zip_positions(a, [F.col("id").desc()], b, [F.col("other")])
        assert zipped.agg(F.count("*"), F.count_if(F.col("id") + F.col("other") == n - 1)).first()[:] == (1000, 1000)
        assert scan.head_share(a, [F.col("id")], 0.25).agg(F.count("*"), F.max("id")).first()[:] == (n // 4, n // 4 - 1)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_band_filters_are_the_identity_together():
    bands = kernels.band_filters()
    whole = bands.sum(0)
    assert np.allclose(whole, np.eye(1, len(whole), len(whole) // 2)) and np.allclose(bands, bands[:, ::-1])
    assert np.allclose(bands.sum(1), [1, 0, 0, 0])  # only the lowest passes a flat image
    im = np.random.default_rng(0).integers(0, 256, (9, 12, 3)).astype(np.uint8)
    assert np.allclose(kernels.filter_bands(im, np.ones(4)), im)


def test_band_gains_keep_the_power_of_each_draw():
    assert np.allclose(kernels.band_gains(3, 0.0), 1) and not np.allclose(kernels.band_gains(3, 1.0), 1)


def test_augment_without_strength_is_the_identity():
    im = np.random.default_rng(1).integers(0, 256, (8, 8, 3)).astype(np.uint8)
    assert (kernels.augment(im, 5, 0.0) == im).all()
    assert (kernels.augment(im, 5, 1.0) == kernels.augment(im, 5, 1.0)).all() and (kernels.augment(im, 5, 1.0) != im).any()


def test_drawings_stay_inside():
    im = np.zeros((6, 5, 3), np.uint8)
    assert kernels.draw_points(im, [(0, 0, 1), (4, 5, 0)], 0).sum() == 255
    assert (kernels.draw_lines(im, [(-3, 2, 1), (9, 2, 1)], [(0, 1)])[2, :, 1] == 255).all()
    assert (kernels.draw_lines(im, [(0, 0, 1), (4, 4, 0)], [(0, 1)]) == 0).all()
    flat = kernels.draw_surface(im, np.zeros((6, 5), int), np.ones((3, 3)), np.ones((6, 5), bool))
    assert (flat == 0).all()


def test_soft_histogram(spark):
    got = spark.sql("select array(0D, 0.5D, 1D) as v").select(X.soft_histogram(F.col("v"), 5, 0.2).alias("h")).first().h
    want = np.exp(-0.5 * ((np.array([0, 0.5, 1])[:, None] - np.linspace(0, 1, 5)) / 0.2) ** 2).mean(0)
    assert np.allclose(got, want / (want.sum() + 1e-10))


def test_jet_ends(spark):
    rows = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "v double").select(*[v.alias(k) for k, v in X.jet(F.col("v")).items()]).collect()
    assert [tuple(r) for r in rows] == [(0, 0, 0.5), (0.5, 1, 0.5), (0.5, 0, 0)]


def test_configurations_inherit(tmp_path, caplog):
    (tmp_path / "a.json").write_text('{"model": {"size": 1, "depth": 2}, "seed": 3}')
    (tmp_path / "b.py").write_text("name = 'b'\n")
    (tmp_path / "own.json").write_text('{"_base_config_": ["a.json", "b.py"], "model": {"size": 9}, "more": 1}')
    assert registry.load_config(str(tmp_path / "own.json")) == {"model": {"size": 9, "depth": 2}, "seed": 3, "name": "b", "more": 1}
    assert "more" in caplog.text and "size" not in caplog.text
    (tmp_path / "twice.json").write_text('{"_base_config_": ["a.json", "a.json"]}')
    with pytest.raises(KeyError, match="model"):
        registry.load_config(str(tmp_path / "twice.json"))
    (tmp_path / "kind.json").write_text('{"_base_config_": "a.json", "seed": {"x": 1}}')
    with pytest.raises(TypeError):
        registry.load_config(str(tmp_path / "kind.json"))
    with pytest.raises(ValueError):
        registry.load_config(str(tmp_path / "x.yaml"))


def test_similarity_fits_together():
    """Many sets at once as one by one, reflected ones and points that coincide among them."""
    import numpy as np

    from veilframe.operators import keypoints

    rng = np.random.default_rng(5)
    source, target = rng.normal(size=(40, 17, 2)), rng.normal(size=(40, 17, 2))
    target[1] = source[1] * [-1, 1]
    source[0] = 3.0
    one = np.stack([keypoints.similarity_fit(a, b) for a, b in zip(source, target, strict=True)])
    assert np.allclose(keypoints.similarity_fits(source, target), one, atol=1e-12, equal_nan=True)
    assert np.isnan(one[0]).all()
