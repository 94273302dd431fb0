"""The anonymisation plan. All it does lies within an image, so one Arrow pass over the images detects, fuses and redacts them: image bytes are
never shuffled, and nothing is stored in between. Tables of detections (from a cache, say) are fused after one exchange of their
ids, boxes and masks; only then do regions have to be joined with images.

Models plug in as plain functions. A detector maps an image to ``Found`` objects (box, and where the model gives them: mask, keypoints,
landmarks, surface coordinates). A generator maps a crop to a crop, or, marked by ``region_generator``, a ``Region``
(condition, mask, latent vector, keypoints) to a crop. Results are pasted by mask where there is one.

Fails closed: an image passes unchanged only if the detector finished on it and found nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.registry import Registry
from ..functions.storage import cut
from ..operators import contours, fusion, kernels
from ..operators import geometry as G
from ..operators import runs as R
from ..operators.fusion import KIND_RANK, Fusion
from ..operators.tracking import track_seed, tracks

c = F.col
IMAGE_SCHEMA = "image_id long, height int, width int, n_channels int, data binary"
#: mask: bits of the box, row by row; keypoints and landmarks in image pixels; surface: two bytes a box pixel, a vertex number plus one or 0.
DETAIL_SCHEMA = "mask binary, keypoints array<struct<x: double, y: double, v: double>>, landmarks array<struct<x: double, y: double>>, surface binary"
DETECTION_SCHEMA = f"image_id long, det_id long, kind string, score double, x0 long, y0 long, x1 long, y1 long, {DETAIL_SCHEMA}"
_FOUND = "det_id: long, kind: string, score: double, x0: long, y0: long, x1: long, y1: long, mask: binary, keypoints: array<struct<x: double, y: double, v: double>>, landmarks: array<struct<x: double, y: double>>, surface: binary"
OUTCOME_SCHEMA = f"image_id long, height int, width int, error string, found array<struct<{_FOUND}>>"
#: grown box, own box, pixels of the mask, what is pasted as runs over the image, and what generators get.
_REGION = "paste_order: int, det_id: long, kind: string, score: double, x0: long, y0: long, x1: long, y1: long, own_x0: long, own_y0: long, own_x1: long, own_y1: long, mask_area: long, hole: array<bigint>, seed: long, keypoints: array<struct<x: double, y: double, v: double>>"
REGION_NAMES = ("paste_order", "det_id", "kind", "score", *G.COORDS, *(f"own_{n}" for n in G.COORDS), "mask_area", "hole", "seed", "keypoints")
#: As _FOUND; a type that doesn't take a session to make.
_POINT = [StructField("x", DoubleType()), StructField("y", DoubleType())]
FOUND_TYPE = StructType(
    [StructField("det_id", LongType()), StructField("kind", StringType()), StructField("score", DoubleType()), *[StructField(n, LongType()) for n in G.COORDS]]
    + [StructField("mask", BinaryType()), StructField("keypoints", ArrayType(StructType([*_POINT, StructField("v", DoubleType())]))), StructField("landmarks", ArrayType(StructType(_POINT))), StructField("surface", BinaryType())]
)
DETECTORS, GENERATORS = Registry("detector"), Registry("generator")
for _name, _f in kernels.GENERATORS.items():
    GENERATORS.register(_name)(_f)


@dataclass
class Found:
    """What a detector reports. mask: bool, the box's height x width; keypoints: (x, y, v) each; landmarks: (x, y) each; surface: vertex numbers,
    -1 for none, the box's height x width."""

    kind: str
    score: float
    x0: int
    y0: int
    x1: int
    y1: int
    mask: np.ndarray | None = None
    keypoints: list | None = None
    landmarks: list | None = None
    surface: np.ndarray | None = None

    def row(self, det_id: int) -> dict:
        names = lambda points, keys: None if points is None else [dict(zip(keys, map(float, p), strict=True)) for p in points]
        return {
            "det_id": det_id, "kind": self.kind, "score": float(self.score), "x0": int(self.x0), "y0": int(self.y0), "x1": int(self.x1), "y1": int(self.y1),
            "mask": None if self.mask is None else np.packbits(np.asarray(self.mask, bool)).tobytes(),
            "keypoints": names(self.keypoints, "xyv"), "landmarks": names(self.landmarks, "xy"),
            "surface": None if self.surface is None else (np.asarray(self.surface) + 1).astype("<u2").tobytes(),
        }


@dataclass
class Region:
    """What a region generator gets: the crop with its hole grey, the mask (True: to anonymise), a latent vector that depends on
    the seed alone, and keypoints as shares of the crop."""

    condition: np.ndarray
    mask: np.ndarray
    z: np.ndarray
    keypoints: list | None


def region_generator(f: Callable[[Region], np.ndarray]) -> Callable[[Region], np.ndarray]:
    f.takes_region = True
    return f


def pixels_of(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.n_channels)


def of_ids(schema: str, rows: DataFrame) -> str:
    """A schema with the image ids of the rows, which may be of any type."""
    return schema.replace("image_id long", f"image_id {rows.schema['image_id'].dataType.simpleString()}")


def looked_at(detector: Callable, image: np.ndarray) -> list[dict]:
    return [(Found(*x) if isinstance(x, tuple) else x).row(i + 1) for i, x in enumerate(detector(image))]


def outcomes(images: DataFrame, detector: Callable) -> DataFrame:
    """detector: image -> [Found or (kind, score, x0, y0, x1, y1)]. One row an image (OUTCOME_SCHEMA), also where nothing was found or the detector
    failed, so that the two can be told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                error, found = None, []
                try:
                    image = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["n_channels"])
                    found = looked_at(detector, image)
                except Exception as e:  # of one image; the others go on
                    error = f"{type(e).__name__}: {e}"
                out.append({"image_id": r["image_id"], "height": r["height"], "width": r["width"], "error": error, "found": found})
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = images.select("image_id", "height", "width", "n_channels", "data")
    schema = to_arrow_schema(rows.sparkSession.createDataFrame([], of_ids(OUTCOME_SCHEMA, images)).schema)
    return rows.mapInArrow(run, of_ids(OUTCOME_SCHEMA, images))


def detections_of(found: DataFrame, score_threshold: float = 0.0) -> DataFrame:
    """outcomes -> DETECTION_SCHEMA and the image's height and width."""
    rows = found.select("image_id", "height", "width", F.explode("found").alias("d")).select("image_id", "d.*", "height", "width")
    return rows.filter(c("score") >= score_threshold)


def detect(images: DataFrame, detector: Callable, score_threshold: float = 0.0) -> DataFrame:
    """The detections alone (DETECTION_SCHEMA). The threshold is applied here and may be used inside as well."""
    return detections_of(outcomes(images, detector), score_threshold).drop("height", "width")


@DETECTORS.register("bright_regions")
def bright_regions(threshold: int = 200):
    """An example detector without a network: connected bright regions, scored by the share of bright pixels."""

    def find(image: np.ndarray):
        mask = image.mean(2) > threshold
        return [("face", float(mask[y0:y1, x0:x1].mean()), x0, y0, x1, y1) for x0, y0, x1, y1 in contours.region_boxes(mask)]

    return find


def paste_order(detections: DataFrame) -> DataFrame:
    """Faces by rising area, vehicles by falling, persons by rising; face < vehicle < person < person_cse; later ones win."""
    area = (c("x1") - c("x0")) * (c("y1") - c("y0"))
    rank = F.create_map(*[F.lit(x) for k, v in KIND_RANK.items() for x in (k, v)])[c("kind")]
    signed = F.when(c("kind") == "vehicle", -area).otherwise(area)
    w = Window.partitionBy("image_id").orderBy("kind_rank", "_area", "det_id")
    return detections.withColumns({"kind_rank": rank, "_area": signed}).withColumn("paste_order", F.row_number().over(w)).drop("_area")


def seed_of(image_id, det_id) -> int:
    """The latent seed of a detection without a track: of its ids alone."""
    return int(hashlib.md5(f"{image_id}:{det_id}".encode()).hexdigest()[:8], 16)


def regions_of(image_id, found: list[dict], width: int, height: int, o: Fusion, holes: bool) -> list[dict]:
    """One image's regions in the order of pasting; boxes with packed bits get runs."""
    return [dict(zip(REGION_NAMES, r, strict=True)) for r in regions_of_all([(image_id, height, width, found)], o, holes)[0]]


#: The values of a region by name: of its place n, the part p, its image's id.
REGION_VALUES = {
    "paste_order": lambda n, p, image: n, "det_id": lambda n, p, image: p.det_id, "kind": lambda n, p, image: p.kind, "score": lambda n, p, image: p.source["score"],
    **{name: lambda n, p, image, k=k: int(p.grown[k]) for k, name in enumerate(G.COORDS)}, **{f"own_{name}": lambda n, p, image, k=k: int(p.box[k]) for k, name in enumerate(G.COORDS)},
    "mask_area": lambda n, p, image: p.area, "hole": lambda n, p, image: p.hole, "seed": lambda n, p, image: seed_of(image, p.det_id), "keypoints": lambda n, p, image: p.source.get("keypoints"),
}


def regions_of_all(rows: list[tuple], o: Fusion, holes: bool, names: tuple[str, ...] = REGION_NAMES) -> list[list[tuple]]:
    """``regions_of`` of several images (image_id, height, width, found): the named values of _REGION."""
    for _, height, width, found in rows:
        for d in found:
            if d.get("runs") is None and d.get("mask") is not None:
                d["runs"] = R.from_bits(d["mask"], (d["x0"], d["y0"], d["x1"], d["y1"]), width, height)
    fused = fusion.fuse_many([(found, width, height) for _, height, width, found in rows], o, holes)
    make = [(lambda n, p, image: None) if name == "hole" and not holes else REGION_VALUES[name] for name in names]
    return [[tuple([f(n, p, row[0]) for f in make]) for n, p in enumerate(parts, 1)] for row, parts in zip(rows, fused, strict=True)]


def listed(values: pa.Array) -> list:
    """As Python values; numbers by numpy, which is faster."""
    plain = not values.null_count and (pa.types.is_integer(values.type) or pa.types.is_floating(values.type))
    return values.to_numpy().tolist() if plain else values.to_pylist()


def found_rows(batch: pa.RecordBatch, made: Callable[[dict[str, pa.Array]], list] | None = None) -> Iterator[tuple]:
    """(image_id, height, width, found) of each row; runs stay numpy slices. made: from the fields of all detections, the runs of each or None."""
    column = batch.column("found")
    parts = column.flatten()
    fields = {parts.type.field(i).name: child for i, child in enumerate(parts.flatten())}
    runs = fields.pop("runs", None)
    plain = [dict(zip(fields, v, strict=True)) for v in zip(*map(listed, fields.values()), strict=True)]
    if runs is not None:
        at, values = runs.offsets.to_numpy(), runs.values.to_numpy()
        for k, d in enumerate(plain):
            d["runs"] = values[at[k] : at[k + 1]] if runs[k].is_valid else None
    elif made is not None:
        for d, own in zip(plain, made(fields), strict=True):
            d["runs"] = own
    ids, heights, widths = (batch.column(n).to_pylist() for n in ("image_id", "height", "width"))
    first = 0
    for k, n in enumerate((v or 0) for v in pa.compute.list_value_length(column).to_pylist()):
        yield ids[k], heights[k], widths[k], plain[first : first + n]
        first += n


#: Images that are fused together: enough for numpy, few enough for their masks to stay small.
TOGETHER = 64


def fuse_rows(rows: DataFrame, o: Fusion = Fusion(), holes: bool = True, made: Callable[[dict[str, pa.Array]], list] | None = None, names: tuple[str, ...] = REGION_NAMES) -> DataFrame:
    """rows(image_id, height, width, found), one an image, as ``outcomes`` and ``by_image`` make them -> image_id, regions. made: makes the runs of detections that
    have none (``found_rows``). names: what of a region is made."""
    fields = dict(zip(REGION_NAMES, _REGION.split(", ", len(REGION_NAMES) - 1), strict=True))
    schema = of_ids(f"image_id long, regions array<struct<{', '.join(fields[n] for n in names)}>>", rows)
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)
    kind = arrow.field("regions").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                part = list(found_rows(batch.slice(first, TOGETHER), made))
                regions = regions_of_all(part, o, holes, names)
                flat = [r for some in regions for r in some]
                columns = zip(*flat, strict=True) if flat else [()] * kind.value_type.num_fields
                values = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(columns, kind.value_type, strict=True)], fields=list(kind.value_type))
                ends = np.r_[0, np.cumsum([len(some) for some in regions])].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], arrow.field("image_id").type), pa.ListArray.from_arrays(ends, values, type=kind)], schema=arrow)

    return rows.select("image_id", F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), "found").mapInArrow(run, schema)


def by_image(detections: DataFrame, width=640, height=480) -> DataFrame:
    """Detections, gathered to one row an image. width, height: numbers, or columns where images differ in size."""
    names = [n for n in ("det_id", "kind", "score", *G.COORDS, "mask", "runs", "keypoints") if n in detections.columns]
    sized = detections.withColumns({"_h": G.col_of(height).cast("int"), "_w": G.col_of(width).cast("int")})
    gathered = sized.groupBy("image_id").agg(F.first("_h").alias("height"), F.first("_w").alias("width"), F.collect_list(F.struct(*names)).alias("found"))
    return gathered


def fuse(detections: DataFrame, o: Fusion = Fusion(), width=640, height=480, holes: bool = True) -> DataFrame:
    """A table of detections (DETECTION_SCHEMA; masks as packed bits, or as ``runs``) -> image_id and its regions (_REGION), one row each. One exchange, of
    detections by image."""
    return fuse_rows(by_image(detections, width, height), o, holes).select("image_id", F.inline("regions"))


def hole_of(region: dict, box: tuple[int, int, int, int], width: int) -> np.ndarray:
    """What is pasted of a region inside a box; the whole box where nothing is said."""
    if region.get("hole") is None:
        return np.ones((box[3] - box[1], box[2] - box[0]), bool)
    return R.to_array(np.asarray(region["hole"], np.int64), box, width)


def redact_regions(image: np.ndarray, regions: list[dict], make: Callable, z_dim: int = 512, **options) -> np.ndarray:
    """Regions in order, each over the result so far, so that later ones win; pasted where their mask says."""
    out = image.copy()
    for r in regions:
        x0, y0, x1, y1 = max(0, r["x0"]), max(0, r["y0"]), min(out.shape[1], r["x1"]), min(out.shape[0], r["y1"])
        if x1 <= x0 or y1 <= y0:
            continue
        crop, hole = out[y0:y1, x0:x1], hole_of(r, (x0, y0, x1, y1), out.shape[1])
        if getattr(make, "takes_region", False):
            points = [((p["x"] - x0) / (x1 - x0), (p["y"] - y0) / (y1 - y0), p["v"]) for p in r["keypoints"]] if r.get("keypoints") else None
            z = np.random.RandomState(r["seed"] % (1 << 32)).normal(size=z_dim)
            new = make(Region(np.where(hole[..., None], 127, crop).astype(np.uint8), hole, z, points), **options)
        else:
            new = make(crop, **options)
        out[y0:y1, x0:x1][hole] = new[hole]
    return out


def generator_of(generator: str | Callable) -> Callable:
    return GENERATORS.get(generator) if isinstance(generator, str) else generator


def with_results(batch: pa.RecordBatch, results: list[tuple[bytes, str]]) -> pa.RecordBatch:
    names = ["image_id", "height", "width", "n_channels"]
    data, status = zip(*results, strict=True) if results else ((), ())
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(data, pa.binary()), pa.array(status, pa.string())], names=[*names, "data", "status"])


def redact(images: DataFrame, fused: DataFrame, looked_at: DataFrame, generator: str | Callable = "blur", **options) -> DataFrame:
    """images(IMAGE_SCHEMA), regions (as of ``fuse``), looked_at(image_id, error): the images that the detector came to -> images with ``data`` redacted
    and ``status``. Masked as a whole are images without a row in looked_at, those with an error, and those whose redaction fails; only one that was
    looked at without a find passes. Regions are gathered per image before the bytes join them."""
    make = generator_of(generator)
    names = ["paste_order", *G.COORDS, *[n for n in ("hole", "seed", "keypoints") if n in fused.columns]]
    regions = fused.groupBy("image_id").agg(F.collect_list(F.struct(*names)).alias("regions"))
    marks = looked_at.groupBy("image_id").agg(F.max("error").alias("error"), F.lit(True).alias("seen")).join(regions, "image_id", "left")
    joined = images.join(marks, "image_id", "left").select("image_id", "height", "width", "n_channels", "data", "error", "seen", "regions")

    def one(r: dict) -> tuple[bytes, str]:
        masked = bytes([128]) * len(r["data"] or b"")
        if not r["seen"]:
            return masked, "missing_masked"
        if r["error"] is not None:
            return masked, "error_masked"
        if not r["regions"]:
            return r["data"], "no_region"
        try:
            image = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["n_channels"])
            return redact_regions(image, sorted(r["regions"], key=lambda x: x["paste_order"]), make, **options).tobytes(), "ok"
        except Exception:  # fail closed: the original never passes
            return masked, "error_masked"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_results(batch, [one(r) for r in batch.to_pylist()])

    return joined.mapInArrow(run, of_ids(IMAGE_SCHEMA, images) + ", status string")


def anonymise(images: DataFrame, detector: Callable, generator: str | Callable = "blur", score_threshold: float = 0.3, o: Fusion | None = None, **options) -> DataFrame:
    """Detect, fuse within each image's own size, redact: one pass without an exchange -> images with ``data`` redacted and ``status``, as ``redact``.
    Unlike the published defaults, o keeps persons of any size."""
    make = generator_of(generator)
    o = replace(o or Fusion(minimum_area=1), score_threshold=score_threshold)

    def one(r: dict) -> tuple[bytes, str]:
        masked = bytes([128]) * len(r["data"] or b"")
        try:
            image = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["n_channels"])
            regions = regions_of(r["image_id"], looked_at(detector, image), r["width"], r["height"], o, True)
            if not regions:
                return r["data"], "no_region"
            return redact_regions(image, regions, make, **options).tobytes(), "ok"
        except Exception:  # fail closed: neither a failed detector nor a failed generator lets the original pass
            return masked, "error_masked"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_results(batch, [one(r) for r in batch.to_pylist()])

    return images.select("image_id", "height", "width", "n_channels", "data").mapInArrow(run, of_ids(IMAGE_SCHEMA, images) + ", status string")


def frame_regions(images: DataFrame, detector: Callable, o: Fusion) -> DataFrame:
    """image_id, error, regions: one pass that detects and fuses; no image bytes are kept."""
    schema = of_ids(f"image_id long, error string, regions array<struct<{_REGION}>>", images)
    arrow = to_arrow_schema(images.sparkSession.createDataFrame([], schema).schema)

    def one(r: dict) -> dict:
        try:
            image = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"], r["n_channels"])
            return {"image_id": r["image_id"], "error": None, "regions": regions_of(r["image_id"], looked_at(detector, image), r["width"], r["height"], o, True)}
        except Exception as e:
            return {"image_id": r["image_id"], "error": f"{type(e).__name__}: {e}", "regions": []}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([one(r) for r in batch.to_pylist()], arrow)

    return images.select("image_id", "height", "width", "n_channels", "data").mapInArrow(run, schema)


def anonymise_video(frames: DataFrame, detector: Callable, generator: str | Callable = "blur", score_threshold: float = 0.3, o: Fusion | None = None, max_gap: int = 5, **options) -> DataFrame:
    """frames(video_id, frame_no, IMAGE_SCHEMA) -> as ``redact``, with one identity a track: detections of all kinds are tracked over the clip and the latent seed
    of a region is its track's. Persons are tracked by their expanded box, others by their own. Frames without regions pass unchanged, those that the
    detector failed on are masked. Regions are stored once, without image bytes; the bytes meet them in one join at the end."""
    o = replace(o or Fusion(minimum_area=1), score_threshold=score_threshold)
    found = cut(frame_regions(frames, detector, o))
    places = frames.select("image_id", "video_id", "frame_no")
    each = found.join(places, "image_id").select("video_id", "frame_no", "image_id", F.inline("regions"))
    person = c("kind").isin("person", "person_cse")
    seen = {n: F.when(person, c(n)).otherwise(c(f"own_{n}")).alias(n) for n in G.COORDS}
    of = tracks(each.select("video_id", "frame_no", c("paste_order").cast("long").alias("det_id"), *seen.values()), max_gap=max_gap)
    of = of.withColumn("track", track_seed(c("track_frame"), c("track_det"))).select("video_id", "frame_no", c("det_id").alias("paste_order"), "track")
    keys = F.struct("video_id", "frame_no", c("paste_order").cast("long"))
    regions = each.withColumn("_k", keys).join(of.select(F.struct("video_id", "frame_no", "paste_order").alias("_k"), "track"), "_k").withColumn("seed", c("track"))
    return redact(frames, regions, found.select("image_id", "error"), generator, **options)


def register_sql_detector(spark, name: str, detector: Callable) -> None:
    """Makes a detector callable from SQL as a table function of an image's columns, for lateral joins:
    ``SELECT i.image_id, d.* FROM images i, LATERAL name(i.height, i.width, i.n_channels, i.data) d``. Rows are those of ``detect`` without the image's id; a
    failed image is an error of the query, as SQL has no row to tell it by."""

    class Detections:
        @staticmethod
        def analyze(height: AnalyzeArgument, width: AnalyzeArgument, n_channels: AnalyzeArgument, data: AnalyzeArgument) -> AnalyzeResult:
            for kind, argument in ((IntegerType, height), (IntegerType, width), (IntegerType, n_channels), (BinaryType, data)):
                if not isinstance(argument.dataType, kind):
                    raise ValueError(f"{name} takes height, width, n_channels (int) and data (binary), not {argument.dataType.simpleString()}")
            return AnalyzeResult(FOUND_TYPE)

        def eval(self, height, width, n_channels, data):
            if data is not None:
                image = np.frombuffer(data, np.uint8).reshape(height, width, n_channels)
                for row in looked_at(detector, image):
                    yield tuple(row.values())

    spark.udtf.register(name, F.udtf(Detections))
