"""Fusion of one image's detections of several models: persons matched to dense-pose persons by their masks, masks merged, boxes expanded, faces
that a person covers removed, all ordered for pasting.

Everything here lies within an image, whose detections are few; Spark deals out the images (``plans.anonymize``). The box expansions are
those of ``operators.geometry`` for one box; tests hold the two against each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np

from . import runs as R

Box = tuple[int, int, int, int]
#: Later kinds are pasted over earlier ones; kinds of other names come after vehicles.
KIND_RANK = {"face": 0, "vehicle": 1, "person": 2, "person_cse": 3}
OTHER_RANK = 1.5


@dataclass(frozen=True)
class Fusion:
    """What fusion goes by. published: faces strictly inside a person's dilated box go whether its mask covers them or not, and dense-pose persons that
    no person's mask matches go as well. Otherwise neither leaves anything visible: a face goes only if masks that are pasted cover all of it, and
    unmatched dense-pose persons are kept by their own mask. simple_faces: faces grow to the simple square of .4, else to the margin square."""

    score_threshold: float = 0.3
    match_iou: float = 0.4
    size: tuple[int, int] = (288, 160)
    dilation: float = 0.02
    background: float = 0.3
    share: float = 0.1
    minimum_area: int = 1024
    minimum_inside: float = 0.0
    ratio_range: tuple[float, float] = (0.0, 99999.0)
    face_share: float = 0.4
    published: bool = False


@dataclass
class Part:
    """A detection on its way: tight or detected box, runs of its mask (None: its box), the image's width and height, the expanded box, the dilated box; holes: runs
    that are pasted."""

    source: dict
    kind: str
    box: Box
    mask: np.ndarray | None
    image: tuple[int, int]
    grown: Box | None = None
    reach: Box | None = None
    hole: np.ndarray = field(default_factory=lambda: R.EMPTY)

    def __post_init__(self):
        x0, y0, x1, y1 = self.box
        self.clipped = max(0, x0), max(0, y0), min(self.image[0], x1), min(self.image[1], y1)

    @property
    def det_id(self) -> int:
        return self.source["det_id"]

    @cached_property
    def runs(self) -> np.ndarray:
        return R.from_box(self.clipped, *self.image) if self.mask is None else self.mask

    @cached_property
    def area(self) -> int:
        x0, y0, x1, y1 = self.clipped
        return max(0, x1 - x0) * max(0, y1 - y0) if self.mask is None else R.area(self.mask)

    @cached_property
    def tight(self) -> Box:
        if self.mask is not None:
            return R.tight(self.mask, *self.image)
        return self.clipped if self.area else (0, 0, *self.image)


def sides(box: Box) -> int:
    return (box[2] - box[0]) * (box[3] - box[1])


def expand_axis(start: int, end: int, target: int, limit: int) -> tuple[int, int]:
    """To the target width about the middle, then shifted inside where one side only is out."""
    grow = target - (end - start)
    s, e = start - grow // 2, end + grow - grow // 2
    both = s < 0 and e > limit
    move = min(-s, limit - e) if s < 0 and e < limit else 0
    s, e = s + move, e + move
    back = min(e - limit, s) if not both and e > limit and s > 0 else 0
    return s - back, e - back


def expanded(box: Box, mask_area: int, width: int, height: int, o: Fusion) -> Box:
    """By a share of its size, to the aspect ratio of the crop, then until the mask leaves enough background."""
    x0, y0, x1, y1 = box
    w, h = x1 - x0, y1 - y0
    more = math.floor(math.sqrt(w * h) * o.share)
    (x0, x1), (y0, y1) = expand_axis(x0, x1, min(w + more, width), width), expand_axis(y0, y1, min(h + more, height), height)
    w, h, ratio = x1 - x0, y1 - y0, o.size[0] / o.size[1]
    tall, wide = (math.floor(w * ratio) if h / w < ratio else h), (math.floor(h / ratio) if h / w > ratio else w)
    (y0, y1), (x0, x1) = expand_axis(y0, y1, tall, height), expand_axis(x0, x1, wide, width)
    w, h = x1 - x0, y1 - y0
    if not (1 - mask_area / (h * w)) > o.background:
        by = math.sqrt(mask_area / (1 - o.background) / (h * w))
        (x0, x1), (y0, y1) = expand_axis(x0, x1, math.ceil(by * w), width), expand_axis(y0, y1, math.ceil(by * h), height)
    return x0, y0, x1, y1


def simple_square(box: Box, share: float) -> Box:
    """Of (1 + share) times the longer side about the centre; may leave the image."""
    x0, y0, x1, y1 = box
    half = int(max(x1 - x0, y1 - y0) * (1 + share) // 2)
    x, y = x0 + (x1 - x0) // 2, y0 + (y1 - y0) // 2
    return x - half, y - half, x + half, y + half


def included(box: Box, width: int, height: int, o: Fusion) -> bool:
    x0, y0, x1, y1 = box
    w, h = x1 - x0, y1 - y0
    inside = (min(x1, width) - max(0, x0)) * (min(height, y1) - max(0, y0))
    return inside / (w * h) >= o.minimum_inside and o.ratio_range[0] < h / w < o.ratio_range[1] and w * h >= o.minimum_area


def strictly_inside(a: Box, b: Box) -> bool:
    return b[0] < a[0] and b[1] < a[1] and b[2] > a[2] and b[3] > a[3]


def match_in_order(left: list[Part], right: list[Part], threshold: float) -> list[tuple[int, int]]:
    """Pairs whose masks' intersection over union reaches the threshold, row by row, each side taken once. Runs are merged only where
    boxes and areas leave that open."""
    taken: set[int] = set()
    out = []
    sizes, others = [p.area for p in left], [p.area for p in right]
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if j in taken:
                continue
            w, h = min(a.box[2], b.box[2]) - max(a.box[0], b.box[0]), min(a.box[3], b.box[3]) - max(a.box[1], b.box[1])
            most = min(max(0, w) * max(0, h), sizes[i], others[j])  # pixels that both can have
            if most < threshold * (sizes[i] + others[j] - most) or not most:
                continue
            both = R.intersection(a.runs, b.runs)
            if both / (sizes[i] + others[j] - both) >= threshold:
                taken.add(j)
                out.append((i, j))
                break
    return out


def person_parts(persons: list[Part], dense: list[Part], o: Fusion) -> list[Part]:
    """Matched pairs as dense-pose persons with both masks and a box about both, other persons by their mask."""
    pairs = match_in_order(persons, dense, o.match_iou)
    out = []
    for i, j in pairs:
        both = Part(dense[j].source, "person_cse", dense[j].box, R.union(persons[i].runs, dense[j].runs), dense[j].image)
        a, b = both.tight, both.box
        both.box = min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])
        out.append(both)
    left, right = {i for i, _ in pairs}, {j for _, j in pairs}
    for i, p in enumerate(persons):
        if i not in left:
            p.box = p.tight
            out.append(p)
    if not o.published:
        out += [p for j, p in enumerate(dense) if j not in right]
    return out


def parts_by_kind(found: list[dict], width: int, height: int, o: Fusion) -> dict[str, list[Part]]:
    by_kind: dict[str, list[Part]] = {}
    for d in sorted(found, key=lambda d: d["det_id"]):
        if d["score"] >= o.score_threshold and d["x1"] > d["x0"] and d["y1"] > d["y0"]:
            by_kind.setdefault(d["kind"], []).append(Part(d, d["kind"], (d["x0"], d["y0"], d["x1"], d["y1"]), d.get("runs"), (width, height)))
    return by_kind


def measured(parts: Iterable[Part]) -> None:
    """Areas and tight boxes of masks, all at once."""
    parts = [p for p in parts if p.mask is not None]
    if parts:
        for p, n, box in zip(parts, *R.measures([p.mask for p in parts], [p.image for p in parts]), strict=True):
            p.area, p.tight = n, box


def fuse(found: list[dict], width: int, height: int, o: Fusion, holes: bool = True) -> list[Part]:
    """found: det_id, kind, score, x0, y0, x1, y1, runs (None: the box) -> parts in the order of pasting: faces by rising area of their box, vehicles by falling,
    persons and dense-pose persons by rising area of their mask. ``grown`` is the box to paste into, ``hole`` what of the image is replaced."""
    return fuse_many([(found, width, height)], o, holes)[0]


def fuse_many(images: list[tuple[list[dict], int, int]], o: Fusion, holes: bool = True) -> list[list[Part]]:
    """``fuse`` of several images, whose masks are measured and dilated together."""
    kinds = [parts_by_kind(found, width, height, o) for found, width, height in images]
    measured(p for by_kind in kinds for k in ("person", "person_cse") for p in by_kind.get(k, []))
    people: list[list[Part]] = []
    for by_kind, (_, width, height) in zip(kinds, images, strict=True):
        people.append([])
        for p in person_parts(by_kind.pop("person", []), by_kind.pop("person_cse", []), o):
            p.grown = expanded(p.box, p.area, width, height, o)
            if included(p.grown, width, height, o):
                people[-1].append(p)
    every = [p for some in people for p in some]
    if every:
        for p, box in zip(every, R.dilated_boxes([p.runs for p in every], [p.grown for p in every], [p.image for p in every], o.size, o.dilation), strict=True):
            p.reach = box
    return [in_order(by_kind, some, width, height, o, holes) for by_kind, some, (_, width, height) in zip(kinds, people, images, strict=True)]


def in_order(by_kind: dict[str, list[Part]], people: list[Part], width: int, height: int, o: Fusion, holes: bool) -> list[Part]:
    if holes:
        for p in people:
            p.hole = R.dilated(p.runs, p.grown, width, height, o.size, o.dilation)
    out = []
    for f in by_kind.pop("face", []):
        over = [p for p in people if strictly_inside(f.box, p.reach)]
        if over and (o.published or hidden(f.runs, over, width, height, o)):
            continue
        f.grown = simple_square(f.box, o.face_share)
        out.append(f)
    for kind in sorted(by_kind):
        for v in by_kind[kind]:
            v.box = v.grown = v.tight
            out.append(v)
    if holes:
        for p in out:
            p.hole = p.runs
    out += people
    size = {"face": lambda p: sides(p.box), "person": lambda p: p.area, "person_cse": lambda p: p.area}
    return sorted(out, key=lambda p: (KIND_RANK.get(p.kind, OTHER_RANK), size.get(p.kind, lambda p: -sides(p.box))(p), p.det_id))


def hidden(face: np.ndarray, over: list[Part], width: int, height: int, o: Fusion) -> bool:
    """Whether the masks that are pasted cover all of a face."""
    holes = R.union(*[p.hole if len(p.hole) else R.dilated(p.runs, p.grown, width, height, o.size, o.dilation) for p in over])
    return R.intersection(face, holes) == R.area(face)
