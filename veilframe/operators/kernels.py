"""Numpy kernels on whole images: the twins of the pixel relation's operators for images too large to explode.

Images are uint8 H x W x C. Each kernel is pure; Arrow functions apply them to rows of images and their regions.
"""

from __future__ import annotations

import numpy as np

from .pixels import gaussian, linear_taps


def _taps(size_in: int, size_out: int) -> np.ndarray:
    m = np.zeros((size_out, size_in))
    for t, s, w in linear_taps(size_in, size_out):
        m[t, s] += w
    return m


def _apply(rows: np.ndarray, cols: np.ndarray, image: np.ndarray) -> np.ndarray:
    return np.einsum("ab,bcd,ec->aed", rows, image.astype(float), cols, optimize=True)


def to_bytes(image: np.ndarray) -> np.ndarray:
    """Half to even; halves are told from their neighbours at six digits, so the order of sums doesn't matter."""
    return np.clip(np.rint(np.round(image, 6)), 0, 255).astype(np.uint8)


def mirror_matrix(n: int, taps) -> np.ndarray:
    """A centred filter along an axis of n cells, mirrored at its ends."""
    m, r = np.zeros((n, n)), len(taps) // 2
    for k, w in enumerate(taps):
        for t in range(n):
            at = (t + k - r) % (2 * (n - 1)) if n > 1 else 0
            m[t, 2 * (n - 1) - at if at >= n else at] += w
    return m


def blur_matrix(n: int, size: int, sigma: float) -> np.ndarray:
    return mirror_matrix(n, gaussian(size, sigma))


def gaussian_blur(image: np.ndarray, size: int = 31, sigma: float = 0.0) -> np.ndarray:
    """Mirrored at the border of the region it is given."""
    return to_bytes(_apply(blur_matrix(image.shape[0], size, sigma), blur_matrix(image.shape[1], size, sigma), image))


def pixelate(image: np.ndarray, cells: int = 8) -> np.ndarray:
    h, w = image.shape[:2]
    return to_bytes(_apply(_taps(cells, h) @ _taps(h, cells), _taps(cells, w) @ _taps(w, cells), image))


def mask_out(image: np.ndarray) -> np.ndarray:
    return np.full_like(image, 128)


def noise(image: np.ndarray, seed: int = 0) -> np.ndarray:
    """The bright half only, as uniform numbers in 0..1 of a range from -1 to 1."""
    return to_bytes((np.random.default_rng(seed).random(image.shape) + 1) * 127.5)


def identity(image: np.ndarray) -> np.ndarray:
    return image


GENERATORS = {"blur": gaussian_blur, "pixelate": pixelate, "mask_out": mask_out, "noise": noise, "identity": identity}


def redact(image: np.ndarray, regions: list[tuple[int, int, int, int]], generator) -> np.ndarray:
    """Regions in order, each over the result so far, so that later ones win and overlaps are treated twice."""
    out = image.copy()
    h, w = out.shape[:2]
    for x0, y0, x1, y1 in regions:
        x0, y0, x1, y1 = max(0, x0), max(0, y0), min(w, x1), min(h, y1)
        if x1 > x0 and y1 > y0:
            out[y0:y1, x0:x1] = generator(out[y0:y1, x0:x1])
    return out


def cubic_weights(size_in: int, size_out: int, antialias: bool = True) -> np.ndarray:
    """Bicubic (a = -0.5) resampling matrix; the kernel widens with the scale when shrinking."""
    scale = size_in / size_out
    grow = max(1.0, scale) if antialias else 1.0
    at = (np.arange(size_out) + 0.5) * scale - 0.5
    d = np.abs(np.arange(size_in)[None, :] - at[:, None]) / grow
    w = np.where(d <= 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0.0))
    return w / w.sum(1, keepdims=True)


def area_weights(size_in: int, size_out: int) -> np.ndarray:
    edges = np.arange(size_out + 1) * size_in / size_out
    left = np.maximum(edges[:-1, None], np.arange(size_in)[None, :])
    right = np.minimum(edges[1:, None], np.arange(size_in)[None, :] + 1)
    w = np.clip(right - left, 0, None)
    return w / w.sum(1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int, policy: str = "default") -> np.ndarray:
    """default: masks nearest, images bicubic, nearest when both sides grow; ``face``: bicubic up, area down."""
    h, w = image.shape[:2]
    if policy == "face":
        pick = lambda a, b: cubic_weights(a, b) if b > a else area_weights(a, b)
        return to_bytes(_apply(pick(h, height), pick(w, width), image))
    if image.dtype == bool or (height > h and width > w):
        return image[(np.arange(height) * h // height)[:, None], (np.arange(width) * w // width)[None, :]]
    return to_bytes(_apply(cubic_weights(h, height), cubic_weights(w, width), image))


def resize_steps(image: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Down and up again through square sizes."""
    for n in sizes:
        image = to_bytes(_apply(cubic_weights(image.shape[0], n), cubic_weights(image.shape[1], n), image))
    return image


def warp(image: np.ndarray, matrix: np.ndarray, height: int, width: int, fill: int = 255) -> np.ndarray:
    """Affine warp: matrix maps input to output coordinates; linear sampling, fill outside."""
    inverse = np.linalg.inv(np.vstack([matrix, [0, 0, 1]]))
    ys, xs = np.mgrid[0:height, 0:width]
    sx, sy = (inverse[i, 0] * xs + inverse[i, 1] * ys + inverse[i, 2] for i in (0, 1))
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = (sx - x0)[..., None], (sy - y0)[..., None]

    def at(y, x):
        ok = (y >= 0) & (y < image.shape[0]) & (x >= 0) & (x < image.shape[1])
        out = np.full((height, width, image.shape[2]), float(fill))
        out[ok] = image[y[ok], x[ok]]
        return out

    top = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx
    low = at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return to_bytes(top * (1 - fy) + low * fy)


def paste_back(face: np.ndarray, background: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The face warped back by the inverse of its alignment; only where black and white frames agree is it valid."""
    back = np.linalg.inv(np.vstack([matrix, [0, 0, 1]]))[:2]
    h, w = background.shape[:2]
    spread = warp(face, back, h, w, 255).astype(int) - warp(face, back, h, w, 0).astype(int)
    valid = (np.abs(spread) == 0).all(2)
    out = background.copy()
    out[valid] = warp(face, back, h, w, 0)[valid]
    return out


def stitch_background(image: np.ndarray, faces: list[tuple[tuple[int, int, int, int], np.ndarray]], resize_background: bool) -> np.ndarray:
    """First face wins in overlaps; the background may be softened through twice the generator's size."""
    out = image.copy()
    if resize_background and faces:
        n = 2 * faces[0][1].shape[0]
        out = resize(resize(image, n, n, "face"), *image.shape[:2], "face")
    free = np.ones(image.shape[:2], bool)
    for (x0, y0, x1, y1), face in faces:
        part = free[y0:y1, x0:x1]
        out[y0:y1, x0:x1][part] = resize(face, y1 - y0, x1 - x0, "face")[part]
        free[y0:y1, x0:x1] = False
    return out


def draw_boxes(image: np.ndarray, boxes: list[tuple[int, int, int, int]], colour=(255, 0, 0)) -> np.ndarray:
    out = image.copy()
    for x0, y0, x1, y1 in boxes:
        out[[y0, min(y1, len(out)) - 1], x0:x1] = colour
        out[y0:y1, [x0, min(x1, out.shape[1]) - 1]] = colour
    return out


def draw_points(image: np.ndarray, points: list[tuple[int, int, int]], radius: int = 2, colour=(255, 0, 0)) -> np.ndarray:
    """A disc at each visible (x, y, v)."""
    ys, xs = np.mgrid[: image.shape[0], : image.shape[1]]
    out = image.copy()
    for x, y, v in points:
        if v > 0:
            out[(xs - x) ** 2 + (ys - y) ** 2 <= radius**2] = colour
    return out


def draw_lines(image: np.ndarray, points: list[tuple[int, int, int]], pairs: list[tuple[int, int]], colour=(0, 255, 0)) -> np.ndarray:
    """Lines one cell wide between the pairs of points that are both visible, cut at the image's border."""
    out = image.copy()
    for a, b in pairs:
        (xa, ya, va), (xb, yb, vb) = points[a], points[b]
        if va > 0 and vb > 0:
            n = max(abs(xb - xa), abs(yb - ya)) + 1
            x, y = (np.floor(np.linspace(p, q, n) + 0.5).astype(int) for p, q in ((xa, xb), (ya, yb)))
            ok = (x >= 0) & (x < out.shape[1]) & (y >= 0) & (y < out.shape[0])
            out[y[ok], x[ok]] = colour
    return out


def draw_mask(image: np.ndarray, mask: np.ndarray, share: float = 0.2, colour=(255, 255, 255)) -> np.ndarray:
    """The colour mixed into the masked cells."""
    mixed = image * (1 - share) + np.asarray(colour, float) * share
    return np.where(mask[:, :, None], to_bytes(mixed), image)


def draw_surface(image: np.ndarray, vertices: np.ndarray, embedding: np.ndarray, mask: np.ndarray, share: float = 0.7) -> np.ndarray:
    """Masked cells mixed with the colour of their surface vertex: its first three embedding values, each stretched to
    bytes over all vertices."""
    three = embedding[:, :3]
    low, span = three.min(0), np.ptp(three, axis=0)
    palette = to_bytes((three - low) / np.where(span > 0, span, 1) * 255)
    return np.where(mask[:, :, None], to_bytes(image * (1 - share) + palette[vertices] * share), image)


def image_grid(images: list[np.ndarray], columns: int, pad: int = 2) -> np.ndarray:
    h, w, n = images[0].shape
    rows = -(-len(images) // columns)
    out = np.zeros((rows * (h + pad) - pad, columns * (w + pad) - pad, n), np.uint8)
    for i, im in enumerate(images):
        y, x = (i // columns) * (h + pad), (i % columns) * (w + pad)
        out[y : y + h, x : x + w] = im
    return out


def augment_matrix(seed: int, strength: float, size: int) -> np.ndarray:
    """A random affine map about the image's centre: quarter turns, scale, rotation, stretch and shift, each with the
    probability ``strength``."""
    rng = np.random.default_rng(seed)
    m = np.eye(3)

    def turn(a):
        return np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])

    if rng.random() < strength:
        m = turn(np.pi / 2 * rng.integers(0, 4)) @ m
    if rng.random() < strength:
        m = np.diag([*[2 ** (rng.normal() * 0.2)] * 2, 1]) @ m
    if rng.random() < strength:
        m = turn((rng.random() * 2 - 1) * np.pi) @ m
    if rng.random() < strength:
        s = 2 ** (rng.normal() * 0.2)
        m = np.diag([s, 1 / s, 1]) @ m
    if rng.random() < strength:
        m = np.array([[1, 0, rng.normal() * 0.125 * size], [0, 1, rng.normal() * 0.125 * size], [0, 0, 1]]) @ m
    centre = np.array([[1, 0, -(size - 1) / 2], [0, 1, -(size - 1) / 2], [0, 0, 1]])
    return (np.linalg.inv(centre) @ m @ centre)[:2]


def colour_matrix(seed: int, strength: float) -> np.ndarray:
    """3x4 map of RGB in -1..1: brightness, contrast, luma flip, hue about the grey axis, saturation."""
    rng = np.random.default_rng([seed, 1])
    m, axis = np.eye(4), np.ones(3) / np.sqrt(3)
    grey = np.zeros((4, 4))
    grey[:3, :3] = np.outer(axis, axis)
    grey[3, 3] = 1
    if rng.random() < strength:
        m[:3, 3] += rng.normal() * 0.2
    if rng.random() < strength:
        m = np.diag([*[2 ** (rng.normal() * 0.5)] * 3, 1]) @ m
    if rng.random() < strength and rng.random() < 0.5:
        flip = np.eye(4)
        flip[:3, :3] -= 2 * np.outer(axis, axis)
        m = flip @ m
    if rng.random() < strength:
        a = (rng.random() * 2 - 1) * np.pi
        cross = np.array([[0, -axis[2], axis[1]], [axis[2], 0, -axis[0]], [-axis[1], axis[0], 0]])
        hue = np.eye(4)
        hue[:3, :3] = np.cos(a) * np.eye(3) + np.sin(a) * cross + (1 - np.cos(a)) * np.outer(axis, axis)
        m = hue @ m
    if rng.random() < strength:
        m = (grey + (np.eye(4) - grey) * 2 ** rng.normal()) @ m
    return m[:3]


#: Expected share of power in the four bands of natural images. Fixed values.
BAND_POWER = np.array([10, 1, 1, 1]) / 13


def band_filters() -> np.ndarray:
    """Four centred filters, low to high, that sum to the identity: octaves split by the half-band filter of the
    orthogonal wavelet with two vanishing moments, dilated once an octave."""
    root = np.sqrt(3)
    wavelet = np.array([1 - root, 3 - root, 3 + root, 1 + root]) / (4 * np.sqrt(2))
    low = np.convolve(wavelet, wavelet[::-1]) / 2
    high = -low
    high[len(low) // 2] += 1
    below, bands = np.ones(1), []
    for step in (1, 2, 4):
        spread = np.zeros((2, step * (len(low) - 1) + 1))
        spread[:, ::step] = low, high
        bands.append(np.convolve(below, spread[1]))
        below = np.convolve(below, spread[0])
    size = len(below)
    return np.stack([np.pad(b, (size - len(b)) // 2) for b in [below, *bands[::-1]]])


def band_gains(seed: int, strength: float) -> np.ndarray:
    """Each band's amplification, drawn with the probability ``strength``; every draw keeps the expected power."""
    rng = np.random.default_rng([seed, 2])
    gains = np.ones(4)
    for band in range(4):
        one = np.ones(4)
        if rng.random() < strength:
            one[band] = 2 ** rng.normal()
        gains *= one / np.sqrt((BAND_POWER * one**2).sum())
    return gains


def filter_bands(image: np.ndarray, gains) -> np.ndarray:
    """Both axes filtered by the sum of the bands times their gains; the result isn't rounded."""
    taps = np.asarray(gains) @ band_filters()
    return _apply(mirror_matrix(image.shape[0], taps), mirror_matrix(image.shape[1], taps), image)


def cut_out(image: np.ndarray, cx: float, cy: float, share: float = 0.5, fill: int = 128) -> np.ndarray:
    """A box of that share of the sides about (cx, cy), both in 0..1, filled; cells count by their middles."""
    h, w = image.shape[:2]
    hit = lambda n, at: np.abs((np.arange(n) + 0.5) / n - at) < share / 2
    out = image.copy()
    out[np.outer(hit(h, cy), hit(w, cx))] = fill
    return out


def augment(image: np.ndarray, seed: int, strength: float = 0.5, noise_std: float = 0.1) -> np.ndarray:
    """Geometry, colours, band gains, noise and a box cut out, each drawn by the seed with the probability ``strength``."""
    h, w = image.shape[:2]
    out = warp(image[:, ::-1] if np.random.default_rng([seed, 3]).random() < strength / 2 else image, augment_matrix(seed, strength, h), h, w, fill=128)
    m = colour_matrix(seed, strength)
    unit = filter_bands((out / 127.5 - 1) @ m[:, :3].T + m[:, 3], band_gains(seed, strength))
    rng = np.random.default_rng([seed, 4])
    if rng.random() < strength:
        unit = unit + rng.normal(size=unit.shape) * abs(rng.normal()) * noise_std
    out = to_bytes((unit + 1) * 127.5)
    return cut_out(out, *rng.random(2)) if rng.random() < strength else out
