"""Whitening of embeddings by their exact covariance: digit-slice matrix products, big integers, one eigendecomposition.

Vectors become whole numbers, x = floor(SCALE * c) + SHIFT. ``gram_parts`` cuts them into limbs of LIMB_BITS bits, so that float64 products
of BLOCK_ROWS rows are sums below 2**53 and therefore exact; a task adds them up as big integers and writes one row a dimension, as
digits of DIGIT_BITS bits, whose sums stay exact in longs. ``merged`` adds tasks up in two steps, at most FAN_IN rows of a dimension at a
time in the first. The driver sees dim rows of dim numbers, whatever the count of vectors: it forms n G - S S' (n squared times the
covariance, exactly), rounds it once and decomposes it. Rows are then projected, written, and their covariance is measured from what was written.

Defined results: rows whose vector is null, or holds a null or an entry that isn't finite, are dropped, and so are those of another length
than most have (the shorter on ties), empty ones too; entries whose whole number leaves the range of longs are cut off at its ends; deviation is null where the exact
number leaves that range; components without variance (an eigenvalue of at most RANK_SHARE of the trace) are left out, so equal vectors give no
rows; a table without vectors gives none; rows that repeat an id are rows of their own, null ids stay; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

c = F.col
SCALE, SHIFT = 1024, 100_000
#: Products of two limbs are below 2**40, sums over BLOCK_ROWS = 2**13 rows at most 2**53: whole numbers that float64 holds exactly.
LIMB_BITS, BLOCK_ROWS = 20, 1 << 13
#: Digits of sums that leave a task; longs hold 2**22 of them.
DIGIT_BITS = 40
#: Partial sums of a dimension that one group of the first merging step holds.
FAN_IN = 64
RANK_SHARE = 1e-13
COMPONENTS = 8


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vectors can be used: no nulls, all finite, of the most frequent length."""
    finite = F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    kept = rows.filter(c(vector).isNotNull() & finite & (F.size(vector) > 0))
    lengths = kept.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n")).orderBy(c("n").desc(), "length").first()
    return kept.filter(F.size(vector) == (lengths["length"] if lengths else -1))


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * c) + SHIFT as longs, cut off at their ends."""
    x = np.floor(vectors.astype(np.float64) * SCALE)
    safe = np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)
    if (np.abs(x) < 2.0**62).all():
        return safe + SHIFT
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    exact = [min(high, max(low, (0 if np.isinf(v) else int(v)) + SHIFT)) if np.isfinite(v) else (high if v > 0 else low) for v in x.ravel()]
    return np.array(exact, np.int64).reshape(x.shape)


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x = sum of limb k times 2**(LIMB_BITS k); all but the last are not negative, the last has the sign and is below 2**LIMB_BITS in size."""
    out = []
    while True:
        if (np.abs(x) < 1 << LIMB_BITS).all() and x.min(initial=0) > np.iinfo(np.int64).min:
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << LIMB_BITS) - 1)).astype(np.float64))
        x = x >> LIMB_BITS


def exact_gram(x: np.ndarray) -> np.ndarray:
    """x' x of up to BLOCK_ROWS rows, in big integers."""
    cut_up = limbs(x)
    out = np.zeros((x.shape[1],) * 2, object)
    for i, a in enumerate(cut_up):
        for j, b in enumerate(cut_up):
            out = out + (a.T @ b).astype(np.int64).astype(object) * (1 << (LIMB_BITS * (i + j)))
    return out


def to_digits(values: list[int]) -> list[list[int]]:
    """Each number as digits of DIGIT_BITS bits, lowest first, the last with the sign; all as long as the longest needs."""
    width = max(1, max(-(-(v.bit_length() + 1) // DIGIT_BITS) for v in values))
    mask = (1 << DIGIT_BITS) - 1
    return [[(v >> (DIGIT_BITS * k)) & mask for k in range(width - 1)] + [v >> (DIGIT_BITS * (width - 1))] for v in values]


def from_digits(digits: list[list[int]]) -> list[int]:
    return [sum(d << (DIGIT_BITS * k) for k, d in enumerate(row)) for row in digits]


def as_matrix(batch: pa.RecordBatch, at: int = 0) -> np.ndarray:
    """A list column of equal lengths as rows."""
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def gram_parts(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row a task and dimension: i, part, n, sum, and row i of the Gram matrix of the whole numbers, as digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, None, None
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                x = whole(as_matrix(batch.slice(first, BLOCK_ROWS)))
                ones = np.ones((len(x), 1), np.int64)
                g = exact_gram(np.hstack([ones, x]))  # the column of ones gives the sums
                gram, n = g if gram is None else gram + g, n + len(x)
        if n:
            total = gram[0, 1:]
            for i in range(len(total)):
                yield pa.RecordBatch.from_pylist([{"i": i, "n": n, "values": to_digits([int(total[i]), *map(int, gram[i + 1, 1:])])}], out)

    out = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("values", pa.list_(pa.list_(pa.int64())))])
    rows = vectors.select(vector).mapInArrow(run, "i int, n bigint, values array<array<bigint>>")
    return rows.withColumn("part", F.spark_partition_id())


def _added(table: pa.Table) -> dict:
    """Rows of one dimension added up, number by number; carries are settled, so digits stay small."""
    values = [0] * len(table.column("values")[0])
    for row in table.column("values").to_pylist():
        values = [a + b for a, b in zip(values, from_digits(row), strict=True)]
    return {"i": table.column("i")[0].as_py(), "n": sum(table.column("n").to_pylist()), "values": to_digits(values)}


def merged(parts: DataFrame) -> DataFrame:
    """One row a dimension. First FAN_IN groups a dimension by task number, then those; of 1e5 tasks a group holds 1,563 rows of dim numbers."""
    schema = "i int, n bigint, values array<array<bigint>>"
    arrow = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("values", pa.list_(pa.list_(pa.int64())))])

    def add(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_added(table)], arrow)

    first = parts.withColumn("part", c("part") % FAN_IN).groupBy("i", "part").applyInArrow(add, schema)
    return first.groupBy("i").applyInArrow(add, schema)


def decompose(n: int, sums: list[int], gram: list[list[int]], components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors in columns, trace) of the covariance with divisor n, the largest first. It is rounded once, from the exact n G - S S'.
    Signs: the largest entry of a vector is positive."""
    dim = len(sums)
    v = np.array([[(n * gram[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dim)] for i in range(dim)], np.float64)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = sum(n * gram[i][i] - sums[i] ** 2 for i in range(dim)) / (n * n)
    kept = int((values[:components] > RANK_SHARE * trace).sum()) if trace > 0 else 0
    values, vectors = values[:kept], vectors[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(kept)]) if kept else np.ones(0)
    return values, vectors * signs, float(trace)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; null beyond longs."""
    base = [s // n for s in sums]
    rest = [s % n for s in sums]
    high = np.iinfo(np.int64).max
    size = max((max(abs(int(lo) - b), abs(int(hi) - b)) for lo, hi, b in zip(x.min(0), x.max(0), base, strict=True)), default=0)
    if ((size + 1) * n) ** 2 * len(sums) <= high:
        d = n * (x - np.array(base)) - np.array(rest)
        return (d * d).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e <= high else None for e in exact]


def projected(vectors: DataFrame, n: int, sums: list[int], values: np.ndarray, basis: np.ndarray, vector: str = "embedding") -> DataFrame:
    """vec_id, deviation, white: the row's coordinates along the components, over the root of the eigenvalue."""
    base, rest = np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])
    scaled = basis / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = whole(as_matrix(batch, 1))
                far = np.abs(x.astype(np.float64)).max(initial=0) >= 2.0**62
                gap = (x.astype(np.float64) - base if far else (x - base).astype(np.float64)) - rest
                white = gap @ scaled
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(x, n, sums), pa.int64()), pa.array(white.tolist(), pa.list_(pa.float64()))], names=["vec_id", "deviation", "white"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", vector).mapInArrow(run, f"vec_id {kind}, deviation bigint, white array<double>")


def identity_error(white: DataFrame, size: int) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity. Each task centres its rows and sends count, mean and
    products, which are merged about the common mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                w = as_matrix(batch)
                n, mean, m2 = merge_moments((n, mean, m2), (len(w), w.mean(0), (w - w.mean(0)).T @ (w - w.mean(0))))
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "mean": mean.tolist(), "m2": m2.ravel().tolist()}], out)

    out = pa.schema([("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("m2", pa.list_(pa.float64()))])
    parts = white.select("white").mapInArrow(run, "n bigint, mean array<double>, m2 array<double>")
    total = (0, np.zeros(size), np.zeros((size, size)))
    for r in parts.toLocalIterator():  # one row of size^2 + size numbers a task
        total = merge_moments(total, (r["n"], np.array(r["mean"]), np.array(r["m2"]).reshape(size, size)))
    return float(np.abs(total[2] / total[0] - np.eye(size)).max())


def merge_moments(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


RESULT = "vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """rows(vec_id, embedding) -> RESULT, one row a vector and component."""
    kept = usable(rows, vector)
    totals = sorted(merged(cut(gram_parts(kept, vector))).collect(), key=lambda r: r["i"])
    empty = rows.sparkSession.createDataFrame([], RESULT.format(kind=rows.schema["vec_id"].dataType.simpleString()))
    if not totals:
        return empty
    n, numbers = totals[0]["n"], [from_digits(r["values"]) for r in totals]
    sums, gram = [v[0] for v in numbers], [v[1:] for v in numbers]
    values, basis, trace = decompose(n, sums, gram, components)
    if not len(values):
        return empty
    white = cut(projected(kept, n, sums, values, basis, vector))
    error = identity_error(white, len(values))
    explained = F.array(*[F.lit(float(e / trace)) for e in values])
    each = white.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return each.select("vec_id", (c("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", F.get(explained, c("k")).alias("explained"), F.lit(error).alias("identity_error"))
