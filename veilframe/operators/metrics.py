"""Quality metrics as aggregations: per image first, then over the dataset, so partial sums do the work."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.storage import Cut, cut
from .matching import nearest_centre, vector_blocks
from .pixels import gaussian

c = F.col


def mse(pairs: DataFrame, scale: float = 255.0) -> DataFrame:
    d = (c("a") - c("b")) / scale
    return pairs.groupBy("image_id").agg(F.avg(d * d).alias("mse"))


def psnr_unit(m: Column) -> Column:
    """Of images in 0..1; NULL for equal ones."""
    return F.when(m > 0, 10 * F.log10(1 / m))


def psnr_255(m: Column) -> Column:
    return 20 * F.log10(255.0 / F.sqrt(m + 1e-10))


def age(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("image_id").agg(F.avg(F.abs(c("a") - c("b"))).alias("age"))


def l1_l2(pairs: DataFrame) -> DataFrame:
    """Mean absolute error and the mean of the images' root mean square errors."""
    d = (c("a") - c("b")) / 255.0
    per = pairs.groupBy("image_id").agg(F.avg(F.abs(d)).alias("l1"), F.sqrt(F.avg(d * d)).alias("rmse"))
    return per.agg(F.avg("l1").alias("l1"), F.avg("rmse").alias("l2"))


def pooling(height: int, width: int) -> int:
    """Side of the blocks that images are averaged over before their similarity is taken: that of the shorter side over 256, rounded half to even, 1 at least."""
    return max(1, round(min(height, width) / 256))


def pooled(pairs: DataFrame, factor: int) -> DataFrame:
    """Pairs of pixels averaged over blocks of factor x factor; what doesn't fill a block at the far sides goes."""
    if factor == 1:
        return pairs
    y, x = F.floor(c("y") / factor).cast("long"), F.floor(c("x") / factor).cast("long")
    blocks = pairs.groupBy("image_id", y.alias("y"), x.alias("x")).agg(F.avg("a").alias("a"), F.avg("b").alias("b"), F.count("*").alias("_n"))
    return blocks.filter(c("_n") == factor * factor).drop("_n")


def ssim(pairs: DataFrame, size: int = 11, sigma: float = 1.5, width: int = 8, height: int = 8, k1: float = 0.01, k2: float = 0.03, span: float = 255.0, factor: int | None = None) -> DataFrame:
    """Mean structural similarity over the windows that lie inside the image, of images averaged over ``pooling`` blocks first (or blocks of ``factor``); k1 and
    k2 are squared with the span. The window is separable: each pixel goes to as many windows as a row has taps, then again by columns."""
    factor = pooling(height, width) if factor is None else factor
    pairs, width, height = pooled(pairs, factor), width // factor, height // factor
    if size > min(width, height):
        raise ValueError("the kernel is larger than the image")
    taps = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(w).alias("w")) for k, w in enumerate(gaussian(size, sigma))])
    values = {"ma": c("a"), "mb": c("b"), "aa": c("a") * c("a"), "bb": c("b") * c("b"), "ab": c("a") * c("b")}
    m = pairs.select("image_id", "y", "x", *[v.cast("double").alias(n) for n, v in values.items()])
    for axis, limit in (("x", width - size), ("y", height - size)):
        rows = m.withColumn("_t", F.explode(taps)).withColumn(axis, c(axis) - c("_t")["k"]).filter((c(axis) >= 0) & (c(axis) <= limit))
        m = rows.groupBy("image_id", "y", "x").agg(*[F.sum(c("_t")["w"] * c(n)).alias(n) for n in values])
    c1, c2 = (k1 * span) ** 2, (k2 * span) ** 2
    va, vb, cov = c("aa") - c("ma") ** 2, c("bb") - c("mb") ** 2, c("ab") - c("ma") * c("mb")
    value = (2 * c("ma") * c("mb") + c1) / (c("ma") ** 2 + c("mb") ** 2 + c1) * (2 * cov + c2) / (va + vb + c2)
    return m.groupBy("image_id").agg(F.avg(value).alias("ssim"))


#: Partial moments of a dimension that one group of the first merging step holds.
FAN_IN = 64
_PART = "i int, n bigint, mean array<double>, m2 array<double>"


def merged_moments(a: tuple, b: tuple, i: slice | int = slice(None)) -> tuple:
    """Counts, means and centred sums of products of two sets of rows as those of both; i: the row of the matrix that is merged."""
    n = a[0] + b[0]
    gap = b[1] - a[1]
    cross = np.outer(gap, gap) if isinstance(i, slice) else gap[i] * gap
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + cross * (a[0] * b[0] / n)


def gram_rows(features: DataFrame, group: str) -> DataFrame:
    """features(group, vec) -> group, i, n, mean, m2: a row a group and dimension, with the mean vector and that row of the centred sums of products. One
    matrix product a batch and group; a task holds one dim x dim matrix a group (groups are few, as real and generated images), rows of
    which are merged in two steps, FAN_IN tasks at a time in the first. Null vectors and groups are left out."""
    kind = features.schema[group].dataType.simpleString()
    schema = f"g {kind}, {_PART}"
    rows = features.select(c(group).alias("g"), c("vec").cast("array<double>").alias("vec")).filter("g is not null and vec is not null")
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = batch.column(0).dictionary_encode()
            of = codes.indices.to_numpy(zero_copy_only=False)
            for k, g in enumerate(codes.dictionary.to_pylist()):
                mine = x[of == k]
                mean = mine.mean(0)
                new = (len(mine), mean, (mine - mean).T @ (mine - mean))
                held[g] = merged_moments(held[g], new) if g in held else new
        for g, (n, mean, m2) in held.items():
            for i in range(len(mean)):
                yield pa.RecordBatch.from_pylist([{"g": g, "i": i, "n": n, "mean": mean.tolist(), "m2": m2[i].tolist()}], arrow)

    def merge(table: pa.Table) -> pa.Table:
        i, total = table.column("i")[0].as_py(), None
        for n, mean, m2 in zip(*(table.column(k).to_pylist() for k in ("n", "mean", "m2")), strict=True):
            new = (n, np.array(mean), np.array(m2))
            total = new if total is None else merged_moments(total, new, i)
        return pa.Table.from_pylist([{"g": table.column("g")[0].as_py(), "i": i, "n": total[0], "mean": total[1].tolist(), "m2": total[2].tolist()}], arrow)

    first = rows.mapInArrow(parts, schema).withColumn("part", F.spark_partition_id() % FAN_IN)
    return first.groupBy("g", "i", "part").applyInArrow(merge, schema).groupBy("g", "i").applyInArrow(merge, schema).withColumnRenamed("g", group)


def moments(features: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """features(group, vec) -> means (group, i, mean) and covariances (group, i, j from i on, cov), ddof 1."""
    rows = gram_rows(features, group)
    means = rows.select(group, "i", F.get("mean", c("i")).alias("mean"))
    cov = rows.select(group, "i", "n", F.posexplode("m2").alias("j", "p")).filter("j >= i")
    return means, cov.select(group, "i", "j", F.when(c("n") > 1, c("p") / (c("n") - 1)).alias("cov"))


def frechet(mean1: np.ndarray, cov1: np.ndarray, mean2: np.ndarray, cov2: np.ndarray, eps: float = 1e-6) -> float:
    """Squared distance of two Gaussians; a singular product is regularised by eps on the diagonals."""

    def root(m: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh((m + m.T) / 2)
        return (vectors * np.sqrt(np.clip(values, 0, None))) @ vectors.T

    if min(np.linalg.eigvalsh(cov1).min(), np.linalg.eigvalsh(cov2).min()) < 1e-12:
        cov1, cov2 = cov1 + eps * np.eye(len(cov1)), cov2 + eps * np.eye(len(cov2))
    half = root(cov1)
    cross = np.sqrt(np.clip(np.linalg.eigvalsh(half @ cov2 @ half), 0, None)).sum()
    return float(((mean1 - mean2) ** 2).sum() + np.trace(cov1) + np.trace(cov2) - 2 * cross)


def frechet_distance(features: DataFrame, group: str, first, second) -> float:
    """Of two groups of feature vectors; of each, dim^2 numbers reach the driver, where the matrix root is taken."""
    rows = gram_rows(features.filter(c(group).isin(first, second)), group).collect()

    def of(g):
        mine = sorted((r for r in rows if r[group] == g), key=lambda r: r["i"])
        return np.array(mine[0]["mean"]), np.array([r["m2"] for r in mine]) / (mine[0]["n"] - 1)

    return frechet(*of(first), *of(second))


def trimmed(values: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Mean and population deviation of the values between two order statistics, inclusive: the one at or below the rank
    low * (n - 1) and the one at or above the rank high * (n - 1). Equal values are counted before anything is sorted, so ties meet in a row and not in a
    task; ranks are running sums over range-partitioned values."""
    counts = cut(values.select(c(value).alias("v")).filter("v is not null").groupBy("v").agg(F.count("*").alias("n")))
    n = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    stored = cut(counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("_p", F.spark_partition_id()))
    sizes = stored.groupBy("_p").agg(F.sum("n").alias("_n"))  # one row a partition
    shift = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    upto = c("_before") + F.sum("n").over(Window.partitionBy("_p").orderBy("v"))
    ranked = stored.join(F.broadcast(shift), "_p").select("v", "n", upto.alias("last"))
    ends = [math.floor(low * (n - 1)), math.ceil(high * (n - 1))]
    hit = F.lit(False)
    for at in ends:
        hit = hit | ((c("last") > at) & (c("last") - c("n") <= at))
    bounds = ranked.filter(hit).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    kept = counts.filter((c("v") >= bounds["lo"]) & (c("v") <= bounds["hi"])) if n else counts
    total = F.sum("n")
    mean = F.sum(c("v") * c("n")) / total
    centre = kept.agg(mean.alias("m")).first()["m"]
    gap = c("v") - F.lit(centre)
    return kept.agg(F.coalesce(total, F.lit(0)).alias("n"), mean.alias("mean"), F.sqrt(F.sum(gap * gap * c("n")) / total).alias("std"))


def mean_of_present(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """Mean over the rows that have a value, and how many do."""
    return rows.groupBy(key).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def counters(rows: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows there are, and how many of each named condition, in one row."""
    return rows.agg(F.count("*").alias("instances"), *[F.count_if(v).alias(k) for k, v in conditions.items()])


def status_counts(rows: DataFrame, status: Column) -> DataFrame:
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def boxes_per_frame(boxes: DataFrame, key: str, order: str, values: list[str], strict_compat: bool = False) -> DataFrame:
    """The boxes of each frame in order, as one list. strict_compat: the first of a frame is listed twice."""
    rows = boxes.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *values))).alias("boxes"))
    return rows.withColumn("boxes", F.concat(F.slice("boxes", 1, 1), "boxes")) if strict_compat else rows


def path_length(a: Column, b: Column, eps: float) -> Column:
    """Squared distance of two feature vectors a step of eps apart, by eps squared."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v) / eps**2


def stored_vectors(features: DataFrame, hashes: int = 0, seed: int = 0) -> Cut:
    """The vectors of a table as ``x``, the bytes of their doubles, in the shared folder: what is read once a round is neither made anew nor taken apart by
    entries. hashes: so many hashes of each vector go along, h0 for the first draw and h1, h2, ... for the rounds."""
    rows = features.filter("vec is not null").select(c("vec").cast("array<double>").alias("vec"))
    names = [f"h{r}" for r in range(hashes)]
    rows = rows.select("vec", *[F.xxhash64("vec", F.lit(seed), *[F.lit(r - 1)] * (r > 0)).alias(n) for r, n in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in vector_blocks(batch.column(0), np.zeros((0, 1))):
                ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 8)
                data = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])
                yield pa.RecordBatch.from_arrays([data, *batch.columns[1:]], names=["x", *names])

    return Cut(rows.mapInArrow(run, ", ".join(["x binary", *[f"{n} long" for n in names]])))


def vectors_of(column: pa.Array, table: np.ndarray) -> Iterator[np.ndarray]:
    """``vector_blocks`` of vectors as lists or as ``stored_vectors`` keeps them, few enough rows at a time to stay in a core's cache."""
    if pa.types.is_binary(column.type) and len(column):
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        values = pa.array(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.float64))
        column = pa.FixedSizeListArray.from_arrays(values, int(ends[1] - ends[0]) // 8)
    for x in vector_blocks(column, table):
        for first in range(0, len(x), 1024):
            yield x[first : first + 1024]


def centre_sums(features: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass: the sum and count of the vectors next to each centre (smallest number on ties), and the sum of squared distances. features: with ``vec``, or as
    stored. Matrix products a batch; a task sends one k x dim matrix, rows of which are added up by centre."""
    sent = features.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = sent.value
        total, n, cost = np.zeros_like(k), np.zeros(len(k), np.int64), np.zeros(len(k))
        for batch in batches:
            for x in vectors_of(batch.column(0), k):
                near, d = nearest_centre(x, k)
                order = np.argsort(near, kind="stable")
                count = np.bincount(near, minlength=len(k))
                some = np.flatnonzero(count)
                total[some] += np.add.reduceat(x[order], (np.cumsum(count) - count)[some])
                cost += np.bincount(near, d, len(k))
                n += count
        hit = np.flatnonzero(n)
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(n[hit]), pa.array(cost[hit]), pa.array(total[hit].tolist(), pa.list_(pa.float64()))], names=["entry", "n", "cost", "total"])

    kept = features.select("x") if "x" in features.columns else features.filter("vec is not null").select(c("vec").cast("array<double>"))
    rows = kept.mapInArrow(run, "entry int, n bigint, cost double, total array<double>")
    # sums by centre and dimension, added up before they leave a task
    sums = rows.groupBy("entry").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(centres.shape[1])])
    total, n, cost = np.zeros_like(centres), np.zeros(len(centres), np.int64), 0.0
    for r in sums.collect():  # a row a centre
        total[r["entry"]], n[r["entry"]] = [r[f"t{i}"] for i in range(centres.shape[1])], r["n"]
        cost += r["cost"]
    return total, n, cost


def lloyd_step(features: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(new centres, count of each, objective under the old ones): each centre goes to the mean of its vectors; one without any stays."""
    total, n, cost = centre_sums(features, centres)
    return np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres), n, cost


def seed_centres(features: DataFrame, k: int, rounds: int = 5, over: float = 2.0, seed: int = 0) -> np.ndarray:
    """k-means||: each round draws vectors with probability over * k times their share of the objective; the some over * k * rounds candidates, weighted by how
    many vectors are next to them, are brought down to k on the driver. Draws go by a hash of the vector, so they don't depend on partitions or retries."""
    kept = stored_vectors(features, rounds + 1, seed)
    try:
        return stored_seeds(kept.df, k, rounds, over, seed)
    finally:
        kept.drop()


def stored_seeds(rows: DataFrame, k: int, rounds: int, over: float, seed: int) -> np.ndarray:
    """``seed_centres`` of vectors stored with rounds + 1 hashes."""
    first = rows.select("x", "h0").orderBy("h0").limit(1).collect()
    if not first:
        raise ValueError("no vectors to seed from")
    vector = lambda r: np.frombuffer(r["x"], np.float64)
    centres = np.array([vector(first[0])])
    for r in range(rounds):
        cost = centre_sums(rows, centres)[2]
        if cost <= 0:
            break
        sent = rows.sparkSession.sparkContext.broadcast(centres)

        def draw(batches: Iterator[pa.RecordBatch], sent=sent, cost=cost) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, hits = 0, [np.zeros(0, np.int64)]
                for x in vectors_of(batch.column(0), sent.value):
                    d = nearest_centre(x, sent.value)[1]
                    u = (batch.column(1).slice(at, len(x)).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
                    hits.append(at + np.flatnonzero(u < over * k * d / cost))
                    at += len(x)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(hits)))], names=["x"])

        drawn = rows.select("x", f"h{r + 1}").mapInArrow(draw, "x binary").distinct().collect()
        centres = np.vstack([centres, *sorted(map(vector, drawn), key=list)])
    weights = centre_sums(rows, centres)[1]
    return reduced_centres(centres, weights, k, seed)


def mean_variance(rows: DataFrame) -> float:
    """The mean over dimensions of the population variance of stored vectors: sums of a task about its own mean, merged about the common one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, off = 0, 0.0, 0.0
        for batch in batches:
            for x in vectors_of(batch.column(0), np.zeros((0, 1))):
                new = x.mean(0)
                off = off + ((x - new) ** 2).sum(0) + (new - mean) ** 2 * (n * len(x) / (n + len(x)))
                mean = mean + (new - mean) * (len(x) / (n + len(x)))
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(mean)), pa.array(np.arange(len(mean), dtype=np.int32)), pa.array(mean), pa.array(off)], names=["n", "i", "mean", "off"])

    each = rows.select("x").mapInArrow(run, "n bigint, i int, mean double, off double")
    of = Window.partitionBy("i")
    about = F.sum(c("n") * c("mean")).over(of) / F.sum("n").over(of)
    off = each.withColumn("off", c("off") + c("n") * (c("mean") - about) * (c("mean") - about))  # a row a task and dimension
    return off.groupBy("i").agg((F.sum("off") / F.sum("n")).alias("v")).agg(F.avg("v")).first()[0] or 0.0


def reduced_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over weighted candidates; fewer where there are fewer different ones."""
    rng = np.random.default_rng(seed)
    chosen = [points[int(np.argmax(weights))]]
    d = ((points - chosen[0]) ** 2).sum(1) * weights
    while len(chosen) < k and d.sum() > 0:
        new = points[rng.choice(len(points), p=d / d.sum())]
        chosen.append(new)
        d = np.minimum(d, ((points - new) ** 2).sum(1) * weights)
    return np.array(chosen)


def k_means(features: DataFrame, k: int = 512, tol: float = 1e-5, limit: int = 1000, seed: int = 0, centres: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Lloyd's rounds from k-means|| seeds (or given centres) until the squared move of all centres is at most tol times the mean variance of the
    dimensions -> (centres, counts, objective, rounds). Vectors are stored once as bytes; a round is one pass over those."""
    draws = 5
    kept = stored_vectors(features, 0 if centres is not None else draws + 1, seed)
    try:
        centres = stored_seeds(kept.df, k, draws, 2.0, seed) if centres is None else np.asarray(centres, float)
        spread = mean_variance(kept.df)
        for done in range(1, limit + 1):
            new, n, cost = lloyd_step(kept.df, centres)
            moved = ((new - centres) ** 2).sum()
            centres = new
            if moved <= tol * spread:
                break
    finally:
        kept.drop()
    return centres, n, cost, done


def standardise_stats(features: DataFrame) -> DataFrame:
    """Per dimension: mean and reciprocal population deviation."""
    each = features.select(F.posexplode("vec").alias("i", "e"))
    return each.groupBy("i").agg(F.avg("e").alias("mean"), (1 / F.sqrt(F.var_pop("e"))).alias("rstd"))


def unit(v: Column) -> Column:
    """The vector scaled to length one."""
    length = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    return F.transform(v, lambda x: x / length)


def spherical(a: Column, b: Column) -> Column:
    """2 asin(|x - y| / 2)^2 of the vectors scaled to length one."""
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    na, nb = norm(a), norm(b)
    d = F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x / na - y / nb) * (x / na - y / nb)), F.lit(0.0), lambda s, v: s + v))
    return 2 * F.asin(d / 2) * F.asin(d / 2)


def ema(rows: DataFrame, key: str, order: list[str], value: str, beta: float) -> DataFrame:
    """Running exponential average of each key's values in order, started at the first."""
    listed = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, value))).alias("p"))
    first = F.get("p", F.lit(0))[value]
    return listed.select(key, F.aggregate("p", first, lambda a, x: a * beta + x[value] * (1 - beta)).alias("ema"))


#: Metrics by name: what a report can ask for.
PER_IMAGE = {"mse": mse, "age": age, "ssim": ssim}


def report(pairs: DataFrame, names: list[str], **options) -> DataFrame:
    """The named metrics of each image in one row."""
    out = None
    for n in names:
        part = PER_IMAGE[n](pairs, **options.get(n, {}))
        out = part if out is None else out.join(part, "image_id")
    return out


