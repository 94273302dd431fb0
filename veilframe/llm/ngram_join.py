"""N-gram Jaccard join with Bayesian candidate pruning.

All pairs of different texts whose sets of word shingles (5 words) have Jaccard similarity of at least
``threshold`` = 0.8, reported as one row a document: its class, the number of links it has, and the document
that stands for its exact copies.

1. Sketch. One narrow Arrow pass makes 128 MinHash values of each text; the text's digest (md5) is made by Spark. The sketches are
   written to the shared folder, and equal texts become one node (partial minimum before the shuffle, so a text
   that a third of all rows share is no hot key). Copies are never expanded. Nodes are numbered as they are written, so
   ids may be of any type that can be ordered.
2. Candidates. 32 bands of 4 values; nodes alone in a bucket leave at once (a pair at the threshold shares no
   bucket with probability 5e-8). Buckets of more than ``block_rows`` nodes are cut in blocks, and every
   pair of blocks is a task of its own, so no bucket has to fit in one.
3. Bayesian pruning, in a bucket: pairs compare (a byte each of) their MinHash values 16 at a time; with a uniform prior the
   posterior of the similarity after m matches in n is Beta(m+1, n-m+1), and a pair is dropped as soon as its
   probability of reaching the threshold is below ``tolerance``. A bucket passes on the forest of surviving pairs
   only (each node linked towards the first of its component), never all pairs.
4. Components of the forest say which texts may be linked; each component, cut in blocks of at most about
   ``text_block_rows`` texts and ``text_block_bytes`` of them, gets its texts and counts intersections over an inverted index of the
   shingles' 64-bit hashes, exact but for collisions of those. Here all pairs of the component are decided; their
   numbers are added up per node, and again only a forest leaves. A component of several blocks whose surviving pairs are few, as a chain of texts each
   near the next, isn't taken by blocks: those pairs are listed and each is decided by itself. What decides between the two is which ships fewer texts; both
   are exact.
5. Components of the exact forest are the classes.

Only texts that are still candidates move, one row a distinct text: to their node, then to the pairs of blocks. The ids that choose them are
broadcast up to ``max_broadcast`` rows (counted first), beyond it those joins are shuffles. A task holds one Arrow batch of
texts (rows up to spark.sql.execution.arrow.maxRecordsPerBatch and its byte limit) and one pair of blocks.
Words are lower-case runs of letters, digits and underscores;
a text of fewer than 5 words has one shingle, all its words. Defined results: null texts and texts without words
are linked to nothing (equal texts without words, but not null, are copies still); rows are judged each by their own text, so
rows that repeat an id with different texts may be in different classes; null ids are larger than all others when the
smallest of a class is taken; a class of null ids only is null; an
empty table gives an empty one; other columns are not looked at. ``keep_one`` keeps one row a class, be ids repeated or null:
of its rows with the smallest id one with the smallest digest; rows with null text stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Cut

SHINGLE, BANDS, ROWS, STEP = 5, 32, 4, 16
HASHES = BANDS * ROWS
WORD = re.compile(r"\w+")
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_shingles(texts: list[str], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles one after the other, and how many each text has."""
    ids: dict[str, int] = {}
    lists = [WORD.findall(t.lower()) for t in texts]
    codes = [np.fromiter((ids.setdefault(w, len(ids)) for w in ws), np.int64, len(ws)) for ws in lists]
    word_hash = np.fromiter((int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in ids), _U, len(ids))
    out, sizes = [], np.zeros(len(texts), np.int64)
    for i, c in enumerate(codes):
        if len(c) == 0:
            continue
        h = word_hash[c]
        k = min(n, len(h))
        acc = np.full(len(h) - k + 1, k, _U)
        for j in range(k):
            acc = mix(acc * _U(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j])
        sizes[i] = len(acc)
        out.append(acc)
    return (np.concatenate(out) if out else np.zeros(0, _U)), sizes


_RNG = np.random.default_rng(20)
MULTIPLIERS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * _U(2) + _U(1)
ADDENDS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minhash(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """uint32 [texts, HASHES]; all ones for texts without shingles."""
    out = np.full((len(sizes), HASHES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        work = np.empty_like(shingles)
        for j in range(HASHES):
            np.multiply(shingles, MULTIPLIERS[j], out=work)
            work += ADDENDS[j]
            out[full, j] = np.minimum.reduceat(work, starts) >> _U(32)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """int64 [texts, BANDS]: one hash of the ROWS values of each band."""
    values = sig.astype(_U).reshape(len(sig), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), (len(sig), BANDS)).copy()
    for r in range(ROWS):
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + values[:, :, r])
    return keys.view(np.int64)


def _beta_tail(a: int, b: int, t: float) -> float:
    """P(X >= t) for X ~ Beta(a, b) with whole a, b: a binomial sum."""
    n = a + b - 1
    return sum(math.comb(n, j) * t**j * (1 - t) ** (n - j) for j in range(a))


def least_matches(threshold: float, tolerance: float, total: int = HASHES, step: int = STEP) -> list[int]:
    """For n = step, 2*step, ...: the smallest number of matches whose posterior still reaches the tolerance."""
    return [next((m for m in range(n + 1) if _beta_tail(m + 1, n - m + 1, threshold) >= tolerance), n + 1) for n in range(step, total + 1, step)]


def surviving(pivot: np.ndarray, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Which of the others are not pruned against the pivot."""
    alive, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for k, need in enumerate(least):
        cols = slice(k * STEP, (k + 1) * STEP)
        matches[alive] += (others[alive, cols] == pivot[cols]).sum(1)
        alive = alive[matches[alive] >= need]
        if not len(alive):
            break
    return alive


def surviving_pairs(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) are not pruned."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, need in enumerate(least):
        cols = slice(k * STEP, (k + 1) * STEP)
        matches[alive] += (left[alive, cols] == right[alive, cols]).sum(1)
        alive = alive[matches[alive] >= need]
    return alive


def signature_forest(ids: np.ndarray, sigs: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Breadth-first over surviving pairs: (nodes, first node of their component) for all that are not first.
    A node that is reached leaves the pool, so a bucket of copies costs one sweep."""
    pool, found, tops = np.arange(len(ids)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(pool):
        root, queue, pool = pool[0], [pool[0]], pool[1:]
        while queue and len(pool):
            alive = surviving(sigs[queue.pop()], sigs[pool], least)
            if len(alive):
                reached = pool[alive]
                queue.extend(reached)
                found.append(ids[reached])
                tops.append(np.full(len(reached), ids[root]))
                pool = np.delete(pool, alive)
    return np.concatenate(found), np.concatenate(tops)


def exact_links(shingles: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """shingles: distinct hashes of each text. Pairs within ``left`` (right None) or between left and right:
    number of links of each text, and the first text of its component (as positions)."""
    n = len(shingles)
    degree, parent = np.zeros(n, np.int64), np.arange(n)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in shingles], np.int64)
    over = left if right is None else right  # the indexed side
    owner = np.repeat(np.arange(len(over)), sizes[over])
    flat = np.concatenate([shingles[i] for i in over]) if len(over) else np.zeros(0, _U)
    by = np.argsort(flat, kind="stable")
    keys, starts, counts = np.unique(flat[by], return_index=True, return_counts=True)
    owner = owner[by]
    for a, i in enumerate(left):
        if not sizes[i] or not len(keys):
            continue
        at = np.minimum(np.searchsorted(keys, shingles[i]), len(keys) - 1)
        at = at[keys[at] == shingles[i]]
        if not len(at):
            continue
        c = counts[at]
        ends = np.cumsum(c)
        where = np.arange(ends[-1]) - np.repeat(ends - c, c) + np.repeat(starts[at], c)
        shared = np.bincount(owner[where], minlength=len(over))
        hit = shared >= np.ceil(threshold * (sizes[i] + sizes[over] - shared) - 1e-9)
        hit &= shared > 0
        if right is None:
            hit[: a + 1] = False
        partners = over[hit]
        degree[i] += len(partners)
        degree[partners] += 1
        top = root(i)
        for p in partners:
            r = root(int(p))
            if r != top:
                parent[max(r, top)] = min(r, top)
                top = min(r, top)
    return degree, np.array([root(x) for x in range(n)], np.int64)


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> node, class: the smallest node of its connected component. Minimum labels along edges
    and label of label, each round written to the shared folder; stops when a round changes nothing."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    links = Cut(both)
    labels = Cut(links.df.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = links.df.join(labels.df.select(F.col("a").alias("b"), F.col("label").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        step = labels.df.join(near, "a").select("a", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        jump = labels.df.select(F.col("a").alias("label"), F.col("label").alias("further"))
        new = Cut(step.join(jump, "label", "left").select("a", F.least("label", F.coalesce("further", "label")).alias("label"), "was"))
        changed = new.df.filter(F.col("label") != F.col("was")).limit(1).count()
        labels.drop()
        labels = new
        if not changed:
            break
    links.drop()
    return labels.df.select(F.col("a").alias("node"), F.col("label").alias("class"))


def in_blocks(rows: DataFrame, n_blocks: Column, node: str) -> DataFrame:
    """Adds block (of the node), lo and hi: each pair of blocks of a key is a group of its own."""
    rows = rows.withColumn("n_blocks", n_blocks.cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(3), node), F.col("n_blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    return rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "n_blocks")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def sketch(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, digest, n_bytes, bands (a key a band), sig (a byte of each MinHash value); the last two
    null for texts without words. Rows with null text aren't there."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_all = batch.column(3).to_pylist()
            start, total = 0, 0
            for i, t in enumerate(texts_all):
                total += len(t)
                if total < 1_000_000 and i < len(texts_all) - 1:
                    continue
                texts = texts_all[start : i + 1]
                shingles, sizes = text_shingles(texts)
                sig = minhash(shingles, sizes)
                bands, low = band_keys(sig), sig.astype(np.uint8)
                full = sizes > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(start, len(texts)) for k in range(3)],
                        pa.array([b if f else None for b, f in zip(bands, full, strict=True)], pa.list_(pa.int64())),
                        pa.array([b.tobytes() if f else None for b, f in zip(low, full, strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "digest", "n_bytes", "bands", "sig"],
                )
                start, total = i + 1, 0

    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", digest_of(F.col("text")).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, n_bytes bigint, bands array<bigint>, sig binary")


def _grouped(rows: DataFrame, keys: list[str], process, schema: str) -> DataFrame:
    """Deals rows by the keys, sorts them and gives process(table, bounds) tables of whole groups: group i is
    rows bounds[i] to bounds[i + 1]. Only the group that is still open is held back."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if not len(table):
                continue
            change = np.zeros(len(table) - 1, bool)
            for k in keys:
                values = table.column(k).to_numpy()
                change |= values[1:] != values[:-1]
            bounds = np.concatenate([[0], np.flatnonzero(change) + 1])
            if len(bounds) > 1:
                yield process(table.slice(0, bounds[-1]), bounds)
            held = table.slice(bounds[-1])
        if held is not None:
            yield process(held, np.array([0, len(held)]))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stream, schema)


def candidate_forest(nodes: DataFrame, threshold: float, tolerance: float, block_rows: int) -> DataFrame:
    """nodes(node, bands, sig) -> edges (a, b) of the pruned candidate forest."""
    # bytes of different values are equal once in 256 times, which raises the share of matches at the threshold
    least = least_matches(threshold + (1 - threshold) / 256, tolerance)
    keys = nodes.select("node", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keys.join(sizes, "key")
    member = in_blocks(shared, F.ceil(F.col("n") / block_rows), "node").join(nodes.select("node", "sig"), "node")

    def process(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        ids = table.column("node").to_numpy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), HASHES)
        size = np.diff(bounds)
        two = bounds[:-1][size == 2]
        kept = surviving_pairs(sigs[two], sigs[two + 1], least)
        x, y = ids[two[kept]], ids[two[kept] + 1]
        edges = [(np.maximum(x, y), np.minimum(x, y))]
        for i in np.flatnonzero(size > 2):
            part = slice(bounds[i], bounds[i + 1])
            order = np.argsort(ids[part], kind="stable")
            edges.append(signature_forest(ids[part][order], sigs[part][order], least))
        a, b = (np.concatenate([e[k] for e in edges]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _grouped(member.select("key", "lo", "hi", "node", "sig"), ["key", "lo", "hi"], process, "a bigint, b bigint").distinct()


def pair_counts(members: DataFrame, least: list[int], block_rows: int) -> DataFrame:
    """members(node, comp, bands, sig) -> comp, pairs: about how many surviving pairs the buckets of a component hold, counted once a bucket. In each bucket
    PIVOTS nodes are compared with all others; the number only chooses how pairs are decided, not which."""

    def process(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        comps, pairs = [], []
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(table), HASHES)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            mine, n = sigs[start:end], end - start
            pivots = range(0, n, max(1, -(-n // PIVOTS)))
            hits = sum(len(surviving(mine[p], mine, least)) - 1 for p in pivots)
            comps.append(table.column("comp")[int(start)].as_py())
            pairs.append(hits * n / len(pivots) / 2)
        return pa.RecordBatch.from_arrays([pa.array(comps, pa.int64()), pa.array(pairs, pa.float64())], names=["comp", "pairs"])

    return _grouped(_bucketed(members, block_rows), ["key", "comp", "lo", "hi"], process, "comp bigint, pairs double").groupBy("comp").agg(F.sum("pairs").alias("pairs"))


#: Nodes of a bucket that are compared with all others to tell how many pairs there are.
PIVOTS = 8


def _bucketed(members: DataFrame, block_rows: int) -> DataFrame:
    """members(node, comp, bands, sig) -> key, comp, lo, hi, node, sig of the buckets that two or more nodes of a component share."""
    keys = members.select("node", "comp", F.explode("bands").alias("key"))
    shared = keys.join(keys.groupBy("key", "comp").agg(F.count("*").alias("n")).filter("n > 1"), ["key", "comp"])
    dealt = in_blocks(shared, F.ceil(F.col("n") / block_rows), "node")
    return dealt.join(members.select("node", "sig"), "node").select("key", "comp", "lo", "hi", "node", "sig")


def surviving_edges(members: DataFrame, least: list[int], block_rows: int) -> DataFrame:
    """members(node, comp, bands, sig) -> a, b: every surviving pair once, a < b."""

    def process(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        ids = table.column("node").to_numpy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), HASHES)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            mine, names = sigs[start:end], ids[start:end]
            for i in range(len(mine) - 1):
                near = names[i + 1 :][surviving(mine[i], mine[i + 1 :], least)]
                left.append(np.minimum(near, names[i]))
                right.append(np.maximum(near, names[i]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (left, right)], names=["a", "b"])

    return _grouped(_bucketed(members, block_rows), ["key", "comp", "lo", "hi"], process, "a bigint, b bigint").filter("a <> b").distinct()


def exact_pairs(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """pairs(a, b), texts(node, text) -> (node, links, a) as of ``exact_join``: two rows for each pair that is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                one, two = (np.unique(text_shingles([t])[0]) for t in (x, y))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                if shared and shared >= math.ceil(threshold * (len(one) + len(two) - shared) - 1e-9):
                    kept.append(i)
            a, b = (batch.column(k).take(pa.array(kept, pa.int64())) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]), pa.array(np.ones(2 * len(kept), np.int64)), pa.concat_arrays([a, a])], names=["node", "links", "a"])

    left, right = texts.select(F.col("node").alias("a"), F.col("text").alias("x")), texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "node bigint, links bigint, a bigint")


def exact_join(texts: DataFrame, threshold: float) -> DataFrame:
    """texts(comp, block, lo, hi, node, text) -> (node, links, a): links counted in this pair of blocks, and a, the
    first node of the node's exact component here. Pairs within a block count where lo = hi = block."""

    def process(table: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
        all_nodes, all_degrees, all_tops = [], [], []
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            part = table.slice(start, end - start)
            rows = sorted(set(zip(part.column("node").to_pylist(), part.column("block").to_pylist(), part.column("text").to_pylist(), strict=True)))
            nodes, block = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows])
            lo, hi = part.column("lo")[0].as_py(), part.column("hi")[0].as_py()
            sets = [np.unique(text_shingles([r[2]])[0]) for r in rows]
            if lo == hi:
                degree, top = exact_links(sets, np.arange(len(nodes)), None, threshold)
            else:
                degree, top = exact_links(sets, np.flatnonzero(block == lo), np.flatnonzero(block == hi), threshold)
            all_nodes.append(nodes)
            all_degrees.append(degree)
            all_tops.append(nodes[top])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (all_nodes, all_degrees, all_tops)], names=["node", "links", "a"])

    return _grouped(texts, ["comp", "lo", "hi"], process, "node bigint, links bigint, a bigint")


def n_blocks(rows: int, size: int) -> Column:
    """Blocks of a component of n nodes and ``bytes`` of text, a node a block at most."""
    return F.least(F.col("n"), F.greatest(F.ceil(F.col("n") / rows), F.ceil(F.col("bytes") / size))).cast("long")


def broadcast_rows(size: DataFrame, blocks: Column) -> int:
    """size(n, bytes): a row a component -> the rows that in_blocks makes of their nodes."""
    return size.agg(F.sum(F.col("n") * blocks).alias("rows")).first()["rows"] or 0


class Classes:
    """What the join finds: ``rows`` (doc_id, digest of all rows with a text), ``texts`` (digest, node, copy_id, n_copies; a row a
    distinct text) and ``linked`` (node, class_id, class_digest, n_links; nodes that came to the exact count), all stored.
    (class_id, class_digest) is the row that stands for the class."""

    def __init__(self, docs: DataFrame, threshold: float, tolerance: float, block_rows: int, text_block_rows: int, text_block_bytes: int, max_broadcast: int):
        sk = Cut(sketch(docs))
        self.rows = sk.df.select("doc_id", "digest")
        # one row a distinct text; equal digests have equal sketches
        alike = sk.df.groupBy("digest").agg(
            F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"), F.first("n_bytes").alias("n_bytes"), F.first("bands").alias("bands"), F.first("sig").alias("sig")
        )
        alike = Cut(alike.withColumn("node", F.monotonically_increasing_id()))
        self.texts = alike.df.select("digest", "node", "copy_id", "n_copies")
        nodes = alike.df.filter(F.col("sig").isNotNull()).select("node", "bands", "sig")
        forest = Cut(candidate_forest(nodes, threshold, tolerance, block_rows))
        maybe = components(forest.df.filter("a <> b")).withColumnRenamed("class", "comp")
        maybe = Cut(maybe.join(alike.df.select("node", "digest", "copy_id", "n_bytes"), "node"))
        forest.drop()
        size = maybe.df.groupBy("comp").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
        blocks = n_blocks(text_block_rows, text_block_bytes)
        size = Cut(size.withColumn("blocks", blocks)).df
        least = least_matches(threshold + (1 - threshold) / 256, tolerance)
        large = maybe.df.select("node", "comp").join(size.filter("blocks > 1").select("comp", "n", "blocks"), "comp")
        listed = None
        if size.filter("blocks > 1").limit(1).count():
            members = large.select("node", "comp").join(nodes, "node")
            counts = pair_counts(members, least, block_rows).join(size, "comp")
            few_pairs = Cut(counts.filter(2 * F.col("pairs") <= F.col("n") * F.col("blocks")).select("comp")).df
            if few_pairs.limit(1).count():
                listed = Cut(surviving_edges(members.join(few_pairs, "comp"), least, block_rows)).df
                size = size.join(few_pairs, "comp", "left_anti")
        few = broadcast_rows(size, F.col("blocks")) <= max_broadcast and maybe.df.count() <= max_broadcast
        bound = F.broadcast if few else lambda df: df
        wanted = maybe.df.select("node", F.col("copy_id").alias("__id"), F.col("digest").alias("__digest"))
        texts = docs.filter(F.col("text").isNotNull()).select("doc_id", digest_of(F.col("text")).alias("digest"), "text")
        texts = texts.join(bound(wanted), (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id")))
        # rows that repeat an id and its text are one text
        texts = texts.groupBy("node").agg(F.first("text").alias("text"))
        active = in_blocks(maybe.df.select("node", "comp").join(size.select("comp", "blocks"), "comp"), F.col("blocks"), "node")
        counted = exact_join(texts.join(bound(active), "node").select("comp", "lo", "hi", "block", "node", "text"), threshold)
        if listed is not None:
            named = listed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            counted = counted.unionByName(exact_pairs(listed, Cut(texts.join(named, "node")).df, threshold))
        links = Cut(counted)
        classes = components(links.df.filter("node <> a").select(F.col("node").alias("a"), F.col("a").alias("b")))
        degree = links.df.groupBy("node").agg(F.sum("links").alias("n_links"))
        found = classes.join(degree, "node", "full").join(maybe.df.select("node", "copy_id", "digest"), "node")
        found = found.select("node", F.coalesce("class", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "copy_id", "digest")
        first = F.min(F.struct(F.col("copy_id").isNull().alias("none"), "copy_id", "digest")).alias("first")
        tops = found.groupBy("class").agg(first)
        linked = found.select("node", "class", "n_links").join(tops, "class")
        self.linked = Cut(linked.select("node", F.col("first")["copy_id"].alias("class_id"), F.col("first")["digest"].alias("class_digest"), "n_links")).df

    def members(self) -> DataFrame:
        """A row each of ``rows``, with its text's numbers and its class."""
        rows = self.rows.join(self.texts, "digest").join(self.linked, "node", "left")
        alone = F.col("class_digest").isNull()
        return rows.select(
            "doc_id", "digest", "copy_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(alone, F.col("copy_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_digest", "digest").alias("class_digest"),
        )


def find_classes(
    docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6, block_rows: int = 8000, text_block_rows: int = 400, text_block_bytes: int = 16_000_000, max_broadcast: int = 2_000_000
) -> Classes:
    return Classes(docs.select("doc_id", "text"), threshold, tolerance, block_rows, text_block_rows, text_block_bytes, max_broadcast)


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """docs(doc_id, text) -> doc_id, class_id (smallest id of its class: copies and linked texts), copy_id
    (smallest id with the same text), n_copies (rows with that text), n_links (other texts linked to it)."""
    one = lambda n: F.lit(n).cast("long")
    bare = docs.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), one(1).alias("n_copies"), one(0).alias("n_links"))
    return find_classes(docs, **options).members().select(bare.columns).unionByName(bare)


def keep_one(docs: DataFrame, max_broadcast: int = 2_000_000, **options) -> DataFrame:
    """One row of each class, with all its columns. Rows are known by (doc_id, digest of the text): all but the one that
    stands for its class go, and where that one repeats, one of its rows stays. The keys of both are broadcast below
    ``max_broadcast`` rows."""
    members = find_classes(docs, max_broadcast=max_broadcast, **options).members()
    stands = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    keys = members.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).agg(F.count("*").alias("__n"), F.first(stands).alias("__stands"))
    keys = Cut(keys.filter(~F.col("__stands") | (F.col("__n") > 1))).df
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("__row"), F.col("doc_id").alias("__doc"), digest_of(F.col("text")).alias("__key"))
    counts = keys.agg(F.count("*").alias("n"), F.count_if("__stands").alias("again")).first()
    bound = F.broadcast if counts["n"] <= max_broadcast else lambda df: df
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__digest"))
    kept = rows.join(bound(keys.select("__id", "__digest")), same, "left_anti").select("__row")
    if counts["again"]:
        twice = rows.join(bound(keys.filter("__stands").select("__id", "__digest")), same, "left_semi")
        kept = kept.unionByName(twice.groupBy("__doc", "__key").agg(F.first("__row").alias("__row")).select("__row"))
    return kept.select("__row.*")


#: All pairs that share a shingle are counted; ids are taken to be unique.
ORACLE = """
WITH RECURSIVE t AS MATERIALIZED (SELECT text, min(doc_id) AS copy_id, count(*) AS n_copies FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT copy_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM t),
g AS MATERIALIZED (SELECT DISTINCT copy_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g FROM (SELECT copy_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT copy_id, count(*) AS n FROM g GROUP BY copy_id),
c AS MATERIALIZED (SELECT x.copy_id AS a, y.copy_id AS b, count(*) AS s FROM g x JOIN g y ON x.g = y.g AND x.copy_id <> y.copy_id GROUP BY x.copy_id, y.copy_id),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.copy_id = a JOIN n y ON y.copy_id = b WHERE s >= ceil(0.8 * (x.n + y.n - s) - 1e-9)),
r AS (SELECT a AS node, a AS top FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.top),
k AS (SELECT node, min(top) AS class_id FROM r GROUP BY node),
m AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, coalesce(k.class_id, t.copy_id, d.doc_id) AS class_id, coalesce(t.copy_id, d.doc_id) AS copy_id, coalesce(t.n_copies, 1) AS n_copies, coalesce(m.n_links, 0) AS n_links
FROM documents d LEFT JOIN t ON t.text = d.text LEFT JOIN k ON k.node = t.copy_id LEFT JOIN m ON m.a = t.copy_id
"""
