"""Merkle manifest of a dataset: a tree of digests a language, a tree over their roots, and each row's proof.

``manifest`` makes a leaf of each row, ``climb`` a tree of each group, ``proofs`` checks every row by its siblings. Leaves of a group
lie in aligned blocks of ``fanout ** BLOCK_LEVELS``; a block is one contiguous numpy matrix of 64-byte hexadecimal digests, reshaped by the
fanout and hashed row by row, level by level. As blocks are aligned, what lies in a block depends on nothing outside it; the block roots
are the leaves of the next round, so a tree of any size takes a few rounds of tasks that each hold one block. Blocks are written to
the shared folder once: proofs read them there, joined with the path of their root. Only digests, ids and two flags leave the first pass.

Defined results: nulls are written ``-``, in the leaf and as a language of its own, which comes first; rows with a null id come first
in their language, rows that repeat an id in the order of their leaves, so equal rows share a digest, and each has its own proof; a lone
leaf is its tree's root and has no siblings; an empty table gives no rows; columns other than the named ones are ignored, also those
of clashing names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scan import positions
from .common import cut

c = F.col
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block holds fanout ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 10
HEX = 64
_PATH = "array<struct<own: int, left: string, right: string>>"
_BLOCK = "grp string, pos bigint, n bigint, items binary, ids array<bigint>, tampered binary, root string"


def leaf_text(changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Column:
    """Each field as ``-``, or its UTF-8 byte count, a colon and the value."""

    def part(name: str) -> Column:
        value = (changed or {}).get(name, c(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.concat(*[part(n) for n in fields])


def group_key(lang: Column) -> Column:
    """Never null, in the order of languages with null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


def levels_of(n: int, fanout: int) -> int:
    """Levels above n leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def hashed(nodes: np.ndarray, fanout: int) -> np.ndarray:
    """One level up: a contiguous (n,) matrix of 64-byte digests, every ``fanout`` of them one; the last run may be shorter."""
    data, width = memoryview(nodes.tobytes()), HEX * fanout
    return np.array([hashlib.sha256(data[i : i + width]).hexdigest().encode() for i in range(0, len(data), width)], dtype=f"S{HEX}")


def block_levels(nodes: np.ndarray, levels: int, fanout: int) -> list[np.ndarray]:
    """Nodes of a block on each level, the block's root last."""
    out = [nodes]
    for _ in range(levels):
        out.append(hashed(out[-1], fanout))
    return out


def digests(values: list[str | bytes]) -> np.ndarray:
    return np.array([v.encode() if isinstance(v, str) else v for v in values], dtype=f"S{HEX}")


def levels_here(n: int, fanout: int, levels: int) -> int:
    """Levels that a block of a tree of n leaves spans: all of it where the tree is one block."""
    return min(levels, levels_of(n, fanout))


def in_blocks(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes(grp, pos, n, digest and, in the first round, doc_id, tampered) -> one row a block (_BLOCK)."""
    size = fanout**levels
    extra = [c("doc_id").cast("bigint") if "doc_id" in nodes.columns else F.lit(None).cast("bigint").alias("doc_id"), c("tampered") if "tampered" in nodes.columns else F.lit(None).cast("string").alias("tampered")]
    rows = nodes.select("grp", F.floor(c("pos") / size).cast("bigint").alias("block"), "pos", "n", "digest", *extra)

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        items, n = digests(part["digest"].tolist()), int(part["n"].iloc[0])
        root = block_levels(items, levels_here(n, fanout, levels), fanout)[-1][0].decode()
        ids = None if part["doc_id"].isna().all() else [None if pd.isna(v) else int(v) for v in part["doc_id"]]
        changed = digests(["" if v is None else v for v in part["tampered"]]).tobytes()
        return pd.DataFrame([(part["grp"].iloc[0], int(part["block"].iloc[0]), n, items.tobytes(), ids, changed, root)], columns=["grp", "pos", "n", "items", "ids", "tampered", "root"])

    # ids as nullable integers: a null among them mustn't turn them into floats
    return rows.withColumn("doc_id", c("doc_id").cast("string")).groupBy("grp", "block").applyInPandas(pack, _BLOCK)


def run_path(level: np.ndarray, at: int, fanout: int) -> dict:
    """Where a node stands in its run, and what is left and right of it there."""
    first = at // fanout * fanout
    run = level[first : first + fanout]
    own = at - first
    return {"own": own, "left": b"".join(run[:own].tolist()).decode(), "right": b"".join(run[own + 1 :].tolist()).decode()}


def climb(nodes: DataFrame, fanout: int = 2, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """nodes(grp, pos from 0, n of its group, digest) -> (blocks as stored, paths(grp, pos of the block, root of the group, path above the
    block's root)). Rounds: as many as the largest group needs, one number a round reaches the driver."""
    blocks = cut(in_blocks(nodes, fanout, levels))
    size = fanout**levels
    most = blocks.agg(F.max("n").alias("n")).first()["n"] or 0
    if most <= size:
        return blocks, blocks.select("grp", "pos", "root", F.array().cast(_PATH).alias("path"))
    parents = blocks.select("grp", "pos", F.ceil(c("n") / size).cast("bigint").alias("n"), c("root").alias("digest"))
    above, paths = climb(parents, fanout, levels)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                items = np.frombuffer(r["items"], dtype=f"S{HEX}")
                tree = block_levels(items, levels_here(r["n"], fanout, levels), fanout)
                path = [[run_path(level, k // fanout**up, fanout) for up, level in enumerate(tree[:-1])] + r["path"] for k in range(len(items))]
                first = r["pos"] * size
                yield pa.RecordBatch.from_pylist([{"grp": r["grp"], "pos": first + k, "root": r["top"], "path": p} for k, p in enumerate(path)], out)

    out = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("root", pa.string()), ("path", pa.list_(pa.struct([("own", pa.int32()), ("left", pa.string()), ("right", pa.string())])))])
    joined = above.select("grp", "pos", "n", "items").join(paths.select("grp", "pos", c("root").alias("top"), "path"), ["grp", "pos"])
    return blocks, joined.mapInArrow(spread, f"grp string, pos bigint, root string, path {_PATH}")


def fold(own: np.ndarray, tree: list[np.ndarray], fanout: int) -> np.ndarray:
    """What each leaf of a block makes of the block's root: own digest and the tree's siblings, level by level. Places of siblings
    are index arithmetic: node k of a level stands at k % fanout of run k // fanout."""
    n = len(own)
    now, at = own.copy(), np.arange(n)
    for level in tree[:-1]:
        padded = np.zeros(-(-len(level) // fanout) * fanout, dtype=f"S{HEX}")
        padded[: len(level)] = level
        runs = padded.reshape(-1, fanout)[at // fanout].copy()
        runs[np.arange(n), at % fanout] = now
        full = np.minimum(fanout, len(level) - at // fanout * fanout) * HEX  # bytes of the run; the last one may be shorter
        data, width = memoryview(np.ascontiguousarray(runs).tobytes()), HEX * fanout
        now = np.array([hashlib.sha256(data[i * width : i * width + full[i]]).hexdigest().encode() for i in range(n)], dtype=f"S{HEX}")
        at = at // fanout
    return now


def sibling_bytes(tree: list[np.ndarray], n: int, fanout: int) -> list[bytes]:
    """For each leaf its siblings within the block, level by level, left to right."""
    parts = [b""] * n
    for up, level in enumerate(tree[:-1]):
        data, step = level.tobytes(), fanout**up
        for node in range(len(level)):
            first = node // fanout * fanout
            last = min(first + fanout, len(level))
            near = data[first * HEX : node * HEX] + data[(node + 1) * HEX : last * HEX]
            for k in range(node * step, min(n, (node + 1) * step)):
                parts[k] += near
    return parts


def manifest(docs: DataFrame, fanout: int = 2, levels: int = BLOCK_LEVELS, tampered: Column | None = None) -> DataFrame:
    """docs(FIELDS; doc_id a whole number) -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. tampered: rows whose n_chars grows by one before they are
    checked; by default those where 7 divides the
    crc32 of the decimal id."""
    chosen = F.crc32(c("doc_id").cast("string").cast("binary")) % 7 == 0 if tampered is None else tampered
    leaf = lambda changed=None: F.sha2(leaf_text(changed), 256)
    changed = F.when(chosen & c("n_chars").isNotNull(), leaf({"n_chars": c("n_chars") + 1}))
    rows = docs.select(c("doc_id").cast("bigint").alias("doc_id"), group_key(c("lang")).alias("grp"), leaf().alias("digest"), changed.alias("tampered"))
    placed = positions(rows, [c("grp"), c("doc_id"), c("digest")], "at")
    # rows lie in order of groups, so a group's leaves start at its smallest place
    groups = cut(placed.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("n")))
    leaves = placed.join(groups, "grp").select("grp", (c("at") - c("first")).alias("pos"), "n", "digest", "doc_id", "tampered")
    blocks, paths = climb(leaves, fanout, levels)
    # the tree over subroots: one leaf a language
    tops = paths.filter("pos = 0").select(c("grp").alias("lang"), c("root").alias("digest"))
    total = F.lit(groups.count()).cast("bigint")
    tops = positions(tops, [c("lang")], "pos").select(F.lit("").alias("grp"), "lang", "pos", total.alias("n"), "digest")
    tops = cut(tops)
    top_blocks, top_paths = climb(tops.select("grp", "pos", "n", "digest"), fanout, levels)
    over = cut(leaf_paths(top_blocks, top_paths, fanout, levels).join(tops.select("pos", "lang"), "pos").select(c("lang").alias("grp"), "root", c("path").alias("above")))
    whole = paths.select("grp", "pos", c("root").alias("subroot"), "path").join(over, "grp")
    whole = whole.select("grp", "pos", "subroot", "root", F.concat("path", "above").alias("path"))
    return proofs(blocks, whole, fanout, levels)


def leaf_paths(blocks: DataFrame, paths: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The whole path of each leaf: grp, pos, root, path. For small trees, as that over the subroots; ``proofs`` doesn't write paths out."""
    size = fanout**levels

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                items = np.frombuffer(r["items"], dtype=f"S{HEX}")
                tree = block_levels(items, levels_here(r["n"], fanout, levels), fanout)
                rows = [
                    {"grp": r["grp"], "pos": r["pos"] * size + k, "root": r["top"], "path": [run_path(level, k // fanout**up, fanout) for up, level in enumerate(tree[:-1])] + r["path"]}
                    for k in range(len(items))
                ]
                yield pa.RecordBatch.from_pylist(rows, out)

    out = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("root", pa.string()), ("path", pa.list_(pa.struct([("own", pa.int32()), ("left", pa.string()), ("right", pa.string())])))])
    joined = blocks.select("grp", "pos", "n", "items").join(paths.select("grp", "pos", c("root").alias("top"), "path"), ["grp", "pos"])
    return joined.mapInArrow(spread, f"grp string, pos bigint, root string, path {_PATH}")


def proofs(blocks: DataFrame, whole: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Every row of every block checked by its siblings: one block at a time in memory."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                leaves = np.frombuffer(r["items"], dtype=f"S{HEX}")
                n = len(leaves)
                tree = block_levels(leaves, levels_here(r["n"], fanout, levels), fanout)
                changed = np.frombuffer(r["tampered"], dtype=f"S{HEX}")
                now = fold(np.where(changed == b"", leaves, changed), tree, fanout)
                for step in r["path"]:
                    left, right = step["left"].encode(), step["right"].encode()
                    now = digests([hashlib.sha256(left + d + right).hexdigest() for d in now.tolist()])
                above = "".join(s["left"] + s["right"] for s in r["path"]).encode()
                proof = [hashlib.sha256(p + above).hexdigest() for p in sibling_bytes(tree, n, fanout)]
                root = r["root"].encode()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["ids"] if r["ids"] is not None else [None] * n, pa.int64()), pa.array([d.decode() for d in leaves.tolist()]), pa.array([r["subroot"]] * n), pa.array([r["root"]] * n),
                        pa.array(proof), pa.array([d.decode() for d in now.tolist()]), pa.array([d == root for d in now.tolist()]),
                    ],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    joined = blocks.drop("root").join(whole, ["grp", "pos"]).select("n", "items", "ids", "tampered", "subroot", "root", "path")
    return joined.mapInArrow(check, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


_CRC = "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(strlen(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS BIGINT), 1)) AS BIGINT))), lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda u, v: CASE WHEN u % 2 = 1 THEN xor(u // 2, CAST(3988292384 AS BIGINT)) ELSE u // 2 END)), CAST(4294967295 AS BIGINT))"


def _sql_leaf(n_chars: str = "n_chars") -> str:
    values = [f"CAST({n_chars if n == 'n_chars' else n} AS VARCHAR)" for n in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


_ROWS = f"SELECT doc_id, lang, {_sql_leaf()} AS leaf, CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_sql_leaf('n_chars + 1')} ELSE {_sql_leaf()} END AS given FROM documents"
ORACLE = f"""WITH RECURSIVE leaves AS MATERIALIZED (
 SELECT *, coalesce('=' || lang, '-') AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM ({_ROWS}) q),
up AS (SELECT grp, 0 AS lvl, pos, n, leaf AS d FROM leaves UNION ALL
 SELECT grp, lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY grp, lvl, pos // 2),
subroots AS MATERIALIZED (SELECT grp, d, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, pos, n, d FROM subroots UNION ALL
 SELECT lvl + 1, pos // 2, (max(n) + 1) // 2, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
nodes AS MATERIALIZED (SELECT grp, lvl, pos, n, d FROM up),
tops AS MATERIALIZED (SELECT lvl, pos, n, d FROM top),
low AS (SELECT l.grp, l.pos, s.lvl, (l.pos >> s.lvl) % 2 AS own, o.d AS sib FROM leaves l JOIN (SELECT DISTINCT grp, lvl, n FROM nodes) s ON s.grp = l.grp AND s.n > 1
 LEFT JOIN nodes o ON o.grp = l.grp AND o.lvl = s.lvl AND o.pos = xor(l.pos >> s.lvl, CAST(1 AS BIGINT))),
high AS (SELECT r.grp, s.lvl, (r.pos >> s.lvl) % 2 AS own, o.d AS sib FROM subroots r JOIN (SELECT DISTINCT lvl, n FROM tops) s ON s.n > 1
 LEFT JOIN tops o ON o.lvl = s.lvl AND o.pos = xor(r.pos >> s.lvl, CAST(1 AS BIGINT))),
paths AS (SELECT grp, pos, list({{'own': own, 'sib': coalesce(sib, '')}} ORDER BY lvl) AS p FROM low GROUP BY grp, pos),
above AS (SELECT grp, list({{'own': own, 'sib': coalesce(sib, '')}} ORDER BY lvl) AS p FROM high GROUP BY grp),
whole AS (SELECT l.*, r.d AS subroot, list_concat(coalesce(p.p, []), coalesce(a.p, [])) AS p FROM leaves l JOIN subroots r USING (grp) LEFT JOIN paths p ON p.grp = l.grp AND p.pos = l.pos LEFT JOIN above a ON a.grp = l.grp),
folded AS (SELECT *, list_reduce(list_prepend(given, list_transform(p, lambda s: CASE s.own WHEN 0 THEN '0' || s.sib ELSE '1' || s.sib END)),
 lambda a, s: sha256(CASE s[1] WHEN '0' THEN a || s[2:] ELSE s[2:] || a END)) AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, (SELECT d FROM tops WHERE n = 1) AS root, sha256(coalesce(list_reduce(list_prepend('', list_transform(p, lambda s: s.sib)), lambda a, s: a || s), '')) AS proof_sha256, folded_root,
 folded_root = (SELECT d FROM tops WHERE n = 1) AS verified FROM folded"""
