"""Bytes formats with the standard library alone: PNG, PPM, tar shards, EXIF orientation."""

from __future__ import annotations

import io
import struct
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_png(image: np.ndarray, level: int = 6) -> bytes:
    """uint8 H x W (grey), H x W x 3 or x 4."""
    image = image[:, :, None] if image.ndim == 2 else image
    h, w, n = image.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, w * n)], 1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[n], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """8-bit grey, RGB or RGBA without interlace -> uint8 H x W x channels."""
    at, body, head = 8, b"", None
    while at < len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        kind, chunk = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"IDAT":
            body += chunk
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("only plain 8-bit PNG images are read")
    w, h, n = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w * n), np.uint8)
    above = np.zeros(w * n, np.int64)
    for y in range(h):
        row, how = raw[y, 1:].astype(np.int64), raw[y, 0]
        if how == 2:
            row = (row + above) & 255
        elif how == 1:
            row = row.reshape(w, n).cumsum(0).ravel() & 255
        elif how in (3, 4):
            # each value needs its left neighbour's: a loop over pixels, channels at once
            cells, up = row.reshape(w, n), above.reshape(w, n)
            left, corner = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for x in range(w):
                if how == 3:
                    add = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    da, db, dc = abs(p - left), abs(p - up[x]), abs(p - corner)
                    add = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, up[x], corner))
                cells[x] = (cells[x] + add) & 255
                left, corner = cells[x], up[x]
            row = cells.ravel()
        out[y] = row
        above = row
    return out.reshape(h, w, n)


def encode_ppm(image: np.ndarray) -> bytes:
    return f"P6 {image.shape[1]} {image.shape[0]} 255\n".encode() + image.astype(np.uint8).tobytes()


def exif_orientation(data: bytes) -> int:
    """1 to 8 of a JPEG's EXIF block; 1 where there is none."""
    at = 2
    while data[:2] == b"\xff\xd8" and at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] != 0xDA:
        kind, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        if kind == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            tiff = data[at + 10 : at + 2 + size]
            order = "<" if tiff[:2] == b"II" else ">"
            (start,) = struct.unpack(order + "I", tiff[4:8])
            (count,) = struct.unpack(order + "H", tiff[start : start + 2])
            for i in range(count):
                tag, _, _, value = struct.unpack(order + "HHIH", tiff[start + 2 + 12 * i : start + 12 + 12 * i])
                if tag == 0x0112 and 1 <= value <= 8:
                    return value
        at += 2 + size
    return 1


def exif_block(orientation: int) -> bytes:
    """The head of a JPEG with nothing but an orientation."""
    tiff = b"II*\0" + struct.pack("<IH", 8, 1) + struct.pack("<HHIHH", 0x0112, 3, 1, orientation, 0) + b"\0" * 4
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(tiff) + 8) + b"Exif\0\0" + tiff + b"\xff\xd9"


def orient(image: np.ndarray, orientation: int) -> np.ndarray:
    """The image as it is meant to be seen."""
    if orientation in (2, 4, 5, 7):
        image = {2: image[:, ::-1], 4: image[::-1], 5: np.swapaxes(image, 0, 1), 7: np.swapaxes(image[::-1, ::-1], 0, 1)}[orientation]
    elif orientation in (3, 6, 8):
        image = np.rot90(image, {3: 2, 6: 3, 8: 1}[orientation])
    return np.ascontiguousarray(image)


def tar_samples(shards: DataFrame) -> DataFrame:
    """binaryFile rows of tar shards -> shard, key, member, data; a sample is the members of one key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    for m in tar:
                        if m.isfile():
                            key, _, member = m.name.partition(".")
                            rows.append((path, key, member, tar.extractfile(m).read()))
                yield pd.DataFrame(rows, columns=["shard", "key", "member", "data"])

    return shards.select("path", "content").mapInPandas(run, "shard string, key string, member string, data binary")


def write_tar(samples: DataFrame, shards: int | None = None) -> DataFrame:
    """samples(key, other columns) -> path, content: tar shards in which each other column is a member <key>.<column>. Samples are dealt to a count of shards by their
    key, or go by their own column shard, as of ``shards.shard_numbers``; a task holds one shard."""
    names = [n for n in samples.columns if n not in ("key", "shard")]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        blob = io.BytesIO()
        with tarfile.open(fileobj=blob, mode="w") as tar:
            for row in part.sort_values("key").to_dict("records"):
                for n in names:
                    data = row[n] if isinstance(row[n], bytes) else str(row[n]).encode()
                    info = tarfile.TarInfo(f"{row['key']}.{n}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame({"path": [f"shard-{part['_shard'].iloc[0]:06d}.tar"], "content": [blob.getvalue()]})

    dealt = samples.withColumn("_shard", F.col("shard") if shards is None else F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInPandas(run, "path string, content binary")


def png_of(px: str, height: int, width: int):
    """Column of PNG bytes of grey values in row order."""

    @F.pandas_udf("binary")
    def encode(values: pd.Series) -> pd.Series:
        return pd.Series([encode_png(np.reshape(v, (height, width)).astype(np.uint8)) for v in values])

    return encode(px)


def decoded_samples(members: DataFrame) -> DataFrame:
    """tar_samples(...) -> key, image (channel values in row order, of the .png member), height, width, text (of the .txt member): a row a sample."""

    @F.pandas_udf("struct<px: array<int>, height: int, width: int>")
    def decode(data: pd.Series) -> pd.DataFrame:
        images = [decode_png(v) for v in data]
        return pd.DataFrame({"px": [im.ravel().astype(np.int32) for im in images], "height": [im.shape[0] for im in images], "width": [im.shape[1] for im in images]})

    images = members.filter("member = 'png' or member like '%.png'").select("shard", "key", decode("data").alias("d"))
    texts = members.filter("member = 'txt' or member like '%.txt'").select("shard", "key", F.decode("data", "UTF-8").alias("text"))
    both = images.join(texts, ["shard", "key"], "left")
    return both.select("key", F.col("d")["px"].alias("image"), F.col("d")["height"].alias("height"), F.col("d")["width"].alias("width"), "text")


def brace_range(pattern: str) -> list[str]:
    """``a-{000..012}.tar`` -> the thirteen names."""
    head, _, rest = pattern.partition("{")
    if not rest:
        return [pattern]
    span, _, tail = rest.partition("}")
    first, last = span.split("..")
    return [f"{head}{i:0{len(first)}d}{tail}" for i in range(int(first), int(last) + 1)]
