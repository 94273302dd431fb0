"""Members of tar files by byte ranges: a large tar is read by as many tasks as it has ranges, and no task holds more than a member.

Tars up to ``split_bytes`` are one range. Of larger ones the headers are walked (a seek a member, no contents) and ranges are cut where a sample, the
members of one key, begins. Of many bytes ranges are longer, up to SPLIT_BYTES, so that there are some TASKS of them. What a member decodes to is found by its suffix in DECODERS.
"""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.registry import Registry
from .formats import brace_range, decode_png

NAME = "tar_members"
SCHEMA = "shard string, key string, member string, data binary"
SPLIT_BYTES = 64 << 20
#: Ranges shorter than SPLIT_BYTES are not cut beyond about so many.
TASKS = 128
#: By suffix: (type of the value, bytes -> value).
DECODERS = Registry("decoder")


def _png(data: bytes) -> dict:
    image = decode_png(data)
    return {"px": image.ravel().astype(np.int32), "height": image.shape[0], "width": image.shape[1]}


for _suffix, _kind, _f in (
    ("png", "struct<px: array<int>, height: int, width: int>", _png), ("txt", "string", lambda b: b.decode()), ("cls", "bigint", lambda b: int(b)),
    ("json", "string", lambda b: json.dumps(json.loads(b), sort_keys=True)), ("npy", "array<double>", lambda b: np.load(io.BytesIO(b)).ravel().astype(float)),
):
    DECODERS.register(_suffix)((_kind, _f))


class ByteRange(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def split_name(name: str) -> tuple[str, str]:
    """(key, member): the name up to the first dot of its last part, and the rest."""
    folder, slash, last = name.rpartition("/")
    key, _, member = last.partition(".")
    return folder + slash + key, member


class TarReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int):
        self.path, self.split_bytes = path, split_bytes

    def files(self) -> list[tuple[str, int]]:
        """(URI, size) of the tars: those of a folder, or those that a comma list of names with brace ranges gives."""
        out = []
        for pattern in self.path.split(","):
            for uri in brace_range(pattern):
                files, at = fs.FileSystem.from_uri(uri)
                info = files.get_file_info(at)
                if info.type == fs.FileType.Directory:
                    inside = sorted((f.base_name, f.size) for f in files.get_file_info(fs.FileSelector(at)) if f.extension == "tar")
                    out += [(f"{uri.rstrip('/')}/{name}", size) for name, size in inside]
                elif info.type == fs.FileType.NotFound:
                    raise FileNotFoundError(uri)
                else:
                    out.append((uri, info.size))
        return out

    def range_bytes(self, total: int) -> int:
        """The length of a range of so many bytes."""
        return max(self.split_bytes, min(SPLIT_BYTES, total // TASKS))

    def cuts(self, uri: str, split_bytes: int) -> list[int]:
        """Where ranges of a large tar begin."""
        files, at = fs.FileSystem.from_uri(uri)
        out, last = [0], None
        with files.open_input_file(at) as f, tarfile.open(fileobj=f, mode="r:") as tar:
            for m in tar:
                key = split_name(m.name)[0]
                if key != last and m.offset - out[-1] >= split_bytes:
                    out.append(m.offset)
                last = key
                tar.members = []  # the walk keeps none of them
        return out

    def partitions(self) -> list[InputPartition]:
        out, files = [], self.files()
        split = self.range_bytes(sum(size for _, size in files))
        for uri, size in files:
            starts = self.cuts(uri, split) if size > split else [0]
            out += [ByteRange(uri, a, b) for a, b in zip(starts, [*starts[1:], size], strict=True)]
        return out

    def read(self, partition: ByteRange) -> Iterator[tuple]:
        files, at = fs.FileSystem.from_uri(partition.path)
        with files.open_input_file(at) as f:
            f.seek(partition.start)
            with tarfile.open(fileobj=f, mode="r:") as tar:  # places are counted from where the file stands
                for m in tar:
                    if m.offset >= partition.end:  # places are those of the file
                        return
                    if m.isfile():
                        yield (partition.path, *split_name(m.name), tar.extractfile(m).read())
                    tar.members = []


class TarMembers(DataSource):
    """Options: path (a folder or a comma list of URIs, brace ranges allowed) and splitBytes."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TarReader:
        return TarReader(self.options["path"], int(self.options.get("splitbytes", SPLIT_BYTES)))


def tar_members(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    spark.dataSource.register(TarMembers)
    return spark.read.format(NAME).option("path", path).option("splitBytes", split_bytes).load()


def decoded_members(members: DataFrame, suffix: str) -> DataFrame:
    """The members of a suffix -> shard, key, member, value as its decoder makes it."""
    kind, decode = DECODERS.get(suffix)

    def frames(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([decode(v) for v in data])

    def values(data: pd.Series) -> pd.Series:
        return pd.Series([decode(v) for v in data])

    made = F.pandas_udf(frames if kind.startswith("struct") else values, kind)
    mine = (F.col("member") == suffix) | F.endswith("member", F.lit(f".{suffix}"))
    return members.filter(mine).select("shard", "key", "member", made("data").alias("value"))
