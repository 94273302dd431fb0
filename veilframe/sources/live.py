"""A live source that keeps no backlog: each trigger reads the newest frame file and passes over all that came before it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "latest_frames"


class NewestFile(InputPartition):
    def __init__(self, path: str, dropped: int):
        self.path, self.dropped = path, dropped


class LatestReader(DataSourceStreamReader):
    """Offsets are the newest file and how many there were. From one to the next lies one partition, the newest file; the files between are counted,
    never opened. The log of offsets makes a batch that runs again read the same file."""

    def __init__(self, folder: str, schema: StructType):
        self.folder, self.schema = folder, schema

    def initialOffset(self) -> dict:
        return {"file": "", "seen": 0}

    def latestOffset(self) -> dict:
        files, root = fs.FileSystem.from_uri(self.folder)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        whole = sorted((f.mtime_ns or 0, f.base_name) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")
        return {"file": whole[-1][1], "seen": len(whole)} if whole else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if not end["file"] or end["file"] == start["file"]:
            return []
        return [NewestFile(f"{self.folder.rstrip('/')}/{end['file']}", max(0, end["seen"] - start["seen"] - 1))]

    def read(self, partition: NewestFile) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(partition.path)
        table = parquet.read_table(path, filesystem=files, columns=[n for n in self.schema.names if n != "dropped"])
        table = table.append_column("dropped", pa.array([partition.dropped] * len(table), pa.int64()))
        yield from table.select(self.schema.names).cast(to_arrow_schema(self.schema)).to_batches()


class LatestFrames(DataSource):
    """Options: path, a folder of Parquet files that appear whole (a URI that executors share), and frameSchema, the columns to read. Adds dropped: how
    many files were passed over since the last one read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return f"{self.options['frameschema']}, dropped long"

    def streamReader(self, schema) -> LatestReader:
        return LatestReader(self.options["path"], schema)


def latest_frames(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of the newest file of a folder, with the count of files passed over."""
    spark.dataSource.register(LatestFrames)
    return spark.readStream.format(NAME).option("path", path).option("frameSchema", schema).load()
