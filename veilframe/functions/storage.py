"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session. Only a local master, whose
    driver and executors are one process, may go without it; a temporary folder is made there."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; on a cluster it has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="veilframe-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Paths of the tables that are there now. Only names: the package goes to workers by value, sessions can't.
LIVE: set[str] = set()


def delete(path: str) -> None:
    context = SparkSession.active().sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
    LIVE.discard(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for files that aren't a table; ``free`` deletes it with the others."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    LIVE.add(path)
    return path


class Cut:
    """A DataFrame written to the shared folder and read back: its lineage ends there, so a lost executor costs a
    re-read and not a recomputation. ``drop`` frees the files once nothing reads them any more."""

    def __init__(self, df: DataFrame):
        spark = df.sparkSession
        self.path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.parquet(self.path)
        self.df = spark.read.schema(schema).parquet(self.path)
        LIVE.add(self.path)

    def drop(self) -> None:
        delete(self.path)


def cut(df: DataFrame) -> DataFrame:
    return Cut(df).df


def marked() -> set[str]:
    """The tables that are there now, for ``free``."""
    return set(LIVE)


def free(since: set[str] | None = None, keep: tuple[Cut, ...] = ()) -> None:
    """Frees the tables made since the mark (all without one), but for those to keep. What was derived from them must be written by then."""
    for path in LIVE - (since or set()) - {k.path for k in keep}:
        delete(path)
