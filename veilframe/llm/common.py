"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import Cut, cut, free, marked, shared_dir

__all__ = ["Cut", "cut", "free", "marked", "shared_dir"]
#: ASCII white space that separates words, as a regex class body and as a trim set.
WS_CLASS = r"\x20\x09-\x0D"
WS_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def held(value: Column) -> Column:
    """The value, computed where it stands. The optimiser pushes filters (also those that it derives from
    explode) through deterministic projections by copying their expressions; inside a lambda a copied
    expression would be evaluated once an element. What depends on the partition number isn't copied."""
    return F.when(F.spark_partition_id() >= 0, value)


def split_words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    body = F.btrim(text, F.lit(WS_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, f"[{WS_CLASS}]+"))


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits, the words of shingle comparisons."""
    body = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, " "))


def with_window_hashes(df: DataFrame, words: str, n: int, out: str) -> DataFrame:
    """Adds one 64-bit hash for each run of n neighbouring words, in order. Hashes of runs are put together from
    those of two shorter ones, by doubling, so each step looks at two values a window. Every step is a
    column of its own: nested, they would be evaluated once for each use."""
    names: list[str] = []

    def put(value: Column) -> str:
        nonlocal df
        names.append(f"__h{len(names)}")
        df = df.withColumn(names[-1], value)
        return names[-1]

    def joined(left: str, right: str, gap: int) -> Column:
        """The run at i of left, then the run at i + gap of right."""
        return F.zip_with(left, F.slice(right, F.lit(gap + 1), F.size(words)), lambda a, b: F.xxhash64(a, b))

    doubles, width, done, covered = put(F.transform(words, lambda w: F.xxhash64(w))), 1, None, 0
    while True:
        if n & width:
            done, covered = (doubles, width) if done is None else (put(joined(done, doubles, covered)), covered + width)
        if width * 2 > n:
            break
        doubles, width = put(joined(doubles, doubles, width)), width * 2
    # runs that reach over the end are hashed with nulls; they are cut off
    runs = F.when(F.size(words) >= n, F.slice(done, F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<bigint>"))
    return df.withColumn(out, held(runs)).drop(*names)


def window_texts(words: Column, n: int) -> Column:
    """As window_hashes, but the words themselves, one space between."""
    last = F.size(words) - F.lit(n)
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    ).otherwise(F.array().cast("array<string>"))
