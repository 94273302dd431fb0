"""Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def held(value: Column) -> Column:
    """The value, computed where it stands. The optimiser pushes filters through deterministic projections by
    copying their expressions, which grow with every step of a chain of projections; what depends on the partition
    number isn't copied."""
    return F.when(F.spark_partition_id() >= 0, value)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once a row: as the argument of a lambda it can't be copied into the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
