"""Union of the harmonised sources, and set operations on keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name; absent columns become null if allowed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def combine(*branches: DataFrame) -> DataFrame:
    """Union of unified branches, with ``source_rank``, the position of the branch, for row order."""
    ranked = [b.withColumn("source_rank", F.lit(i)) for i, b in enumerate(branches)]
    return union_all(*ranked, allow_missing=True)


def with_seq(df: DataFrame, order: Sequence[str], name: str = "ordered") -> DataFrame:
    """Add ``seq``, a unique bigint that rises in ``order`` (which must identify a row).

    The table is range-partitioned and sorted, so the partition number and position that make up
    the id follow the order. It is written before use: a retry could otherwise cut the ranges
    elsewhere.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.withColumn("seq", F.monotonically_increasing_id()), name)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_difference(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``a`` that ``b`` lacks."""
    return a.select(column).subtract(b.select(column))


def value_intersection(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).intersect(b.select(column))


def with_features(df: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Left join to a feature table; rows without features stay, with nulls."""
    return df.join(features, key, "left")
