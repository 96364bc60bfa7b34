"""Set logic on key columns and stacking of batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat(*batches: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), batches)


def concat_tagged(batches: Mapping[str, DataFrame], tag: str) -> DataFrame:
    return concat(*[df.withColumn(tag, F.lit(name)) for name, df in batches.items()])


def _presence(sets: Sequence[DataFrame]) -> DataFrame:
    """Distinct values with one bit per set they occur in.

    Every set operation below is a filter on it: one shuffle of locally combined keys for any
    number of sets, and a value that fills a third of a set is one row per task.
    """
    if len(sets) > 62:
        raise ValueError("at most 62 sets")
    key = sets[0].columns
    bits = concat(*[s.toDF(*key).withColumn("__bit", F.lit(1 << i)) for i, s in enumerate(sets)])
    return bits.groupBy(*key).agg(F.bit_or("__bit").alias("__bits"))


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def intersect(*sets: DataFrame) -> DataFrame:
    return in_exactly(len(sets), *sets)


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return _presence([a, b]).filter(F.col("__bits") == 1).drop("__bits")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return in_exactly(1, a, b)


def in_at_least(k: int, *sets: DataFrame) -> DataFrame:
    return _presence(sets).filter(F.bit_count("__bits") >= k).drop("__bits")


def in_exactly(k: int, *sets: DataFrame) -> DataFrame:
    return _presence(sets).filter(F.bit_count("__bits") == k).drop("__bits")


def subset_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: is a contained in b, and do they share anything."""
    seen = _presence([a, b])
    return seen.agg(
        (F.count_if(F.col("__bits") == 1) == 0).alias("is_subset"),
        (F.count_if(F.col("__bits") == 3) == 0).alias("is_disjoint"),
    )
