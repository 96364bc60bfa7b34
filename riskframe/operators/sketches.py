"""Stored sketches: quantiles and distinct counts of any part of the data without reading its rows again.

A sketch is kept per group and part (a day, say), next to its exact number of rows. Sketches of parts
merge into that of their union, inside the aggregate and map-side, so neither the number of rows nor
of parts of a hot group reaches one task as a list.

Quantile sketches (KLL) answer with a value whose rank is off by at most ``rank_error(k)`` of the rows
with 99 % confidence; distinct counts (HyperLogLog) have a relative standard error of
``distinct_error(lg)``. The exact forms are ``quantiles.exact_quantiles`` and ``profile.value_counts``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items that a quantile sketch keeps of its coarsest level, and bits of a distinct sketch's buckets.
QUANTILE_K, DISTINCT_LG = 1024, 14


def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a quantile at 99 % confidence, as published for KLL sketches."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = DISTINCT_LG) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / (1 << lg) ** 0.5


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = QUANTILE_K) -> DataFrame:
    """(by, n, sketch): values present and their sketch, one row for each group and part.

    Nulls and NaN are left out; a group without values has no row.
    """
    present = df.select(*by, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    return present.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__v", k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, parts, one column per probability) of the union of stored parts."""
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.kll_merge_agg_double("sketch").alias("__s")
    )
    if not by:  # a table without parts has no quantiles
        merged = merged.where("parts > 0")
    values = [F.kll_sketch_get_quantile_double("__s", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
    return merged.select(*by, "n", "parts", *values)


def rank_bounds(df: DataFrame, value: str, quantiles: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """(by, below, up_to): exact shares of the values below, and up to, a group's quantile."""
    present = df.select(*by, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    both = present.join(quantiles.select(*by, F.col(column).alias("__q")), list(by))
    share = lambda hit: F.count_if(hit) / F.count(F.lit(1))
    return both.groupBy(*by).agg(share(F.col("__v") < F.col("__q")).alias("below"), share(F.col("__v") <= F.col("__q")).alias("up_to"))


def within_rank(p: float, tolerance: float) -> Column:
    """Whether a value with ranks ``below`` to ``up_to`` is a p-quantile up to a tolerance."""
    return (F.col("below") <= p + tolerance) & (F.col("up_to") >= p - tolerance)


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str], lg: int = DISTINCT_LG) -> DataFrame:
    """(by, n, sketch) of the distinct values present, one row for each group and part.

    Values are sketched by their text, so numbers, dates and texts alike can be counted.
    """
    present = df.where(F.col(value).isNotNull())
    return present.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col(value).cast("string"), lg).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, parts, n_distinct): rows, parts and estimated distinct values of the union of stored parts."""
    out = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("parts"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))), F.lit(0)).alias("n_distinct"),
    )
    return out
