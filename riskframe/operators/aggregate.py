"""Grouped reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from riskframe.operators.ordered import positions
from riskframe.operators.profile import draw_below, draw_key, draw_threshold, spread


def _poisson_distribution() -> list[float]:
    """P(X <= k) of a Poisson(1) variable for k = 0, 1, ... up to the resolution of a draw."""
    out, term, total = [], math.exp(-1), 0.0
    while 1.0 - total > 2.0**-33:
        total += term
        out.append(total)
        term /= len(out)
    return out


POISSON_1 = _poisson_distribution()


def rate(condition: Column) -> Column:
    """Share of rows where the condition holds (null counts as missing)."""
    return F.avg(condition.cast("double"))


def weighted_mean(x: str, w: str) -> Column:
    return F.sum(F.col(x) * F.col(w)) / F.sum(w)


def group_by(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Grouped aggregate that leaves out rows with a missing key."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(*aggs)


def most_common(df: DataFrame, value: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value and its count; ties go to the value seen first in ``order``."""
    counts = _value_counts(df, value, order, by)
    rank = F.struct(F.col("cnt"), (-F.col("seen")).alias("s"))
    return counts.groupBy(*by).agg(F.max_by(value, rank).alias(value), F.max("cnt").alias("cnt"))


def least_common(df: DataFrame, value: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    counts = _value_counts(df, value, order, by)
    rank = F.struct("cnt", "seen")
    return counts.groupBy(*by).agg(F.min_by(value, rank).alias(value), F.min("cnt").alias("cnt"))


def _value_counts(df: DataFrame, value: str, order: str, by: Sequence[str]) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(order).alias("seen"))
    )


def arg_extreme(df: DataFrame, x: str, tiebreak: str, by: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """Full row holding the extreme of ``x``; ties go to the smallest ``tiebreak``, of any type.

    Nulls and NaN are no extremes.
    """
    row = F.struct(*[c for c in df.columns if c not in by])
    rows = df.filter(F.col(x).isNotNull())
    if isinstance(df.schema[x].dataType, (DoubleType, FloatType)):
        rows = rows.filter(~F.isnan(x))
    if largest:
        # per value first: then the largest value's smallest tiebreak needs no negation
        rows = rows.groupBy(*by, F.col(x).alias("__x")).agg(F.min_by(row, tiebreak).alias("__r"))
        return rows.groupBy(*by).agg(F.max_by("__r", "__x").alias("r")).select(*by, "r.*").select(*df.columns)
    pick = F.min_by(row, F.struct(F.col(x), F.col(tiebreak).alias("t")))
    return rows.groupBy(*by).agg(pick.alias("r")).select(*by, "r.*").select(*df.columns)


def collect_chunks(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], size: int, **cut) -> DataFrame:
    """Members of each group as ordered lists of at most ``size`` entries.

    A list per group would have to fit in one row; numbered chunks keep every member for groups
    of any size.
    """
    numbered = positions(df, order, by, "__pos", **cut)
    entry = F.struct("__pos", value)
    return (
        numbered.withColumn("chunk", F.floor(F.col("__pos") / size))
        .groupBy(*by, "chunk")
        .agg(F.array_sort(F.collect_list(entry)).alias("__m"))
        .select(*by, "chunk", F.col(f"__m.{value}").alias("members"))
    )


def bootstrap_ci(df: DataFrame, key: str, value: str, by: Sequence[str], replicates: int = 1000, seed: int = 11, level: float = 0.95) -> DataFrame:
    """Percentile bootstrap interval of the group mean.

    Each row draws one Poisson(1) weight per replicate from a hash of (row key, replicate), so the
    replicates are sums with map-side combining: the shuffle carries groups x replicates rows.
    """
    rows = spread(df.filter(F.col(value).isNotNull()).select(*by, key, value), key)
    rep = rows.withColumn("__rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    # inverse of the Poisson(1) distribution function: the weight is the first bound above the draw
    weight = F.lit(len(POISSON_1))
    for k in reversed(range(len(POISSON_1))):
        below = draw_below(F.col("__h"), F.lit(draw_threshold(POISSON_1[k])))
        weight = F.when(below, k).otherwise(weight)
    means = (
        rep.withColumn("__h", draw_key(seed, key, "__rep"))
        .withColumn("__w", weight)
        .groupBy(*by, "__rep")
        .agg((F.sum(F.col(value) * F.col("__w")) / F.sum("__w")).alias("__m"))
    )
    tail = (1.0 - level) / 2
    # the quantile buffer holds one number per replicate
    ends = F.percentile("__m", F.array(F.lit(tail), F.lit(1 - tail)))
    return means.groupBy(*by).agg(ends.alias("__q")).select(
        *by, F.get("__q", F.lit(0)).alias("ci_low"), F.get("__q", F.lit(1)).alias("ci_high")
    )
