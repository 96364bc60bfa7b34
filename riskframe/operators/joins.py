"""Keyed joins with match reporting.

Sides are never broadcast by hint unless their size is bounded by construction: Spark broadcasts
what its size estimate (or the adaptive runtime size) allows and falls back to a sort-merge join,
whose skewed partitions the adaptive planner splits. A full outer join cannot be split that way,
so ``full_join`` is written as a left join plus an anti join, which can.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordered import positions

#: Measured keys up to which one-row-per-key statistics are broadcast (a few MB).
BROADCAST_KEYS = 50_000

#: Levels of which all pairs may be formed.
PAIRED_LEVELS = 2_000

BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str], indicator: str | None = None) -> DataFrame:
    """Full outer join on equal key names, optionally with the origin of each row."""
    on = list(on)
    if indicator:
        left, right = left.withColumn("__l", F.lit(1)), right.withColumn("__r", F.lit(1))
    matched = left.join(right, on, "left")
    rest = right.join(left.select(*on).distinct(), on, "left_anti")
    out = matched.unionByName(rest, allowMissingColumns=True)
    if not indicator:
        return out
    origin = (
        F.when(F.col("__l").isNull(), RIGHT_ONLY)
        .when(F.col("__r").isNull(), LEFT_ONLY)
        .otherwise(BOTH)
    )
    return out.withColumn(indicator, origin).drop("__l", "__r")


def match_counts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: distinct keys in both, only left, only right.

    Keys are reduced to presence flags first, so one shuffle of distinct keys answers all three.
    """
    tagged = (
        left.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r")))
        .na.drop(subset=list(on))
        .groupBy(*on)
        .agg(F.max("l").alias("l"), F.max("r").alias("r"))
    )
    return tagged.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count_if(F.col("r") == 0).alias("n_left_only"),
        F.count_if(F.col("l") == 0).alias("n_right_only"),
    )


def key_profile(df: DataFrame, on: Sequence[str], items: int = 200, tracked: int = 4096) -> tuple[int, list[int]]:
    """Approximate number of distinct keys, and hashes of the heavy ones, from one bounded pass.

    A key counts as heavy from half a percent of the rows. Both are hints: a wrong guess changes
    how rows are moved, never the result.
    """
    hashed = df.select(F.xxhash64(*on).alias("h"))
    row = hashed.selectExpr(
        "approx_count_distinct(h) AS d", f"approx_top_k(h, {items}, {tracked}) AS t", "count(*) AS n"
    ).first()
    return row["d"], [t["item"] for t in row["t"] or [] if t["count"] * 200 >= row["n"]]


def group_join(rows: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach per-key statistics (one row per key, derived from ``rows``) back to the rows.

    Few keys (measured): the statistics are broadcast. Many keys: only those of the heavy keys are,
    at most 200 rows, and rows of the other keys, none of which is large, join as usual. No key's
    rows are gathered either way.
    """
    if how not in ("inner", "left"):
        raise ValueError("statistics can be attached by an inner or a left join")
    by = list(by)
    keys, heavy = key_profile(rows, by)
    if keys <= BROADCAST_KEYS:
        return rows.join(F.broadcast(stats), by, how)
    if not heavy:
        return rows.join(stats, by, how)
    is_heavy = F.xxhash64(*by).isin(heavy)
    split = rows.filter(is_heavy).join(F.broadcast(stats.filter(is_heavy)), by, how)
    return split.unionByName(rows.filter(~is_heavy).join(stats.filter(~is_heavy), by, how))


def average_sources(sources: Sequence[DataFrame], key: str, value: str, min_sources: int = 1) -> DataFrame:
    """Mean over the sources that know a key, for keys known to at least ``min_sources``."""
    if len(sources) > 62:
        raise ValueError("at most 62 sources")
    stacked = None
    for i, s in enumerate(sources):
        part = s.select(key, F.col(value).cast("double").alias("v"), F.lit(1 << i).alias("src"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return (
        stacked.groupBy(key)
        .agg(F.avg("v").alias("avg_value"), F.bit_count(F.bit_or("src")).alias("n_sources"))
        .filter(F.col("n_sources") >= min_sources)
    )


def align_add(left: DataFrame, right: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Label-aligned addition: keys known to one side only give null."""
    l = left.select(key, F.col(value).alias("__a"))
    r = right.select(key, F.col(value).alias("__b"))
    return full_join(l, r, [key]).select(key, (F.col("__a") + F.col("__b")).alias(name))


def join_by_position(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]) -> DataFrame:
    """Side-by-side rows by position; the shorter side is padded with nulls."""
    l, r = positions(left, left_order), positions(right, right_order)
    return l.join(r, "pos", "full")


def pairs_of_levels(df: DataFrame, key: str, stat: Column, name: str) -> DataFrame:
    """All ordered pairs of the few levels of ``key`` with the difference of their statistic.

    The table is reduced to one row with one statistic per level; the pairs come from exploding
    that row twice, so the expansion depends on the number of levels only. More than ``PAIRED_LEVELS``
    levels fail the job before they are gathered.
    """
    stats = df.filter(F.col(key).isNotNull()).groupBy(key).agg(stat.alias("__s"))
    few = stats.limit(PAIRED_LEVELS + 1)  # one more than allowed tells
    row = few.agg(F.map_from_entries(F.collect_list(F.struct(key, "__s"))).alias("m"))
    many = F.raise_error(F.lit(f"more than {PAIRED_LEVELS} levels of {key} to pair"))
    row = row.select(F.when(F.size("m") > PAIRED_LEVELS, many).otherwise(F.col("m")).alias("m"))
    a = row.select("m", F.explode("m").alias("level_a", "stat_a"))
    b = a.select("level_a", "stat_a", F.explode("m").alias("level_b", "stat_b"))
    return b.select("level_a", "level_b", (F.col("stat_a") - F.col("stat_b")).alias(name))
