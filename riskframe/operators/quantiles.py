"""Exact quantiles that do not hold a column in one aggregation buffer.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That is fine for a
score with a few hundred levels and fatal for an amount with billions. ``exact_quantiles`` picks:

* few distinct values (measured): the built-in ``percentile``, whose buffer is then bounded;
* many: rank the values per group, equal values combined before they are ordered. Hot groups (or
  the whole column, when there is no group) are cut into slices first; the sizes of the slices tell
  which ones hold the wanted ranks, and only those are looked at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ordered import (
    SLICE,
    Slices,
    null_safe_join,
    split_points,
)

#: Distinct values up to which the built-in ``percentile`` buffer is accepted.
BUFFER_VALUES = 200_000

#: Slices to cut a column into at least; all but those holding a wanted rank are skipped.
MIN_SLICES = 64

LINEAR, EXCLUSIVE = "linear", "exclusive"


def _rank(p: float, n: Column, method: str) -> tuple[Column, Column]:
    """0-based lower row and real-valued rank of probability ``p`` among ``n`` rows."""
    if method == LINEAR:
        real = F.lit(float(p)) * (n - 1)
        return F.floor(real), real
    if method == EXCLUSIVE:
        real = F.lit(float(p)) * (n + 1) - 1
        low = F.least(F.greatest(F.floor(real), F.lit(0)), F.greatest(n - 2, F.lit(0)))
        return low, real
    raise ValueError(f"unknown quantile method {method!r}")


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    method: str = LINEAR,
    buffer_values: int = BUFFER_VALUES,
    slices: int | None = None,
) -> DataFrame:
    """One row per group with ``n`` and one column per entry of ``probs``.

    Null values and rows with a null group key are left out. ``linear`` interpolates at
    ``p * (n - 1)``, ``exclusive`` at ``p * (n + 1) - 1``.
    """
    col = F.col(value) if isinstance(value, str) else value
    clean = df.select(*by, col.cast("double").alias("__v"))
    clean = clean.filter(reduce(and_, [F.col(c).isNotNull() for c in clean.columns]))
    if method == LINEAR and buffer_values:
        if clean.agg(F.approx_count_distinct("__v", 0.02)).first()[0] <= buffer_values:
            return _built_in(clean, probs, by)
    # slices are there to be skipped, so finer than the tasks need
    points = split_points(clean, [*by, "__v"], slices, MIN_SLICES)
    return _by_slices(clean, probs, Slices(clean, by, ["__v"], points), method)


def _built_in(clean: DataFrame, probs: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    points = F.array(*[F.lit(float(p)) for p in probs.values()])
    out = clean.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.percentile("__v", points).alias("__q")
    )
    return out.select(*by, "n", *[F.get("__q", F.lit(i)).alias(name) for i, name in enumerate(probs)])


def _targets(probs: Mapping[str, float], n: Column, method: str) -> Column:
    """Distinct 0-based ranks needed to interpolate every probability."""
    lows = [_rank(p, n, method)[0] for p in probs.values()]
    return F.array_distinct(
        F.array(*[c.cast("long") for low in lows for c in (low, F.least(low + 1, n - 1))])
    )


def _by_slices(clean: DataFrame, probs: Mapping[str, float], cuts: Slices, method: str) -> DataFrame:
    by = cuts.by
    sliced = cuts.assign(clean)
    if cuts.cuts:
        group = Window.partitionBy(*by)
        earlier = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        sizes = sliced.filter(cuts.sliced()).groupBy(*by, SLICE).agg(F.count(F.lit(1)).alias("__cnt"))
        ranged = sizes.select(
            *by, SLICE, F.col("__cnt").alias("__size"),
            F.coalesce(F.sum("__cnt").over(earlier), F.lit(0)).alias("__lo"),
            F.sum("__cnt").over(group).alias("__n"),
        )
        holds_target = F.exists(
            _targets(probs, F.col("__n"), method),
            lambda k: (k >= F.col("__lo")) & (k < F.col("__lo") + F.col("__size")),
        )
        ranged = ranged.select(*by, SLICE, "__lo", "__n", holds_target.alias("__needed"))
        # about one row per split point: bounded by MAX_SLICES, not by the data
        known = null_safe_join(sliced, F.broadcast(ranged), [*by, SLICE])
        # groups that are not cut have no row in that table and stay whole
        kept = known.filter(F.coalesce("__needed", F.lit(True)))
    else:
        kept = sliced.withColumns({"__lo": F.lit(None).cast("long"), "__n": F.lit(None).cast("long")})
    values = kept.groupBy(*by, SLICE, "__v").agg(
        F.count(F.lit(1)).alias("__cnt"), F.first("__lo").alias("__lo"), F.first("__n").alias("__n")
    )
    local = Window.partitionBy(*by, SLICE)
    upto = local.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumns(
        {
            "__end": F.coalesce("__lo", F.lit(0)) + F.sum("__cnt").over(upto),
            "n": F.coalesce(F.col("__n"), F.sum("__cnt").over(local)),
        }
    )
    n = F.col("n")

    def covers(k: Column) -> Column:
        return (k < F.col("__end")) & (k >= F.col("__end") - F.col("__cnt"))

    # plain comparisons drop almost all rows before the array functions see any
    lows = [_rank(p, n, method)[0].cast("long") for p in probs.values()]
    ranked = ranked.filter(reduce(or_, [covers(k) for low in lows for k in (low, F.least(low + 1, n - 1))]))
    inside = F.filter(_targets(probs, n, method), covers)
    at = F.map_from_entries(F.collect_list(F.struct("__k", "__v")))  # at most 2 * len(probs) entries
    hits = (
        ranked.withColumn("__k", F.explode(inside))
        .groupBy(*by)
        .agg(F.first("n").alias("n"), at.alias("__at"))
    )
    out = []
    for name, p in probs.items():
        low, real = _rank(p, n, method)
        low = low.cast("long")
        a = F.try_element_at("__at", low)
        b = F.try_element_at("__at", F.least(low + 1, n - 1))
        out.append((a + (b - a) * (real - low)).alias(name))
    return hits.select(*by, "n", *out)


def median(df: DataFrame, value: str | Column, by: Sequence[str] = (), name: str = "median", **kw) -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by, **kw).drop("n")
