"""Inspection: shape, schema, describe, value counts, samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskframe.operators.joins import group_join
from riskframe.operators.ordered import positions
from riskframe.operators.quantiles import BUFFER_VALUES, exact_quantiles

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, cells."""
    cols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(cols).alias("n_cols"), (F.col("n_rows") * cols).alias("n_cells")
    )


def schema_table(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def one_row_to_long(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Turn a one-row wide result into (column, value) rows."""
    return row.unpivot([], list(columns), name, value)


def per_column(df: DataFrame, fn, name: str = "column", value: str = "value", columns=None) -> DataFrame:
    """One aggregate per column in a single pass, in long form."""
    columns = list(columns or df.columns)
    return one_row_to_long(df.agg(*[fn(F.col(c)).alias(c) for c in columns]), columns, name, value)


def non_null_counts(df: DataFrame) -> DataFrame:
    return per_column(df, F.count, value="non_null")


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), buffer_values: int = BUFFER_VALUES, **cut
) -> DataFrame:
    """count, mean, std, min, quartiles, max per column (and group), one row per column.

    One wide aggregate serves all moments and the quartiles of columns with few distinct values;
    only the other columns take the sliced quantile path, all together.
    """
    columns, by = list(columns or numeric_columns(df)), list(by)
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = rows.na.drop(subset=by) if by else rows
    distinct = rows.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    few = [c for c in columns if distinct[c] <= buffer_values]
    points = F.array(*[F.lit(p) for p in QUARTILES.values()])

    def cell(c: str) -> Column:
        quartiles = F.percentile(c, points) if c in few else F.lit(None).cast("array<double>")
        return F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max"), quartiles.alias("__q"),
        )

    wide = rows.groupBy(*by).agg(*[cell(c).alias(c) for c in columns])
    long = wide.select(*by, F.inline(F.array(*columns)))
    keys = [*by, "column"]
    out = long.select(
        *keys, "count", "mean", "std", "min",
        *[F.get("__q", F.lit(i)).alias(name) for i, name in enumerate(QUARTILES)], "max",
    )
    many = [c for c in columns if c not in few]
    if not many:
        return out
    # the others stand in one long table of (column, value): one sample, one pass, one ranking for all
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("__value")) for c in many])
    found = exact_quantiles(rows.select(*by, F.inline(cells)), "__value", QUARTILES, keys, buffer_values=0, **cut)
    sliced = found.select(*keys, *[F.col(q).alias(f"__{q}") for q in QUARTILES])
    merged = {q: F.coalesce(q, f"__{q}") for q in QUARTILES}
    return out.join(sliced, keys, "left").withColumns(merged).drop(*[f"__{q}" for q in QUARTILES])


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value and its frequency; ties go to the smallest value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("freq")
    )
    top = F.min_by("value", F.struct((-F.col("freq")).alias("f"), F.col("value").alias("v")))
    return counts.groupBy("column").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
        top.alias("top"), F.max("freq").alias("freq"),
    )


def describe_all(df: DataFrame, **options) -> DataFrame:
    """Numbers and all other columns in one report; what does not apply to a column is null."""
    numbers = numeric_columns(df)
    others = [c for c in df.columns if c not in numbers]
    if not (numbers and others):
        return describe(df, numbers, **options) if numbers else describe_text(df, others)
    return describe(df, numbers, **options).unionByName(describe_text(df, others), allowMissingColumns=True)


def head(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last n rows, in ascending order again; needs one top-n, not a full sort."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(n).orderBy(*order)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Even out rows over all tasks before each is expanded a hundredfold.

    The expansion, not the few narrow columns moved here, is the cost of such jobs, and a file
    layout of a few large splits would leave it to a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def draw_key(seed: int, *keys) -> Column:
    """Hash text of key and seed: a draw that stays the same under any partitioning."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed))))


def draw_threshold(p) -> Column | str:
    """Hex text t such that a 32-bit hex draw h satisfies ``h < t`` with probability ``p``.

    Comparing text keeps the draw out of number conversion: this is the hot loop of resampling
    and simulation. ``p`` is a number or a Column in [0, 1].
    """
    if isinstance(p, Column):
        text = F.lower(F.lpad(F.hex(F.ceil(p * F.lit(4294967296.0))), 8, "0"))
        return F.when(p >= 1, F.lit("g")).otherwise(text)
    return "g" if p >= 1 else format(math.ceil(p * 4294967296.0), "08x")


def draw_below(digest: Column, threshold, part: int = 0) -> Column:
    """Whether the ``part``-th 32-bit slice of a digest lies below a ``draw_threshold``."""
    return F.substring(digest, 1 + 8 * part, 8) < threshold


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n random rows, the same for every run and cluster size."""
    return df.orderBy(draw_key(seed, key), key).limit(n)


def sample_fraction(df: DataFrame, fraction: float, seed: int, key: str | None = None) -> DataFrame:
    """Fraction sample; with ``key`` it is stable under re-partitioning."""
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(draw_below(draw_key(seed, key), F.lit(draw_threshold(fraction))))


def sample_strata(df: DataFrame, key: str, by: str, sizes: int | Mapping, seed: int) -> DataFrame:
    """An exact number of random rows of each stratum, all of a smaller one; the same for every run.

    The rows with the least draws of a stratum are kept. Each task keeps no more than the largest
    wanted number for each of its strata before anything is shuffled, in one pass over the rows. ``sizes``
    is one number, or numbers by stratum; strata it does not name give no rows.
    """
    order = Window.partitionBy(by).orderBy(draw_key(seed, key), key)
    most = sizes if isinstance(sizes, int) else max(sizes.values(), default=0)
    if not isinstance(sizes, int):
        df = df.filter(F.col(by).isin(list(sizes)))
    kept = df.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= most)
    if not isinstance(sizes, int):
        wanted = reduce(lambda out, s: F.when(F.col(by) == F.lit(s[0]), F.lit(s[1])).otherwise(out), sizes.items(), F.lit(0))
        kept = kept.filter(F.col("__rank") <= wanted)
    return kept.drop("__rank")


def sample_strata_fraction(df: DataFrame, key: str, by: str, fraction: float, seed: int) -> DataFrame:
    """The same fraction of every stratum, its number of rows rounded half up, by least draws.

    Rows are numbered by the batch operator, which cuts strata of any size into slices.
    """
    drawn = df.withColumn("__draw", draw_key(seed, key))
    numbered = positions(drawn, ["__draw", key], [by], "__pos").withColumn("__stratum", F.struct(by))  # null is a stratum
    counts = df.groupBy(F.struct(by).alias("__stratum")).agg(F.floor(F.count(F.lit(1)) * fraction + 0.5).alias("__wanted"))
    return group_join(numbered, counts, ["__stratum"]).filter(F.col("__pos") < F.col("__wanted")).select(df.columns)


def value_counts(df: DataFrame, column: str, name: str = "cnt", dropna: bool = True) -> DataFrame:
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def value_shares(df: DataFrame, column: str, name: str = "pct") -> DataFrame:
    """Percentages; the share is rounded to four places before it is scaled."""
    counts = value_counts(df, column, "__n")
    total = df.agg(F.count(column)).scalar()
    return counts.select(column, (F.bround(F.col("__n") / total, 4) * 100).alias(name))


def key_is_unique(df: DataFrame, *key: str) -> DataFrame:
    """One row: rows, distinct keys, and whether they agree."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__c"))
    return per_key.agg(
        F.sum("__c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
        (F.max("__c") == 1).alias("is_unique"),
    )
