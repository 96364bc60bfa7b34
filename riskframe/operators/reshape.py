"""Pivots, cross-tabs and long/wide changes.

Levels are found in the data, or given as a list that must name every label: a label outside it
fails the job, so that nothing is dropped without notice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
#: Labels that may become columns.
MAX_LEVELS = 10_000


def levels_of(df: DataFrame, column: str) -> list[str]:
    """The labels of a column in order."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{column} has more than {MAX_LEVELS} labels")
    return sorted(r[0] for r in found)


def declared(df: DataFrame, column: str, levels: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """``df`` whose labels are checked against ``levels``, and the levels (found if None)."""
    if levels is None:
        return df, levels_of(df, column)
    label = F.col(column)
    text = F.concat(F.lit(f"{column} has an undeclared label: "), label.cast("string"))
    checked = F.when(label.isNull() | label.isin(list(levels)), label).otherwise(F.raise_error(text))
    return df.withColumn(column, checked), list(levels)


def pivot(df: DataFrame, row: str, column: str, levels: Sequence[str] | None, *aggs: Column, fill=None) -> DataFrame:
    """Row x level table; rows with a missing row or column label are left out."""
    df, levels = declared(df, column, levels)
    out = df.na.drop(subset=[row, column]).groupBy(row).pivot(column, list(levels)).agg(*aggs)
    return out if fill is None else out.na.fill(fill)


def pivot_margins(df: DataFrame, row: str, column: str, levels: Sequence[str] | None, agg: Column) -> DataFrame:
    """Pivot with an ``All`` row and column computed from the raw rows."""
    df, levels = declared(df, column, levels)
    cube = (
        df.na.drop(subset=[row, column])
        .cube(row, column)
        .agg(agg.alias("__v"), F.grouping(row).alias("__gr"), F.grouping(column).alias("__gc"))
    )
    labelled = cube.select(
        F.when(F.col("__gr") == 1, ALL).otherwise(F.col(row)).alias(row),
        F.when(F.col("__gc") == 1, ALL).otherwise(F.col(column)).alias(column),
        "__v",
    )
    return labelled.groupBy(row).pivot(column, [*levels, ALL]).agg(F.first("__v"))


def crosstab(df: DataFrame, row: str, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    return pivot(df, row, column, levels, F.count(F.lit(1)), fill=0)


def crosstab_share(df: DataFrame, row: str, column: str, levels: Sequence[str] | None = None, scale: float = 1.0) -> DataFrame:
    """Row-normalised cross-tab (each row sums to ``scale``)."""
    df, levels = declared(df, column, levels)
    counts = crosstab(df, row, column, levels)
    total = sum((F.col(c) for c in levels[1:]), F.col(levels[0]))
    return counts.select(row, *[(F.col(c) / total * scale).alias(c) for c in levels])


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def transpose_small(df: DataFrame, key: str, columns: Sequence[str], levels: Sequence[str] | None = None, name: str = "field") -> DataFrame:
    """Swap rows and columns of a table whose row labels are few."""
    df, levels = declared(df, key, levels)
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [key], list(columns), name, "__v"
    )
    return long.groupBy(name).pivot(key, list(levels)).agg(F.first("__v"))
