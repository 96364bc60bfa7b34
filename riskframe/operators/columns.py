"""Projection, renaming, dropping, and positional row access."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.ordered import positions


def assign(df: DataFrame, **exprs: Column) -> DataFrame:
    return df.withColumns(exprs)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, fn) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def take_positions(df: DataFrame, order: Sequence[str], wanted: Sequence[int], **cut) -> DataFrame:
    """Rows at the listed positions, repeated as listed; ``slot`` is the place in the list.

    The list is part of the call, so the join side built from it has a known size.
    """
    numbered = positions(df, order, **cut)
    spark = df.sparkSession
    slots = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(int(w)).cast("long") for w in wanted])).alias("slot", "pos")
    )
    return numbered.join(F.broadcast(slots), "pos")


def every_kth(df: DataFrame, order: Sequence[str], k: int, **cut) -> DataFrame:
    return positions(df, order, **cut).filter(F.pmod("pos", F.lit(k)) == 0)


def repeat_rows(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Each row ``times`` times, with the copy number."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def expand_levels(df: DataFrame, **levels: Sequence) -> DataFrame:
    """Every row with every combination of declared, literal levels (scenario grids).

    The expansion happens in the task that holds the row: no second table, no shuffle.
    """
    for name, values in levels.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def fold_rows(df: DataFrame, order: Sequence[str], value: str, width: int, **cut) -> DataFrame:
    """A column read row-wise into ``width`` columns c0..c{width-1}."""
    pos = positions(df.select(*order, value), order, **cut)
    cells = pos.select(
        F.floor(F.col("pos") / width).alias("row"), F.pmod("pos", F.lit(width)).alias("col"), value
    )
    return cells.groupBy("row").agg(
        *[F.max(F.when(F.col("col") == i, F.col(value))).alias(f"c{i}") for i in range(width)]
    )


def unfold_rows(df: DataFrame, row: str, columns: Sequence[str], value: str = "value") -> DataFrame:
    """Inverse of ``fold_rows``: position and value."""
    width = len(columns)
    cells = F.posexplode(F.array(*[F.col(c) for c in columns])).alias("__i", value)
    return df.select(row, cells).select((F.col(row) * width + F.col("__i")).alias("pos"), value)
