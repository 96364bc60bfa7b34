"""Missing values: masks, counts, dropping and filling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.joins import group_join
from riskframe.operators.ordered import forward_fill
from riskframe.operators.profile import per_column
from riskframe.operators.quantiles import median


def null_mask(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[F.col(c).isNull().alias(c) for c in columns])


def null_counts(df: DataFrame) -> DataFrame:
    return per_column(df, lambda c: F.count_if(c.isNull()), value="nulls")


def null_total(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).select(
        reduce(lambda a, b: a + b, [F.col(c) for c in df.columns]).alias("total_nulls")
    )


def null_pct(df: DataFrame, digits: int = 2) -> DataFrame:
    return per_column(
        df, lambda c: F.bround(F.avg(c.isNull().cast("int")) * 100, digits), value="pct_null"
    )


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. The schema depends on the data: one aggregate runs."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if row[c] == 0])


def drop_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None, thresh: int | None = None) -> DataFrame:
    return df.na.drop(how=how, thresh=thresh, subset=list(subset) if subset else None)


def fill_median(df: DataFrame, *columns: str, **quantile_options) -> DataFrame:
    """Impute with the column's median, fed in as a scalar subquery."""
    filled = {
        c: F.coalesce(F.col(c), median(df, c, **quantile_options).scalar()) for c in columns
    }
    return df.withColumns(filled)


def fill_group_median(df: DataFrame, column: str, by: str, **quantile_options) -> DataFrame:
    """Impute with the median of the row's own group; rows without a group stay as they are."""
    medians = median(df, column, [by], "__median", **quantile_options)
    return (
        group_join(df, medians, [by], "left")
        .withColumn(column, F.coalesce(column, "__median"))
        .drop("__median")
    )


def fill_forward(df: DataFrame, column: str, order: Sequence[str], by: Sequence[str] = (), **options) -> DataFrame:
    return forward_fill(df, column, order, by, **options)
