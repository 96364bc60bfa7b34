"""Named queries over the standard tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Attribute access to the parquet tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function ``Tables -> DataFrame`` under its own name."""

    def register(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"duplicate query {fn.__name__}")
        QUERIES[fn.__name__] = Query(fn, sql)
        return fn

    return register


def r(x: str | Column, digits: int = 6) -> Column:
    """Round computed doubles so that summation order does not show."""
    return F.round(F.col(x) if isinstance(x, str) else x, digits)


def iso(x: str | Column) -> Column:
    """Date as ISO text."""
    return F.date_format(F.col(x) if isinstance(x, str) else x, "yyyy-MM-dd")


def N() -> Column:
    """Row count."""
    return F.count(F.lit(1))
