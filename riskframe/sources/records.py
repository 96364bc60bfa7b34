"""Small tables from Python records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.files import read_schema


def from_columns(spark: SparkSession, columns: Mapping[str, Sequence], schema: str) -> DataFrame:
    """Aligned columns; all must have the same length."""
    names = read_schema(schema).fieldNames()
    if len({len(columns[n]) for n in names}) > 1:
        raise ValueError("all columns must have the same length")
    return spark.createDataFrame(list(zip(*[columns[n] for n in names])), schema)


def from_records(spark: SparkSession, records: Sequence[Mapping], schema: str) -> DataFrame:
    """Records as mappings; a missing field is null."""
    names = read_schema(schema).fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def from_mapping(spark: SparkSession, mapping: Mapping, schema: str) -> DataFrame:
    """A labelled series: key and value rows."""
    return spark.createDataFrame(list(mapping.items()), schema)
