"""Column types of text files, from every value rather than from a first part.

Each type has a bit. A value sets the bits of the types that can hold it, and a column's state is
the conjunction of the states of its values: one integer, the same in whatever order and parts the
values come, so states of files can be stored and merged with those of files that arrive later.
The column gets the narrowest type whose bit is left, text if none is; one odd value in the last row
widens it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskframe.sources.files import CSV_TEXT, read_csv

#: Types from narrow to wide. Whole numbers are also decimal numbers, dates are also timestamps.
LATTICE = ("boolean", "bigint", "double", "date", "timestamp")
#: The state of a column without values.
ANY = (1 << len(LATTICE)) - 1


def value_state(value: Column) -> Column:
    """Bits of the types that can hold a text; null for a null, which fits all."""
    fits = {
        "boolean": value.rlike(r"^(?i:true|false)$"),
        "bigint": value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull(),
        "double": value.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
        "date": value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$")
        & value.try_cast("timestamp").isNotNull(),
    }
    state = sum((F.when(fits[t], F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(LATTICE)), F.lit(0))
    return F.when(value.isNotNull(), state)


def column_states(texts: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, position, state, filled): one row per column of texts, from one pass."""
    columns = list(columns or texts.columns)
    quoted = [f"`{c.replace('`', '``')}`" for c in columns]
    aggs = [x for i, c in enumerate(quoted) for x in (F.bit_and(value_state(F.col(c))).alias(f"s{i}"), F.count(F.col(c)).alias(f"n{i}"))]
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.coalesce(f"s{i}", F.lit(ANY)).alias("state"), F.col(f"n{i}").alias("filled"))
        for i, c in enumerate(columns)
    ]
    return texts.agg(*aggs).select(F.inline(F.array(*rows)))


def merge_states(*states: DataFrame) -> DataFrame:
    """The states of several files' columns as those of one table; columns that a file lacks stay."""
    stacked = states[0]
    for more in states[1:]:
        stacked = stacked.unionByName(more)
    return stacked.groupBy("column").agg(
        F.min("position").alias("position"), F.bit_and("state").alias("state"), F.sum("filled").alias("filled")
    )


def with_types(states: DataFrame) -> DataFrame:
    """Add the ``type`` of each column; without any value it is text."""
    kind = F.lit("string")
    for i, name in reversed(list(enumerate(LATTICE))):
        kind = F.when(F.col("state").bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)).otherwise(kind)
    return states.withColumn("type", F.when(F.col("filled") > 0, kind).otherwise(F.lit("string")))


def read_texts(spark: SparkSession, path: str | Sequence[str], sep: str = ",", **options) -> DataFrame:
    """All columns of CSV files with a header, as texts."""
    paths = [path] if isinstance(path, str) else list(path)
    names = spark.read.options(**CSV_TEXT).option("header", True).option("sep", sep).csv(paths).columns
    return read_csv(spark, paths, StructType([StructField(n, StringType()) for n in names]), sep=sep, **options)


def infer_schema(spark: SparkSession, path: str | Sequence[str], sep: str = ",", **options) -> StructType:
    """The schema that holds every value of CSV files with a header."""
    found = with_types(column_states(read_texts(spark, path, sep, **options))).orderBy("position").collect()  # one row per column
    return StructType.fromDDL(", ".join(f"`{r['column'].replace('`', '``')}` {r['type']}" for r in found))


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ",", **options) -> DataFrame:
    """CSV files with the narrowest types that hold every value."""
    return read_csv(spark, path, infer_schema(spark, path, sep, **options), sep=sep, **options)
