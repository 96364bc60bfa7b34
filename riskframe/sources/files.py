"""File sources and sinks with explicit schemas."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskframe.functions.text import literal
from riskframe.sources.csv_split import csv_records, parsed

#: How text is read: doubled quotes, "" for an empty text. Nothing at all stands for null, which the
#: parser marks by a character of its own so that it differs from an empty text.
CSV_TEXT = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\u0000"}

LOANS_SCHEMA = """application_id long, application_date date, applicant_age int, annual_income double,
credit_score double, employment_status string, home_ownership string, num_dependents int,
existing_debt double, loan_amount double, loan_term_months int, loan_status string"""

BUREAU_SCHEMA = """application_id long, bureau_score int, num_bureau_inquiries int,
open_credit_lines int, last_delinquency_date date"""


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str | StructType, sep: str = ",",
    date_format: str = "yyyy-MM-dd", columns: Sequence[str] | None = None, header: bool = True,
    corrupt: str | None = None, line_breaks: bool = True, whole_files: bool | None = None,
) -> DataFrame:
    """Typed CSV scan: blanks are null, a quoted empty text is empty, quotes protect separators,
    quotes and line ends.

    With a header, columns are found by name in any order, and a name that a file lacks is an
    error. ``columns`` prunes the result; ``corrupt`` adds a column with the raw text of rows that
    do not fit the schema.

    Files larger than a partition are read by several tasks each (``csv_split``); ``whole_files``
    decides otherwise. Without ``line_breaks`` in quotes the built-in reader splits them by itself.
    """
    wanted = read_schema(schema)
    paths = [path] if isinstance(path, str) else list(path)

    def scan(files: list[str], fields: StructType) -> DataFrame:
        names = fields.fieldNames()
        if corrupt:
            fields = StructType([*fields, StructField(corrupt, StringType())])
        parsing = {**CSV_TEXT, "sep": sep, "dateFormat": date_format, "mode": "PERMISSIVE"}
        if corrupt:
            parsing["columnNameOfCorruptRecord"] = corrupt
        whole = whole_files if whole_files is not None or not line_breaks else not oversized(spark, files)
        if line_breaks and not whole:
            records = csv_records(spark, files, names if header else None, sep)
            if records is not None:
                return parsed(records, fields, {**parsing, "multiLine": "true"})
        reader = spark.read.schema(fields).options(**parsing).option("multiLine", line_breaks)
        return reader.option("header", header).option("enforceSchema", not header).csv(files)

    if header:
        names = spark.read.options(**CSV_TEXT).option("header", True).option("sep", sep).csv(paths).columns
        missing = [f.name for f in wanted if f.name not in names]
        if missing and names:
            raise ValueError(f"no column {', '.join(missing)} in the header")
        in_file = StructType([wanted[n] if n in wanted.fieldNames() else StructField(n, StringType()) for n in names])
        df = scan(paths, in_file if names else wanted)
        df = df.select(*wanted.fieldNames(), *([corrupt] if corrupt else []))
    else:
        df = scan(paths, wanted)
    return df.select(*columns, *([corrupt] if corrupt else [])) if columns else df


def oversized(spark: SparkSession, paths: list[str]) -> bool:
    """Whether a file is larger than the session's partitions; only the files' sizes are read."""
    largest = spark.read.format("binaryFile").load(paths).agg(F.max("length")).first()[0]
    limit = spark.sql("SET spark.sql.files.maxPartitionBytes").first()["value"]
    return (largest or 0) > in_bytes(limit)


def in_bytes(size: str) -> int:
    """A size setting such as ``128m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def split_corrupt(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of the others, of a scan with a ``corrupt`` column."""
    return df.where(F.col(corrupt).isNull()).drop(corrupt), df.where(F.col(corrupt).isNotNull()).select(corrupt)


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType, **options) -> DataFrame:
    """Like ``read_csv``, but a missing path gives an empty table with the same schema."""
    try:
        return read_csv(spark, path, schema, **options)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], read_schema(schema))


def read_schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_json(df: DataFrame, column: str, schema: str, name: str = "rec") -> DataFrame:
    return df.withColumn(name, F.from_json(column, schema))


def explode_delimited(df: DataFrame, column: str, row_sep: str, field_sep: str, fields: Sequence[str]) -> DataFrame:
    """One long delimited text to one row per entry with named string fields; separators are literal."""
    keep = [c for c in df.columns if c != column]
    rows = df.select(*keep, F.posexplode(F.split(column, literal(row_sep))).alias("entry_no", "__e"))
    parts = F.split("__e", literal(field_sep))
    return rows.select(
        *keep, "entry_no", *[F.trim(F.get(parts, F.lit(i))).alias(f) for i, f in enumerate(fields)]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """CSV that ``read_csv`` reads back unchanged, line ends, quotes and outer blanks included."""
    exact = {"quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "", "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode(mode).options(**exact).option("header", header).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, "append")


def filter_to_csv(df: DataFrame, condition, path: str) -> None:
    write_csv(df.filter(condition), path)


def save_snapshot(df: DataFrame, path: str, compression: str = "zstd", partition_by: Sequence[str] = ()) -> None:
    """Compressed columnar snapshot of a cleaned table."""
    writer = df.write.mode("errorifexists").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_snapshot(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def to_json_rows(df: DataFrame, pretty: bool = False, column: bool = False) -> DataFrame | Column:
    """One JSON text per row, or the expression for it, indented if ``pretty``."""
    text = F.to_json(F.struct(*df.columns), {"pretty": "true"} if pretty else {})
    return text if column else df.select(text.alias("json"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)
