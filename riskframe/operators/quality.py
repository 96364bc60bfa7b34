"""Duplicates, safe casts, row validation with quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskframe.functions.numbers import close_to
from riskframe.functions.text import literal
from riskframe.operators.joins import full_join, group_join
from riskframe.operators.ordered import positions
from riskframe.session import materialize


SIX_DIGITS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over all columns, nulls included: a short stand-in for wide or long values.

    Times keep their microseconds; every double has one spelling, so none are merged.
    """
    if len(columns) == 1 and isinstance(df.schema[columns[0]].dataType, StringType):
        return F.coalesce(F.sha2(F.col(columns[0]), 256), F.lit("missing"))
    exact = {"ignoreNullFields": "false", "timestampFormat": SIX_DIGITS, "timestampNTZFormat": SIX_DIGITS}
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), exact), 256)


def duplicate_flags(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Key with ``is_dup`` (second and later copies by key) and ``has_copies`` (any copy).

    The fingerprints are written once, next to the key, and everything after works on that narrow
    table: long texts are read a single time and never shuffled. Groups are reduced by fingerprint,
    and only repeated fingerprints travel back. A combination that fills a third of the table is one row on the
    reduced side, which is broadcast to the rows it belongs to.
    """
    marked = materialize(df.select(key, fingerprint(df, columns).alias("__fp")), "fingerprints")
    repeated = (
        marked.groupBy("__fp")
        .agg(F.count(F.lit(1)).alias("__copies"), F.min(key).alias("__first"))
        .filter("__copies > 1")
    )
    return group_join(marked, repeated, ["__fp"], "left").select(
        key,
        F.coalesce(F.col(key) != F.col("__first"), F.lit(False)).alias("is_dup"),
        F.col("__copies").isNotNull().alias("has_copies"),
    )


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset) if subset else None)


def duplicate_key_count(df: DataFrame, *key: str) -> DataFrame:
    """Rows that repeat an earlier key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).agg(
        F.sum(F.col("c") - 1).alias("duplicate_keys")
    )


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per business key; an aggregate, so copies of a hot key combine map-side."""
    rest = [c for c in df.columns if c not in key]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")
    return df.groupBy(*key).agg(latest).select(*key, "__r.*").select(*df.columns)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def strip_number(x: str | Column, *junk: str) -> Column:
    """``"5.72%"`` to 5.72; anything that is still no number becomes null."""
    col = F.col(x) if isinstance(x, str) else x
    for j in junk:
        col = F.replace(col, F.lit(j), F.lit(""))
    return F.trim(col).try_cast("double")


def try_int(x: str | Column) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return F.trim(col).try_cast("long")


def text_bool(x: str | Column) -> Column:
    """Exactly ``True`` is true."""
    col = F.col(x) if isinstance(x, str) else x
    return col == "True"


def category_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Label and its 0-based ordinal in label order; join it to encode, or keep it as a dictionary."""
    labels = df.select(column).distinct().filter(F.col(column).isNotNull())
    return positions(labels, [column], name=name)


def in_range(x: str | Column, low: float, high: float) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return col.between(low, high)


def parse_fields(df: DataFrame, raw: str, fields: dict[str, str], sep: str = ",") -> DataFrame:
    """Split a delimited line into typed columns plus ``error`` (null for good rows).

    ``sep`` is taken as it is. ``fields`` maps column names to types; a wrong field count or an unparsable value is
    reported with a reason instead of failing the job.
    """
    parts = F.split(F.col(raw), literal(sep), -1)
    n = len(fields)
    typed = {}
    bad = F.lit(False)
    for i, (name, kind) in enumerate(fields.items()):
        text = F.get(parts, F.lit(i))
        typed[name] = text if kind == "string" else F.trim(text).try_cast(kind)
        if kind != "string":
            bad = bad | typed[name].isNull()
    error = F.when(
        F.size(parts) != n,
        F.concat(F.size(parts).cast("string"), F.lit(f" fields instead of {n}")),
    ).when(bad, F.lit("not a number"))
    return df.withColumns({**typed, "error": error})


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows."""
    good = parsed.filter(F.col("error").isNull()).drop("error")
    return good, parsed.filter(F.col("error").isNotNull())


def all_close(a: DataFrame, b: DataFrame, key: Sequence[str], column: str, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """One row: whether two keyed columns agree within tolerance, and by how much they differ."""
    right = b.select(*key, F.col(column).alias("__other"))
    both = full_join(a.select(*key, column), right, list(key))
    ok = F.coalesce(close_to(column, "__other", rtol, atol), F.lit(False))
    return both.agg(F.bool_and(ok).alias("all_close"), F.count(F.lit(1)).alias("n_rows"))
