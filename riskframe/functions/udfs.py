"""The Python extension surface: Arrow-batched functions for rules that have no built-in form.

Every rule in the library is a built-in expression. These four show where user code plugs in,
and each keeps its memory bounded: scalar and table functions see one Arrow batch, the group function
receives groups that were already reduced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def scalar(fn: Callable[[pd.Series], pd.Series], returns=DoubleType()):
    """Vectorised element function."""

    def run(s: pd.Series) -> pd.Series:
        return fn(s)

    return F.pandas_udf(run, returns)


@F.pandas_udf(StringType())
def age_band(age: pd.Series) -> pd.Series:
    """Young below 35, Mid-Career below 55, else Senior."""
    out = np.select([age < 35, age < 55], ["Young", "Mid-Career"], default="Senior")
    return pd.Series(out, index=age.index).where(age.notna(), None)


@F.pandas_udf(DoubleType())
def row_volatility(rows: pd.Series) -> pd.Series:
    """Max minus min of every row vector."""
    sizes = rows.map(len, na_action="ignore").fillna(0).astype(np.int64).to_numpy()
    out = np.full(len(rows), None, dtype=object)
    if sizes.any():
        flat = np.concatenate([r for r, n in zip(rows, sizes) if n])
        starts = np.cumsum(sizes[sizes > 0]) - sizes[sizes > 0]
        out[sizes > 0] = np.maximum.reduceat(flat, starts).astype(float) - np.minimum.reduceat(flat, starts)
    return pd.Series(out, index=rows.index)


def batch_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Count, mean, squared deviations from it, min and max per ``grp`` of each Arrow batch of (grp, x).

    A custom group summary as a map-side partial: the shuffle afterwards carries one row per
    group and batch, so a group holding most of the table is never gathered anywhere.
    """
    for pdf in batches:
        out = pdf.groupby("grp", as_index=False)["x"].agg(n="count", mean="mean", m2="var", lo="min", hi="max")
        yield out.assign(m2=out["m2"].fillna(0) * (out["n"] - 1))[out["n"] > 0]


MOMENTS_SCHEMA = "grp string, n long, mean double, m2 double, lo double, hi double"


def merge_moments(partial: DataFrame) -> DataFrame:
    """(grp, n, mean, sd, lo, hi) from the batches' moments.

    Deviations are taken from each group's mean, so large values with a small spread lose nothing;
    a group of one row has no deviation.
    """
    whole = partial.groupBy("grp").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    apart = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)
    merged = partial.join(whole, "grp").groupBy("grp", "centre").agg(
        F.sum("n").alias("n"), F.sum(apart).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))))
    return merged.select("grp", "n", F.col("centre").alias("mean"), sd.alias("sd"), "lo", "hi")


def entry_parser(fields: Mapping[str, str], keep: Mapping[str, str], raw: str = "raw", row_sep: str = ";", field_sep: str = ","):
    """A table function over (keep..., raw) that parses texts of delimited entries, a batch at a time.

    ``fields`` gives the entries' fields in order, each ``string`` or ``int``; ``keep`` the columns that
    every entry repeats from its row, with their types. Both decide the columns of the result: keep,
    fields and ``error``. An entry with a wrong number of fields or a field that is no number has an error
    and no fields; a null text is an empty one, whose single entry is empty.
    """
    numbers = [t == "int" for t in fields.values()]
    returns = ", ".join(f"`{n}` {t}" for n, t in [*keep.items(), *fields.items(), ("error", "string")])

    @F.arrow_udtf(returnType=returns)
    class ParseEntries:
        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            # literal separators: split_pattern takes no regular expression
            entries = pc.split_pattern(pc.fill_null(batch.column(raw), ""), row_sep)
            rows = pc.list_parent_indices(entries)
            cells = pc.split_pattern(pc.list_flatten(entries), field_sep)
            counts = pc.list_value_length(cells)
            fits = pc.equal(counts, len(numbers))
            error = pc.if_else(fits, pa.scalar(None, pa.string()), pc.binary_join_element_wise(pc.cast(counts, pa.string()), f" fields instead of {len(numbers)}", ""))
            flat = pc.list_flatten(cells.filter(fits))
            where = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
            columns = [flat.take(pa.array(np.arange(i, len(flat), len(numbers)))) for i in range(len(numbers))]
            wrong = np.full(len(where), len(numbers))
            for i in reversed(range(len(numbers))):
                if numbers[i]:
                    text = pc.utf8_trim_whitespace(columns[i])
                    digits = pc.match_substring_regex(text, r"^[+-]?[0-9]{1,18}$")
                    value = pc.cast(pc.replace_substring_regex(pc.if_else(digits, text, "0"), r"^\+", ""), pa.int64())
                    small = pc.and_(digits, pc.and_(pc.greater_equal(value, -(1 << 31)), pc.less(value, 1 << 31)))
                    columns[i] = pc.cast(pc.if_else(small, value, 0), pa.int32())
                    wrong = np.where(small.to_numpy(zero_copy_only=False), wrong, i)
            good = wrong == len(numbers)
            # place of each entry among the good ones, null for the others
            place = np.zeros(len(cells), np.int64)
            place[where] = np.cumsum(good) - 1
            fine = np.zeros(len(cells), bool)
            fine[where] = good
            at = pa.array(place, mask=~fine)
            named = {n: batch.column(n).take(rows) for n in keep}
            for name, values in zip(fields, columns):
                named[name] = values.filter(pa.array(good)).take(at)
            texts = np.full(len(cells), None, dtype=object)
            texts[where[~good]] = [f"field {i + 1} is not a number" for i in wrong[~good]]
            named["error"] = pc.coalesce(pa.array(texts.tolist(), pa.string()), error)
            yield pa.table(named)

    return ParseEntries
