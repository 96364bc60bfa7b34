"""Per-row results of a stream that depend on all earlier rows of the same key.

The count and total of each key are kept in the stream's state store, which checkpoints them by
batch: a batch reads and writes only the keys it has rows of, a retried batch starts from the state
before it, and a restarted stream goes on. Within a batch the rows of a key are taken in a stated
order; rows that arrive in a later batch follow those that were already out, whatever their order.

All rows that one batch holds of a key pass through one task, so a batch must be small enough for its
hottest key (``files_per_trigger`` of the reader); a row costs about 150 bytes and its own length there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from riskframe.session import ship_package

#: Texts that give every value back as it was.
EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "true", "allowNonNumericNumbers": "true",
}


def number_rows(
    stream: DataFrame, key: str, order: Sequence[str], value: str | None = None, seq: str = "seq", total: str = "running"
) -> DataFrame:
    """Each row of a stream with its number 1, 2, 3, ... within its key, and with ``value`` the total
    of that column up to it.

    Nulls in ``order`` come last; ties come in an order of their own. A null value or NaN adds nothing;
    a null key is a key.
    """
    ship_package(stream.sparkSession)
    ranks = [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"__n{i}"), F.col(c).alias(f"__o{i}"))]
    fields = StructType(stream.schema.fields)
    packed = stream.select(
        F.col(key).alias("__key"), *ranks,
        (F.lit(0.0) if value is None else F.coalesce(F.nanvl(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0))).alias("__value"),
        F.to_json(F.struct(*[F.col(c) for c in stream.columns]), EXACT).alias("__row"),
    )
    # a null order value sorts by its flag; any value of the type keeps the column free of nulls
    types = packed.schema
    for i in range(len(order)):
        kind = types[f"__o{i}"].dataType
        zero = F.lit("1970-01-01").cast(kind) if kind.typeName() in ("date", "timestamp", "timestamp_ntz") else F.lit(0).cast(kind)
        packed = packed.withColumn(f"__o{i}", F.coalesce(f"__o{i}", zero))
    names = [n for i in reversed(range(len(order))) for n in (f"__o{i}", f"__n{i}")]

    def emit(_: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, before = state.get if state.exists else (0, 0.0)
        parts = list(frames)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if len(rows) > 1 and names:
            rows = rows.iloc[np.lexsort([rows[n].to_numpy() for n in names])]
        running = np.cumsum(np.r_[before, rows["__value"].to_numpy()])[1:]
        state.update((count + len(rows), float(running[-1])))
        yield pd.DataFrame({"__row": rows["__row"].to_numpy(), "__seq": np.arange(count + 1, count + len(rows) + 1), "__total": running})

    numbered = packed.groupBy("__key").applyInPandasWithState(
        emit, "__row string, __seq long, __total double", "n long, total double", "append", GroupStateTimeout.NoTimeout
    )
    row = F.from_json("__row", fields, EXACT)
    out = numbered.select(row.alias("__r"), F.col("__seq").alias(seq), F.col("__total").alias(total)).select("__r.*", seq, total)
    return out if value is not None else out.drop(total)
