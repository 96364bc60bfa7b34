"""Correlations of wide tables: a Gram matrix of column blocks.

With d columns an aggregate of one expression per pair has d^2 / 2 of them, too many to plan beyond
some hundreds. Here a task takes rows in Arrow batches as a matrix, multiplies blocks of columns and
adds the products up, so it emits one partial sum per pair of blocks however many rows it has. Partial
sums of a pair of blocks are added by Spark, dealt by that pair.

Columns are centred by approximate means from a first pass, so sums of squares lose nothing to large
values. Pairs are complete pairwise: rows where either value is null or NaN do not count for a pair, as
in ``stats.correlation_pairs``. A task's sums take 8 d^2 bytes, five times that where values are missing:
``MAX_COLUMNS`` bounds d.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from riskframe.session import ship_package

#: Columns of a block, and columns that a table may have.
WIDTH, MAX_COLUMNS = 256, 4096
#: Rows of an Arrow batch that are multiplied at a time, and groups that tasks' sums are added in first.
ROWS, MERGED = 4096, 64


class Gram:
    """Sums over rows for pairs of column blocks: x'y, and per pair of columns the number of rows
    with both values and the sums of x, y, x^2 and y^2 over these rows."""

    def __init__(self, columns: int, centre: np.ndarray, width: int):
        self.cuts = [slice(a, min(a + width, columns)) for a in range(0, columns, width)]
        self.centre = centre
        self.sums: dict[tuple[int, int], list[np.ndarray]] = {}

    def add(self, x: np.ndarray) -> None:
        there = ~np.isnan(x)
        x = np.where(there, x - self.centre, 0.0)
        whole = there.all()
        mask = None if whole else there.astype(np.float64)
        square = x * x
        for i, a in enumerate(self.cuts):
            for j, b in enumerate(self.cuts[i:], i):
                if whole:  # the same for all pairs: kept as row and column sums
                    n = np.full((1, 1), float(len(x)))
                    parts = [x[:, a].T @ x[:, b], n, x[:, a].sum(0)[:, None], x[:, b].sum(0)[None], square[:, a].sum(0)[:, None], square[:, b].sum(0)[None]]
                else:
                    ma, mb = mask[:, a], mask[:, b]
                    parts = [x[:, a].T @ x[:, b], ma.T @ mb, x[:, a].T @ mb, ma.T @ x[:, b], square[:, a].T @ mb, ma.T @ square[:, b]]
                known = self.sums.get((i, j))
                self.sums[i, j] = parts if known is None else [p + q for p, q in zip(known, parts)]

    def rows(self) -> Iterator[tuple[int, int, bool, bytes]]:
        """Block pairs with their sums as bytes; True where rows count for all pairs alike."""
        for (i, j), parts in self.sums.items():
            alike = parts[1].shape == (1, 1)
            yield i, j, alike, b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


def unpack(data: bytes, alike: bool, high: int, wide: int) -> np.ndarray:
    """The six sums of a block pair in their full shape."""
    shapes = [(high, wide), (1, 1), (high, 1), (1, wide), (high, 1), (1, wide)] if alike else [(high, wide)] * 6
    flat, at, out = np.frombuffer(data, np.float64), 0, np.empty((6, high, wide))
    for k, shape in enumerate(shapes):
        out[k] = flat[at : at + shape[0] * shape[1]].reshape(shape)
        at += shape[0] * shape[1]
    return out


def _matrix(batch: pa.RecordBatch, columns: int, vector: bool) -> np.ndarray:
    if not vector:
        return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64)
    cells = batch.column(0)
    out = np.full((len(batch), columns), np.nan)
    sizes = np.diff(cells.offsets.to_numpy())
    flat = cells.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    right = sizes == columns  # a vector of another length counts for no pair
    ends = np.cumsum(sizes)
    if right.any():
        out[right] = flat[(ends[right] - columns)[:, None] + np.arange(columns)]
    return out


def correlation_long(
    df: DataFrame, columns: Sequence[str] | None = None, vector: str | None = None, size: int | None = None, width: int = WIDTH
) -> DataFrame:
    """(a, b, n, r) for a < b by place: Pearson r and rows of every pair of columns.

    Either ``columns`` names numeric columns, and a and b are names, or ``vector`` an array column
    with ``size`` elements, and a and b are places from 0. r is null where fewer than two rows count
    or a column is constant.
    """
    spark = df.sparkSession
    ship_package(spark)
    if vector is None:
        chosen, size = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]), len(columns)
        means = chosen.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in chosen.columns]).first()
        centre = np.array([m or 0.0 for m in means])
    else:
        if not isinstance(df.schema[vector].dataType, ArrayType) or not size:
            raise ValueError("a vector column needs its number of elements")
        chosen = df.select(F.col(vector).cast("array<double>").alias("v")).where(F.size("v") == size)
        # any value near the data serves as a centre
        first = chosen.first()
        centre = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in first["v"]]) if first else np.zeros(size)
    if size > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} columns")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = Gram(size, centre, width)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                gram.add(_matrix(batch.slice(at, ROWS), size, vector is not None))
        for i, j, alike, data in gram.rows():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([alike]), pa.array([data], pa.binary())], names)

    def added(table: pa.Table, i: int, j: int) -> np.ndarray:
        high, wide = (min(width, size - k * width) for k in (i, j))
        total = np.zeros((6, high, wide))
        for alike, data in zip(table.column("alike").to_pylist(), table.column("sums")):
            total += unpack(data.as_py(), alike, high, wide)
        return total

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        columns = [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([False]), pa.array([added(table, i, j).tobytes()], pa.binary())]
        return pa.table(columns, names=names)

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        xy, n, x, y, xx, yy = added(table, i, j)
        with np.errstate(divide="ignore", invalid="ignore"):
            vx, vy = xx - x * x / n, yy - y * y / n
            r = (xy - x * y / n) / np.sqrt(vx * vy)
        # rounding alone makes no variance
        flat = (vx <= 1e-12 * xx) | (vy <= 1e-12 * yy) | (n < 2)
        r = np.clip(np.where(flat, np.nan, r), -1, 1)
        a, b = np.nonzero(np.ones_like(n, bool) if i < j else np.triu(np.ones_like(n, bool), 1))
        values = r[a, b]
        return pa.table({"a": a + i * width, "b": b + j * width, "n": n[a, b].astype(np.int64), "r": pa.array(values, mask=np.isnan(values))})

    names, schema = ["i", "j", "alike", "sums"], "i int, j int, alike boolean, sums binary"
    sums = chosen.mapInArrow(partial, schema).withColumn("part", F.spark_partition_id() % MERGED)
    sums = sums.groupBy("i", "j", "part").applyInArrow(merge, schema)
    pairs = sums.groupBy("i", "j").applyInArrow(finish, "a long, b long, n long, r double")
    if vector is not None:
        return pairs
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in columns]), (F.col(c) + 1).cast("int"))
    return pairs.select(name("a").alias("a"), name("b").alias("b"), "n", "r")
