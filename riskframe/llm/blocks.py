"""Vectors in packed blocks, tiles of query blocks against candidate blocks, merging by heaps.

A block is one row: the ids and numbers of vectors of one length as binary columns, a bounded number
of them. A
tile is one query block with one candidate block; tiles are dealt by their pair of block numbers,
so a task holds one tile at a time whatever the size of the table. A tile returns one row per query
with its best candidates, and a streaming heap merges the rows of a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialize, ship_package

QUERY_ROWS, CANDIDATE_ROWS = 512, 2048


def usable(vectors: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(id, v) of rows whose id is not null and whose vector is neither null nor empty nor holds a
    null or non-finite number; ``zero`` also keeps vectors of zeros only."""
    chosen = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    chosen = chosen.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
    return chosen if zero else chosen.where(F.exists("v", lambda x: x != 0))


def pack(vectors: DataFrame, rows: int, encode: Callable[[np.ndarray], dict], fields: str, extra: str = "") -> tuple[DataFrame, DataFrame]:
    """One row per block: length d, block, ids, and what ``encode`` makes of the block's matrix; and the
    number of blocks for each length.

    Only vectors of one length meet in a block. ``fields`` are the columns that ``encode`` returns.
    ``extra`` names a long column of ``vectors`` that travels along. Of rows with the same id and
    length the one with the smallest vector stays.
    """
    ship_package(vectors.sparkSession)
    sized = vectors.select("id", "v", F.size("v").alias("d"), *([extra] if extra else []))
    # one row per length, written so that its size is known when it is joined
    sizes = materialize(sized.groupBy("d").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks")), "block-sizes")
    chosen = sized.join(sizes, "d").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")

    def run(key, table):
        ids = table.column("id").to_numpy()
        column = table.column("v").combine_chunks()
        matrix = column.flatten().to_numpy().reshape(len(ids), key[0].as_py())
        order = np.argsort(ids, kind="stable")
        if len(ids) > 1 and (ids[order][1:] == ids[order][:-1]).any():
            order = np.lexsort((*matrix.T[::-1], ids))
            order = order[np.r_[True, ids[order][1:] != ids[order][:-1]]]
        out = {"d": pa.scalar(key[0].as_py(), pa.int32()), "block": pa.scalar(key[1].as_py(), pa.int32()), "ids": ids[order].tobytes()}
        out |= encode(np.ascontiguousarray(matrix[order]))
        if extra:
            out[extra] = table.column(extra).to_numpy()[order].tobytes()
        return pa.table({k: pa.array([v.as_py() if isinstance(v, pa.Scalar) else v], pa.int32() if k in ("d", "block") else None) for k, v in out.items()})

    schema = f"d int, block int, ids binary, {fields}" + (f", {extra} binary" if extra else "")
    return chosen.groupBy("d", "block").applyInArrow(run, schema), sizes


def tiles(queries: DataFrame, candidates: DataFrame, q_sizes: DataFrame, c_sizes: DataFrame, tile: Callable, score: str) -> DataFrame:
    """(query_id, ids, scores): what ``tile(query block, candidate block)`` finds in every tile.

    A query block goes to each candidate block of its length and the other way round: a stated query
    set against all rows, in blocks.
    """
    each = lambda df, sizes, name: df.join(sizes, "d").withColumn(name, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    left = each(queries, c_sizes, "c").withColumnRenamed("block", "q")
    right = each(candidates, q_sizes, "q").withColumnRenamed("block", "c")
    kind = pa.float64() if score == "double" else pa.int64()
    schema = pa.schema([("query_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("scores", pa.list_(kind))])

    def run(a, b):
        if not len(a) or not len(b):
            return schema.empty_table()
        read = lambda t: {c: t.column(c)[0].as_py() for c in t.column_names}
        query, ids, scores = tile(read(a), read(b))
        cuts = np.flatnonzero(np.r_[True, query[1:] != query[:-1], True]) if len(query) else np.zeros(1, dtype=np.int64)
        offsets = pa.array(cuts.astype(np.int32))
        return pa.table(
            [
                pa.array(query[cuts[:-1]], pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(scores, kind)),
            ],
            schema=schema,
        )

    return left.groupBy("d", "q", "c").cogroup(right.groupBy("d", "q", "c")).applyInArrow(
        run, f"query_id long, ids array<long>, scores array<{score}>"
    )


def best_of(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best pairs of each query: highest score first, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    if not len(query):
        return query, ids, scores
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    keep = place < k
    return query[keep], ids[keep], scores[keep]


def merge(found: DataFrame, k: int, score: str) -> DataFrame:
    """(query_id, rank, vec_id, score): a heap of k entries over the tiles of each query."""

    def ranked(query: int, heap: list) -> list[tuple]:
        return [(query, i + 1, -n, s) for i, (s, n) in enumerate(sorted(heap, reverse=True))]

    kind = pa.float64() if score == "double" else pa.int64()
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", kind)])

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, heap, done = None, [], []
        for batch in batches:
            for query, ids, scores in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if query != at:
                    if heap:
                        done += ranked(at, heap)
                    at, heap = query, []
                for entry in zip(scores, (-i for i in ids)):
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
            if len(done) >= 1 << 14:
                yield emit(done)
                done = []
        if heap:
            done += ranked(at, heap)
        if done:
            yield emit(done)

    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        run, f"query_id long, rank int, vec_id long, score {score}"
    )
