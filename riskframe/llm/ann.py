"""Nearest neighbours by a block matrix join over int8 product tiles with error bounds.

Every vector is also kept as int8 numbers times a scale, x = s q + e. Then

    <x, y> = <s q, s' q'> + <e, y> + <s q, e'>,

so the int8 product is off by at most |e| |y| + |s q| |e'|. In a tile the k-th largest lower bound
of a query is a floor: pairs whose upper bound lies below cannot be among its k best. The others
are recomputed from the original vectors in double precision, component by component in order, and
heaps merge the tiles. The result is exact; the index is only the quantised blocks.

Defined results: a query never finds rows of its own id; vectors that are null, empty, zero, hold a
null or non-finite number or have a null id take no part; queries meet vectors of their own length; of
rows with the same id and length the smallest vector counts; ties go to the smaller id; fewer candidates
than k give fewer rows; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from riskframe.llm import blocks


def quantise(x: np.ndarray) -> dict:
    """int8 numbers, scales, and the norms that the bound needs."""
    x = np.asarray(x)
    wide = x.astype(np.float64)
    scale = np.abs(wide).max(axis=1) / 127
    scale[scale == 0] = np.finfo(np.float64).tiny
    q = np.rint(wide / scale[:, None]).clip(-127, 127)
    back = q * scale[:, None]
    norms = np.stack([scale, np.linalg.norm(wide - back, axis=1), np.linalg.norm(wide, axis=1), np.linalg.norm(back, axis=1)])
    return {"kind": x.dtype.str, "vectors": x.tobytes(), "int8": q.astype(np.int8).tobytes(), "norms": norms.tobytes()}


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """int8 products, exact: partial sums of up to 1024 terms fit a float's 24 bits."""
    out = np.zeros((len(a), len(b)), dtype=np.float64 if a.shape[1] > 1024 else np.float32)
    for i in range(0, a.shape[1], 1024):
        out += a[:, i : i + 1024].astype(np.float32) @ b[:, i : i + 1024].astype(np.float32).T
    return out


def in_order(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of x[i] and y[j], summed in the order of the components."""
    total = np.zeros(len(i), dtype=x.dtype)
    for d in range(x.shape[1]):
        total += x[i, d] * y[j, d]
    return total


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the largest inner product
    for every row of ``queries``."""
    candidates = blocks.usable(vectors, key, vector, zero=False)
    fields = "kind string, vectors binary, int8 binary, norms binary"
    c, n_c = blocks.pack(candidates, blocks.CANDIDATE_ROWS, quantise, fields)
    q, n_q = blocks.pack(blocks.usable(queries, key, vector, zero=False), blocks.QUERY_ROWS, quantise, fields)

    def load(row: dict):
        ids = np.frombuffer(row["ids"], dtype=np.int64)
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind).reshape(len(ids), -1)
        return ids, read("vectors", row["kind"]).astype(np.float64), read("int8", np.int8), np.frombuffer(row["norms"]).reshape(4, -1)

    def tile(a: dict, b: dict):
        (qi, qv, q8, (qs, qe, _, qb)), (ci, cv, c8, (cs, ce, cn, _)) = load(a), load(b)
        near = products(q8, c8) * qs[:, None] * cs[None, :]
        # rounding of the bound itself is far below the slack
        off = (qe[:, None] * cn[None, :] + qb[:, None] * ce[None, :]) * (1 + 1e-9) + 1e-12 * qb[:, None] * cn[None, :]
        place = np.searchsorted(ci, qi).clip(0, len(ci) - 1)
        own = np.flatnonzero(ci[place] == qi)
        near[own, place[own]] = -np.inf
        floor = near - off
        if len(ci) > k:
            floor = np.partition(floor, len(ci) - k, axis=1)[:, len(ci) - k]
        else:
            floor = np.full(len(qi), -np.inf)
        i, j = np.nonzero((near + off >= floor[:, None]) & (near > -np.inf))
        scores = np.concatenate([in_order(qv, cv, i[s : s + (1 << 20)], j[s : s + (1 << 20)]) for s in range(0, len(i), 1 << 20)] or [np.zeros(0)])
        return blocks.best_of(qi[i], ci[j], scores, k)

    return blocks.merge(blocks.tiles(q, c, n_q, n_c, tile, "double"), k, "double")
