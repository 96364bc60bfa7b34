"""Exact top-k inner products by a three-phase uniform threshold.

A score is the sum of partial scores over ``lists`` groups of components, as if each group were held
by another node. Row blocks hold a part of every list.

1. Every list gathers its ``k`` highest local scores in each row block. The k-th best total among
   what was gathered, over all blocks, is a safe cutoff: at least k rows reach it.
2. The cutoff goes out with the query blocks. A row whose partial scores are all below cutoff /
   lists cannot reach it, so each list collects just its entries at or above that share.
3. A collected row whose seen parts and bounds on unseen parts (the share, or Cauchy-Schwarz) stay
   below the cutoff is dropped; the others are resolved exactly in integers, and heaps merge.

Defined results: components are ``floor(64 * x)``; a query never finds rows of its own id; vectors
that are null, empty, hold a null or non-finite number or have a null id take no part, zero vectors do;
queries meet vectors of their own length; of rows with the same id and length the smallest vector counts;
ties go to the smaller id; an empty table gives no rows. A score beyond a long raises an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm import blocks
from riskframe.session import materialize


def encode(x: np.ndarray) -> dict:
    """Integers in the smallest type that holds them."""
    x = np.asarray(x)
    top = int(max(x.max(), -int(x.min()) - 1)) if x.size else 0
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    return {"kind": np.dtype(kind).str, "vectors": x.astype(kind).tobytes()}


def partial(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products a b', exact: in floats while every sum fits their digits."""
    top = a.shape[1] * int(np.abs(a.astype(np.int64)).max(initial=0)) * int(np.abs(b.astype(np.int64)).max(initial=0))
    if top >= 1 << 62:
        raise ArithmeticError("a score may not fit a long")
    kind = np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64
    return a.astype(kind) @ b.astype(kind).T


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, lists: int = 2, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest integer score
    for every row of ``queries``."""
    whole = lambda df: df.select(
        "id", F.transform("v", lambda x: F.floor(x.cast("double") * 64)).alias("v")
    )
    candidates = whole(blocks.usable(vectors, key, vector, zero=True))
    fields = "kind string, vectors binary"
    c, n_c = blocks.pack(candidates, blocks.CANDIDATE_ROWS, encode, fields)
    wanted = whole(blocks.usable(queries, key, vector, zero=True))
    q, n_q = blocks.pack(wanted, blocks.QUERY_ROWS, encode, fields)

    def groups_of(width: int) -> list[tuple[int, int]]:
        cuts = np.linspace(0, width, min(lists, width) + 1).astype(int).tolist()
        return list(zip(cuts[:-1], cuts[1:]))

    def load(a: dict, b: dict):
        ids = [np.frombuffer(x["ids"], dtype=np.int64) for x in (a, b)]
        x, y = (np.frombuffer(r["vectors"], dtype=r["kind"]).reshape(len(i), -1) for r, i in zip((a, b), ids))
        place = np.searchsorted(ids[1], ids[0]).clip(0, len(ids[1]) - 1)
        own = np.flatnonzero(ids[1][place] == ids[0])
        parts = [partial(x[:, s:e], y[:, s:e]) for s, e in groups_of(x.shape[1])]
        partial(x[:1], y[:1])  # the whole sum must fit as well
        return *ids, x, y, parts, (own, place[own])

    def resolve(x, y, i, j) -> np.ndarray:
        return np.concatenate(
            [
                np.einsum("nd,nd->n", x[i[s : s + (1 << 18)]].astype(np.int64), y[j[s : s + (1 << 18)]].astype(np.int64))
                for s in range(0, len(i), 1 << 18)
            ]
            or [np.zeros(0, dtype=np.int64)]
        )

    def gather(a: dict, b: dict):
        """Phase 1 in a tile: the best totals among the heads of the local lists."""
        qi, ci, x, y, parts, own = load(a, b)
        seen = np.zeros((len(qi), len(ci)), dtype=bool)
        for p in parts:
            if len(ci) > k:
                heads = np.argpartition(p, len(ci) - k - 1, axis=1)[:, len(ci) - k - 1 :]
                np.put_along_axis(seen, heads, True, axis=1)
            else:
                seen[:] = True
        seen[own] = False
        i, j = np.nonzero(seen)
        return blocks.best_of(qi[i], ci[j], resolve(x, y, i, j), k)

    def collect(a: dict, b: dict):
        """Phases 2 and 3 in a tile: sufficient entries of every list, then exact totals."""
        qi, ci, x, y, parts, own = load(a, b)
        cutoff = np.frombuffer(a["cutoff"], dtype=np.int64)[:, None]
        free = cutoff == np.iinfo(np.int64).min  # fewer than k candidates at all: everything counts
        share = cutoff / len(parts)
        any_, upper = np.zeros((len(qi), len(ci)), dtype=bool), np.zeros((len(qi), len(ci)))
        for (s, e), p in zip(groups_of(x.shape[1]), parts):
            enough = p >= np.floor(share)
            any_ |= enough
            norms = [np.sqrt((z[:, s:e].astype(np.float64) ** 2).sum(axis=1)) for z in (x, y)]
            bound = np.minimum(share, norms[0][:, None] * norms[1][None, :] * (1 + 1e-9))
            upper += np.where(enough, p, bound)
        may = free | (any_ & (upper * (1 + np.sign(upper) * 1e-9) >= cutoff - 1))
        may[own] = False
        i, j = np.nonzero(may)
        total = resolve(x, y, i, j)
        good = free[i, 0] | (total >= cutoff[i, 0])
        return blocks.best_of(qi[i][good], ci[j][good], total[good], k)

    gathered = blocks.merge(blocks.tiles(q, c, n_q, n_c, gather, "long"), k, "long")
    safe = materialize(gathered.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff")), "cutoffs")
    informed = wanted.join(safe, "id", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(-(2**63)).cast("long")))
    q, n_q = blocks.pack(informed, blocks.QUERY_ROWS, encode, fields, extra="cutoff")
    return blocks.merge(blocks.tiles(q, c, n_q, n_c, collect, "long"), k, "long")
