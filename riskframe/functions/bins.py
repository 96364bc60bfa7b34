"""Assigning values to bins."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _edges(edges: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(e)) for e in edges])


def digitize(x, edges: Sequence[float]) -> Column:
    """Number of edges <= x: bins closed on the left."""
    col = _c(x).cast("double")
    return F.when(col.isNotNull(), F.size(F.filter(_edges(edges), lambda e: e <= col)))


def search_sorted(x, edges: Sequence[float]) -> Column:
    """Number of edges < x: the leftmost position that keeps the edges sorted."""
    col = _c(x).cast("double")
    return F.when(col.isNotNull(), F.size(F.filter(_edges(edges), lambda e: e < col)))


def cut(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (low, high] the value falls in; outside values become null."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    col = _c(x)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = col > F.lit(float(low))
        if not math.isinf(high):
            inside = inside & (col <= F.lit(float(high)))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def equal_width(x, low, width, bins: int, high=None) -> Column:
    """0-based bin of an equal-width histogram; the last bin is closed on both sides.

    Values outside the range are null, and a zero width puts everything in bin 0. Where the range
    is that of the data, ``high`` is its maximum, which ``low + width * bins`` may just miss.
    """
    col, low, width = _c(x), _c(low), _c(width)
    high = low + width * bins if high is None else _c(high)
    raw = F.coalesce(F.floor(F.try_divide(col - low, width)), F.lit(0))
    return F.when((col >= low) & (col <= high), F.least(raw, F.lit(bins - 1)).cast("int"))
