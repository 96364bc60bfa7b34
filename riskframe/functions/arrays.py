"""Vector, nested-list and map helpers built on higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def vector(*cols) -> Column:
    """Columns stacked into one double vector."""
    return F.array(*[_c(c).cast("double") for c in cols])


def total(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x)


def mean(a) -> Column:
    """Mean of an array; null for an empty one."""
    return F.try_divide(total(a), F.size(_c(a)))


def dot(a, b) -> Column:
    return total(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def dot_weights(a, weights: list[float]) -> Column:
    return dot(a, F.array(*[F.lit(float(w)) for w in weights]))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def distance(a, b) -> Column:
    """Euclidean distance of two vectors."""
    diff = F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(total(diff))


def value_range(a) -> Column:
    return F.array_max(_c(a)) - F.array_min(_c(a))


def arange(start, stop, step) -> Column:
    """Half-open ascending range of a positive step; ends are numbers or columns."""
    start, stop, step = (x if isinstance(x, Column) else F.lit(x) for x in (start, stop, step))
    return F.filter(F.sequence(start, F.greatest(start, stop), step), lambda x: x < stop)


def linspace(start, stop, n: int) -> Column:
    """n evenly spaced points, both ends included."""
    start, stop = _c(start) if isinstance(start, (str, Column)) else F.lit(float(start)), (
        _c(stop) if isinstance(stop, (str, Column)) else F.lit(float(stop))
    )
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + (stop - start) * i / F.lit(float(n - 1))
    )


def index_in(a, value) -> Column:
    """0-based index of the first match, -1 when absent."""
    return F.array_position(_c(a), value) - 1


def count_in(a, value) -> Column:
    return F.size(F.filter(_c(a), lambda x: x == value))


def matrix_map(m, fn) -> Column:
    """Apply a function to every cell of an array of arrays."""
    return F.transform(_c(m), lambda row: F.transform(row, fn))


def merge_maps(left, right) -> Column:
    """Union of two maps; the right one wins on common keys."""
    left, right = _c(left), _c(right)
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)


def drop_key(m, key) -> Column:
    return F.map_filter(_c(m), lambda k, _: k != key)


def invert_map(m) -> Column:
    """Swap keys and values (values must be distinct and non-null)."""
    return F.map_from_entries(
        F.transform(F.map_entries(_c(m)), lambda e: F.struct(e["value"], e["key"]))
    )


def map_get(m, key, default=None) -> Column:
    value = F.try_element_at(_c(m), F.lit(key))
    return value if default is None else F.coalesce(value, F.lit(default))
