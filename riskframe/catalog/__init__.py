"""Query catalog: importing the section modules fills the registry."""

from riskframe.catalog import (  # noqa: F401
    aggregates,
    filters,
    joins,
    ordering,
    profiling,
    projection,
    quality,
    recoding,
    reshaping,
    scalars,
    scans,
    statistics,
    streams,
)
from riskframe.catalog.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
