"""Session defaults, the shared work folder, shipping of the package and memory of Python workers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Settings the library relies on. Everything else is left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even when a later step on the same key must shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "riskframe", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session with the library defaults; ``conf`` wins over them.

    Keys in ``conf`` use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Work folder of each application in this process.
_ROOTS: dict[str, str] = {}


def work_dir(spark: SparkSession, purpose: str, base: str | None = None) -> str:
    """A fresh path for intermediate tables and stream checkpoints.

    ``base`` wins; else the cluster's shared folder (``spark.checkpoint.dir``) is used. Without
    either only a session whose tasks run in the driver's own process may fall back to a temporary
    folder, because executors elsewhere could not read one. The application's folder is removed by
    its file system when the driver's JVM ends; a folder given as ``base`` stays.
    """
    if base is not None:
        return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="riskframe-")
        _ROOTS[app] = os.path.join(root, f"riskframe-{app}")
        path = spark._jvm.org.apache.hadoop.fs.Path(_ROOTS[app])
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return os.path.join(_ROOTS[app], f"{purpose}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a narrow intermediate once and read it back.

    For results that are expensive to compute and read several times; the written table also
    survives lost executors.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="riskframe-"), "riskframe.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


#: Rows of text that a task handles at a time.
ROWS = 512


def release() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # no glibc
        pass


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow`` over batches of at most ``ROWS`` rows, after which the worker gives back
    what is free. Workers live on through the stages that follow, beside the executor's own memory."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batch.slice(at, ROWS) for batch in batches for at in range(0, len(batch), ROWS))
        finally:
            release()

    return lean
