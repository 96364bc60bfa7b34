"""Snapshots of several tables, published together, and writes that count what they write.

A store is a folder with data folders and manifests. A manifest lists, for one version, each key with
its data folder and number of rows. Writers put data into folders of their own and publish by renaming
a finished manifest to the next version's name, which file systems with an atomic rename (HDFS, POSIX)
grant to one writer only; another takes the version after it. Readers read what one manifest lists,
so they see all tables of a version or none, and a writer that fails leaves the versions before it as
they were. Files are touched by Spark's writers and the session's Hadoop file system alone.

Row counts come from observed metrics: they are gathered inside the write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class _Files:
    """The few file operations that Spark's readers and writers do not have."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def system(self, path: str):
        return self.path(path).getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        if not self.system(folder).exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.system(folder).listStatus(self.path(folder)))

    def write(self, path: str, text: str) -> None:
        out = self.system(path).create(self.path(path), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self.system(path).open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> bool:
        """Whether the rename was granted: not if the target exists."""
        target_path = self.system(target).makeQualified(self.path(target))
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target_path.toUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.system(source).makeQualified(self.path(source)), target_path, none)
        except Exception as e:
            if context.util().exists(target_path):
                return False
            raise e
        return True

    def remove(self, path: str) -> None:
        self.system(path).delete(self.path(path), True)


class SnapshotStore:
    """Versions of named tables under a folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.files = spark, base.rstrip("/"), _Files(spark)

    def _manifest(self, version: int) -> str:
        return f"{self.base}/manifests/v{version:010d}.json"

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.base}/manifests")
        return [int(n[1:11]) for n in names if n.startswith("v") and n.endswith(".json")]

    def listing(self, version: int | None = None) -> dict[str, dict]:
        """What a version holds; the last one if none is named."""
        versions = self.versions()
        if version is None and not versions:
            return {}
        if version is not None and version not in versions:
            raise ValueError(f"no version {version}")
        return json.loads(self.files.read(self._manifest(version or versions[-1])))["tables"]

    def keys(self, version: int | None = None) -> DataFrame:
        """(key, version, n_rows), where ``version`` is the one that wrote the table."""
        rows = [(k, t["version"], t["n_rows"]) for k, t in sorted(self.listing(version).items())]
        return self.spark.createDataFrame(rows, "key string, version long, n_rows long")

    def read(self, key: str, version: int | None = None, columns: list[str] | None = None) -> DataFrame:
        table = self.listing(version).get(key)
        if table is None:
            raise ValueError(f"no table {key}")
        df = self.spark.read.schema(table["schema"]).parquet(f"{self.base}/data/{table['folder']}")
        return df.select(*columns) if columns else df

    def publish(self, tables: Mapping[str, DataFrame], drop: tuple[str, ...] = (), compression: str = "zstd") -> int:
        """Write tables and publish them together; other keys of the last version stay, but for ``drop``.

        A writer that comes second takes the tables of the first as its last version.
        """
        written = {}
        for key, df in tables.items():
            folder = f"{len(written):04d}-{uuid.uuid4().hex}"
            seen = Observation()
            counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
            counted.write.option("compression", compression).parquet(f"{self.base}/data/{folder}")
            schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
            written[key] = {"folder": folder, "n_rows": seen.get["n"], "schema": schema}
        while True:
            versions = self.versions()
            version = (versions[-1] if versions else 0) + 1
            listed = {k: t for k, t in self.listing().items() if k not in drop}
            listed |= {k: {**t, "version": version} for k, t in written.items()}
            pending = f"{self.base}/manifests/pending-{uuid.uuid4().hex}"
            self.files.write(pending, json.dumps({"version": version, "tables": listed}))
            if self.files.rename(pending, self._manifest(version)):
                return version
            self.files.remove(pending)

    def expire(self, keep: int) -> int:
        """Remove all but the last ``keep`` manifests and the data only they list; returns folders removed.

        Data that no manifest lists, which a failed writer left, stays: a writer may be at work.
        """
        versions = self.versions()
        old, held = versions[:-keep], versions[-keep:]
        used = {t["folder"] for v in held for t in self.listing(v).values()}
        gone = {t["folder"] for v in old for t in self.listing(v).values()} - used
        for version in old:
            self.files.remove(self._manifest(version))
        for folder in gone:
            self.files.remove(f"{self.base}/data/{folder}")
        return len(gone)


def write_reconciled(source: DataFrame, keep: Column, path: str, parts: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Write the rows that ``keep`` holds for as Parquet, and counts gathered while they are written.

    ``n_source`` rows came in, ``n_rejected`` failed (a null condition fails), ``n_written`` went out, of
    which each of ``parts`` counts some; parts must cover every written row exactly once. The folder
    appears under its name only if all this adds up; else nothing is left of it and the job fails.
    """
    files = _Files(source.sparkSession)
    parts = dict(parts or {})
    came, went = Observation(), Observation()
    holds = F.coalesce(keep, F.lit(False))
    counted = source.observe(came, F.count(F.lit(1)).alias("n_source"), F.count_if(~holds).alias("n_rejected"))
    kept = counted.filter(holds).observe(
        went, F.count(F.lit(1)).alias("n_written"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in parts.items()]
    )
    if files.system(path).exists(files.path(path)):
        raise ValueError(f"{path} exists")
    pending = f"{path.rstrip('/')}-pending-{uuid.uuid4().hex}"
    try:
        kept.write.parquet(pending)
        counts = {**came.get, **went.get}
        if counts["n_source"] != counts["n_written"] + counts["n_rejected"]:
            raise ValueError(f"rows were lost: {counts}")
        if parts and sum(counts[n] for n in parts) != counts["n_written"]:
            raise ValueError(f"parts do not add up: {counts}")
        if not files.rename(pending, path):
            raise ValueError(f"{path} exists")
    except BaseException:
        files.remove(pending)
        raise
    return counts
