"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` (never by a
local checkpoint), so a lost executor costs only its running tasks.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LEFT: list[tuple[SparkSession, str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session. Only a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current is None:
            if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
            current = spark.sparkContext.getCheckpointDir()
        root = current
    return root.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _LEFT:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session may already be gone at exit; the other folders are still tried
            continue


class Workspace:
    """A folder of intermediate tables for one call of an operator."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/tidemark-{label}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._tables: list[str] = []
        _LEFT.append((spark, self.base))

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` and returns the written table."""
        self._n += 1
        path = f"{self.base}/{self._n:03d}-{name}"
        df.write.parquet(path)
        self._tables.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._tidemark_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for t in tables:
            path = getattr(t, "_tidemark_path", None)
            if path:
                _delete(self.spark, path)

    def drop_all_but(self, *tables: DataFrame) -> None:
        """Deletes every table of this workspace that is not among ``tables``."""
        keep = {getattr(t, "_tidemark_path", None) for t in tables}
        for path in self._tables:
            if path not in keep:
                _delete(self.spark, path)
        self._tables = [path for path in self._tables if path in keep]
