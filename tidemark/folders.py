"""Folders for intermediate results where all executors see them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_MADE: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, deleted at exit; only a local session without that setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/tidemark-{label}-{uuid.uuid4().hex[:12]}"
    _MADE.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _MADE:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone by now; the other folders are still tried
            continue
