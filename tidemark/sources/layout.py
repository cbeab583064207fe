"""Moves of an older folder layout (SYMBOL/DAY and flat files) to symbol=S/date=D, planned as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_DAY = r"\d{4}-\d{2}-\d{2}"
_SYMBOL = "[A-Z0-9]{5,24}"


def _qualified(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path).toString()


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified) of the visible Parquet files; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return found.select("path", F.col("modificationTime").alias("modified"))


def duplicate_partitions(files: DataFrame) -> DataFrame:
    """(directory, symbol, day) of the partitions that an older folder and the new layout both hold."""
    part = lambda pattern: [F.regexp_extract("path", pattern, k).alias(n) for k, n in ((1, "directory"), (2, "symbol"), (3, "day"))]
    old = files.select(*part(rf"/([^/=]+)/({_SYMBOL})/({_DAY})(?:\.parquet$|/)")).where("directory <> ''").distinct()
    new = files.select(*part(rf"/([^/]+)/symbol=({_SYMBOL})/date=({_DAY})/")).where("directory <> ''")
    return old.join(new, ["directory", "symbol", "day"], "left_semi")


def migration_plan(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """(source, target, action) of every file outside the new layout.

    A file goes to its symbol's and day's folder; a flat file's day is the one
    in its name, else the day it was changed. If the target is taken, a file
    from a day folder stays ("skip") and a flat one goes to
    ``_layout_quarantine`` ("quarantine"). Metadata has days only. Files that
    fit no layout are listed with a null target ("unknown").
    """
    _, base = _qualified(spark, root)
    rel = F.substring("path", len(base) + 2, 1 << 20)
    known = files.select("path", "modified", rel.alias("rel")).where(~F.col("rel").startswith("_"))
    old = known.where(~F.col("rel").rlike(rf"^[^/]+/(symbol={_SYMBOL}/)?date={_DAY}/[^/]+$"))
    part = lambda pattern, k: F.regexp_extract("rel", pattern, k)
    deep, flat, meta = rf"^([^/]+)/({_SYMBOL})/(?:date=)?({_DAY})/([^/]+)$", rf"^([^/]+)/({_SYMBOL})/([^/]+)$", rf"^(metadata)/({_DAY})/([^/]+)$"
    named = F.regexp_extract(part(flat, 3), f"({_DAY})", 1)
    day = F.when(named != "", named).otherwise(F.date_format("modified", "yyyy-MM-dd"))
    target = (
        F.when(F.col("rel").rlike(meta), F.concat_ws("/", part(meta, 1), F.concat(F.lit("date="), part(meta, 2)), part(meta, 3)))
        .when(F.col("rel").rlike(deep), F.concat_ws("/", part(deep, 1), F.concat(F.lit("symbol="), part(deep, 2)), F.concat(F.lit("date="), part(deep, 3)), part(deep, 4)))
        .when(F.col("rel").rlike(flat), F.concat_ws("/", part(flat, 1), F.concat(F.lit("symbol="), part(flat, 2)), F.concat(F.lit("date="), day), part(flat, 3)))
    )
    is_flat = F.col("rel").rlike(flat) & ~F.col("rel").rlike(meta)
    taken = known.select(F.col("rel").alias("target"), F.lit(True).alias("taken"))
    turn = F.row_number().over(W.partitionBy("target").orderBy(F.col("flat"), "rel"))
    found = old.select("rel", target.alias("target"), is_flat.alias("flat")).withColumn("turn", turn).join(taken, "target", "left")
    free = F.col("taken").isNull() & (F.col("turn") == 1)
    action = F.when(F.col("target").isNull(), "unknown").when(free, "move").when(F.col("flat"), "quarantine").otherwise("skip")
    goal = F.when(F.col("flat") & ~free, F.concat(F.lit("_layout_quarantine/"), F.col("target"))).otherwise(F.col("target"))
    return found.select(F.col("rel").alias("source"), goal.alias("target"), action.alias("action"))


def migrate(spark: SparkSession, root: str) -> dict[str, int]:
    """Carries out the plan by renames, one file at a time on the driver; returns the number of files by action."""
    fs, base = _qualified(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    done: dict[str, int] = {}
    # The plan is complete before the first file moves.
    for r in migration_plan(spark, listing(spark, root), root).collect():
        if r.action in ("move", "quarantine"):
            goal = path(f"{base}/{r.target}")
            fs.mkdirs(goal.getParent())
            if not fs.rename(path(f"{base}/{r.source}"), goal):
                raise RuntimeError(f"{r.source} could not be moved")
        done[r.action] = done.get(r.action, 0) + 1
    return done
