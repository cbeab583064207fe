"""The partitioned store: append, compaction, layout audit, scans and footprint."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import dedup_first, depth_key
from tidemark.operators.quality import utc_day
from tidemark.registry import SPECS, complete, conform
from tidemark.sources.footers import footer_counts

#: Rows of a file that compaction writes.
FILE_ROWS = 20_000_000


def partition_columns(name: str) -> list[str]:
    return ["symbol", "date"] if SPECS[name].by_symbol else ["date"]


def append(df: DataFrame, name: str, root: str) -> DataFrame:
    """Appends complete rows below ``root/<directory>/symbol=S/date=D``; returns the rejected ones.

    Rejected rows are counted while the others are written. Only if there are
    any does the result read the source again.
    """
    spec = SPECS[name]
    if not spec.writable:
        raise ValueError(f"{name} is read-only")
    rows, seen = conform(df, spec), Observation()
    _, bad = complete(rows, spec)
    incomplete = F.count_if(F.greatest(*[F.col(f.name).isNull() for f in spec.schema if not f.nullable], F.lit(False)))
    good, _ = complete(rows.observe(seen, incomplete.alias("rejected")), spec)
    parts = partition_columns(name)
    # All rows of a partition meet in a few tasks, so a batch leaves few files.
    good.withColumn("date", utc_day(F.col(spec.time))).repartition(*parts).write.mode("append").partitionBy(*parts).parquet(f"{root}/{spec.directory}")
    try:
        rejected = seen.get["rejected"]
    except Py4JJavaError:  # no row was left to write, and the adaptive plan dropped the count with the rest
        return bad
    return bad if rejected else df.sparkSession.createDataFrame([], bad.schema)


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _data_schema(name: str) -> T.StructType:
    """The columns within the files, so that none of them has to be opened to learn it."""
    return T.StructType([f for f in SPECS[name].schema if f.name not in partition_columns(name)])


def _segment_paths(spark: SparkSession, name: str, root: str) -> tuple[str, list[str]]:
    path = f"{root}/_segments/{SPECS[name].directory}"
    return path, [f"{path}/{c}" for c in _children(spark, path) if c.startswith("batch=") and _folders(spark, f"{path}/{c}")]


def segments(spark: SparkSession, name: str, root: str, tolerant: bool = True) -> DataFrame | None:
    """Rows of the streaming segments that no compaction has taken in yet, None if there are none; ``batch`` names the query and its batch."""
    path, held = _segment_paths(spark, name, root)
    return spark.read.schema(_data_schema(name)).option("basePath", path).option("ignoreCorruptFiles", str(tolerant).lower()).parquet(*held) if held else None


def read(spark: SparkSession, name: str, root: str, tolerant: bool = True) -> DataFrame:
    """The stored rows: final files, then segments. Unreadable files are passed over, or raise if not ``tolerant``."""
    spec = SPECS[name]
    reader = spark.read.schema(_data_schema(name)).option("ignoreCorruptFiles", str(tolerant).lower())
    tables = [reader.parquet(f"{root}/{spec.directory}")] if _children(spark, f"{root}/{spec.directory}") else []
    if (recent := segments(spark, name, root, tolerant)) is not None:
        tables.append(recent.drop("batch"))
    if not tables:
        return spark.createDataFrame([], spec.schema).withColumn("date", F.lit(None).cast("date"))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def partition_counts(spark: SparkSession, name: str, root: str) -> DataFrame | None:
    """(partition columns, n_rows) of final files and segments from their footers; None if nothing is stored. A damaged file raises."""
    parts, path = partition_columns(name), f"{root}/{SPECS[name].directory}"
    tables = [footer_counts(spark, path, partitions=parts, by=parts)] if _children(spark, path) else []
    base, held = _segment_paths(spark, name, root)
    if held:
        tables.append(footer_counts(spark, *held, partitions=["batch", *parts], by=parts, base=base))
    if not tables:
        return None
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1]).groupBy(*parts).agg(F.sum("n_rows").alias("n_rows"))


def _keyed(rows: DataFrame, name: str) -> DataFrame:
    return depth_key(rows) if "update" in SPECS[name].key else rows


def compact(spark: SparkSession, name: str, root: str, where: str | DataFrame, arrival: tuple[str, ...] = ("received_at",), dedup: bool = True) -> int:
    """Rewrites partitions, segments taken in, first row of a key kept; returns the rows.

    ``where`` is a condition on the partition columns, or a table of them. A
    partition gets one file for every ``FILE_ROWS`` rows. Nothing is
    passed over: a file that cannot be read raises before anything is
    replaced. The rows read in the one pass over the data must be as many as
    the footers of the old files say, and the footers of the new files must
    say as many as were kept, before a manifest is written and partitions are
    swapped by renames. A job that dies before the manifest leaves the old
    partitions; one that dies after it is finished by :func:`recover`.
    """
    spec, parts = SPECS[name], partition_columns(name)
    counts = partition_counts(spark, name, root)
    if counts is None:
        return 0
    chosen = counts.where(where) if isinstance(where, str) else counts.join(where.select(*parts).distinct(), parts, "left_semi")
    held = chosen.collect()  # one row a partition, as many as folders are renamed
    if not held:
        return 0
    keys = spark.createDataFrame([(*(r[p] for p in parts), -(-r.n_rows // FILE_ROWS)) for r in held], ", ".join(f"{p} {'date' if p == 'date' else 'string'}" for p in parts) + ", _files long")
    rows = read(spark, name, root, tolerant=False).where(F.col("date").isin(sorted({r.date for r in held}))).join(F.broadcast(keys), parts)
    taken_in, kept_rows = Observation(), Observation()
    rows = rows.observe(taken_in, F.count(F.lit(1)).alias("n"))
    kept = rows
    if dedup:
        order = [c for c in arrival if c in rows.columns] or [spec.time]
        kept = dedup_first(_keyed(rows, name), spec.key, order).select(*rows.columns)
    kept = kept.observe(kept_rows, F.count(F.lit(1)).alias("n"))
    staging = f"{root}/_staging/{spec.directory}/{uuid.uuid4().hex}"
    of_key = F.pmod(F.xxhash64(*[F.col(k) for k in spec.key if k in rows.columns]), F.col("_files"))
    kept.withColumn("_file", of_key).repartition(*parts, "_file").drop("_file", "_files").write.partitionBy(*parts).parquet(f"{staging}/new")
    n = footer_counts(spark, f"{staging}/new").first()[0]
    expected = sum(r.n_rows for r in held)
    if taken_in.get["n"] != expected or kept_rows.get["n"] != n:
        _delete(spark, staging)
        raise RuntimeError(f"{taken_in.get['n']} rows read of {expected}, {n} written of {kept_rows.get['n']}; nothing was replaced")
    folders = [f"{a}/{b}" for a in _folders(spark, f"{staging}/new") for b in _folders(spark, f"{staging}/new/{a}")] if len(parts) == 2 else _folders(spark, f"{staging}/new")
    taken = []
    for batch in _children(spark, f"{root}/_segments/{spec.directory}"):
        taken += [f"{root}/_segments/{spec.directory}/{batch}/{f}" for f in folders if _exists(spark, f"{root}/_segments/{spec.directory}/{batch}/{f}")]
    _write_text(spark, f"{staging}/manifest.json", json.dumps({"target": f"{root}/{spec.directory}", "folders": folders, "segments": taken}))
    _swap(spark, staging)
    return n


def _folders(spark: SparkSession, path: str) -> list[str]:
    return [c for c in _children(spark, path) if "=" in c]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and renamed, so it is there whole or not at all."""
    fs, where = _fs(spark, path + ".tmp")
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(where, spark._jvm.org.apache.hadoop.fs.Path(path))


def _swap(spark: SparkSession, staging: str) -> None:
    """Puts the staged partitions in place; may be called again after a failure at any point."""
    manifest = json.loads("".join(r.value for r in spark.read.text(f"{staging}/manifest.json").collect()))
    fs, _ = _fs(spark, staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in manifest["folders"]:
        new, target, old = path(f"{staging}/new/{folder}"), path(f"{manifest['target']}/{folder}"), path(f"{staging}/old/{folder}")
        if not fs.exists(new):
            continue  # in place already
        if fs.exists(target):
            fs.mkdirs(old.getParent())
            if not fs.rename(target, old):
                raise RuntimeError(f"{target} could not be set aside")
        fs.mkdirs(target.getParent())
        if not fs.rename(new, target):
            raise RuntimeError(f"{new} could not be put in place")
    for segment in manifest["segments"]:
        _delete(spark, segment)
        if not _folders(spark, segment.rsplit("/", 1)[0]):
            _delete(spark, segment.rsplit("/", 1)[0])
    _delete(spark, staging)


def recover(spark: SparkSession, root: str) -> dict[str, int]:
    """Finishes or drops what compactions that died left behind; returns how many of each. To be called before writing starts."""
    done = {"finished": 0, "dropped": 0}
    for directory in _children(spark, f"{root}/_staging"):
        for one in _children(spark, f"{root}/_staging/{directory}"):
            staging = f"{root}/_staging/{directory}/{one}"
            if _exists(spark, f"{staging}/manifest.json"):
                _swap(spark, staging)
                done["finished"] += 1
            else:
                _delete(spark, staging)
                done["dropped"] += 1
    return done


def files(spark: SparkSession, root: str, pattern: str | None = "*.parquet") -> DataFrame:
    """(path, length) of the visible files below a folder, Parquet only unless told otherwise; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader if pattern is None else reader.option("pathGlobFilter", pattern)).load(root).select("path", "length")


def dataset_bytes(listing: DataFrame) -> DataFrame:
    """(directory, day, bytes) of the files of every dataset and day."""
    parts = r"/([^/]+)/(?:symbol=[^/]+/)?date=(\d{4}-\d{2}-\d{2})/[^/]+$"
    rows = listing.select(F.regexp_extract("path", parts, 1).alias("directory"), F.regexp_extract("path", parts, 2).alias("day"), "length")
    return rows.where("day <> ''").groupBy("directory", "day").agg(F.sum("length").alias("bytes"))


def audit(listing: DataFrame) -> DataFrame:
    """Partitions and bytes by layout: hive (symbol=S/date=D), legacy (SYMBOL/DAY), other."""
    layout = F.when(F.col("path").rlike(r"/date=\d{4}-\d{2}-\d{2}/"), "hive").when(F.col("path").rlike(r"/[A-Z0-9]{5,24}/\d{4}-\d{2}-\d{2}(\.parquet$|/)"), "legacy").otherwise("other")
    return listing.withColumn("layout", layout).groupBy("layout").agg(F.count_distinct(F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).alias("partitions"), F.sum("length").alias("bytes"))


def backup_scope(listing: DataFrame) -> DataFrame:
    """Files and bytes that a backup would take of a listing of any files; temporary, cache and segment files are left out."""
    skip = F.col("path").rlike(r"__pycache__|\.pyc$|\.pytest_cache|\.tmp$|\.segment\.|\.merge\.|/_segments/|/_staging/")
    return listing.where(~skip).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def latest_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.agg(F.max(column).alias("latest"))
