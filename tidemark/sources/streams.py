"""File-based sources: envelopes as JSON lines, poll answers, reports; and whether the day's metadata are due."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.registry import SPECS
from tidemark.sources import parse


def envelopes(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A stream of (stream, data, received_at) from files of JSON lines {"received_at": ms, "message": {..}}.

    ``files_per_trigger`` bounds a batch, which is the backpressure of this
    source. Lines that are no object with an arrival time and a message are passed over.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return _unwrapped(lines)


def envelopes_batch(spark: SparkSession, path: str) -> DataFrame:
    return _unwrapped(spark.read.text(path))


def _unwrapped(lines: DataFrame) -> DataFrame:
    parts = lines.select(F.get_json_object("value", "$.received_at").try_cast("bigint").alias("received_at"), F.get_json_object("value", "$.message").alias("value"))
    return parse.unwrap(parts.where("received_at IS NOT NULL AND value IS NOT NULL")).select("stream", "data", "received_at")


def poll_answers(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A stream of (symbol, data, received_at) from the files that a poll writes."""
    return spark.readStream.schema("symbol string, data string, received_at long").option("maxFilesPerTrigger", files_per_trigger).json(path)


def reports(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents of a folder, one row each; those that are malformed are passed over."""
    rows = spark.read.schema(f"{schema}, _malformed string").option("multiLine", True).option("columnNameOfCorruptRecord", "_malformed").json(path)
    return rows.where("_malformed IS NULL").drop("_malformed")


def metadata_due(stored: DataFrame, now: DataFrame) -> DataFrame:
    """The rows of ``now`` (timestamp) whose UTC day has no stored metadata yet; ``stored`` has the partition column ``date``."""
    day = F.to_date(F.timestamp_millis("timestamp"))
    return now.withColumn("date", day).join(stored.select("date").distinct(), "date", "left_anti").select("timestamp")


def directories() -> list[str]:
    """The datasets' folders, each once, in order."""
    return list(dict.fromkeys(s.directory for s in SPECS.values()))
