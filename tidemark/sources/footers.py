"""Counts and extremes of Parquet tables from the footers of their files; no data page is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet scans answer aggregates from the footers, where the query allows it."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    return own


def _grouped(table: DataFrame, partitions: Sequence[str], by: Sequence[str], first: list[Column], again: list[Column]) -> DataFrame:
    # Footers answer for all partition columns at once or for none; other groupings add up their answers.
    if list(by) == list(partitions) or not by:
        return table.groupBy(*by).agg(*first)
    return table.groupBy(*partitions).agg(*first).groupBy(*by).agg(*again)


def footer_counts(spark: SparkSession, *paths: str, partitions: Sequence[str] = (), by: Sequence[str] = (), base: str | None = None) -> DataFrame:
    """(*by, n_rows) of the files below ``paths``; ``partitions`` are all partition columns, ``by`` some of them. A file without a sound footer raises."""
    reader = footer_session(spark).read
    table = (reader.option("basePath", base) if base else reader).parquet(*paths)
    return _grouped(table, partitions, by, [F.count(F.lit(1)).alias("n_rows")], [F.sum("n_rows").alias("n_rows")])


def footer_range(spark: SparkSession, path: str, column: str, partitions: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """(*by, least, most, n_rows): the extremes of a number column and the rows, without a scan."""
    table = footer_session(spark).read.parquet(path)
    first = [F.min(column).alias("least"), F.max(column).alias("most"), F.count(F.lit(1)).alias("n_rows")]
    return _grouped(table, partitions, by, first, [F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n_rows").alias("n_rows")])
