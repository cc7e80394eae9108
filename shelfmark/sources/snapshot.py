"""Partitioned snapshots of gzipped JSON Lines: ``<entity>/updated_date=YYYY-MM-DD/<part>.gz``."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.scalars import partition_date
from shelfmark.operators.parse import parse_lines

PARTITION = "updated_date"
GZ = "*.gz"


def literal(name: str) -> str:
    """A file's name as readers take it for that file alone: they would read ``[``, ``{``, ``*`` and ``?`` as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", name)


def list_files(spark: SparkSession, path: str, entity: str, pattern: str = GZ) -> DataFrame:
    """(entity, file, partition, bytes, modified) of the matching files; contents are not read.

    ``file`` is written as in the origin of lines and in the manifest: special characters escaped.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.lit(entity).alias("entity"),
            F.col("_metadata.file_path").alias("file"),
            partition_date(F.col("path"), PARTITION).alias("partition"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def latest_partition(rows: DataFrame, column: str = "partition") -> DataFrame:
    """The rows of the newest partition; none when there are no rows."""
    newest = rows.select(F.max(column)).scalar()
    return rows.where(F.col(column) == newest)


def scan_window(rows: DataFrame, start=None, end=None, column: str = "partition") -> DataFrame:
    """The rows of the partitions from ``start`` to ``end``, both included; None is open."""
    if start is not None:
        rows = rows.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col(column) <= F.lit(end).cast("date"))
    return rows


def scan_lines(
    spark: SparkSession,
    path: str,
    pattern: str = GZ,
    files: list[str] | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Lines with their origin: ``_partition``, ``_file``, ``_row`` (rising within a file), ``value``.

    ``files`` limits the scan to the given paths below ``path`` (as listed by :func:`list_files`), ``start`` and ``end`` to a
    window of partitions. Both act on the file listing, before anything is read; a filter put
    on the result would come after the row numbers and read everything.
    """
    reader = spark.read.option("basePath", path)
    if files is None:
        lines = reader.option("pathGlobFilter", pattern).text(path)
    else:
        lines = reader.text([literal(unquote(f)) for f in files])
    lines = scan_window(lines, start, end, PARTITION)
    return lines.select(*_origin(lines.columns), "value")


def _origin(columns: list[str]) -> list[Column]:
    found = F.col(PARTITION).cast("date") if PARTITION in columns else F.lit(None).cast("date")
    return [
        found.alias("_partition"),
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def scan_jsonl(spark: SparkSession, path: str, **limits) -> DataFrame:
    """Parsed lines; takes what :func:`scan_lines` takes."""
    return parse_lines(scan_lines(spark, path, **limits))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int, pattern: str = GZ) -> DataFrame:
    """The same lines as a stream of files, each read once; ``_row`` is added per batch."""
    schema = T.StructType().add("value", T.StringType()).add(PARTITION, T.DateType())
    lines = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
    )
    return lines.select(
        F.col(PARTITION).alias("_partition"), F.col("_metadata.file_path").alias("_file"), "value"
    )


def number_lines(wanted: DataFrame, all_lines: DataFrame) -> DataFrame:
    """Add the 1-based ``line`` within its file to ``wanted`` (say, the quarantined lines).

    ``_row`` is gapless within an unsplittable file, so its distance from the file's first
    row is the line number; only two columns of the stored lines are read for that.
    """
    first = all_lines.groupBy("_file").agg(F.min("_row").alias("_first"))
    return (
        wanted.join(first, "_file")
        .withColumn("line", F.col("_row") - F.col("_first") + 1)
        .drop("_first")
    )
