"""CSV folders and log folders."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources.snapshot import literal

# How much of a log is looked at, and the mark of an error line.
LOG_TAIL = 50
ERROR_MARK = "ERROR"

#: Files whose first lines are read at once.
OPEN_FILES = 16


def scan_csv(spark: SparkSession, path: str, ddl: str, multi_line: bool = True) -> DataFrame:
    """The CSV files of a folder, columns matched by name and cast to the declared types.

    Every file is read by its own header; declared columns that a file does not have become NULL.
    Headers come with the listing: of each file the first line is read, by threads of the driver.
    Files of one header are read together. ``multi_line`` allows line breaks inside quoted values, at
    the price of one task a file; without such values turn it off.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}
    wanted = T.StructType.fromDDL(ddl)
    listed = spark.read.option("pathGlobFilter", "*.csv").text(path).inputFiles()
    names = sorted({unquote(f) for f in listed if unquote(f).endswith(".csv")})
    headers: dict[str, list[str]] = {}
    for name, header in zip(names, first_lines(spark, names), strict=True):
        if header is not None:
            headers.setdefault(header, []).append(name)
    parts = []
    for header in sorted(headers):
        # the names of columns are found by a listing of its own that takes names of files as patterns again
        odd = [f for f in headers[header] if literal(f) != f]
        for files in (sorted(set(headers[header]) - set(odd)), sorted(odd)):
            if files:
                reader = spark.read.options(**options)
                rows = (reader.schema(_header_schema(header)) if files[0] in odd else reader).csv([literal(f) for f in files])
                parts.append(rows.select(*[_typed(rows, f).alias(f.name) for f in wanted.fields]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], wanted)


def first_lines(spark: SparkSession, names: Sequence[str]) -> list[str | None]:
    """The first line of each of some files, None for an empty one. No more than a buffer's length is read."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(name: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(name)
        stream = path.getFileSystem(settings).open(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return list(pool.map(first, names))


def _header_schema(header: str) -> T.StructType:
    """The columns of a header line as text; repeated and empty names get their place behind them."""
    names = next(csv.reader([header]), [])
    unique = [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]
    return T.StructType([T.StructField(n, T.StringType()) for n in unique])


def _typed(rows: DataFrame, f: T.StructField):
    if f.name not in rows.columns:
        return F.lit(None).cast(f.dataType)
    text = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(text, f.dataType)
    return text.try_cast(f.dataType)


def last_lines(lines: DataFrame, order: list[str], n: int = LOG_TAIL) -> DataFrame:
    return lines.orderBy(*[F.desc(c) for c in order]).limit(n)


def error_lines(lines: DataFrame, order: list[str], text: str = "value", n: int = LOG_TAIL) -> DataFrame:
    """Error lines among the last ``n`` lines (not the last ``n`` errors)."""
    return last_lines(lines, order, n).where(F.col(text).contains(ERROR_MARK))


def newest_file(files: DataFrame, at: str = "modified", name: str = "file", by: tuple[str, ...] = ()) -> DataFrame:
    """The newest file, or that of each ``by``; of equally new ones the last by name."""
    newest = files.groupBy(*by).agg(F.max_by(name, F.struct(at, name)).alias(name))
    return newest.where(F.col(name).isNotNull())


def scan_log(spark: SparkSession, path: str, tail: int = LOG_TAIL) -> DataFrame:
    """Error lines among the last lines of the newest ``.log`` file of a folder."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.log")
        .load(path)
        .select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"))
    )
    newest = newest_file(files).first()
    if newest is None:
        return spark.createDataFrame([], "value string")
    lines = spark.read.text(literal(newest.file)).select(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.trim("value").alias("value"),
    )
    return error_lines(lines, ["block", "row"], n=tail).orderBy("block", "row").select("value")
