"""Secondary indexes: from the values of a column to the keys of the rows that hold them.

Each part of a table (its base, and each batch after it) has its own index of a column below
``<root>/_lookups/<table>.<column>``: the different (value, leading key) pairs, cut by value like a
base is cut by key. A lookup opens the pieces whose bounds hold a wanted value, and then, of a clustered
base, the pieces that hold the keys found there: a few files of however many.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import clustered
from shelfmark.operators.clustered import PIECE_ROWS, Piece
from shelfmark.operators.publish import arrivals, find, path_exists, published
from shelfmark.plans.catalog import TABLES

_LISTED = "path string, low string, high string, n_rows bigint"


def _folder(root: str, table: str, column: str, part: tuple[str, int]) -> str:
    return f"{root}/_lookups/{table}.{column}/{part[0]}={part[1]:012d}"


def index(spark: SparkSession, root: str, table: str, column: str, piece_rows: int = PIECE_ROWS) -> list[str]:
    """Index the column of every visible part of a table that has no index yet; the new folders.

    The bounds of the pieces are written last, so an index without them is not used and written again.
    """
    made = []
    for part in published(spark, root, table):
        folder = _folder(root, table, column, part)
        if path_exists(spark, f"{folder}/bounds/_SUCCESS"):
            continue
        rows = arrivals(spark, root, table, [part]).select(F.col(column).alias("value"), F.col(TABLES[table].key[0]).alias("key"))
        rows = rows.where("value is not null").distinct()
        pieces = clustered.write_pieces(rows, folder, "pieces", ["value", "key"], rows.count(), piece_rows)
        listed = spark.createDataFrame([(p.path, p.low, p.high, p.n_rows) for p in pieces], _LISTED)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/bounds")
        made.append(folder)
    return made


def _keys(spark: SparkSession, root: str, table: str, column: str, holds, wanted: Column) -> DataFrame:
    """(key) of the rows of all parts whose value is ``wanted``, from the pieces for which ``holds`` is true."""
    index(spark, root, table, column)
    found = spark.createDataFrame([], f"key {arrivals(spark, root, table).schema[TABLES[table].key[0]].dataType.simpleString()}")
    for part in published(spark, root, table):
        folder = _folder(root, table, column, part)
        pieces = [Piece(*p) for p in spark.read.schema(_LISTED).parquet(f"{folder}/bounds").collect()]
        open_ = [p for p in pieces if holds(p)]
        if open_:
            found = found.union(clustered.read_pieces(spark, folder, open_).where(wanted).select("key"))
    return found.distinct()


def lookup(spark: SparkSession, root: str, table: str, column: str, values: Sequence) -> DataFrame:
    """The current rows whose column is one of ``values`` (compared as text). Missing indexes are written first.

    Keys found in a part that a later one has replaced are found too, so the column of the current rows
    is compared once more.
    """
    wanted = sorted({str(v) for v in values})
    text = F.col("value").cast("string")
    keys = _keys(spark, root, table, column, lambda p: any(p.low <= v <= p.high for v in wanted), text.isin(wanted))
    return find(spark, root, table, keys).where(F.col(column).cast("string").isin(wanted))


def between(spark: SparkSession, root: str, table: str, column: str, low: str, high: str) -> DataFrame:
    """The current rows whose column lies between two texts, both included (texts, and dates as ISO text)."""
    text = F.col("value").cast("string")
    keys = _keys(spark, root, table, column, lambda p: p.low <= high and low <= p.high, (text >= low) & (text <= high))
    return find(spark, root, table, keys).where(F.col(column).cast("string").between(low, high))
