"""Bases cut into pieces by ranges of their key, so that a batch touches only some of them.

A piece is a folder of files that holds the rows whose keys lie between two bounds of the leading key
column, compared as text. Pieces follow each other in order of their keys; neighbours share a bound
only where one value of the leading column (a busy parent, say) fills more than one piece.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a piece, about.
PIECE_ROWS = 1_000_000


@dataclass(frozen=True)
class Piece:
    """A folder below that of the table, the smallest and largest leading key in it, and its rows."""

    path: str
    low: str
    high: str
    n_rows: int


def lead(keys: Sequence[str]) -> Column:
    """The column by which bounds are compared."""
    return F.col(keys[0]).cast("string")


def n_below(value: Column, bounds: Sequence[str], inclusive: bool) -> Column:
    """How many of the sorted ``bounds`` are below ``value`` (or equal): a binary search.

    The bounds are one constant; a value is compared with as many of them as their number has bits.
    """
    if not bounds:
        return F.lit(0)
    held = F.from_json(F.lit(json.dumps(list(bounds))), "array<string>")
    widths = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(bounds).bit_length()))])

    def step(found: Column, width: Column) -> Column:
        bound = F.get(held, found + width - 1)  # NULL behind the last
        return F.when(bound <= value if inclusive else bound < value, found + width).otherwise(found)

    return F.aggregate(widths, F.lit(0), step)


def touched(pieces: Sequence[Piece], leads: DataFrame) -> list[int]:
    """The numbers of the pieces in which keys with the given values (one column) are or belong.

    A value between two pieces belongs to the one before. No more numbers reach the driver than there
    are pieces.
    """
    if not pieces:
        return []
    value = F.col(leads.columns[0]).cast("string")
    first = n_below(value, [p.high for p in pieces], inclusive=False)
    last = n_below(value, [p.low for p in pieces], inclusive=True) - 1
    found = leads.select(first.alias("first"), last.alias("last")).distinct()
    gap = F.greatest(F.least("first", "last"), F.lit(0))
    numbers = F.explode(F.sequence(F.when(F.col("first") <= F.col("last"), F.col("first")).otherwise(gap), F.greatest("last", F.lit(0))))
    return sorted(r[0] for r in found.select(numbers.alias("n")).distinct().collect())


def others(pieces: Sequence[Piece], numbers: Sequence[int]) -> list[Piece]:
    """The pieces but those of the given numbers."""
    taken = set(numbers)
    return [p for n, p in enumerate(pieces) if n not in taken]


def stretches(numbers: Sequence[int]) -> list[int]:
    """The first of each run of consecutive numbers."""
    return [n for before, n in pairwise([-2, *numbers]) if n != before + 1]


def write_pieces(
    rows: DataFrame, root: str, folder: str, keys: Sequence[str], n_rows: int, piece_rows: int = PIECE_ROWS, starts: Sequence[str] = ()
) -> list[Piece]:
    """Write ``rows`` in pieces below ``root``/``folder``; what was written, in order.

    One shuffle by range of the whole key, so that a busy parent's rows spread as well; rows are sorted
    inside the files. A task cuts its sorted rows into pieces as it writes them, so the keys sampled for the
    ranges grow with the tasks and not with the pieces. ``starts`` are bounds that no piece may cross: rows
    from each on are cut apart.
    """
    stretch = F.greatest(n_below(lead(keys), starts, inclusive=True) - 1, F.lit(0))
    tasks = max(-(-n_rows // max(piece_rows, PIECE_ROWS)), 2 * rows.sparkSession.sparkContext.defaultParallelism)
    order = [lead(keys), *keys]
    cut = rows.withColumn("range", stretch).repartitionByRange(max(1, min(tasks, -(-n_rows // piece_rows))), "range", *order)
    cut = cut.sortWithinPartitions("range", *order).withColumn("_id", F.monotonically_increasing_id())
    # a piece is named by the number of its first row; the lower 33 bits count the rows of a task
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) % F.lit(piece_rows)
    cut = cut.withColumn("cut", F.col("_id") - inside).drop("_id").sortWithinPartitions("range", "cut", *order)
    cut.write.mode("overwrite").partitionBy("range", "cut").parquet(f"{root}/{folder}")
    # only the leading key column is read
    schema = f"`{keys[0]}` {rows.schema[keys[0]].dataType.simpleString()}, range int, cut bigint"
    written = rows.sparkSession.read.schema(schema).parquet(f"{root}/{folder}")
    found = written.groupBy("range", "cut").agg(F.min(lead(keys)).alias("low"), F.max(lead(keys)).alias("high"), F.count("*").alias("n"))
    pieces = [Piece(f"{folder}/range={r.range}/cut={r.cut}", r.low, r.high, r.n) for r in found.collect()]
    return sorted(pieces, key=by_bounds)


def by_bounds(piece: Piece) -> tuple[bytes, bytes, str]:
    """The order of pieces: that of text on the executors."""
    return piece.low.encode(), piece.high.encode(), piece.path


def read_pieces(spark: SparkSession, root: str, pieces: Sequence[Piece]) -> DataFrame:
    """The rows of some pieces."""
    return spark.read.parquet(*[f"{root}/{p.path}" for p in pieces])
