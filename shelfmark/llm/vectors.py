"""What the two vector searches share: vectors as matrices, and cells of shards and query blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a shard and of a block of queries.
SHARD_ROWS, QUERY_ROWS = 8192, 2048


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(i, v): vectors as doubles, without nulls and those holding null or non-finite components."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        table.select(table[id_col].cast("long").alias("i"), table[vector_col].cast("array<double>").alias("v"))
        .where("i is not null and v is not null").where(F.coalesce(finite, F.lit(False)))
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lens = np.diff(column.offsets.to_numpy())
    wide = int(lens.max(initial=0))
    if (lens == wide).all():
        return flat.reshape(len(column), wide)
    out = np.zeros((len(column), wide))
    out[np.arange(wide)[None, :] < lens[:, None]] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both filled up with zeros to the wider one's width."""
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) if x.shape[1] < wide else x for x in (a, b))


def search_cells(
    rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``search(shard, block)`` for every shard of ``rows`` and every block of ``queries``.

    Both have a column ``i``. Shards and blocks are cut by hash, so none grows with the table; each
    cell is one task's work on two bounded sets of rows, and returns its own best only.
    """
    shards, blocks = max(1, -(-n_rows // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def own(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    left = rows.withColumn("shard", own("i", shards)).withColumn("block", every(blocks))
    right = queries.withColumn("block", own("i", blocks)).withColumn("shard", every(shards))
    cells = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    return cells.applyInArrow(lambda a, b: search(a, b), schema)
