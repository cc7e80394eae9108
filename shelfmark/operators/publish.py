"""Batches of tables that become visible together.

Each batch is written below ``<root>/<table>/batch=<n>``; appending one row to the list of
published batches makes all its tables visible at once. A batch that is written again after a
failure lands in the same place. Reading folds the visible batches by key.

A base that `merge` wrote is cut by key (`clustered`). Its pieces are listed with their bounds in the row
that made it visible, so readers fold only the pieces that later batches touch, and the next `merge`
writes only these anew and names the others where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import clustered
from shelfmark.operators.clustered import PIECE_ROWS, Piece
from shelfmark.operators.upsert import ARRIVAL, fold
from shelfmark.plans.catalog import ENTITIES, TABLES

PARALLEL_WRITES = 4
_ROW = (
    "batch bigint, kind string, tables array<string>, reaches bigint, "
    "pieces array<struct<path: string, low: string, high: string, n_rows: bigint>>, counts map<string, bigint>"
)
_LIST_SCHEMA = f"{_ROW}, at timestamp"


def _place(root: str, table: str, batch: int, kind: str = "batch") -> str:
    return f"{root}/{table}/{kind}={batch:012d}"


def _published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_LIST_SCHEMA).parquet(f"{root}/_batches")


def fold_list(spark: SparkSession, root: str) -> int:
    """Rewrite the list of published batches as one file without the rows no reader needs; how many are left.

    A row is needed if it is the newest base of a table, or a batch that some table's base doesn't cover,
    or the last row of all, which the next number follows. The files that were read are deleted once the
    new one is there; until then rows are listed twice, which readers don't mind.
    """
    listed = _published(spark, root)
    files = listed.inputFiles()
    rows = listed.dropDuplicates(["batch", "kind"]).withColumn("table", F.explode("tables")).withColumn("reach", F.coalesce("reaches", "batch"))
    bases = rows.where("kind = 'base'").groupBy("table").agg(F.max(F.struct("reach", "batch")).alias("base"))
    met = rows.join(bases, "table", "left")
    covered = F.coalesce(F.col("batch") <= F.col("base.reach"), F.lit(False))
    needed = F.when(F.col("kind") == "base", F.col("batch") == F.col("base.batch")).otherwise(~covered)
    last = rows.select(F.max("batch")).scalar()
    keep = met.where(needed | (F.col("batch") == last)).select("batch", "kind").distinct()
    kept = listed.dropDuplicates(["batch", "kind"]).join(keep, ["batch", "kind"], "left_semi").select(*listed.columns)
    kept = spark.createDataFrame(kept.collect(), listed.schema)  # a row a batch since the last fold
    kept.coalesce(1).write.mode("append").parquet(f"{root}/_batches")
    for file in files:
        remove(spark, unquote(file))
    return kept.count()


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def next_batch(spark: SparkSession, root: str) -> int:
    """A batch number above all published ones."""
    if not path_exists(spark, f"{root}/_batches"):
        return 0
    newest = _published(spark, root).agg(F.max("batch")).first()[0]
    return 0 if newest is None else newest + 1


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def publish(
    spark: SparkSession,
    root: str,
    batch: int,
    tables: Mapping[str, DataFrame],
    kind: str = "batch",
    reaches: int | None = None,
) -> None:
    """Write all tables of a batch, then make them visible with one appended row.

    The tables do not depend on each other, so their jobs are submitted side by side. Their rows are
    counted as they are written (`batch_counts`).
    """

    def write(item: tuple[str, DataFrame]) -> tuple[str, int]:
        name, rows = item
        seen = Observation()
        rows.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(_place(root, name, batch, kind))
        return name, seen.get["n"]

    with ThreadPoolExecutor(max_workers=PARALLEL_WRITES) as pool:
        counts = dict(pool.map(write, tables.items()))
    _announce(spark, root, batch, kind, sorted(tables), batch if reaches is None else reaches, counts=counts)


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """(batch, kind, table_name, n_rows) as observed while each table of each listed batch was written."""
    listed = _published(spark, root).dropDuplicates(["batch", "kind"])
    return listed.select("batch", "kind", F.explode("counts").alias("table_name", "n_rows"))


def _announce(
    spark: SparkSession, root: str, batch: int, kind: str, tables: Sequence[str], reaches: int,
    pieces: Sequence[Piece] | None = None, counts: Mapping[str, int] | None = None,
) -> None:
    """Make what was written visible with one appended row."""
    listed = None if pieces is None else [(p.path, p.low, p.high, p.n_rows) for p in pieces]
    made = spark.createDataFrame([(batch, kind, list(tables), reaches, listed, counts)], _ROW)
    made.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/_batches")


def pieces_of(spark: SparkSession, root: str, table: str, base: int) -> list[Piece] | None:
    """The pieces of a base in order of their keys, None if it was not cut into any."""
    row = _published(spark, root).where((F.col("kind") == "base") & (F.col("batch") == base) & F.array_contains("tables", table)).first()
    return None if row is None or row.pieces is None else [Piece(*p) for p in row.pieces]


def published(spark: SparkSession, root: str, table: str) -> list[tuple[str, int]]:
    """The visible batches of a table: the newest base, if any, and all that came after it.

    Only these leave the list, which is filtered by the newest base first: as many as were published
    since the last :func:`compact`.
    """
    if not path_exists(spark, f"{root}/_batches"):
        return []
    listed = _published(spark, root).where(F.array_contains("tables", table))
    # a base covers the batches up to ``reaches``; an older one is its own number
    reaches = F.coalesce("reaches", "batch")
    base = listed.where("kind = 'base'").agg(F.max(F.struct(reaches.alias("reaches"), "batch"))).first()[0]
    later = listed.where("kind = 'batch'")
    if base is not None:
        later = later.where(F.col("batch") > base.reaches)
    found = [("batch", r.batch) for r in later.select("batch").distinct().orderBy("batch").collect()]
    return ([] if base is None else [("base", base.batch)]) + found


def arrivals(
    spark: SparkSession, root: str, table: str, visible: Sequence[tuple[str, int]] | None = None,
    only: Sequence[int] | None = None,
) -> DataFrame | None:
    """All visible rows of a table with ``_batch`` and their origin, not yet folded.

    ``only`` names the pieces of a base that are wanted, if it has pieces.
    """
    visible = published(spark, root, table) if visible is None else visible
    parts = []
    for kind, number in visible:
        if kind == "base":
            pieces = pieces_of(spark, root, table, number)
            if pieces is None:
                part = spark.read.parquet(_place(root, table, number, kind))
            else:
                wanted = pieces if only is None else [pieces[n] for n in only]
                part = clustered.read_pieces(spark, f"{root}/{table}", wanted) if wanted else None
            if part is not None:  # a base came before every batch that is still visible
                parts.append(part.select(*_known(part)).withColumn("_batch", F.lit(-1).cast("bigint")))
    paths = [_place(root, table, b, k) for k, b in visible if k == "batch"]
    if paths:
        part = spark.read.option("basePath", f"{root}/{table}").parquet(*paths)
        parts.append(part.select(*_known(part), F.col("batch").cast("bigint").alias("_batch")).drop("batch"))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _known(part: DataFrame) -> list[str]:
    """The columns of a table and its arrival order; what else a batch notes of the origin has no use later."""
    return [c for c in part.columns if c in ARRIVAL or not c.startswith("_")]


def replaced_name(entity: str) -> str:
    """The table of markers: parents that came again, with all their children."""
    return f"replaced_{entity}"


def _markers(spark: SparkSession, root: str, table: str, visible: Sequence[tuple[str, int]]) -> DataFrame | None:
    """(id, _marker): the newest marked version of each parent in the visible batches of a list table."""
    owner = next((e.name for e in ENTITIES.values() for t in e.tables if t.name == table and t.rows in ("many", "items")), None)
    if owner is None:
        return None
    numbers = {n for kind, n in visible if kind == "batch"}
    marked = [("batch", n) for kind, n in published(spark, root, replaced_name(owner)) if n in numbers and kind == "batch"]
    rows = arrivals(spark, root, replaced_name(owner), marked) if marked else None
    return None if rows is None else rows.groupBy("id").agg(F.max(F.struct("_batch", "_file", "_row")).alias("_marker"))


def _without_replaced(rows: DataFrame, markers: DataFrame | None, parent_key: str) -> DataFrame:
    """Rows that came with the newest marked version of their parent, or after it, or whose parent has none.

    The markers are unique by parent, so a busy parent's rows are split by the adaptive skew join.
    """
    if markers is None:
        return rows
    met = rows.join(markers.withColumnRenamed("id", parent_key), parent_key, "left")
    kept = F.col("_marker").isNull() | (F.struct("_batch", "_file", "_row") >= F.col("_marker"))
    return met.where(kept).drop("_marker").select(*rows.columns)


def without_replaced(spark: SparkSession, root: str, table: str, rows: DataFrame, visible: Sequence[tuple[str, int]]) -> DataFrame:
    """The arrivals of a table less the children that a marked later version of their parent lacks."""
    return _without_replaced(rows, _markers(spark, root, table, visible), TABLES[table].key[0])


def resolve(
    spark: SparkSession, root: str, table: str, newest_by: str | None = None, keep: Sequence[str] = ()
) -> DataFrame | None:
    """The current rows of a table, None before its first batch.

    Arrival order decides between versions, unless ``newest_by`` names a column to compare
    first. A base with nothing after it is the table: it is read as it is, and so are the pieces of a
    base that no later batch touches. ``keep`` names columns of the origin (``_file``, ``_row``,
    ``_pos``) to be kept. Children of a parent that a batch has marked as replaced are gone unless they
    came with its marked version.
    """
    visible = published(spark, root, table)
    if not visible:
        return None
    later = [v for v in visible if v[0] == "batch"]
    if not later:
        rows = arrivals(spark, root, table, visible)
        return rows.select(*[c for c in rows.columns if c in keep or not c.startswith("_")])
    markers = _markers(spark, root, table, visible)
    pieces = pieces_of(spark, root, table, visible[0][1]) if visible[0][0] == "base" else None
    if not pieces:
        return _current(arrivals(spark, root, table, visible), table, markers, newest_by, keep)
    open_ = _touched(spark, root, table, later, pieces, markers)
    merged = _current(arrivals(spark, root, table, visible, open_), table, markers, newest_by, keep)
    rest = clustered.others(pieces, open_)
    if not rest:
        return merged
    return merged.unionByName(clustered.read_pieces(spark, f"{root}/{table}", rest).select(*merged.columns))


def _current(rows: DataFrame, table: str, markers: DataFrame | None, newest_by: str | None, keep: Sequence[str]) -> DataFrame:
    """One row per key of the arrivals of a table, less the children that are gone."""
    spec = TABLES[table]
    rows = _without_replaced(rows, markers, spec.key[0])
    order = ["_batch", *[c for c in ARRIVAL if c in rows.columns]]
    if newest_by:
        order = [F.col(newest_by).alias("_newest"), *order]
    return fold(rows, spec.key, spec.policy, order, keep)


def find(
    spark: SparkSession, root: str, table: str, wanted: Sequence | DataFrame, newest_by: str | None = None
) -> DataFrame | None:
    """The current rows whose leading key column is one of ``wanted``: values, or a table of one column.

    Of a base cut by key only the pieces are opened whose bounds hold a value.
    """
    visible = published(spark, root, table)
    if not visible:
        return None
    key = TABLES[table].key[0]
    only = None
    pieces = pieces_of(spark, root, table, visible[0][1]) if visible[0][0] == "base" else None
    if isinstance(wanted, DataFrame):
        keys = wanted.toDF(key).distinct()
        only = clustered.touched(pieces, keys) if pieces else None
    elif pieces:
        texts = [str(v) for v in wanted]
        only = [n for n, p in enumerate(pieces) if any(p.low <= v <= p.high for v in texts)]
    if pieces and not only and len(visible) == 1:
        only = [0]  # for the columns
    rows = arrivals(spark, root, table, visible, only)
    rows = rows.join(keys, key, "left_semi") if isinstance(wanted, DataFrame) else rows.where(F.col(key).isin(*wanted))
    return _current(rows, table, _markers(spark, root, table, visible), newest_by, ())


def _touched(
    spark: SparkSession, root: str, table: str, later: Sequence[tuple[str, int]], pieces: Sequence[Piece], markers: DataFrame | None
) -> list[int]:
    """The pieces of a base that hold keys of later batches, or children of parents these replace."""
    key = TABLES[table].key[0]
    leads = arrivals(spark, root, table, later).select(clustered.lead([key]).alias("lead"))
    if markers is not None:
        leads = leads.union(markers.select("id"))
    return clustered.touched(pieces, leads)


def merge(
    spark: SparkSession, root: str, table: str, newest_by: str | None = None, piece_rows: int = PIECE_ROWS
) -> int | None:
    """Fold the batches after the base of a table into a new base cut by key; the batch it reaches.

    Only pieces that the batches touch are read and written anew; the new base names the others where
    they are. Neighbouring touched pieces are cut again together, so pieces keep their size as the table
    grows. The first merge writes the whole table. The new base becomes visible when it is whole.
    """
    visible = published(spark, root, table)
    later = [v for v in visible if v[0] == "batch"]
    pieces = pieces_of(spark, root, table, visible[0][1]) if visible and visible[0][0] == "base" else None
    if not visible:
        return None
    if pieces and not later:
        return _reach(spark, root, visible[0][1])
    newest = later[-1][1] if later else _reach(spark, root, visible[0][1])
    base, keys = next_batch(spark, root), TABLES[table].key
    folder = _place("", table, base, "base").rsplit("/", 1)[1]
    markers = _markers(spark, root, table, visible)
    open_ = _touched(spark, root, table, later, pieces, markers) if pieces else []
    rows = arrivals(spark, root, table, visible, open_ if pieces else None)
    total = rows.count()  # as the files say
    rest = clustered.others(pieces or [], open_)
    starts = [pieces[n].low for n in clustered.stretches(open_)] if pieces else []
    rows = _current(rows, table, markers, newest_by, ARRIVAL)
    made = clustered.write_pieces(rows, f"{root}/{table}", folder, keys, total, piece_rows, starts)
    if not rest and not made:  # nothing is left of the table
        publish(spark, root, base, {table: rows}, "base", newest)
        return newest
    pieces = sorted([*rest, *made], key=clustered.by_bounds)
    _announce(spark, root, base, "base", [table], newest, pieces, {table: sum(p.n_rows for p in pieces)})
    return newest


def compact(
    spark: SparkSession,
    root: str,
    table: str,
    newest_by: str | None = None,
    cluster_by: Sequence[str] = (),
) -> int | None:
    """Fold the visible batches of a table into a new base; returns the batch it reaches.

    The base has a place of its own and becomes visible when it is whole; what it replaces is left to
    `drop_hidden`, so readers of the older state are not disturbed.
    ``cluster_by`` sorts the rows inside each file, so that lookups and ranges on these columns
    skip row groups by their minimum and maximum; it needs no further shuffle.
    """
    visible = published(spark, root, table)
    if not visible:
        return None
    newest = visible[-1][1] if visible[-1][0] == "batch" else _reach(spark, root, visible[-1][1])
    current = resolve(spark, root, table, newest_by, keep=ARRIVAL)
    if cluster_by:
        current = current.sortWithinPartitions(*cluster_by)
    publish(spark, root, next_batch(spark, root), {table: current}, kind="base", reaches=newest)
    return newest


def _reach(spark: SparkSession, root: str, base: int) -> int:
    found = _published(spark, root).where((F.col("kind") == "base") & (F.col("batch") == base))
    return found.agg(F.max(F.coalesce("reaches", "batch"))).first()[0]


def drop_hidden(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete the folders of a table that no reader of its present state needs; their paths.

    Of an older base those pieces stay that are part of the newest one.
    """
    visible = published(spark, root, table)
    keep = {_place(root, table, b, kind).rsplit("/", 1)[1] for kind, b in visible}
    named = {p.path for kind, b in visible if kind == "base" for p in pieces_of(spark, root, table, b) or []}
    keep |= {p.split("/")[0] for p in named}
    reach = next((_reach(spark, root, b) for kind, b in visible if kind == "base"), -1)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in store.listStatus(folder) if store.exists(folder) else []:
        name = status.getPath().getName()
        kind, _, number = name.partition("=")
        covered = kind == "base" or (kind == "batch" and int(number) <= reach)
        if covered and name not in keep:
            store.delete(status.getPath(), True)
            dropped.append(name)
        elif kind == "base" and any(p.startswith(f"{name}/") for p in named):
            for piece in store.globStatus(jvm.org.apache.hadoop.fs.Path(status.getPath(), "range=*/cut=*")):
                where = piece.getPath()
                path = f"{name}/{where.getParent().getName()}/{where.getName()}"
                if path not in named:
                    store.delete(where, True)
                    dropped.append(path)
    return sorted(dropped)
