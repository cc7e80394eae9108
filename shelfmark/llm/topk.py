"""Exact top-k search by inner product with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.vectors import QUERY_ROWS, SHARD_ROWS, matrix, same_width, usable
from shelfmark.session import stored

#: Documents of a range block; blocks scored until the first look at the bounds, twice as many until the next one.
BLOCK, STRIDE = 16, 8
#: Vectors that give documents their order (a bounded sample), how many of the nearest of them say where a
#: document stands, and shards whose bounds a task compares at once.
HEADS, PLACES, GROUP = 256, 4, 4096
_LEAST, _MOST = -(2**63), 2**63 - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of every component."""
    return np.floor(1024.0 * vectors)


def _exact(docs: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    """Inner products as 64-bit integers; those beyond are set to the nearest one."""
    if small:
        return (docs @ query).astype(np.int64)
    q = [int(x) for x in query.tolist()]
    sums = (sum(int(a) * b for a, b in zip(row, q, strict=True)) for row in docs.tolist())
    return np.fromiter((min(max(s, _LEAST), _MOST) for s in sums), np.int64, len(docs))


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The largest score each query can have among documents with these extremes; infinite where sums are rounded."""
    queries, high = same_width(queries, high)
    low = same_width(high, low)[1]
    if not _small(queries, high, low):
        return np.full((len(queries), len(high)), np.inf)
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def _small(queries: np.ndarray, *docs: np.ndarray) -> bool:
    """Whether all products add up exactly in double precision."""
    largest = max(max(np.abs(d).max(initial=0) for d in docs), 1.0) * max(np.abs(queries).max(initial=0), 1.0)
    return bool(largest * max(queries.shape[1], 1) < 2**53)


def places(docs: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """One number a document: its `PLACES` nearest heads by inner product, the nearest first."""
    docs, heads = same_width(docs, heads)
    if not docs.size or not len(heads):
        return np.zeros(len(docs), np.int64)
    docs = docs / np.maximum(np.abs(docs).max(axis=1, keepdims=True), 1.0)  # no overflow
    near = np.argsort(-(docs @ heads.T), axis=1, kind="stable")[:, :PLACES].astype(np.int64)
    return near @ (HEADS ** np.arange(PLACES - 1, -1, -1, dtype=np.int64)[: near.shape[1]])


def search(
    ids: np.ndarray, docs: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
    order_by: np.ndarray | None = None, floors: np.ndarray | None = None,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, scores) of its k best documents; ties to smaller ids.

    Documents are ordered by ``order_by`` (else by the nearest of a few of them) and cut into ranges of
    `BLOCK`. A block keeps, for each term, the largest and the smallest weight in it: the sum of the larger
    products with the query bounds every score in the block. A query takes blocks in descending order of
    their bounds and scores them through their rows, until the next bound is below its k-th score.
    Documents below the query's score in ``floors`` are left out, as k others are known to be above.
    """
    docs, queries = same_width(docs, queries)
    small = _small(queries, docs)
    if order_by is None:
        heads = docs[:: max(1, len(docs) // 64)][:64]
        order_by = places(docs, heads / np.maximum(np.abs(heads).max(axis=1, keepdims=True, initial=0), 1.0))
    order = np.lexsort((ids, order_by))
    ids, docs = ids[order], docs[order]
    starts = np.arange(0, len(docs), BLOCK)
    bounds = _bounds(queries, np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts))
    results = []
    for n in range(len(queries)):
        by_bound = np.argsort(-bounds[n], kind="stable")
        best_ids, best, kth = np.empty(0, np.int64), np.empty(0, np.int64), _LEAST if floors is None else int(floors[n])
        at, stride = 0, STRIDE
        while at < len(by_bound):
            blocks = by_bound[at : at + stride]
            at, stride = at + stride, 2 * stride
            blocks = blocks[bounds[n, blocks] >= kth]
            if not len(blocks):
                break
            rows = (starts[blocks][:, None] + np.arange(BLOCK)[None, :]).ravel()
            rows = rows[rows < len(docs)]
            rows = rows[ids[rows] != query_ids[n]]
            scores = _exact(docs[rows], queries[n], small)
            keep = scores >= kth
            best_ids, best = np.concatenate([best_ids, ids[rows[keep]]]), np.concatenate([best, scores[keep]])
            if len(best) > k:
                top = np.lexsort((best_ids, -best if small else [-int(x) for x in best]))[:k]
                best_ids, best = best_ids[top], best[top]
            if len(best) == k:
                kth = max(kth, int(best.min()))
        results.append((best_ids, best))
    return results


def ordered(rows: DataFrame) -> DataFrame:
    """(shard, place, i, v): the rows in ranges of one order over all of them, written to the shared folder.

    The heads are the vectors with the least hashes of their ids, which the driver reads. Rows that equal each
    other in everything still fall into several ranges, so none grows with a busy place or id.
    """
    some = rows.orderBy(F.xxhash64("i"), "i", "v").limit(HEADS).select("v").toArrow()
    heads = whole(matrix(some["v"])) if len(some) else np.empty((0, 0))
    if heads.size:
        heads = heads / np.maximum(np.abs(heads).max(axis=1, keepdims=True), 1.0)
        heads = heads / np.maximum(np.linalg.norm(heads, axis=1, keepdims=True), 1e-300)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = pa.array(places(whole(matrix(batch.column("v"))), heads))
                yield pa.RecordBatch.from_arrays([at, batch.column("i"), batch.column("v")], names=["place", "i", "v"])

    placed = stored(rows.select("i", "v").mapInArrow(run, "place long, i long, v array<double>"), "places")
    shards = max(1, -(-placed.count() // SHARD_ROWS))
    ranges = placed.withColumn("n", F.monotonically_increasing_id()).repartitionByRange(shards, "place", "i", "n")
    return stored(ranges.select(F.spark_partition_id().alias("shard"), "place", "i", "v"), "ranges")


def extremes(rows: DataFrame) -> DataFrame:
    """(shard, high, low): each shard's largest and smallest weight of every term; batches are combined first."""

    def lists(values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(batch.column("shard").to_numpy(), kind="stable")
                docs = whole(matrix(batch.column("v")))[order]
                shards, starts = np.unique(batch.column("shard").to_numpy()[order], return_index=True)
                high, low = np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts)
                yield pa.RecordBatch.from_arrays([pa.array(shards), lists(high), lists(low)], names=["shard", "high", "low"])

    def combined(parts: pa.Table) -> pa.Table:
        high, low = matrix(parts["high"]).max(axis=0, keepdims=True), matrix(parts["low"]).min(axis=0, keepdims=True)
        return pa.table({"shard": parts["shard"].slice(0, 1), "high": lists(high), "low": lists(low)})

    schema = "shard int, high array<double>, low array<double>"
    return stored(rows.select("shard", "v").mapInArrow(per_batch, schema).groupBy("shard").applyInArrow(combined, schema), "extremes")


def _promising(summary: DataFrame, queries: DataFrame, n_shards: int, blocks: int, best_only: bool) -> DataFrame:
    """(shard, i, copy, bound): shards whose bound reaches a query's floor, or the best one of each group of shards."""

    def cell(group: pa.Table, block: pa.Table) -> pa.Table:
        asked = which = np.empty(0, np.int64)
        bounds = np.empty((len(block), len(group)))
        if len(group) and len(block):
            group = group.sort_by("shard")
            bounds = _bounds(whole(matrix(block["v"])), matrix(group["high"]), matrix(group["low"]))
            if best_only:
                asked, which = np.arange(len(block)), bounds.argmax(axis=1)
            else:
                asked, which = np.nonzero((bounds >= block["floor"].to_numpy()[:, None]) & (group["shard"].to_numpy()[None, :] != block["first"].to_numpy()[:, None]))
        of = block.take(pa.array(asked))
        return pa.table({"shard": group["shard"].take(pa.array(which)), "i": of["i"], "copy": of["copy"], "bound": pa.array(bounds[asked, which])})

    groups = -(-n_shards // GROUP)
    left = summary.withColumn("group", F.expr(f"shard div {GROUP}").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = left.groupBy("group", "block").cogroup(right.groupBy("group", "block")).applyInArrow(cell, "shard int, i long, copy long, bound double")
    return found.groupBy("i", "copy").agg(F.max_by("shard", F.struct("bound", -F.col("shard"))).alias("shard")) if best_only else found


_FOUND = "query_id long, copy long, vec_id long, score long"


def _searched(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The k best of each shard for every query that asks for it: (shard, block, i, copy, v, floor)."""

    def cell(shard: pa.Table, block: pa.Table) -> pa.Table:
        parts = [pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "copy", "vec_id", "score")})]
        if len(shard) and len(block):
            docs, ids = whole(matrix(shard["v"])), shard["i"].to_numpy()
            who, copies = block["i"].to_numpy(), block["copy"].to_numpy()
            found = search(ids, docs, who, whole(matrix(block["v"])), k, shard["place"].to_numpy(), block["floor"].to_numpy())
            for n, (best, scores) in enumerate(found):
                same = [pa.array(np.full(len(best), x[n])) for x in (who, copies)]
                parts.append(pa.table({"query_id": same[0], "copy": same[1], "vec_id": pa.array(best), "score": pa.array(scores)}))
        return pa.concat_tables(parts)

    wanted = asked.select("shard", "block").distinct().toDF("shard", "block")  # columns of its own
    cells = rows.join(wanted, "shard").groupBy("shard", "block")
    return cells.cogroup(asked.groupBy("shard", "block")).applyInArrow(cell, _FOUND)


def top_k(
    table: DataFrame, is_query: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of each query with the largest products.

    Rows stand in one order over the whole table, cut into shards. Every query first searches the shard
    with the best bound; its k-th score there is a floor, and it goes only to those other shards whose bound
    reaches the floor, and prunes their blocks with it.

    ``is_query`` is an SQL condition on the column ``i`` that picks the queries; candidates are
    all rows but those of the query's own id. Vectors become integers (`whole`). Null ids, null vectors
    and vectors holding null or non-finite components take no part; shorter vectors count as filled
    up with zeros. A repeated row is one query, but each copy a candidate. Other columns are not
    read. An empty table gives an empty result.
    """
    usable_rows = usable(table, id_col, vector_col)
    rows = ordered(usable_rows)
    asking = usable_rows.where(is_query).dropDuplicates(["i", "v"]).withColumn("copy", F.xxhash64("v"))
    asking = stored(asking, "top-queries")
    blocks = max(1, -(-asking.count() // QUERY_ROWS))
    asking = asking.withColumn("block", F.pmod(F.xxhash64("i", "copy"), F.lit(blocks)).cast("int"))
    summary = extremes(rows)
    n_shards = max(1, summary.count())

    first = stored(_promising(summary, asking, n_shards, blocks, best_only=True).withColumnRenamed("shard", "first"), "first-shards")
    queries = asking.join(first, ["i", "copy"])
    found = stored(_searched(rows, queries.withColumn("floor", F.lit(_LEAST)).withColumnRenamed("first", "shard"), k), "first-found")
    if n_shards > 1:
        kth = F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(_LEAST)).alias("floor")
        floors = found.groupBy(F.col("query_id").alias("i"), "copy").agg(kth)
        queries = queries.join(floors, ["i", "copy"], "left").withColumn("floor", F.coalesce("floor", F.lit(_LEAST)))
        pairs = _promising(summary, queries, n_shards, blocks, best_only=False).select("shard", "i", "copy")
        found = found.unionByName(_searched(rows, stored(pairs.join(queries.drop("first"), ["i", "copy"]), "asked-shards"), k))
    place = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
