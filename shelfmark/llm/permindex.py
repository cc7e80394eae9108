"""Approximate nearest neighbours with a permutation index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import gather, offsets
from shelfmark.llm.vectors import matrix, same_width, search_cells, usable
from shelfmark.session import stored

#: Pivots, and how many of the nearest ones a vector is known by.
PIVOTS, PREFIX = 256, 64
#: Part of a shard's vectors that is reranked, and how many at least. Where a third of all vectors lie close
#: together, places among them are mostly noise: 0.15 finds 0.86 of the true neighbours there, 0.3 0.97.
RERANK, LEAST = 0.3, 256


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's nearest pivots by cosine, nearest first; ties to the first pivot."""
    vectors, pivots = same_width(_scaled(vectors), pivots)
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)


def different(rows: DataFrame, k: int) -> DataFrame:
    """(i, ids, v): each different vector once, with the ``k`` + 1 smallest of its ids and the smallest.

    More can't be among a query's ``k`` best, as it leaves out its own id only. An id stands there as often
    as it has the vector, ``k`` times at most. Ids are cut before they are shuffled, so copies of one
    vector are no hot key.
    """
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("i"))
    few = rows.groupBy("v", "i").agg(F.count("*").alias("n")).withColumn("rank", smallest).where(F.col("rank") <= k + 1)
    each = F.sort_array(F.collect_list(F.struct("i", "n")))
    ids = F.flatten(F.transform(each, lambda x: F.array_repeat(x["i"], F.least(x["n"], F.lit(k)).cast("int"))))
    return few.groupBy("v").agg(ids.alias("ids")).select(F.col("ids")[0].alias("i"), "ids", "v")


def build(table: DataFrame, id_col: str, vector_col: str, n_pivots: int, prefix: int, k: int) -> DataFrame:
    """(i, ids, v, near): the index of all `different` usable vectors, written to the shared folder.

    Pivots are the vectors with the least hashes of their ids: a bounded sample, the same in every
    run, which the driver reads.
    """
    rows = stored(different(usable(table, id_col, vector_col).where(F.exists("v", lambda x: x != 0)), k), "different-vectors")
    some = rows.select("i", "v").orderBy(F.xxhash64("i"), "i", "v").limit(n_pivots).toArrow()
    pivots = _scaled(matrix(some["v"])) if len(some) else np.empty((0, 0))
    if len(some):
        pivots = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = nearest_pivots(matrix(batch.column("v")), pivots, prefix)
                bounds = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
                lists = pa.ListArray.from_arrays(bounds, pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("i", "ids", "v")), lists], names=["i", "ids", "v", "near"])

    return stored(rows.mapInArrow(run, "i long, ids array<long>, v array<double>, near array<short>"), "permutation-index")


class Postings:
    """Inverted files of a shard: for each pivot, which vectors have it near, and at what place."""

    def __init__(self, near: np.ndarray) -> None:
        self.n, self.prefix = near.shape
        flat = near.ravel()
        order = np.argsort(flat, kind="stable")
        self.rows, self.places = order // max(self.prefix, 1), order % max(self.prefix, 1)
        self.starts = offsets(np.bincount(flat, minlength=int(flat.max(initial=-1)) + 1))

    def distances(self, near: np.ndarray) -> np.ndarray:
        """Spearman's footrule to every vector of the shard, less a constant.

        A pivot that is not among the nearest of a vector counts as at place ``prefix``. So only
        shared pivots change a distance, and only their inverted files are read.
        """
        gain = []
        rows = []
        for i, p in enumerate(near.tolist()):
            if p + 1 < len(self.starts):
                at = slice(self.starts[p], self.starts[p + 1])
                rows.append(self.rows[at])
                gain.append(np.abs(self.places[at] - i) + self.places[at] + i - 2 * self.prefix)
        if not rows:
            return np.zeros(self.n)
        return np.bincount(np.concatenate(rows), weights=np.concatenate(gain), minlength=self.n)


@dataclass
class Shard:
    """Different vectors, the ids of each (one list after another, and its bounds), and the pivots near each."""

    vectors: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray
    near: np.ndarray


def search(shard: Shard, query_ids: np.ndarray, queries: np.ndarray, query_near: np.ndarray, k: int, part: float, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (ids, cosines) of the k best of the shard's vectors that rank first by footrule.

    All vectors are reranked that are as near by footrule as the last one taken.
    """
    postings = Postings(shard.near)
    docs, queries = same_width(shard.vectors, queries)
    docs, queries = _scaled(docs), _scaled(queries)
    norms, asked = np.sqrt((docs * docs).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    first, last, count = shard.ids[shard.bounds[:-1]], shard.ids[shard.bounds[1:] - 1], np.diff(shard.bounds)
    take = min(len(docs), max(least, int(np.ceil(part * len(docs))), k + 1))
    results = []
    for n in range(len(queries)):
        far = postings.distances(query_near[n])
        rows = np.flatnonzero(far <= np.partition(far, take - 1)[take - 1])
        rows = rows[(first[rows] != query_ids[n]) | (last[rows] != query_ids[n])]  # some id is another one
        cosine = (docs[rows] @ queries[n]) / (norms[rows] * asked[n])
        if len(rows) > k:
            best = cosine >= np.partition(cosine, len(rows) - k)[len(rows) - k]  # and all that tie
            rows, cosine = rows[best], cosine[best]
        ids, cosine = gather(shard.ids, shard.bounds[rows], count[rows]), np.repeat(cosine, count[rows])
        other = ids != query_ids[n]
        ids, cosine = ids[other], cosine[other]
        best = np.lexsort((ids, -cosine))[:k]
        results.append((ids[best], cosine[best]))
    return results


def nearest(
    table: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    n_pivots: int = PIVOTS, prefix: int = PREFIX, part: float = RERANK, least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest vectors found for each query, by cosine.

    ``is_query`` is an SQL condition on the column ``i`` that picks the queries; candidates are all
    rows but those of the query's own id. Every different vector is indexed once by its ``prefix``
    nearest pivots. In each shard the queries read the inverted files of their own pivots, and the
    vectors that rank first by footrule (``part`` of the shard, ``least`` at least, and all that tie with
    the last) are reranked by cosines of the original vectors in double precision; ties to smaller ids. More rows reranked, more
    recall: 1.0 for ``part`` is exact search.

    Null ids, null or zero vectors and vectors holding null or non-finite components take no part;
    shorter vectors count as filled up with zeros. A repeated row is one query, but each copy a
    candidate. Other columns are not read. An empty table gives an empty result.
    """
    index = build(table, id_col, vector_col, n_pivots, prefix, k)
    asking = usable(table, id_col, vector_col).where(is_query).dropDuplicates(["i", "v"])
    queries = stored(asking.join(index.select("v", "near"), "v"), "permutation-queries")
    n_rows, n_queries = index.count(), queries.count()

    def cell(shard: pa.Table, block: pa.Table) -> pa.Table:
        names = {"query_id": pa.int64(), "copy": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        parts = [pa.table({c: pa.array([], t) for c, t in names.items()})]
        if len(shard) and len(block):
            asked = block["i"].to_numpy()
            lists = shard["ids"].combine_chunks()
            bounds = lists.offsets.to_numpy().astype(np.int64)
            indexed = Shard(matrix(shard["v"]), lists.flatten().to_numpy(), bounds - bounds[0], matrix(shard["near"]))
            found = search(indexed, asked, matrix(block["v"]), matrix(block["near"]), k, part, least)
            for n, (ids, scores) in enumerate(found):
                copy = pa.array([block["copy"][n].as_py()] * len(ids), pa.int64())
                parts.append(pa.table({"query_id": pa.array(np.full(len(ids), asked[n])), "copy": copy, "vec_id": pa.array(ids), "score": pa.array(scores)}))
        return pa.concat_tables(parts)

    found = search_cells(index, queries.withColumn("copy", F.xxhash64("v")), n_rows, n_queries, cell, "query_id long, copy long, vec_id long, score double")
    place = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
