"""Best-fit packing of token sequences in bulk-synchronous rounds over lengths."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfmark.llm.common import by_bytes
from shelfmark.llm.library import library_encoder
from shelfmark.session import stored

#: Pieces of one length that are ranked together, about.
RANKED = 20_000


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(key, doc_id, piece, start, length, ids_crc32): documents cut to ``capacity`` ids at most.

    A document is its text's ids and ``end_id``. Only longer ones are cut, into full pieces after a
    first one that may be shorter. Null texts count as empty: the end id alone. ``key`` numbers
    the pieces, so repeated and null ids are no trouble. ``ids_crc32`` is taken over little-endian
    unsigned 32-bit ids. Other columns are not read.
    """
    names = ["key", "i", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key = library_encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "t"):
            ids, bounds = encoder.texts(batch.column("t"))
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
            lens = np.diff(bounds)
            count = -(-lens // capacity)
            doc = np.repeat(np.arange(len(lens)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = lens - (count - 1) * capacity
            start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, head[doc])
            blob, at = ids.astype("<u4").tobytes(), (bounds[:-1][doc] + start) * 4
            ends = at + length * 4
            crc = [zlib.crc32(blob[a:b]) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
            columns = [key + np.arange(len(doc)), batch.column("i").take(pa.array(doc)), piece.astype(np.int32), start, length, np.array(crc, np.int64)]
            key += len(doc)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    schema = f"key long, i {kind}, piece int, start long, length long, ids_crc32 long"
    return wanted.mapInArrow(run, schema).withColumnRenamed("i", "doc_id")


@dataclass
class Fillings:
    """Which places pieces of a length get, by rank: one entry for pieces that fill equal gaps alike.

    Entry e gives the pieces of ``length[e]`` from rank ``rank[e]`` on their places: ``each[e]`` of them
    go into each of the sequences from ``first[e]`` on, the first at ``offset[e]``. Entries are in order of
    length and rank.
    """

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and rank: a successor sweep over the entries."""
        shift = np.int64(1) << 40
        at = np.searchsorted(self.length * shift + self.rank, length * shift + rank, "right") - 1
        nth = rank - self.rank[at]
        return self.first[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def best_fit(counts: dict[int, int], capacity: int) -> Fillings:
    """Best-fit decreasing of ``counts[length]`` pieces, a round for each length, longest first.

    Sequences with the same gap are interchangeable and pieces of the same length are, so gaps are held
    in order of size as ranges of sequence numbers, never one by one. In a round the pieces of a length go
    to the successor of their length among the gaps, as many to each gap as it holds; ranks say which
    piece goes where. The gaps are updated, and what is left looks for its successor again; new sequences
    open where there is none. The result is that of the sequential algorithm, in fewer steps: a
    gap that is filled up shrinks to less than half, and a length leaves one gap half filled, so there are
    at most 4 * capacity * (1 + log2 capacity) entries, however many pieces there are.
    """
    open_: list[int] = []  # sizes of gaps, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # (first sequence, how many) with a gap of that size
    entries: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in ranges:
                bisect.insort(open_, gap)
                ranges[gap] = []
            ranges[gap].append((first, n))

    for length in sorted((n for n, count in counts.items() if count), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(open_, length)
            if at == len(open_):
                need = -(-left // (capacity // length))
                put(capacity, opened, need)
                opened += need
            gap = open_[at]
            first, n = ranges[gap].pop()
            if not ranges[gap]:
                del ranges[gap], open_[at]
            each = gap // length
            whole = min(n, left // each)
            if whole:
                entries.append((length, rank, each, first, capacity - gap))
                put(gap - each * length, first, whole)
            rank, left, first, n = rank + whole * each, left - whole * each, first + whole, n - whole
            if n and left:
                entries.append((length, rank, each, first, capacity - gap))
                put(gap - left * length, first, 1)
                left, first, n = 0, first + 1, n - 1
            put(gap, first, n)
    entries.sort()
    return Fillings(*np.array(entries, np.int64).reshape(-1, 5).T)


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """All columns of ``items`` (key, length, ...), and sequence_id and offset: places in few sequences.

    The pieces are counted by length on the executors; the driver gets ``capacity`` counts at most and
    plans the rounds (`best_fit`). A piece's rank among those of its length is its place in a salted
    group of the length plus the sizes of the groups before, and tasks look its place up by rank. So
    each piece is shuffled once, a common length spreads over many groups, and nothing that grows with
    the pieces reaches the driver. Keys must be unique, lengths between 1 and ``capacity``. An empty table
    gives an empty result.
    """
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row a length
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths are not between 1 and {capacity}")
    plan = best_fit(counts, capacity)
    salts = 1 + sum(counts.values()) // RANKED
    whole = F.struct(*items.columns).alias("item")  # so that other columns may have any names
    salted = items.select("length", F.pmod(F.xxhash64("key"), F.lit(salts)).alias("salt"), "key", whole)
    own = [c + "_" * (1 + max(map(len, items.columns))) for c in ("length", "rank")]  # names that no column has
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("key")) - 1
    ranked = salted.withColumn("nth", nth).join(sizes, ["length", "salt"])
    ranked = ranked.select(F.col("length").alias(own[0]), (F.col("before") + F.col("nth")).alias(own[1]), "item.*")
    names = [*items.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = plan.places(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *map(pa.array, found)], names=names)

    schema = StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(run, schema)


def packed(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``."""
    cut = stored(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pack-pieces")
    return pack(cut, capacity).drop("key")
