"""Tokens of two tokenizers over the same texts, aligned by coalescing their byte intervals."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import by_bytes, decimals, gather, offsets
from shelfmark.llm.library import plain_encoder
from shelfmark.llm.sentences import sentences
from shelfmark.session import stored


@dataclass
class Tokens:
    """Token ids of texts one after another, bounds of each text, bytes of each token, and their spelling."""

    ids: np.ndarray
    bounds: np.ndarray
    lens: np.ndarray
    bytes: np.ndarray

    def of(self, keep: np.ndarray) -> Tokens:
        """Without the tokens of texts that are not kept; these have none then."""
        counts = np.diff(self.bounds)
        tokens = np.repeat(keep, counts)
        return Tokens(self.ids[tokens], offsets(counts * keep), self.lens[tokens], self.bytes[np.repeat(tokens, self.lens)])

    def text_bytes(self) -> np.ndarray:
        """Where each text starts among the bytes, and the end."""
        return offsets(self.lens)[self.bounds]


def letters_tokens(path: str, texts: pa.Array) -> Tokens:
    """By a byte-level vocabulary file; strings of special tokens are plain text."""
    encoder = plain_encoder(path)
    ids, bounds = encoder.texts(texts)
    spelled, lens, starts = encoder.spelling()
    return Tokens(ids, bounds, lens[ids], gather(spelled, starts[ids], lens[ids]))


def pieces_tokens(path: str, texts: pa.Array) -> Tokens:
    """By a model file of pieces, which puts a blank before each text."""
    model = sentences(path)
    ids, bounds = model.encode(texts)
    spelled, lens = model.spell(ids)
    return Tokens(ids, bounds, lens, spelled)


def same_texts(a: Tokens, b: Tokens, texts: pa.Array) -> np.ndarray:
    """Which texts are not empty and have both tokenizers' bytes equal to a blank and their own."""
    ends = [x.text_bytes().tolist() for x in (a, b)]
    blobs = [x.bytes.tobytes() for x in (a, b)]
    own = [b"" if not t else b" " + t for t in texts.cast(pa.large_binary()).to_pylist()]
    return np.array(
        [bool(t) and all(blob[e[n] : e[n + 1]] == t for blob, e in zip(blobs, ends, strict=True)) for n, t in enumerate(own)], bool
    )


@dataclass
class Groups:
    """Where texts are cut: group ``a_group[i]`` holds token i of A, ``b_group[j]`` token j of B."""

    a_group: np.ndarray
    b_group: np.ndarray
    n: int


def coalesce(a_ends: np.ndarray, a_lens: np.ndarray, b_ends: np.ndarray, b_lens: np.ndarray) -> Groups:
    """Groups of tokens whose byte ranges hang together.

    All tokens are sorted by start; a group ends where the next start reaches the furthest end so far.
    """
    ends = np.concatenate([a_ends, b_ends])
    starts = ends - np.concatenate([a_lens, b_lens])
    order = np.lexsort((np.arange(len(ends)), starts))
    reach = np.maximum.accumulate(ends[order]) if len(ends) else ends
    head = np.ones(len(ends), bool)
    head[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(head) - 1
    return Groups(group[: len(a_ends)], group[len(a_ends) :], int(head.sum()))


def overlaps(a_ends: np.ndarray, a_lens: np.ndarray, b_ends: np.ndarray, b_lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of all pairs that share a byte; ranges of a side follow each other."""
    first = np.searchsorted(b_ends, a_ends - a_lens, "right")
    count = np.maximum(np.searchsorted(b_ends - b_lens, a_ends, "left") - first, 0)
    a = np.repeat(np.arange(len(a_ends)), count)
    return a, np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(a))


def spelled_groups(a: Tokens, b: Tokens, groups: Groups) -> tuple[bytes, list[int]]:
    """(``a1,a2|b1;a3|b2,b3`` of all texts one after another, where each starts)."""
    size_a, size_b = (np.bincount(g, minlength=groups.n) for g in (groups.a_group, groups.b_group))
    at_a = np.arange(len(a.ids)) + offsets(size_b)[groups.a_group]
    at_b = np.arange(len(b.ids)) + offsets(size_a)[groups.b_group + 1]
    ids = np.empty(len(a.ids) + len(b.ids), np.int64)
    ids[at_a], ids[at_b] = a.ids, b.ids
    ends = np.full(len(ids), ord(","), np.uint8)
    ends[at_a[offsets(size_a)[1:] - 1]] = ord("|")
    ends[at_b[offsets(size_b)[1:] - 1]] = ord(";")
    bounds = a.bounds + b.bounds
    ends[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    return decimals(ids, ends, bounds)


@dataclass
class Slice:
    """What a slice of texts gives: counts and groups of each text, and its links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: bytes
    cuts: list[int]
    pairs: np.ndarray  #: (id of A, id of B) as one number, of each link
    links: np.ndarray  #: bounds of each text's links


def align(a: Tokens, b: Tokens, texts: pa.Array) -> Slice:
    """Groups and links of a slice of texts; links are the overlapping pairs that end together."""
    keep = same_texts(a, b, texts)
    a, b = a.of(keep), b.of(keep)
    a_ends, b_ends = np.cumsum(a.lens), np.cumsum(b.lens)
    groups = coalesce(a_ends, a.lens, b_ends, b.lens)
    i, j = overlaps(a_ends, a.lens, b_ends, b.lens)
    together = a_ends[i] == b_ends[j]
    i, j = i[together], j[together]
    n_groups = np.append(groups.a_group, groups.n)[a.bounds]  # groups before each text
    blob, cuts = spelled_groups(a, b, groups)
    return Slice(np.diff(a.bounds), np.diff(b.bounds), np.diff(n_groups), blob, cuts, (a.ids[i].astype(np.int64) << 32) | b.ids[j].astype(np.int64), np.searchsorted(i, a.bounds))


def aligned(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    show: Callable[[bytes], str] = bytes.decode,
) -> DataFrame:
    """(block, i, n_a, n_b, n_groups, groups, links, pairs, times): every text's alignment.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, the ids of both sides between places where tokens of both end,
    as ``show`` gives it; empty without tokens. A text has no tokens if it is null or empty, or if what
    the tokens of a side spell isn't a blank and the text. Rows are neither merged nor dropped; ids may
    be null or repeat; other columns are not read.

    Texts that a task took together are a block. The first row of a block has its different linked id
    pairs (A's id times 2^32, and B's) with the number of links in it; ``links`` has each link of a text
    as a place in that list, in 2 bytes if the list is short enough, else in 4.
    """
    names = ["block", "i", "n_a", "n_b", "n_groups", "groups", "links", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in by_bytes(batches, "t"):
            texts = pc.fill_null(batch.column("t").cast(pa.large_string()), "")
            blank = pa.scalar(" ", pa.large_string())
            got = align(letters_tokens(a_path, pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string()))), pieces_tokens(b_path, texts), texts)
            pairs, codes, times = np.unique(got.pairs, return_inverse=True, return_counts=True)
            width = 2 if len(pairs) <= 1 << 16 else 4
            blob = codes.astype(f"<u{width}").tobytes()
            at = (got.links * width).tolist()
            rest = [None] * (batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, block)), batch.column("i"), *map(pa.array, (got.n_a, got.n_b, got.n_groups)),
                    pa.array([show(got.groups[x:y]) if y > x else "" for x, y in zip(got.cuts[:-1], got.cuts[1:], strict=True)], pa.string()),
                    pa.array([blob[x:y] for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    pa.array([pairs, *rest], pa.list_(pa.int64())), pa.array([times, *rest], pa.list_(pa.int64())),
                ],
                names=names,
            )
            block += 1

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    return wanted.mapInArrow(run, f"block long, i {kind}, n_a long, n_b long, n_groups long, groups string, links binary, pairs array<long>, times array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n, best): how many links of all `aligned` texts link two ids, and whether none of b's has more."""
    each = _pairs(rows).groupBy("pair").agg(F.sum("times").alias("n"))
    counts = stored(each.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n"), "align-counts")
    return counts.join(counts.groupBy("b").agg(F.max("n").alias("most")), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _pairs(rows: DataFrame) -> DataFrame:
    """(block, code, pair, times): a row for each block and pair, so that common pairs are no hot keys."""
    listed = F.posexplode(F.arrays_zip("pairs", "times")).alias("code", "x")
    return rows.where("pairs is not null").select("block", listed).select("block", "code", "x.pairs", "x.times").withColumnRenamed("pairs", "pair")


def linked(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    show: Callable[[bytes], str] = bytes.decode,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups): `aligned` texts with corpus-wide counts.

    A link is a pair of tokens that end together, its count that of its id pair's links in all texts.
    ``count_sum`` adds the counts of a text's links; ``n_best`` is how many of its links have the highest
    count of all pairs of their B id. Pairs are counted per block before they are shuffled, and blocks
    get the counts of their own pairs back.
    """
    rows = stored(aligned(docs, a_path, b_path, id_col, text_col, show), "align-texts")
    pair = F.shiftleft("a", 32).bitwiseOR(F.col("b"))
    counts = pair_counts(rows).select(pair.alias("pair"), "n", "best")
    back = _pairs(rows).join(counts, "pair").select(F.col("block").alias("of"), "code", "n", "best")
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["i", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def fill(texts: pa.Table, known: pa.Table) -> pa.Table:
        n = np.zeros(len(known), np.int64)
        best = np.zeros(len(known), np.int64)
        codes = known["code"].to_numpy()
        n[codes], best[codes] = known["n"].to_numpy(), known["best"].to_numpy()
        lists = [np.frombuffer(x, f"<u{2 if len(known) <= 1 << 16 else 4}") for x in texts["links"].to_pylist()]
        lens = np.fromiter(map(len, lists), np.int64, len(lists))
        flat, bounds = np.concatenate(lists).astype(np.int64), offsets(lens)
        sums = [np.diff(offsets(x[flat])[bounds]) for x in (best, n)]
        columns = [*(texts[c] for c in names[:4]), pa.array(lens), *map(pa.array, sums), texts["groups"]]
        return pa.table(dict(zip(names, columns, strict=True)))

    whole = rows.drop("pairs", "times").groupBy("block").cogroup(back.groupBy("of"))
    schema = f"i {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return whole.applyInArrow(fill, schema).withColumnRenamed("i", id_col)


def digested(groups: bytes) -> str:
    """Groups as their sha256, where they themselves are not needed."""
    return hashlib.sha256(groups).hexdigest()
