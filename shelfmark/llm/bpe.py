"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from shelfmark.llm.chunks import ChunkEncoder
from shelfmark.llm.common import by_bytes, gather, offsets

#: Fixed: the split of byte-level vocabularies, by which their files are defined.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next free code point."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in printing else next(spare)) for b in range(256)]


class Merges:
    """Merge rules as sorted pair keys, applied to many words at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, size: int) -> None:
        self.size = np.int64(size)
        keys = left.astype(np.int64) * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made.astype(np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], _NONE)

    def run(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols after all merges, new lengths) of words of ``lens`` (all 1 or more) symbols.

        In each round every word merges all places of its lowest-ranked pair, from the left; only
        pairs beside a merge are looked up again. A word without a known pair leaves the rounds.
        """
        words, symbols = np.arange(len(lens)), symbols.astype(np.int64)
        done_words, done_symbols, out_lens = [], [], np.zeros(len(lens), np.int64)
        rank = np.full(len(symbols), _NONE)  # of the pair that starts here
        owner = np.repeat(words, lens)
        inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else owner
        rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = offsets(lens)[:-1]
            least = np.minimum.reduceat(rank, starts)
            if (open_ := least < _NONE).all():
                pass
            else:
                keep = np.repeat(open_, lens)
                done_words.append(words[~open_])
                done_symbols.append(symbols[~keep])
                out_lens[words[~open_]] = lens[~open_]
                words, lens, least = words[open_], lens[open_], least[open_]
                symbols, rank = symbols[keep], rank[keep]
                if not len(words):
                    break
                starts = offsets(lens)[:-1]
            at = np.flatnonzero(rank == np.repeat(least, lens))
            if len(at) > 1 and (close := np.diff(at) == 1).any():  # a run of one pair, as in "aaa"
                head = np.concatenate([[True], ~close])
                at = at[(at - at[head][np.cumsum(head) - 1]) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            owner = np.repeat(np.arange(len(lens)), lens)
            lens = lens - np.bincount(owner[at], minlength=len(lens))
            at = place[at]
            symbols, rank, owner = symbols[keep], rank[keep], owner[keep]
            last = offsets(lens)[1:] - 1
            look = np.concatenate([at, at[at > 0] - 1])
            rank[look] = _NONE
            look = look[owner[look] == owner[np.minimum(look + 1, len(owner) - 1)]]
            look = look[look < len(symbols) - 1]
            rank[look] = self._rank(symbols[look], symbols[look + 1])
            rank[last] = _NONE
        if not done_words:
            return symbols, out_lens
        order = np.concatenate(done_words)
        flat = np.concatenate(done_symbols)
        starts = np.empty(len(order), np.int64)
        starts[order] = offsets(out_lens[order])[:-1]
        return gather(flat, starts, out_lens), out_lens


class ByteBpe:
    """A byte-level vocabulary file: texts to ids and back, as its own library does."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = spec.get("added_tokens", [])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self._merges = Merges(left, right, np.array([vocab[a + b] for a, b in pairs], np.int64), size)
        letters = byte_letters()
        self._first = np.array([vocab[c] for c in letters], np.int64)
        byte_of = {c: i for i, c in enumerate(letters)}
        spelled = [b""] * size
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self._spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self._spelled_lens = np.fromiter(map(len, spelled), np.int64, size)
        self._spelled_starts = offsets(self._spelled_lens)[:-1]
        self._special = {t["content"]: t["id"] for t in added}
        self._at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self._special, key=len, reverse=True))) + ")") if added else None
        self._find = regex.compile(PATTERN).findall
        self._library = Tokenizer.from_file(path)  # only for how it splits letters of rare scripts
        self._unspell = {c: bytes([i]) for i, c in enumerate(letters)}
        self._encoder = ChunkEncoder(self._encode)

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii() or max(text) < "԰":
            return self._find(text)
        # newer letters than the regex module knows may exist: take the library's own split
        return [
            b"".join(self._unspell[c] for c in w).decode("utf-8")
            for w, _ in self._library.pre_tokenizer.pre_tokenize_str(text)
        ]

    def _words(self, chunk: str) -> list[str]:
        # most chunks are a blank and letters, or that and one mark
        if (body := chunk[1:]).isalpha() and chunk[0] == " " and (chunk.isascii() or max(chunk) < "԰"):
            return [chunk]
        if body[:-1].isalpha() and chunk[0] == " " and body[-1] in ".,;:!?|" and (chunk.isascii() or max(chunk) < "԰"):
            return [chunk[:-1], chunk[-1]]
        if self._at_special is None or not self._at_special.search(chunk):
            return self._plain_words(chunk)
        parts = self._at_special.split(chunk)
        return [w for p in parts if p for w in ([p] if p in self._special else self._plain_words(p))]

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self._words(c) for c in chunks]
        words = [w for p in split for w in p]
        raw = [w.encode("utf-8") for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        ids, lens = self._merges.run(self._first[np.frombuffer(b"".join(raw), np.uint8)], lens)
        ids = ids.astype(np.uint32)
        special = [i for i, w in enumerate(words) if w in self._special]
        if special:
            parts = np.split(ids, np.cumsum(lens)[:-1])
            for i in special:
                parts[i], lens[i] = np.array([self._special[words[i]]], np.uint32), 1
            ids = np.concatenate(parts)
        return ids, np.diff(offsets(lens)[offsets(np.fromiter(map(len, split), np.int64, len(split)))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text); nulls count as empty."""
        return self._encoder.texts(texts)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids; bytes that are no UTF-8 become U+FFFD."""
        lens = self._spelled_lens[ids]
        flat = gather(self._spelled, self._spelled_starts[ids], lens)
        ends = offsets(lens)[bounds]
        blob = flat.tobytes()
        parts = [blob[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [p if p.isascii() else p.decode("utf-8", "replace").encode("utf-8") for p in parts]


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One per Python worker and file."""
    return ByteBpe(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text.

    Null and empty texts have no ids; a null id, repeated ids and repeated rows are kept as they
    are, one row out for each row in. Other columns are not read. ``path`` names a byte-level
    vocabulary file that every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            ids, bounds = byte_bpe(path).encode(batch.column("t"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("i"), lists], names=["i", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    return wanted.mapInArrow(run, f"i {kind}, ids array<int>").withColumnRenamed("i", id_col)


def decode_ids(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column("ids")
                lens = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = byte_bpe(path).decode(flat, offsets(lens))
                yield pa.RecordBatch.from_arrays(
                    [part.column("i"), pa.array([t.decode("utf-8") for t in texts], pa.string())], names=["i", "text"]
                )

    kind = rows.schema[id_col].dataType.simpleString()
    wanted = rows.select(rows[id_col].alias("i"), rows[ids_col].alias("ids"))
    return wanted.mapInArrow(run, f"i {kind}, text string").withColumnRenamed("i", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, decoded again, and digested.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8. Null
    texts count as empty; rows are neither merged nor dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            bpe = byte_bpe(path)
            ids, bounds = bpe.encode(batch.column("t"))
            blob, ends = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            hashes = [hashlib.sha256(blob[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            texts = [hashlib.sha256(t).hexdigest() for t in bpe.decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(np.diff(bounds)), pa.array(hashes, pa.string()), pa.array(texts, pa.string())],
                names=["i", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    schema = f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return wanted.mapInArrow(run, schema).withColumnRenamed("i", id_col)
