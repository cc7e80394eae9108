"""SentencePiece encoding and decoding in vectorised merge rounds."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from shelfmark.llm.chunks import Known
from shelfmark.llm.common import by_bytes, decimals, gather, offsets

#: Fixed: the mark that stands for a blank.
MARK = "▁"
_NONE = np.int64(1) << 40


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts one after another, how many each has)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), lens


class PieceMerges:
    """What two neighbouring symbols merge to, and how soon, as sorted pair keys.

    A symbol below ``size`` is a piece, any other one ``size`` plus the code point of a character that
    is no piece. ``rank`` orders pieces by falling score; pieces of one score share a rank.
    """

    def __init__(self, pieces: dict[str, int], scores: dict[str, float], size: int) -> None:
        self.size, self.span = size, size + 0x110000
        self.symbol = np.arange(0x110000, dtype=np.int32) + np.int32(size)
        for text, i in pieces.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        order = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.full(size, _NONE)
        for text, i in pieces.items():
            self.rank[i] = order[scores[text]]
        rank, symbol = self.rank.tolist(), self.symbol
        pairs: dict[int, int] = {}
        beside: set[int] = set()
        early: set[int] = set()
        for text, i in pieces.items():
            beside.update((ord(a) << 21) | ord(b) for a, b in zip(text, text[1:], strict=False))
            for cut in range(1, len(text)):
                sides = []
                for part in (text[:cut], text[cut:]):
                    known = pieces.get(part)
                    if known is not None and rank[known] >= rank[i]:
                        early.add(known)
                    sides.append(known if known is not None else int(symbol[ord(part)]) if len(part) == 1 else None)
                if None not in sides:
                    pairs[sides[0] * self.span + sides[1]] = i
        keys = np.fromiter(pairs, np.int64, len(pairs))
        sort = np.argsort(keys)
        self.keys, self.made = keys[sort], np.fromiter(pairs.values(), np.int64, len(pairs))[sort]
        #: Pairs of characters that stand beside each other in some piece; no merge crosses any other place.
        self.beside = np.sort(np.fromiter(beside, np.int64, len(beside)))
        #: Pieces whose own merge may open a pair that comes no later: of these, one is made at a time.
        self.single = np.zeros(size, bool)
        self.single[list(early)] = True

    def words(self, points: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Lengths of the parts that texts fall into where no piece holds both neighbours."""
        head = np.zeros(len(points), bool)
        head[offsets(lens)[:-1][lens > 0]] = True
        if len(points) > 1:
            want = (points[:-1] << 21) | points[1:]
            at = np.minimum(np.searchsorted(self.beside, want), len(self.beside) - 1)
            head[1:] |= self.beside[at] != want
        return np.diff(np.append(np.flatnonzero(head), len(points)))

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        want = a * self.span + b
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.made[at], -1)

    def run(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols after all merges, how many each word has) of words of ``lens`` (1 or more) symbols.

        In each round every word merges the places of its least rank, from the left and without
        overlap, and the flat arrays are compacted; a word without a pair leaves the rounds. Places
        merge together only where no new pair can come before the next of them (`single`), so the
        result is that of one merge after another, the best and then leftmost pair first.
        """
        words = np.arange(len(lens))
        out_lens = np.zeros(len(lens), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        ranks = np.append(self.rank, _NONE)  # the last one is that of no piece, -1
        owner = np.repeat(words, lens)
        made = np.full(len(symbols), -1)  # by the pair that starts here
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        made[inside] = self._look(symbols[inside], symbols[inside + 1])
        while len(words):
            rank = ranks[made]
            least = np.minimum.reduceat(rank, offsets(lens)[:-1])
            live = least < _NONE
            if not live.all():
                keep = np.repeat(live, lens)
                done.append((words[~live], symbols[~keep]))
                out_lens[words[~live]] = lens[~live]
                words, lens, least = words[live], lens[live], least[live]
                symbols, made, rank = symbols[keep], made[keep], rank[keep]
                if not len(words):
                    break
            owner = np.repeat(np.arange(len(lens)), lens)
            at = np.flatnonzero(rank == least[owner])
            if len(at) > 1:
                head = np.append(True, np.diff(at) != 1)  # places that follow each other share symbols
                if not head.all():
                    at = at[(at - at[head][np.cumsum(head) - 1]) % 2 == 0]
                first = np.append(True, np.diff(owner[at]) != 0)
                # up to and including the first place of a word that has to be merged alone
                alone = self.single[made[at]]
                earlier = np.cumsum(alone) - alone
                at = at[earlier == earlier[first][np.cumsum(first) - 1]]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            lens = lens - np.bincount(owner[at], minlength=len(lens))
            symbols, made, owner = symbols[keep], made[keep], owner[keep]
            look = np.concatenate([place, place[place > 0] - 1])
            made[look] = -1
            look = look[look + 1 < len(symbols)]
            look = look[owner[look] == owner[look + 1]]
            made[look] = self._look(symbols[look], symbols[look + 1])
        order = np.concatenate([w for w, _ in done]) if done else words
        flat = np.concatenate([s for _, s in done]) if done else symbols
        starts = np.empty(len(order), np.int64)
        starts[order] = offsets(out_lens[order])[:-1]
        return gather(flat, starts, out_lens), out_lens


class Sentences:
    """A model file of byte-pair pieces with byte fallback: texts to ids and back, as its own library does.

    The library is asked for the pieces and their scores only. Models of another kind are refused:
    those without byte fallback, with a blank before texts missing, with texts rewritten or blanks
    joined, or with pieces of the user's own or unused ones.
    """

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        hidden = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        bytes_ = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        if len(bytes_) < 256 or any(map(model.is_unused, range(size))) or model.normalize(" Ａ  b ") != f"{MARK * 2}Ａ{MARK * 2}b{MARK}":
            raise ValueError(f"{path} is no model of byte-pair pieces with byte fallback and untouched texts")
        pieces = {n: i for i, n in enumerate(names) if not hidden[i] and not model.is_byte(i)}
        self._merges = PieceMerges(pieces, {n: model.get_score(i) for n, i in pieces.items()}, size)
        self._byte_id = np.array([bytes_[b] for b in range(256)], np.int64)
        byte_of = {i: b for b, i in bytes_.items()}
        spelled = [b"" if hidden[i] else bytes([byte_of[i]]) if i in byte_of else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        spelled[model.unk_id()] = " ⁇ ".encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_lens = np.fromiter(map(len, spelled), np.int64, size)
        self.spelled_starts = offsets(self.spelled_lens)[:-1]
        self._silent = np.array([model.is_control(i) for i in range(size)])
        self._marked = np.array([n.startswith(MARK) for n in names]) & ~self._silent
        self._is_byte = np.zeros(size, bool)
        self._is_byte[list(byte_of)] = True
        self._known = Known(300_000)

    def _fall_back(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the ids of their bytes."""
        odd = np.flatnonzero(symbols >= self._merges.size)
        if not len(odd):
            return symbols, lens
        raw = [chr(c).encode() for c in (symbols[odd] - self._merges.size).tolist()]
        count = np.ones(len(symbols), np.int64)
        count[odd] = np.fromiter(map(len, raw), np.int64, len(raw))
        out = np.repeat(symbols, count)
        at = np.repeat(offsets(count)[:-1][odd], count[odd]) + np.concatenate([np.arange(len(r)) for r in raw])
        out[at] = self._byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.diff(offsets(count)[offsets(lens)])

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, lens = code_points(chunks)
        words = self._merges.words(points, lens)
        inside = np.cumsum(words)
        symbols, counts = self._merges.run(self._merges.symbol[points].astype(np.int64), words)
        symbols, counts = self._fall_back(symbols, counts)
        per_chunk = np.diff(offsets(counts)[np.searchsorted(inside, offsets(lens), "left") + (offsets(lens) > 0)])
        return symbols.astype(np.uint32), per_chunk

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of each text); nulls count as empty.

        Texts are cut at blanks, runs of which stay together; each different chunk is encoded once
        in a while.
        """
        texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), MARK, " ")
        pieces = pc.split_pattern(texts, " ")
        bounds = pieces.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        values = pieces.flatten()
        empty = pc.equal(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        last = np.zeros(len(values), bool)
        last[bounds[1:] - 1] = True
        lone = np.diff(bounds) == 1
        none = np.zeros(len(values), bool)  # texts without any character
        none[bounds[:-1][lone]] = empty[bounds[:-1][lone]]
        ends = np.flatnonzero((~empty | last) & ~none)
        starts = np.flatnonzero(~empty | last)
        first = np.append(0, starts[:-1] + 1)[np.searchsorted(starts, ends)]
        blanks = ends - first + 1
        chunk = pc.binary_join_element_wise(pc.binary_repeat(pa.scalar(MARK, pa.large_string()), pa.array(blanks)), values.take(pa.array(ends)), pa.scalar("", pa.large_string()))
        coded = pc.dictionary_encode(chunk)
        ids, at, lens = self._known.find(coded.dictionary, self._encode)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_chunk = lens[codes]
        return gather(ids, at[codes], per_chunk), offsets(per_chunk)[np.searchsorted(ends, bounds)]

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids one after another, how many each has), the first blank of a text included."""
        lens = self.spelled_lens[ids]
        return gather(self.spelled, self.spelled_starts[ids], lens), lens

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids without the blank put before it; bytes that are no UTF-8 become U+FFFD."""
        flat, lens = self.spell(ids)
        ends = offsets(lens)
        blob, cuts = flat.tobytes(), bounds.tolist()
        seen = offsets(~self._silent[ids])  # ids before each place that say something
        at = np.searchsorted(seen, seen[bounds[:-1]] + 1) - 1  # the first such id of each run
        at = np.minimum(at, max(len(ids) - 1, 0))
        drop = self._marked[ids[at]] & (at < bounds[1:]) if len(ids) else np.zeros(len(bounds) - 1, bool)
        parts = [blob[a + d : b] for a, b, d in zip(ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist(), drop.tolist(), strict=True)]
        for n, part in enumerate(parts):
            if not part.isascii():
                try:
                    part.decode("utf-8")
                except UnicodeDecodeError:
                    parts[n] = self._mend(ids[cuts[n] : cuts[n + 1]], bool(drop[n]))
        return parts

    def _mend(self, ids: np.ndarray, drop: bool) -> bytes:
        """Run by run of byte ids; each byte that is no UTF-8 becomes U+FFFD."""
        kinds = self._is_byte[ids]
        cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(ids)]
        out = b""
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            raw = self.spell(ids[a:b])[0].tobytes()
            while kinds[a] and raw:
                try:
                    out += raw.decode("utf-8").encode()
                    raw = b""
                except UnicodeDecodeError as e:
                    out += raw[: e.start] + "�".encode()
                    raw = raw[e.start + 1 :]
            out += raw
        return out[1:] if drop else out


@functools.lru_cache(maxsize=2)
def sentences(path: str) -> Sentences:
    """One per Python worker and file."""
    return Sentences(path)


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text.

    Null and empty texts have no ids; a null id, repeated ids and repeated rows are kept as they
    are, one row out for each row in. Other columns are not read. ``path`` names a model file that
    every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            ids, bounds = sentences(path).encode(batch.column("t"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("i"), lists], names=["i", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    return wanted.mapInArrow(run, f"i {kind}, ids array<int>").withColumnRenamed("i", id_col)


def decode_pieces(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of ids; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "raw"):
            flat = [np.frombuffer(r or b"", ">i4").astype(np.int64) for r in batch.column("raw").to_pylist()]
            lens = np.fromiter(map(len, flat), np.int64, len(flat))
            texts = sentences(path).decode(np.concatenate(flat), offsets(lens))
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array([t.decode() for t in texts], pa.string())], names=["i", "text"])

    kind = rows.schema[id_col].dataType.simpleString()
    raw = f"unhex(array_join(transform(`{ids_col}`, x -> lpad(hex(x), 8, '0')), ''))"  # batches are cut by bytes
    wanted = rows.selectExpr(f"`{id_col}` AS i", f"{raw} AS raw")
    return wanted.mapInArrow(run, f"i {kind}, text string").withColumnRenamed("i", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, decoded again, and digested.

    Ids are hashed as decimal numbers joined by commas, the decoded text as UTF-8. Null texts count
    as empty; rows are neither merged nor dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            model = sentences(path)
            ids, bounds = model.encode(batch.column("t"))
            separators = np.full(len(ids), ord(","), np.uint8)
            separators[bounds[1:][np.diff(bounds) > 0] - 1] = 0
            blob, cuts = decimals(ids, separators, bounds)
            hashes = [hashlib.sha256(blob[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            texts = [hashlib.sha256(t).hexdigest() for t in model.decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(np.diff(bounds)), pa.array(hashes, pa.string()), pa.array(texts, pa.string())],
                names=["i", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    schema = f"i {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return wanted.mapInArrow(run, schema).withColumnRenamed("i", id_col)
