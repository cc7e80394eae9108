"""Whole texts through a vocabulary file of the tokenizers library."""

from __future__ import annotations

import functools
import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from shelfmark.llm.bpe import byte_letters
from shelfmark.llm.chunks import ChunkEncoder, Known
from shelfmark.llm.common import gather, offsets

#: Marks that no pre-tokenizer here joins to the letters before them.
_MARKS = frozenset(".,;:!?|")


class LibraryEncoder:
    """Ids as the library gives them, asking it for each different word once in a while.

    A chunk of a blank and Latin letters, or that and one mark, is asked for in those parts, any
    other chunk as a whole; both give the library's own ids of the text.
    """

    def __init__(self, path: str, limit: int = 600_000, plain: bool = False) -> None:
        """``plain``: strings of special tokens are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = plain
        self._library.no_truncation()
        self._library.no_padding()
        self._folds = self._library.normalizer is not None and self._probe("  Ab") == self._probe("ab")
        self._blanks = self._probe(" ab") != self._probe("ab")
        self._known = Known(limit)
        self._encoder = ChunkEncoder(self._encode, min(limit, 300_000))

    def _probe(self, text: str) -> list[int]:
        return self._library.encode(text, add_special_tokens=False).ids

    def _words(self, chunk: str) -> list[str]:
        if chunk[:1] != " " or not (chunk.isascii() or max(chunk) < "ʰ"):
            return [chunk]
        body, mark = (chunk[1:-1], chunk[-1:]) if chunk[-1] in _MARKS else (chunk[1:], "")
        if self._folds:
            body = body.lower()
        if not body.isalpha():
            return [chunk]
        word = " " + body if self._blanks else body
        return [word, mark] if mark else [word]

    def _ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self._library.encode_batch_fast(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum())), lens

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self._words(c) for c in chunks]
        coded = pc.dictionary_encode(pa.array([w for p in split for w in p], pa.large_string()))
        ids, starts, lens = self._known.find(coded.dictionary, self._ask)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_word = lens[codes]
        bounds = offsets(np.fromiter(map(len, split), np.int64, len(split)))
        return gather(ids, starts[codes], per_word), np.diff(offsets(per_word)[bounds])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text); nulls count as empty."""
        return self._encoder.texts(texts)

    @functools.cached_property
    def _spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        byte_of = {c: bytes([n]) for n, c in enumerate(byte_letters())}
        size = self._library.get_vocab_size()
        names = [self._library.id_to_token(i) or "" for i in range(size)]
        spelled = [b"".join(byte_of.get(c, c.encode()) for c in name) for name in names]
        lens = np.fromiter(map(len, spelled), np.int64, size)
        return np.frombuffer(b"".join(spelled), np.uint8), lens, offsets(lens)[:-1]

    def spelling(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all entries of a byte-level vocabulary, how many each id has, where they start)."""
        return self._spelled


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One per Python worker and file."""
    return LibraryEncoder(path)


@functools.lru_cache(maxsize=1)
def plain_encoder(path: str) -> LibraryEncoder:
    """One per Python worker, for texts in which no string is a special token."""
    return LibraryEncoder(path, plain=True)
