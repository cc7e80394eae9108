"""Texts as sequences of repeating chunks, so that tokenizers see each different chunk once.

A text is cut before a blank or a line feed that follows a character other than white space. No
pre-tokenizer pattern used here has a match across such a place: runs of letters, digits or marks
end before white space, and runs of white space start there.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfmark.llm.common import gather, offsets

#: Everything some library counts as white space; a cut is never made after one of these.
BLANK = "\x09-\x0d\x1c-\x20\x85\xa0 ᠎ -​    ⁠　﻿"
_ENDS_BLANK = f"[{BLANK}]$"
_CUT = re.compile(f"(?<=[^{BLANK}])(?=[ \\n])").split


def split_texts(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each chunk in order, the chunk of each code, bounds of each text's chunks).

    Joining a text's chunks gives the text. Nulls count as empty texts.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    bounds = pieces.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    values = pieces.flatten()
    encoded = pc.dictionary_encode(values)
    different = encoded.dictionary
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    heads, own = np.unique(codes[bounds[:-1]], return_inverse=True)  # no blank before a text
    codes[bounds[:-1]] = own + len(different)
    blank = pc.if_else(pc.starts_with(different, "\n"), "", " ").cast(pa.large_string())
    rest = pc.binary_join_element_wise(blank, different, pa.scalar("", pa.large_string()))
    keys = pa.concat_arrays([rest, different.take(pa.array(heads))])
    ends_blank = pc.match_substring_regex(keys, _ENDS_BLANK).to_numpy(zero_copy_only=False)
    inner = np.ones(len(values), bool)  # chunks with another one after them in their text
    inner[bounds[1:] - 1] = False
    if (ends_blank[codes] & inner).any():
        lists = [_CUT(t) for t in texts.to_pylist()]
        bounds = offsets(np.fromiter(map(len, lists), np.int64, len(lists)))
        encoded = pc.dictionary_encode(pa.array([c for x in lists for c in x], pa.large_string()))
        return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary, bounds
    return codes, keys, bounds


Ids = tuple[np.ndarray, np.ndarray]


class Known:
    """A bounded cache from strings to ids. When full, it keeps what was asked for last."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self._keep(pa.array([], pa.large_string()), np.empty(0, np.uint32), np.empty(0, np.int64))

    def _keep(self, keys: pa.Array, ids: np.ndarray, lens: np.ndarray) -> None:
        self.keys, self.ids, self.lens, self.starts = keys, ids, lens, offsets(lens)[:-1]

    def find(self, wanted: pa.Array, make: Callable[[list[str]], Ids]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): where the ids of the different strings ``wanted`` are.

        ``make`` gives the ids of unknown strings one after another, and how many each has.
        """
        at = pc.fill_null(pc.index_in(wanted, value_set=self.keys), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = at < 0
        if new.any():
            at[new] = len(self.keys) + np.arange(int(new.sum()))
            unknown = wanted.filter(pa.array(new))
            ids, lens = make(unknown.to_numpy(zero_copy_only=False).tolist())
            self._keep(pa.concat_arrays([self.keys, unknown]), np.concatenate([self.ids, ids]), np.concatenate([self.lens, lens]))
        found = self.ids, self.starts[at], self.lens[at]
        if len(self.keys) > self.limit:
            self._keep(wanted, gather(*found), found[2])
        return found


class ChunkEncoder:
    """Ids of whole texts by way of the ids of their chunks.

    ``encode(list of chunks)`` gives their ids one after another, and how many each has. The cache
    is bounded by ``limit`` entries and lives as long as the Python worker.
    """

    def __init__(self, encode: Callable[[list[str]], Ids], limit: int = 300_000) -> None:
        self._encode, self._known = encode, Known(limit)

    def texts(self, texts: pa.Array) -> Ids:
        """(ids of all texts one after another, bounds of each text)."""
        codes, keys, bounds = split_texts(texts)
        ids, starts, lens = self._known.find(keys, self._encode)
        per_chunk = lens[codes]
        return gather(ids, starts[codes], per_chunk), offsets(per_chunk)[bounds]
