"""Periodic runs of words, found on a harmonic grid and extended through a recompressed grammar."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_words, by_bytes, gather, offsets

#: Candidates that are looked at together.
CHUNK = 1 << 19


def _sides(symbols: np.ndarray, seed: int) -> np.ndarray:
    """Each symbol's side of a level's partition, by a mixed hash."""
    x = symbols.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * seed % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) & np.uint64(1)).astype(bool)


class Grammar:
    """A run-length grammar of texts of words, by alternate block and pair compression.

    Level 0 has the words of all texts, each text between separators that occur once only. A level
    of blocks puts one symbol for each run of equal symbols, a level of pairs one for each pair whose
    left symbol is on one side of a partition and whose right one is on the other. Equal stretches
    are therefore cut alike but for their ends, at every level. Levels end when each text is one symbol.

    ``symbols[l]`` are a level's symbols, ``up[l]`` says of which symbol of the next level each is a part,
    ``low[l]`` where each symbol's parts start at the level before, and ``blocks[l]`` whether the next
    level is one of blocks.
    """

    def __init__(self, words: np.ndarray, lens: np.ndarray) -> None:
        """``words`` are codes from 0, ``lens`` how many each text has."""
        n = int(words.max()) + 1 if len(words) else 0
        self.starts = offsets(lens)[:-1] + 1 + np.arange(len(lens))  # of texts at level 0
        line = np.empty(len(words) + len(lens) + 1, np.int64)
        lone = np.append(0, self.starts + lens)  # places of separators
        line[lone] = n + np.arange(len(lone))
        is_word = np.ones(len(line), bool)
        is_word[lone] = False
        line[is_word] = words
        self.symbols, self.up, self.low, self.blocks = [line], [], [np.empty(0, np.int64)], []
        edge, fresh, seed = ~is_word, n + len(lone), 0
        while True:
            now = self.symbols[-1]
            inner = ~(edge[:-1] | edge[1:])  # neighbours of one text
            if not inner.any():
                break
            same = inner & (now[:-1] == now[1:])
            if same.any():
                head = np.append(True, ~same)
                edge = self._add(head, fresh, edge, True)
                fresh += len(now)
                now = self.symbols[-1]
                inner = ~(edge[:-1] | edge[1:])
                if not inner.any():
                    break
            while True:
                side = _sides(now, seed)
                ways = [inner & (side[:-1] == s) & (side[1:] != s) for s in (False, True)]
                pairs = max(ways, key=np.count_nonzero)
                seed += 1
                if pairs.any():
                    break
            edge = self._add(np.append(True, ~pairs), fresh, edge, False)
            fresh += len(now)

    def _add(self, head: np.ndarray, fresh: int, edge: np.ndarray, blocks: bool) -> np.ndarray:
        """A level above the last; ``head`` marks the first part of each symbol. New symbols are numbered from ``fresh``."""
        now = self.symbols[-1]
        low = np.append(np.flatnonzero(head), len(now))
        size, first = np.diff(low), now[low[:-1]]
        made = np.flatnonzero(size > 1)
        second = size[made] if blocks else now[low[made] + 1]
        order = np.lexsort((second, first[made]))
        a, b = first[made][order], second[order]
        code = np.empty(len(made), np.int64)
        code[order] = np.cumsum(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) - 1
        above = first.copy()
        above[made] = fresh + code
        self.symbols.append(above)
        self.up.append(np.cumsum(head) - 1)
        self.low.append(low)
        self.blocks.append(blocks)
        return edge[low[:-1]]

    def _walk(self, level: int, x: np.ndarray, y: np.ndarray, on: np.ndarray, step: int) -> np.ndarray:
        """Move on over equal symbols of a level as far as needed; those of ``on`` that can go up.

        ``x`` and ``y`` are changed in place. Both can go up where both start a symbol of the next
        level (end one, if ``step`` is -1). The others have stopped at different symbols.
        """
        symbols, risen = self.symbols[level], []
        top = level == len(self.up)
        while len(on):
            a, b = x[on], y[on]
            same = symbols[a] == symbols[b]
            on, a, b = on[same], a[same], b[same]
            if top:
                move: np.ndarray | int = 1
            else:
                up, low = self.up[level], self.low[level + 1]
                if step > 0:
                    at = (low[up[a]] == a) & (low[up[b]] == b)
                else:
                    at = (low[up[a] + 1] == a + 1) & (low[up[b] + 1] == b + 1)
                risen.append(on[at])
                on, a, b = on[~at], a[~at], b[~at]
                move = self._rest(level, a, b, step)
            x[on] += step * move
            y[on] += step * move
        return np.concatenate(risen) if risen else on

    def _rest(self, level: int, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray | int:
        """How many equal symbols can be passed at once: what is left of the shorter block, or one."""
        if level == len(self.up) or not self.blocks[level]:
            return 1
        up, low = self.up[level], self.low[level + 1]
        if step > 0:
            return np.minimum(low[up[a] + 1] - a, low[up[b] + 1] - b)
        return np.minimum(a - low[up[a]], b - low[up[b]]) + 1

    def extend(self, x: np.ndarray, y: np.ndarray, step: int = 1) -> np.ndarray:
        """How many words from the places ``x`` and ``y`` of level 0 are equal, onwards or (-1) backwards.

        A query climbs while both places start symbols that are equal, and comes down again to the
        first words that differ.
        """
        start, x, y = x, x.copy(), y.copy()
        height = np.zeros(len(x), np.int64)
        on = np.arange(len(x))
        for level in range(len(self.symbols)):
            on = self._walk(level, x, y, on, step)
            if level < len(self.up):
                x[on], y[on] = self.up[level][x[on]], self.up[level][y[on]]
                height[on] = level + 1
            if not len(on):
                break
        for level in range(int(height.max(initial=0)), 0, -1):
            on = np.flatnonzero(height >= level)
            low = self.low[level]
            for side in (x, y):
                side[on] = low[side[on]] if step > 0 else low[side[on] + 1] - 1
            symbols = self.symbols[level - 1]
            while len(on):
                a, b = x[on], y[on]
                same = symbols[a] == symbols[b]
                on, a, b = on[same], a[same], b[same]
                move = self._rest(level - 1, a, b, step)
                x[on] += step * move
                y[on] += step * move
        return (x - start) * step


def _grid(lens: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of every multiple of every period of which ``times`` fit, about `CHUNK` at once.

    Periods come in ascending order. ``place + (times - 1) * period`` is still in the text.
    """
    order = np.argsort(-lens, kind="stable")
    tall = lens[order]
    period = 1
    while True:
        first = period
        counts: list[np.ndarray] = []
        total = 0
        while total < CHUNK and (n := int(np.searchsorted(-tall, -times * period, "right"))):
            counts.append((tall[:n] - 1) // period - (times - 2))
            total += int(counts[-1].sum())
            period += 1
        if not counts:
            return
        sizes = np.fromiter(map(len, counts), np.int64, len(counts))
        places = np.concatenate(counts)
        text = order[gather(np.arange(len(tall)), np.zeros(len(sizes), np.int64), sizes)]
        q = np.repeat(first + np.arange(len(sizes)), sizes)
        # a long text may fill several chunks
        bounds = offsets(places)
        for lo in range(0, int(bounds[-1]), CHUNK):
            hi = min(lo + CHUNK, int(bounds[-1]))
            a, b = int(np.searchsorted(bounds, lo, "right")) - 1, int(np.searchsorted(bounds, hi, "left"))
            part = np.minimum(bounds[a + 1 : b + 1], hi) - np.maximum(bounds[a:b], lo)
            k = np.arange(lo, hi) - np.repeat(bounds[a:b], part)
            each = np.repeat(q[a:b], part)
            yield np.repeat(text[a:b], part), each, k * each


def runs(words: np.ndarray, lens: np.ndarray, times: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of texts of word codes, by text, start and period.

    A run is a stretch of at least ``times`` (2 or more) times its smallest period and ``least`` words
    that can't be extended with that period. So ``times`` multiples of the period lie in it, with equal
    words there: only such places of the grid are extended to both sides. Of stretches that are equal
    the smallest period is kept; places in a run whose period divides theirs give that run again and
    are passed over.
    """
    begins = offsets(lens)[:-1]
    found: list[tuple[np.ndarray, ...]] = []
    reach, known = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)  # a run over each word: where it ends, its period
    grammar: Grammar | None = None
    for text, q, place in _grid(lens, times):
        at = begins[text] + place
        for k in range(1, times):  # equal words at the next multiples
            same = words[at] == words[at + k * q]
            text, q, at = text[same], q[same], at[same]
        new = (reach[at] <= at + (times - 1) * q) | (q % known[at] > 0)
        text, q, at = text[new], q[new], at[new]
        if not len(at):
            continue
        if grammar is None:
            grammar = Grammar(words, lens)
        x = at + text + 1  # with the separators before it
        onwards, back = grammar.extend(x, x + q), grammar.extend(x - 1, x + q - 1, -1)
        start, length = at - back, back + q + onwards
        real = length >= np.maximum(times * q, least)
        text, start, length, q = text[real], start[real], length[real], q[real]
        order = np.lexsort((q, length, start))
        text, start, length, q = text[order], start[order], length[order], q[order]
        if len(text):
            once = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))
            text, start, length, q = text[once], start[once], length[once], q[once]
            long = np.argsort(length, kind="stable")  # the longest run over a word is kept last
            cover = gather(np.arange(len(words)), start[long], length[long])
            reach[cover] = np.repeat((start + length)[long], length[long])
            known[cover] = np.repeat(q[long], length[long])
            found.append((text, start, length, q))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))  # type: ignore[return-value]
    text, start, length, q = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((q, length, start))
    text, start, length, q = text[order], start[order], length[order], q[order]
    once = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))
    text, start, length, q = text[once], start[once], length[once], q[once]
    order = np.lexsort((q, start))
    return text[order], (start - begins[text])[order], length[order], q[order]


def repeated(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stand in some run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def find_runs(docs: DataFrame, times: int = 4, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs array<struct<start, length, period>>, collapsed): every text's periodic runs.

    Words are runs of other than ASCII white space, numbered from 0. ``runs`` is in order of start and
    period (see `runs`), and empty without any. ``collapsed`` has the words that no run holds after its
    first period, joined by single blanks. Null texts count as empty: no word, no run, an empty
    ``collapsed``. Rows are neither merged nor dropped; ids may be null or repeat; other columns are not read.
    """
    names = ["i", "n_words", "runs", "collapsed"]
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            flat, bounds = ascii_words(batch.column("t"))
            coded = pc.dictionary_encode(flat)
            words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            text, start, length, period = runs(words, np.diff(bounds), times, least)
            keep = ~repeated(len(words), bounds[text] + start, length, period)
            lists = pa.LargeListArray.from_arrays(pa.array(offsets(keep)[bounds]), flat.filter(pa.array(keep)))
            spans = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(run_type))
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("i"), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(ends), spans),
                    pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ],
                names=names,
            )

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    found = wanted.mapInArrow(run, f"i {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("i", id_col)


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) in which one document of ten has a tail that repeats.

    With h the crc32 of the decimal id, g = floor(h / 10) and n words, documents with h % 10 = 0 get words
    from a = g % n on repeated with a period of 1 + floor((n - a) / (3 + g % 8)); words are then
    joined by blanks. Others, and those with a null id, keep their text.
    """

    def part(xs: str, at: Column, size: Column) -> Column:
        return F.slice(xs, at.cast("int"), size.cast("int"))

    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(docs[text_col], F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"), F.floor(h / 10).cast("long").alias("g"), words.alias("words"))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    left = F.col("n") - F.col("a")
    rows = rows.withColumn("p", 1 + F.floor(left / (3 + F.col("g") % 8)).cast("long"))
    tail = F.flatten(F.array_repeat(part("words", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int")))
    rows = rows.select("i", "t", "words", "a", left.alias("left"), F.when(F.col("n") > 0, tail).alias("tail"))
    made = F.array_join(F.concat(part("words", F.lit(1), F.col("a")), part("tail", F.lit(1), F.col("left"))), " ")
    return rows.select(F.col("i").alias(id_col), F.coalesce(F.when(F.col("tail").isNotNull(), made), F.col("t")).alias(text_col))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of `find_runs` rows.

    The four columns in between are of the run with the greatest length / period, then the smallest
    start, then the smallest period; null without runs. Quotients of whole numbers below 2^26 are
    equal as doubles only if they are equal.
    """
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ranked = F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("x"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("r")))
    best = F.array_max(ranked)["r"]
    rows = found.select(id_col, "runs", "collapsed", best.alias("best"))
    return rows.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
