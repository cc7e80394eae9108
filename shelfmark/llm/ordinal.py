"""Cumulative-link ordinal regression on sparse hashed text features."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import ascii_words, by_bytes, offsets
from shelfmark.session import stored

#: Hashed features: 2 to the power of this.
BITS = 20
#: Cut off around words before they are hashed.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
_RUNS = [(r"[A-Z]+", "A"), (r"\pL+", "a"), (r"\pN+", "9"), (r"aa+", "a")]


def _hashes(words: pa.Array, seed: int) -> np.ndarray:
    mask = (1 << BITS) - 1
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed=seed) & mask for w in words.cast(pa.large_binary()).to_pylist()), np.int64, len(words))


@dataclass(frozen=True)
class Words:
    """The words of some texts: which different word each is, and what it hashes to."""

    doc: np.ndarray
    code: np.ndarray
    count: np.ndarray
    word: np.ndarray
    shape: np.ndarray

    def general(self) -> np.ndarray:
        """Three values a text: shares of words like the one before and of words met before, log length."""
        n, size = len(self.count), np.maximum(self.count, 1)
        like = (self.code[1:] == self.code[:-1]) & (self.doc[1:] == self.doc[:-1])
        again = np.bincount(self.doc[1:][like], minlength=n) / size
        different = np.bincount(_pairs(self.doc, self.code, len(self.word))[0], minlength=n)
        return np.stack([again, np.where(self.count > 0, 1 - different / size, 0.0), np.log1p(self.count) / 10])


def split(texts: pa.Array) -> Words:
    """Words between ASCII white space; null texts have none.

    A word is hashed in lower case and without marks around it, into columns from 3 on; its shape
    (runs of capitals, letters and digits each as one sign, marks as they are) into columns after
    those.
    """
    words, bounds = ascii_words(texts)
    count = np.diff(bounds)
    coded = pc.dictionary_encode(words)
    shape = coded.dictionary
    for pattern, sign in _RUNS:
        shape = pc.replace_substring_regex(shape, pattern, sign)
    word = _hashes(pc.utf8_lower(pc.utf8_trim(coded.dictionary, MARKS)), 1) + 3
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(np.repeat(np.arange(len(count)), count), code, count, word, _hashes(shape, 2) + 3 + (1 << BITS))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, column, value): different words count 1 each, shapes by their share of all words,
    columns 0 to 2 are `Words.general`. A text without words has none."""
    w = split(texts)
    wide = 2 << BITS
    own = _pairs(w.doc, w.word[w.code], wide)
    keys, where = np.unique(w.doc * wide + w.shape[w.code], return_inverse=True)
    shares = np.bincount(where, weights=1.0 / w.count[w.doc], minlength=len(keys))
    full = np.flatnonzero(w.count)
    general = w.general()[:, full]
    return (
        np.concatenate([own[0], keys // wide, full, full, full]),
        np.concatenate([own[1], keys % wide, *(np.full_like(full, i) for i in range(3))]),
        np.concatenate([np.ones(len(own[0])), shares, *general]),
    )


def _pairs(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    keys = np.unique(first * max(size, 1) + second)
    return np.stack([keys // max(size, 1), keys % max(size, 1)])


@dataclass(frozen=True)
class Model:
    """P(grade > k) = logistic(weights of the text's features - thresholds[k]), k from 0."""

    columns: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) of every text (rows) for every k (columns)."""
        w = split(texts)
        by_word, by_shape = self._weight(w.word), self._weight(w.shape)
        hit = np.flatnonzero(by_word[w.code])
        doc, column = _pairs(w.doc[hit], w.word[w.code[hit]], 2 << BITS)
        total = np.zeros(len(texts))
        total += np.bincount(doc, weights=self._weight(column), minlength=len(texts))
        total += np.bincount(w.doc, weights=by_shape[w.code] / w.count[w.doc], minlength=len(texts))
        total += self._weight(np.arange(3)) @ w.general()
        return _logistic(total[:, None] - self.thresholds[None, :])

    def _weight(self, columns: np.ndarray) -> np.ndarray:
        if not len(self.columns):
            return np.zeros(len(columns))
        at = np.minimum(np.searchsorted(self.columns, columns), len(self.columns) - 1)
        return np.where(self.columns[at] == columns, self.weights[at], 0.0)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass(frozen=True)
class Sparse:
    """Values other than zero of texts (rows) for some features (columns)."""

    row: np.ndarray
    at: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    @classmethod
    def of(cls, x: np.ndarray) -> Sparse:
        row, at = np.nonzero(x)
        return cls(row, at, x[row, at], x.shape)

    def times(self, w: np.ndarray) -> np.ndarray:
        """A sum for each text."""
        return np.bincount(self.row, weights=self.value * w[self.at], minlength=self.shape[0])

    def sums(self, of: np.ndarray) -> np.ndarray:
        """A sum for each feature of its values times those ``of`` their texts."""
        return np.bincount(self.at, weights=self.value * of[self.row], minlength=self.shape[1])

    def column(self, at: int) -> np.ndarray:
        mine = self.at == at
        return np.bincount(self.row[mine], weights=self.value[mine], minlength=self.shape[0])

    def dense(self) -> np.ndarray:
        x = np.zeros(self.shape)
        x[self.row, self.at] = self.value
        return x


def fit(columns: np.ndarray, x: Sparse | np.ndarray, grade: np.ndarray, ridge: float = 1e-4, steps: int = 400) -> Model:
    """A model of the features ``columns``, whose values for each text are a row of ``x``.

    All thresholds share one weight a feature. Quasi-Newton (limited-memory BFGS) steps on the
    ridge-penalised likelihood; thresholds stay in order because only their log distances are free.
    Features count by their distance from the mean, scaled, but ``x`` stays sparse.
    """
    x = x if isinstance(x, Sparse) else Sparse.of(x)
    n, top = len(grade), int(grade.max(initial=1))
    mean = x.sums(np.full(n, 1 / max(n, 1)))
    held = np.bincount(x.at, minlength=len(columns))
    squares = np.bincount(x.at, weights=(x.value - mean[x.at]) ** 2, minlength=len(columns)) + (n - held) * mean**2
    scale = np.sqrt(squares / n) + 1e-9 if n else np.ones(len(columns))
    share = np.clip([(grade > k).mean() if n else 0.5 for k in range(top)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-2 * np.arange(top))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2)), np.zeros(len(columns))])

    def cuts(t: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([t[:1], np.exp(t[1:top])]))

    def loss(t: np.ndarray) -> tuple[float, np.ndarray]:
        b, w = cuts(t), t[top:]
        s = x.times(w / scale) - mean @ (w / scale)
        edge = np.concatenate([[-np.inf], b, [np.inf]])
        f_lo, f_hi = _logistic(edge[grade] - s), _logistic(edge[grade + 1] - s)
        p = np.maximum(f_hi - f_lo, 1e-12)
        d_lo, d_hi = f_lo * (1 - f_lo) / p, f_hi * (1 - f_hi) / p
        by_cut = np.array([(d_lo[grade == k + 1].sum() - d_hi[grade == k].sum()) / n for k in range(top)])
        by_theta = np.cumsum(by_cut[::-1])[::-1] * np.concatenate([[1.0], np.exp(t[1:top])])
        value = -np.log(p).mean() + 0.5 * ridge * (w @ w)
        by_text = (d_hi - d_lo) / n
        return value, np.concatenate([by_theta, (x.sums(by_text) - mean * by_text.sum()) / scale + ridge * w])

    if n:
        theta = _bfgs(loss, theta, steps)
    weights = theta[top:] / scale
    return Model(columns, weights, cuts(theta) + mean @ weights)


def _bfgs(loss, theta: np.ndarray, steps: int, memory: int = 30) -> np.ndarray:
    value, slope = loss(theta)
    past: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=memory)  # (step, change of slope, their product)
    for _ in range(steps):
        move = -_inverse_times(past, slope)
        if (drop := move @ slope) >= 0:
            past.clear()
            move = -slope
            drop = move @ slope
        size = 1.0
        while size > 1e-8:
            new, at = loss(theta + size * move)
            if np.isfinite(new) and new <= value + 1e-4 * size * drop:
                break
            size /= 2
        else:
            break
        step, change = size * move, at - slope
        theta, value, slope = theta + step, new, at
        if np.abs(slope).max() < 1e-6:
            break
        if (curve := step @ change) > 1e-14:
            past.append((step, change, curve))
    return theta


def _inverse_times(past: deque[tuple[np.ndarray, np.ndarray, float]], slope: np.ndarray) -> np.ndarray:
    """``slope`` times the inverse curvature that the past steps show."""
    out, parts = slope.copy(), []
    for step, change, curve in reversed(past):
        parts.append(step @ out / curve)
        out -= parts[-1] * change
    if past:
        _, change, curve = past[-1]
        out *= curve / (change @ change)
    for (step, change, curve), part in zip(past, reversed(parts), strict=True):
        out += (part - change @ out / curve) * step
    return out


def sample(docs: DataFrame, labels: DataFrame, grade: Column, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(i, t, g): ``limit`` labelled documents at most, the same ones in every run.

    Of the labels of documents that have a text, those with the least hashes of their ids are taken;
    that many rows are small enough for every join strategy. Null ids and null grades are left out, the
    highest grade and the first text (in order of letters) of an id count.
    """
    some = labels.select(F.col(id_col).alias("i"), grade.cast("int").alias("g")).where("i is not null and g is not null")
    texts = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t")).where("i is not null and t is not null")
    some = some.groupBy("i").agg(F.max("g").alias("g")).join(texts.select("i"), "i", "left_semi")
    some = some.orderBy(F.xxhash64("i"), "i").limit(limit)
    return stored(texts.join(F.broadcast(some), "i").groupBy("i", "g").agg(F.min("t").alias("t")).select("i", "t", "g"), "labelled")


def design(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, values, grades) as `sparse_design` has them, the values as an array."""
    columns, x, grade = sparse_design(rows)
    return columns, x.dense(), grade


def sparse_design(rows: DataFrame, least_z: float = 6.0, least_texts: int = 5) -> tuple[np.ndarray, Sparse, np.ndarray]:
    """(columns, values, grades) of labelled texts (i, t, g).

    All features whose correlation with the grade is ``least_z`` deviations or more from chance,
    however rare, and the three of `Words.general`; those of fewer than ``least_texts`` different
    texts are left out, so that copies of one text count once. Texts stay on the executors: the
    driver gets the chosen values other than zero.
    """

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            doc, column, value = features(batch.column("t"))
            grade, text = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "h"))
            yield pa.RecordBatch.from_arrays([pa.array(column), pa.array(value), pa.array(grade[doc].astype(np.float64)), pa.array(text[doc])], names=["column", "v", "g", "h"])

    n, total, square = rows.agg(F.count("*"), F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum(F.col("g") * F.col("g")), F.lit(0))).first()
    mean = total / max(n, 1)
    found = rows.select("t", "g", F.xxhash64("t").alias("h")).mapInArrow(every, "column long, v double, g double, h long")
    by_text = found.where("column >= 3").groupBy("column", "h").agg(
        F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.sum(F.col("v") * F.col("g")).alias("c")
    )
    sums = by_text.groupBy("column").agg(F.count("*").alias("texts"), *(F.sum(x).alias(x) for x in "sqc"))
    spread = F.sqrt(F.greatest((F.col("q") - F.col("s") * F.col("s") / max(n, 1)) * F.lit(float(square - total * mean)), F.lit(1e-12)))
    z = F.abs((F.col("c") - mean * F.col("s")) / spread) * float(np.sqrt(n))
    chosen = sums.where(F.col("texts") >= least_texts).where(z >= least_z).select("column").toArrow()["column"].to_numpy()
    columns = np.sort(np.concatenate([np.arange(3), chosen]))

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            x = chosen_values(batch.column("t"), columns)
            order = np.argsort(x.row, kind="stable")
            bounds = pa.array(offsets(np.bincount(x.row, minlength=len(batch))).astype(np.int32))
            ats, values = (pa.ListArray.from_arrays(bounds, pa.array(c[order])) for c in (x.at.astype(np.int32), x.value))
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("g"), ats, values], names=["i", "g", "at", "x"])

    kind = rows.schema["i"].dataType.simpleString()
    got = rows.mapInArrow(few, f"i {kind}, g int, at array<int>, x array<double>").toArrow().sort_by("i")
    lens = pc.list_value_length(got["at"]).to_numpy().astype(np.int64)
    at, value = (pc.list_flatten(got[c]).to_numpy() for c in ("at", "x"))
    x = Sparse(np.repeat(np.arange(len(got)), lens), at.astype(np.int64), value.astype(np.float64), (len(got), len(columns)))
    return columns, x, got["g"].to_numpy().astype(np.int64)


def chosen_values(texts: pa.Array, columns: np.ndarray) -> Sparse:
    """The values of the features ``columns`` (sorted), one row a text."""
    doc, column, value = features(texts)
    at = np.minimum(np.searchsorted(columns, column), len(columns) - 1)
    mine = columns[at] == column
    return Sparse(doc[mine], at[mine], value[mine], (len(texts), len(columns)))


def dense(texts: pa.Array, columns: np.ndarray) -> np.ndarray:
    """The values of the features ``columns`` (sorted), one row a text."""
    return chosen_values(texts, columns).dense()


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tails): P(grade > k) for each k of every row. Null texts count as empty; other columns aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "t"):
            tails = model.scores(batch.column("t"))
            bounds = pa.array(np.arange(len(tails) + 1, dtype=np.int32) * tails.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.ListArray.from_arrays(bounds, pa.array(tails.ravel()))], names=["i", "tails"])

    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    return wanted.mapInArrow(run, f"i {kind}, tails array<double>").withColumnRenamed("i", id_col)


def filtered(docs: DataFrame, model: Model, keep: Callable[[np.ndarray], np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, for which ``keep`` is true of the tails of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text_col):
            yield batch.filter(pa.array(keep(model.scores(batch.column(text_col)))))

    return docs.mapInArrow(run, docs.schema)
