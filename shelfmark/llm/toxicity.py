"""Severity of toxic language, by ordinal regression with weights shared over severity grades."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import ordinal

#: Labelled documents that a model is fitted on, at most.
SAMPLE = 4_000
#: Different words typical of toxic texts that a toxic text has from each grade after the first on.
STEPS = (3, 6)


def severities(columns: np.ndarray, x: ordinal.Sparse, toxic: np.ndarray, steps: tuple[int, ...] = STEPS) -> np.ndarray:
    """Grades of labelled texts: 0 for those not toxic, 1 and up for toxic ones.

    Words typical of toxic texts are those that a first model of two grades gives a positive
    weight; a toxic text is graded by how many of them it has.
    """
    first = ordinal.fit(columns, x, toxic)
    typical = (first.weights > 0) & (columns >= 3) & (columns < 3 + (1 << ordinal.BITS))
    hits = np.bincount(x.row[typical[x.at]], minlength=x.shape[0])
    return np.where(toxic > 0, 1 + sum((hits >= s).astype(int) for s in steps), 0)


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> ordinal.Model:
    """A model of severity grades, fitted on ``limit`` labelled documents at most (`ordinal.sample`).

    Without labels the model gives every text even odds, which is not toxic.
    """
    columns, x, toxic = ordinal.sparse_design(ordinal.sample(docs, labels, F.col("toxic"), limit))
    return ordinal.fit(columns, x, severities(columns, x, (toxic > 0).astype(np.int64)))


def clean(tails: np.ndarray) -> np.ndarray:
    """Whether a text is rather not toxic than toxic."""
    return tails[:, 0] <= 0.5


def grade(docs: DataFrame, model: ordinal.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, expected_severity, p_toxic, severity, toxic) of every row.

    ``p_toxic`` is the probability of severity 1 or more, ``severity`` the highest grade that is
    more likely reached than not. Null and empty texts have no feature and so the least
    severity; rows may repeat and ids may be null.
    """
    expected = F.aggregate("tails", F.lit(0.0), lambda a, x: a + x)
    reached = F.size(F.filter("tails", lambda x: x > 0.5)).cast("long")
    return ordinal.scored(docs, model, id_col, text_col).select(
        id_col, expected.alias("expected_severity"), F.col("tails")[0].alias("p_toxic"),
        reached.alias("severity"), (F.col("tails")[0] > 0.5).alias("toxic"),
    )


def select(docs: DataFrame, model: ordinal.Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic."""
    return ordinal.filtered(docs, model, clean, text_col)
