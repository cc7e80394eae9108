"""Quality grades of documents, by ordinal regression on graded ratings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import ordinal

#: Labelled documents that a model is fitted on, at most; words below which a good text is thin.
SAMPLE, THIN = 4_000, 50


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, thin: int = THIN) -> ordinal.Model:
    """A model of three grades: 0 bad, 1 good but thin (fewer than ``thin`` words), 2 good.

    Fitted on ``limit`` labelled documents at most (`ordinal.sample`). Without labels the model
    gives every text even odds.
    """
    columns, x, good = ordinal.sparse_design(ordinal.sample(docs, labels, F.col("quality"), limit))
    thin_texts = x.column(2) < np.log1p(thin) / 10 - 1e-12  # column 2 is the log length
    return ordinal.fit(columns, x, np.where(good > 0, np.where(thin_texts, 1, 2), 0))


def keeps(tails: np.ndarray) -> np.ndarray:
    """Whether a text is selected: good rather than not."""
    return tails[:, 0] >= 0.5


def grade(docs: DataFrame, model: ordinal.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, expected_grade, p_good, keep) of every row.

    ``p_good`` is the tail probability of grade 1 or more; documents with 0.5 or more are kept.
    Null and empty texts are graded as texts without any feature; rows may repeat and ids may be null.
    """
    expected = F.aggregate("tails", F.lit(0.0), lambda a, x: a + x)
    return ordinal.scored(docs, model, id_col, text_col).select(
        id_col, expected.alias("expected_grade"), F.col("tails")[0].alias("p_good"), (F.col("tails")[0] >= 0.5).alias("keep")
    )


def select(docs: DataFrame, model: ordinal.Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    return ordinal.filtered(docs, model, keeps, text_col)
