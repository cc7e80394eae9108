"""A training corpus from ``documents``: graded, cleaned, without near-duplicates and secrets, packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import neardup, packing, quality, secrets, toxicity
from shelfmark.llm.common import prepare, read
from shelfmark.llm.queries import tokenizer
from shelfmark.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model selects; it is fitted on the labelled ones of the whole table."""
    return quality.select(docs, quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model is fitted on the labelled ones of the whole table."""
    return toxicity.select(docs, toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity of 0.8 or more."""
    prepare(spark)
    return neardup.one_of_each(docs, neardup.Plan(shingle=5, percent=80))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` counts the new texts."""
    prepare(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    spans = "spans" + "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    found = secrets.scan(docs, keep=others, out=spans)
    text = F.when(F.size(spans) > 0, secrets.redacted(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    rows = found.withColumn("text", text).drop(spans)
    if "n_chars" in others:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 2048 tokens."""
    prepare(spark)
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("toxicity", civil),
    ("near_duplicates", different),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The classifiers and the tokenizer have no SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept, through Parquet in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
