"""One query an operator, each over its whole table, with the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import alignment, bpe, linkgraph, neardup, packing, periods, permindex, quality, secrets, sentences, token_files, topk, toxicity
from shelfmark.llm.common import read
from shelfmark.llm.oracles import linkgraph_sql, secrets_sql
from shelfmark.session import scratch


def tokenizer(name: str) -> str:
    """The path of a public vocabulary file; every executor must see it.

    ``TOKENIZERS_DIR`` names another folder where executors hold them elsewhere than the driver.
    """
    folder = os.environ.get("TOKENIZERS_DIR")
    return f"{folder}/{name}" if folder else str(public_tokenizers.path(name))


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every hundredth one."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), "i % 100 = 0", 10)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's severity."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets."""
    return secrets.report(read(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors found for every fiftieth one."""
    return permindex.nearest(read(spark, sf_dir, "embeddings"), "i % 50 = 0", 5)


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate group, on three-word shingles."""
    found = neardup.groups(read(spark, sf_dir, "documents"), neardup.Plan(shingle=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_linkgraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict."""
    return linkgraph.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text written to token files, and the files read back."""
    out = scratch(spark, "tokens")
    token_files.write(read(spark, sf_dir, "documents"), out, tokenizer("word_bpe_49k.json"), end_id=2, width=2)
    return token_files.checksums(spark, out)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048."""
    return packing.packed(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality grade."""
    docs = read(spark, sf_dir, "documents")
    return quality.grade(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, one document of ten with a tail that repeats."""
    return periods.digests(periods.find_runs(periods.looped(read(spark, sf_dir, "documents"))))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's tokens of two vocabularies aligned, with corpus-wide counts of linked ids."""
    found = alignment.linked(
        read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"), show=alignment.digested
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the pieces of a model and decoded again."""
    return sentences.round_trip(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_toxicity": op2_toxicity,
    "op3_secrets": op3_secrets,
    "op4_neighbours": op4_neighbours,
    "op5_neardup": op5_neardup,
    "op6_bpe": op6_bpe,
    "op7_linkgraph": op7_linkgraph,
    "op8_token_files": op8_token_files,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_periods": op11_periods,
    "op12_alignment": op12_alignment,
    "op13_sentences": op13_sentences,
}

ORACLES: dict[str, str] = {
    "op1_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 10""",
    "op3_secrets": secrets_sql(),
    "op7_linkgraph": linkgraph_sql(),
}
