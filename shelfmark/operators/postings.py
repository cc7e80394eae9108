"""Inverted files of text columns, stored next to the tables they belong to.

Each part of a table (its base, and each batch after it) has its own postings below
``<root>/_postings/<table>.<column>``: (bucket, token, key, origin, positions), in folders by bucket of the
token and in order of token inside. A search opens the buckets of its tokens only, and reads no text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import invert, placed_tokens
from shelfmark.operators.publish import arrivals, path_exists, published, resolve, without_replaced
from shelfmark.operators.search import wanted_tokens
from shelfmark.operators.upsert import ARRIVAL
from shelfmark.plans.catalog import TABLES

#: Folders that the tokens of a part are spread over.
BUCKETS = 64
_ORDER = ("_batch", *ARRIVAL)


def _bucket(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def _folder(root: str, table: str, column: str, part: tuple[str, int]) -> str:
    return f"{root}/_postings/{table}.{column}/{part[0]}={part[1]:012d}"


def postings(rows: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """(token, *keys, positions): where each token stands in the text of each row, from 0.

    A row of the result is one of a text, so a text's own tokens are grouped without a shuffle.
    """
    cut = rows.select(*keys, placed_tokens(F.col(column)).alias("_placed"))
    each = invert(cut, "_placed", keys).select(*keys, F.explode("words").alias("_word"))
    return each.select("_word.token", *keys, "_word.positions")


def index(spark: SparkSession, root: str, table: str, column: str) -> list[str]:
    """Write the postings of every visible part of a table that has none yet; the new folders.

    Rows are dealt by range of (bucket, token, key), so that a common token's postings spread over tasks.
    A folder is complete when its ``_SUCCESS`` is there; one that a failed run left is written again.
    """
    keys, made = TABLES[table].key, []
    for part in published(spark, root, table):
        folder = _folder(root, table, column, part)
        if path_exists(spark, f"{folder}/_SUCCESS"):
            continue
        rows = arrivals(spark, root, table, [part])
        origin = [c for c in _ORDER if c in rows.columns]
        found = postings(rows, column, [*keys, *origin]).withColumn("bucket", _bucket(F.col("token")))
        found = found.repartitionByRange("bucket", "token", *keys).sortWithinPartitions("bucket", "token", *keys)
        found.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        made.append(folder)
    return made


def _terms(spark: SparkSession, terms: Sequence[str]) -> list[str]:
    """The tokens of the terms, cut as texts are; the driver computes them from the terms alone."""
    return list(spark.range(1).select(wanted_tokens(terms)).first()[0])


def _hits(spark: SparkSession, root: str, table: str, column: str, wanted: Sequence[str]) -> DataFrame:
    """(token, *key, origin, n) of the current rows of a table that have one of the tokens.

    Postings of versions that later parts replaced are left out: of the keys found, the order columns of
    all their versions are folded, and no text.
    """
    index(spark, root, table, column)
    spec, visible = TABLES[table], published(spark, root, table)
    parts = []
    for part in visible:
        found = spark.read.parquet(_folder(root, table, column, part))
        if "token" not in found.columns or "bucket" not in found.columns:  # no text had a token
            continue
        buckets = sorted({spark.range(1).select(_bucket(F.lit(t))).first()[0] for t in wanted})
        found = found.where(F.col("bucket").isin(*buckets) & F.col("token").isin(*wanted))
        parts.append(found.select("token", *spec.key, *[c for c in _ORDER if c in found.columns], F.size("positions").alias("n")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if len(visible) == 1 and visible[0][0] == "base":
        return found
    rows = without_replaced(spark, root, table, arrivals(spark, root, table, visible), visible)
    order = [c for c in _ORDER if c in rows.columns]
    versions = rows.select(*spec.key, F.struct(*order).alias("_order")).join(found.select(*spec.key).distinct(), list(spec.key), "left_semi")
    pick = F.max if spec.policy == "last" else F.min
    newest = versions.groupBy(*spec.key).agg(pick("_order").alias("_newest"))
    # a part's own repeated keys fold as well, so the version is compared and not the part
    return found.withColumn("_order", F.struct(*order)).join(newest, list(spec.key)).where(F.col("_order").eqNullSafe(F.col("_newest"))).drop("_order", "_newest")


def search(
    spark: SparkSession, root: str, table: str, column: str, terms: Sequence[str], match: str = "all"
) -> DataFrame:
    """(*key, hits) of the current rows whose text has all (or any) of the terms' tokens.

    ``hits`` counts the occurrences of the tokens. Terms without any token match no row. Missing postings
    are written first.
    """
    if match not in ("all", "any"):
        raise ValueError("match must be 'all' or 'any'")
    keys = TABLES[table].key
    wanted = _terms(spark, terms)
    if not wanted or not published(spark, root, table):
        current = resolve(spark, root, table)
        if current is None:
            raise ValueError(f"{table} has no visible batch")
        return current.select(*keys, F.lit(0).cast("bigint").alias("hits")).where(F.lit(False))
    found = _hits(spark, root, table, column, wanted)
    found = found.groupBy(*keys).agg(F.count("*").alias("_different"), F.sum("n").alias("hits"))
    return found.where(F.col("_different") >= (len(wanted) if match == "all" else 1)).drop("_different")


def positions(spark: SparkSession, root: str, table: str, column: str, word: str) -> DataFrame:
    """(*key, positions) of a word in the texts of the parts of a table, from the postings alone.

    For a table that is one base, or whose keys never came twice; else join with :func:`search`.
    """
    index(spark, root, table, column)
    paths = [_folder(root, table, column, part) for part in published(spark, root, table)]
    found = spark.read.parquet(*paths).where((F.col("bucket") == _bucket(F.lit(word))) & (F.col("token") == word))
    return found.select(*TABLES[table].key, "positions")
