"""Ids that were merged into other ids: the audit log, and following the merges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.catalog import TABLES
from shelfmark.session import checkpointed


def unique_merges(merged: DataFrame) -> DataFrame:
    """One row per ``original_id``: the last by merge date, then by target, as a whole."""
    rest = [c for c in merged.columns if c != "original_id"]
    first = [c for c in ("merge_date", "merged_into_id") if c in rest]
    by = F.struct(*first, *[c for c in rest if c not in first])
    return merged.groupBy("original_id").agg(F.max(by).alias("_kept")).select(
        *["original_id" if c == "original_id" else F.col(f"_kept.{c}").alias(c) for c in merged.columns]
    )


def audit_merges(
    merged: DataFrame | None, incoming: DataFrame, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """The merge table with the new rows, and the log rows to append: one per new row.

    ``original_id`` is the table's key: of several new rows for an id one is taken
    (`unique_merges`), and ids that the table already has keep their row and are not logged. A log id
    follows from its row, so that reading the log again gives the same ids.
    """
    columns = TABLES["merged_entities"].columns
    added = unique_merges(incoming.where("original_id IS NOT NULL").select(*columns))
    if merged is not None:
        added = added.join(merged.select("original_id"), "original_id", "left_anti").select(*columns)
    digest = F.md5(F.to_json(F.struct(*columns)))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    log = added.select(
        F.concat_ws("-", *[F.substring(digest, a, n) for a, n in parts]).alias("log_id"),
        *columns,
        (F.current_timestamp() if now is None else now).cast("timestamp_ntz").alias("logged_at"),
    )
    return (added if merged is None else merged.select(*columns).unionByName(added)), log


def follow(merged: DataFrame) -> DataFrame:
    """(original_id, final_id): every merge followed to its end.

    Chains are shortened by half per round, so a chain of any length ends after log2(rows)
    rounds. Repeated merges of an id count once (`unique_merges`). Ids on a cycle, or leading to
    one, have no end and are left out; `cycles` lists them.
    """
    links = _links(merged)
    ends = _followed(links)
    return ends.join(
        ends.select(F.col("original_id").alias("final_id")), "final_id", "left_anti"
    ).select("original_id", "final_id")


def cycles(merged: DataFrame) -> DataFrame:
    """(original_id, merged_into_id): the merges whose chain never ends."""
    links = _links(merged)
    ends = follow(merged).select("original_id")
    return links.join(ends, "original_id", "left_anti").withColumnRenamed("final_id", "merged_into_id")


def _links(merged: DataFrame) -> DataFrame:
    pairs = unique_merges(merged).select("original_id", F.col("merged_into_id").alias("final_id"))
    return checkpointed(pairs.where(F.col("original_id") != F.col("final_id")))


def _followed(links: DataFrame) -> DataFrame:
    """Links followed until nothing moves; what is on a cycle still points at a merged id then."""
    rounds = max(1, math.ceil(math.log2(links.count() + 1)))
    for _ in range(rounds):
        ahead = links.select(
            F.col("original_id").alias("final_id"), F.col("final_id").alias("_next")
        )
        stepped = checkpointed(
            links.join(ahead, "final_id", "left").select(
                "original_id",
                F.coalesce("_next", "final_id").alias("final_id"),
                F.col("_next").isNotNull().alias("_moved"),
            )
        )
        links = stepped.drop("_moved")
        if stepped.where("_moved").isEmpty():
            break
    return links


def redirect(rows: DataFrame, columns: Sequence[str], merged: DataFrame) -> DataFrame:
    """Replace merged ids in the given id columns by the id they ended up in.

    The merge side has every id once; a busy id in ``rows`` is split by the adaptive
    skew join. Rows without an id are spread by a random value that meets nothing.
    """
    ends = follow(merged)
    order = rows.columns
    for c in columns:
        hop = ends.select(F.col("original_id").alias("_id"), F.col("final_id").alias("_final"), F.lit(0).alias("_salt"))
        salt = F.when(F.col(c).isNull(), F.monotonically_increasing_id() + 1).otherwise(0).cast("bigint")
        salted = rows.withColumn("_own", salt)
        met = salted.join(hop, (F.col(c) == F.col("_id")) & (F.col("_own") == F.col("_salt")), "left")
        rows = met.withColumn(c, F.coalesce("_final", c)).select(*order)
    return rows.select(*order)
