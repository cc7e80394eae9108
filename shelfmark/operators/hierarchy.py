"""The taxonomy path of topics, children put back together, counts recomputed from facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.plans.catalog import TAXONOMY

PAGE = 1000


def taxonomy_path(levels: dict[str, DataFrame]) -> DataFrame:
    """topic -> subfield -> field -> domain: ids and names of all four levels per topic."""
    top, *lower = TAXONOMY
    path = levels[top].select(
        F.col("id").alias(f"{top[:-1]}_id"), F.col("display_name").alias(f"{top[:-1]}_name")
    )
    above = top
    for level in lower:
        link = f"{above[:-1]}_id"
        here = levels[level].select(
            F.col("id").alias(f"{level[:-1]}_id"),
            F.col("display_name").alias(f"{level[:-1]}_name"),
            link,
        )
        path = here.join(path, link, "left")
        above = level
    names = [f"{level[:-1]}_{part}" for level in reversed(TAXONOMY) for part in ("id", "name")]
    return path.select(*names)


def assemble(children: DataFrame, parent_key: str, size: int = PAGE) -> DataFrame:
    """The children of each record as arrays in their original order: the way back from a cut.

    A record may have any number of children, so they come in pages of at most ``size``; the
    page follows from the position, and no task has to hold more than a page.
    """
    rest = [c for c in children.columns if not c.startswith("_") and c != parent_key]
    page = F.floor(F.col("_pos") / F.lit(size)).alias("page")
    paged = children.groupBy(parent_key, "_file", "_row", page).agg(
        F.array_sort(F.collect_list(F.struct("_pos", *rest))).alias("items")
    )
    return paged.withColumn("items", F.transform("items", lambda item: item.dropFields("_pos")))


def reassemble(
    parents: DataFrame, children: DataFrame, parent_key: str, parent_id: str = "id", size: int = PAGE
) -> DataFrame:
    """All columns of each parent with its children as pages of ``items``: records back from stored tables.

    ``children`` are current rows that kept their origin (`resolve` with ``keep=ARRIVAL``). Those of one
    parent may have come with several of its versions; they stand in order of version and position, each
    version in pages of its own, in order of ``page``. A parent without children has one row with
    an empty list. Children without a parent are left out.
    """
    version = [parent_key, "_file", "_row"]
    # a row a version: few for each parent, whereas a busy parent's pages are never brought together
    before = Window.partitionBy(parent_key).orderBy("_file", "_row").rowsBetween(Window.unboundedPreceding, -1)
    versions = children.groupBy(*version).agg((F.floor(F.max("_pos") / F.lit(size)) + 1).alias("_pages"))
    versions = versions.select(*version, F.coalesce(F.sum("_pages").over(before), F.lit(0)).alias("_before"))
    pages = assemble(children, parent_key, size).join(versions, version).withColumn("page", F.col("_before") + F.col("page"))
    met = parents.join(pages.withColumnRenamed(parent_key, "_parent"), F.col(parent_id) == F.col("_parent"), "left")
    empty = F.array().cast(pages.schema["items"].dataType)
    return met.select(*[parents[c] for c in parents.columns], F.coalesce("page", F.lit(0)).alias("page"), F.coalesce("items", empty).alias("items"))


def compare_counts(
    declared: DataFrame, facts: DataFrame, keys: Sequence[str], declared_count: str
) -> DataFrame:
    """Declared counts next to the number of facts per key, where the two differ.

    A key missing on one side counts as 0 there. Both sides are grouped before they meet.
    """
    said = declared.groupBy(*keys).agg(F.sum(declared_count).cast("bigint").alias("declared"))
    seen = facts.groupBy(*keys).agg(F.count("*").alias("counted"))
    return (
        said.join(seen, list(keys), "full")
        .select(
            *keys,
            F.coalesce("declared", F.lit(0)).alias("declared"),
            F.coalesce("counted", F.lit(0)).alias("counted"),
        )
        .where(F.col("declared") != F.col("counted"))
    )
