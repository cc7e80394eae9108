"""Keyed upsert as a fold over arrivals.

All policies are one grouped aggregate, so equal keys are combined before the shuffle and a key
that holds a large part of the rows still reaches its final task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = ("_file", "_row", "_pos")
POLICIES = ("last", "first")


def fold(
    rows: DataFrame, keys: Sequence[str], policy: str, order: Sequence[str | Column], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the last (or first) one in ``order``, taken as a whole, NULLs included.

    ``order`` must be total within a key. Columns starting with an underscore are dropped, but for
    those of ``keep``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    pick = F.max_by if policy == "last" else F.min_by
    columns = [c for c in rows.columns if c in keep or not c.startswith("_")]
    rest = [c for c in columns if c not in keys]
    by = F.struct(*order)
    if not rest:  # nothing but the key
        return rows.select(*keys).distinct()
    chosen = rows.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_kept"))
    return chosen.select(*[F.col(f"_kept.{c}").alias(c) if c in rest else c for c in columns])


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    policy: str = "last",
    order: Sequence[str] = ARRIVAL,
    newest_by: str | None = None,
) -> DataFrame:
    """Merge ``incoming`` into ``existing`` with one fold.

    ``existing`` is a table that is unique by ``keys``, or earlier arrivals that still have the
    ``order`` columns: those need no fold of their own.
    ``last``: arrival order decides, whatever was there before is overwritten. ``first``: a row
    that is already there is never touched. ``newest_by`` compares that column before the
    arrival order, so an old version cannot overwrite a newer one.
    """
    columns = [c for c in incoming.columns if not c.startswith("_")]
    arrivals = incoming.select(
        *columns, F.lit(1).alias("_turn"), *[F.col(c).alias(f"_by_{c}") for c in order]
    )
    if existing is not None:
        types = dict(arrivals.dtypes)
        held = existing.select(
            *columns,
            F.lit(0).alias("_turn"),
            *[
                (F.col(c) if c in existing.columns else F.lit(None).cast(types[f"_by_{c}"])).alias(f"_by_{c}")
                for c in order
            ],
        )
        arrivals = held.unionByName(arrivals)
    by = ["_turn", *[f"_by_{c}" for c in order]]
    if newest_by:
        by = [F.col(newest_by).alias("_newest"), *by]
    return fold(arrivals, keys, policy, by)


def replace_children(
    existing: DataFrame | None,
    incoming: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    parent_key: str,
    parent_id: str = "id",
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Upsert of child rows in which a new version of a parent replaces all its children.

    ``parents`` are the incoming parent rows with their origin; the children of a parent that
    arrived again survive only if they came with its last version.
    """
    version = ["_file", "_row"]
    last = parents.groupBy(F.col(parent_id).alias(parent_key)).agg(
        F.max(F.struct(*version)).alias("_last")
    )
    newest = last.select(parent_key, *[F.col(f"_last.{c}").alias(c) for c in version])
    # joined on parent and version: the versions of one busy parent spread over the tasks
    fresh = incoming.join(newest, [parent_key, *version], "left_semi")
    kept = None if existing is None else existing.join(last.select(parent_key), parent_key, "left_anti")
    return upsert(kept, fresh, keys, "last", order)
