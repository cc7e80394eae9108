"""Error budgets per file, and audits of keys, references, allowed values and NOT NULL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.parse import MALFORMED, OK
from shelfmark.plans.catalog import MAX_ERRORS, TABLES
from shelfmark.plans.model import Table


def error_budget(shaped: DataFrame, max_errors: int = MAX_ERRORS, file: str = "_file") -> DataFrame:
    """Per file: lines, malformed lines, refused records, and whether it may be loaded.

    Only malformed lines count against the budget. The verdict is taken before any write, so
    a file is loaded completely or not at all.
    """
    status = F.col("status")
    return (
        shaped.groupBy(file)
        .agg(
            F.count("*").alias("n_lines"),
            F.count_if(status == OK).alias("n_records"),
            F.count_if(status == MALFORMED).alias("n_malformed"),
            F.count_if(~status.isin(OK, MALFORMED)).alias("n_rejected"),
        )
        .withColumn("ok", F.col("n_malformed") < max_errors)
    )


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, column: str, parents: DataFrame, parent_key: str = "id") -> DataFrame:
    """Values of ``column`` without a parent, and how many child rows hold each.

    The child side is counted per value first, so the join sees every value once.
    """
    held = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    known = parents.select(F.col(parent_key).alias(column))
    return held.join(known, column, "left_anti")


def not_allowed(rows: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the allowed set; NULL passes."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def missing(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def violations(
    tables: Mapping[str, DataFrame], name: str, constraint: str, spec: Table | None = None
) -> DataFrame:
    """The offending keys, values or rows of one constraint: ``primary_key``,
    ``foreign_key:<column>``, ``check:<column>`` or ``not_null:<column>``."""
    spec = spec or TABLES[name]
    kind, _, column = constraint.partition(":")
    if kind == "primary_key":
        return duplicate_keys(tables[name], spec.key)
    if kind == "foreign_key":
        return orphans(tables[name], column, tables[dict(spec.references)[column]])
    if kind == "check":
        return not_allowed(tables[name], column, spec.allowed[column])
    if kind == "not_null":
        return missing(tables[name], column)
    raise ValueError(f"unknown constraint {constraint!r}")


def validate(tables: Mapping[str, DataFrame], specs: Sequence[Table] | None = None) -> DataFrame:
    """(table, constraint, n_bad) for every declared constraint of the given tables.

    NOT NULL and allowed values of a table share one pass over it. References to a table that
    is not given are left out.
    """
    summary: list[DataFrame] = []
    for spec in specs or [TABLES[n] for n in tables]:
        rows = tables[spec.name]
        repeated = duplicate_keys(rows, spec.key).agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("n_bad")
        )
        summary.append(_labelled(repeated, spec.name, "primary_key"))
        for column, parent in spec.references:
            if parent in tables:
                lost = orphans(rows, column, tables[parent]).agg(
                    F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_bad")
                )
                summary.append(_labelled(lost, spec.name, f"foreign_key:{column}"))
        summary.append(_row_checks(rows, spec))
    merged = summary[0]
    for part in summary[1:]:
        merged = merged.unionByName(part)
    return merged


def audit(tables: Mapping[str, DataFrame], specs: Sequence[Table] | None = None) -> DataFrame:
    """(table_name, constraint, n_bad): what `validate` says, in one pass over each table and one shuffle.

    Every table gives rows (constraint, value, n, parents) for all its constraints at once: its keys, the
    values of its references, its own ids for each reference that points at it, and flags for NOT NULL and
    allowed values, which have no value. They are added up per value before and after one exchange, so a
    value that a third of all rows share is a row a task. A key's rows beyond the first are bad, and
    all rows of a value of a reference whose parent is nowhere; the rest is a sum per constraint.
    References to a table that is not given are left out.
    """
    specs = list(specs or [TABLES[n] for n in tables])
    names: list[tuple[str, str]] = []

    def number(table: str, constraint: str) -> Column:
        names.append((table, constraint))
        return F.lit(len(names) - 1)

    rows: dict[str, list[Column]] = {s.name: [] for s in specs}

    def add(table: str, constraint: Column, value: Column, n: Column, parents: int = 0) -> None:
        rows[table].append(
            F.struct(constraint.alias("c"), value.alias("value"), n.cast("bigint").alias("n"), F.lit(parents).alias("parents"))
        )

    nothing = F.lit(None).cast("array<string>")
    given = {s.name: s for s in specs}
    kinds: list[str] = []
    for spec in specs:
        key = F.array(*[F.col(k).cast("string") for k in spec.key])
        add(spec.name, number(spec.name, "primary_key"), key, F.lit(1))
        kinds.append("key")
        for column, parent in spec.references:
            if parent in given:
                c = number(spec.name, f"foreign_key:{column}")
                kinds.append("reference")
                add(spec.name, c, F.when(F.col(column).isNotNull(), F.array(F.col(column).cast("string"))), F.lit(1))
                add(parent, c, F.array(F.col("id").cast("string")), F.lit(0), 1)
        for column in dict.fromkeys((*spec.key, *spec.required)):
            add(spec.name, number(spec.name, f"not_null:{column}"), nothing, F.col(column).isNull())
            kinds.append("flag")
        for column, allowed in spec.allowed.items():
            bad = F.coalesce(~F.col(column).isin(*allowed), F.lit(False))
            add(spec.name, number(spec.name, f"check:{column}"), nothing, bad)
            kinds.append("flag")
    parts = [tables[s.name].select(F.inline(F.array(*rows[s.name]))) for s in specs]
    all_rows = reduce(DataFrame.unionAll, parts)
    counted = all_rows.groupBy("c", "value").agg(F.sum("n").alias("n"), F.max("parents").alias("parents"))
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("c") + 1)
    bad = (
        F.when(kind == "key", F.col("n") - 1)
        .when(kind == "reference", F.when((F.col("parents") == 0) & F.col("value").isNotNull(), F.col("n")).otherwise(0))
        .otherwise(F.col("n"))
    )
    summed = counted.groupBy("c").agg(F.sum(bad).cast("bigint").alias("n_bad"))  # a row a constraint
    named = all_rows.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], "c int, table_name string, constraint string")
    return named.join(summed, "c", "left").select("table_name", "constraint", F.coalesce("n_bad", F.lit(0)).alias("n_bad"))


def _labelled(counted: DataFrame, table: str, constraint: str) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint"), "n_bad"
    )


def _row_checks(rows: DataFrame, spec: Table) -> DataFrame:
    counts = {}
    for column in dict.fromkeys((*spec.key, *spec.required)):
        counts[f"not_null:{column}"] = F.count_if(F.col(column).isNull())
    for column, allowed in spec.allowed.items():
        counts[f"check:{column}"] = F.count_if(
            F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
        )
    one = rows.agg(
        F.array(
            *[F.struct(F.lit(name).alias("constraint"), n.alias("n_bad")) for name, n in counts.items()]
        ).alias("found")
    )
    return one.select(F.inline("found")).select(
        F.lit(spec.name).alias("table_name"), "constraint", "n_bad"
    )
