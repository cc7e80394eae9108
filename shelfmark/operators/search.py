"""Lookups, ranges, top-k, keyword and containment search."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import tokens


def lookup(rows: DataFrame, column: str, value) -> DataFrame:
    return rows.where(F.col(column) == F.lit(value))


def in_range(rows: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows with ``low <= column <= high``; an open end is None."""
    if low is not None:
        rows = rows.where(F.col(column) >= F.lit(low))
    if high is not None:
        rows = rows.where(F.col(column) <= F.lit(high))
    return rows


def top_k(rows: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties go to the smaller ``tie``."""
    return rows.orderBy(F.desc_nulls_last(by), F.asc(tie)).limit(k)


def wanted_tokens(terms: Sequence[str]) -> Column:
    """The different tokens of the terms, cut as texts are: a term of two words gives two."""
    if not terms:
        return F.array().cast("array<string>")
    return F.array_distinct(F.flatten(F.array(*[tokens(F.lit(t)) for t in terms])))


def keyword(
    rows: DataFrame, column: str, terms: Sequence[str], match: str = "all", rank: bool = False
) -> DataFrame:
    """Rows whose text has all (or any) of the terms' tokens; ``rank`` adds how many it has, ``hits``.

    Terms without any token match no row. A text is cut once: the one-element explode keeps filter and count on the same tokens.
    """
    wanted = wanted_tokens(terms)
    cut = rows.select("*", F.explode(F.array(tokens(F.col(column)))).alias("_tokens"))
    kept = cut.where((F.size(wanted) > 0) & _matches(F.col("_tokens"), wanted, match))
    if rank:
        hits = F.size(F.filter("_tokens", lambda t: F.array_contains(wanted, t)))
        kept = kept.withColumn("hits", hits)
    return kept.drop("_tokens")


def contains(rows: DataFrame, column: str, values: Sequence, match: str = "all") -> DataFrame:
    """Rows whose column holds all (or any) of the values.

    An array is asked for its elements. A VARIANT list is asked for elements that equal a value,
    or are objects all of whose members given in the value (a dict) are equal.
    """
    if isinstance(rows.schema[column].dataType, T.VariantType):
        items = F.try_variant_get(column, "$", "array<variant>")

        def some(value) -> Column:
            return F.exists(items, lambda item: _holds(item, value))

        held = [some(v) for v in values]
        if match not in ("all", "any"):
            raise ValueError("match must be 'all' or 'any'")
        return rows.where(reduce(Column.__and__ if match == "all" else Column.__or__, held))
    wanted = F.array(*[F.lit(v) for v in values])
    return rows.where(_matches(F.col(column), wanted, match))


def _holds(item: Column, value) -> Column:
    if isinstance(value, dict):
        each = [_holds(F.try_variant_get(item, f'$["{k}"]', "variant"), v) for k, v in value.items()]
        return reduce(Column.__and__, each)
    type_ = {bool: "boolean", int: "bigint", float: "double", str: "string"}[type(value)]
    kind = F.schema_of_variant(item)
    same_kind = (kind == "STRING") if type_ == "string" else kind.isin("BOOLEAN") if type_ == "boolean" else ~kind.isin("STRING", "BOOLEAN")
    return F.coalesce(same_kind & (F.try_variant_get(item, "$", type_) == F.lit(value)), F.lit(False))


def _matches(held: Column, wanted: Column, match: str) -> Column:
    if match == "all":
        return held.isNotNull() & (F.size(F.array_except(wanted, held)) == 0)
    if match == "any":
        return F.arrays_overlap(held, wanted)
    raise ValueError("match must be 'all' or 'any'")


def has_word(rows: DataFrame, inverted: str, word: str) -> DataFrame:
    """Rows whose inverted index has the word as a key."""
    return rows.where(F.map_contains_key(inverted, word))
