"""Column functions on VARIANT values that keep an absent key apart from an explicit null.

Type tests cast to the narrowest type of their kind, so no list element or member is copied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SOME_LIST = "array<boolean>"
_SOME_OBJECT = "struct<`_`:boolean>"

# The JSON texts of values that count as false.
_FALSY_JSON = r'^(null|false|""|\[\]|\{\}|-?0(\.0*)?([eE][-+]?\d+)?)$'


def child(value: Column, path: str) -> Column:
    """The value at ``path`` as VARIANT: SQL NULL when absent, variant null when null."""
    return F.try_variant_get(value, path, "variant")


def is_absent(value: Column, path: str) -> Column:
    return child(value, path).isNull()


def is_null(value: Column, path: str) -> Column:
    """True for an explicit JSON null only."""
    return F.coalesce(F.is_variant_null(child(value, path)), F.lit(False))


def get_default(value: Column, path: str, type_: str, absent) -> Column:
    """The value at ``path``; ``absent`` when the key is missing, NULL when it is null."""
    return presence_default(child(value, path), type_, absent)


def presence_default(item: Column, type_: str, absent) -> Column:
    """As :func:`get_default` for a value already taken out as VARIANT."""
    fallback = absent if isinstance(absent, Column) else F.lit(absent)
    return F.when(item.isNull(), fallback.cast(type_)).otherwise(
        F.try_variant_get(item, "$", type_)
    )


def json_or_null(item: Column, absent: str | None = None) -> Column:
    """VARIANT with JSON null turned into SQL NULL and an optional value for absent keys."""
    kept = F.when(~F.is_variant_null(item), item)
    if absent is None:
        return kept
    return F.when(item.isNull(), F.parse_json(F.lit(absent))).otherwise(kept)


def json_text(item: Column, absent: str | None = None) -> Column:
    """The JSON text of a VARIANT; null gives NULL, an absent key gives ``absent``."""
    return F.to_json(json_or_null(item, absent))


def names_or_empty(item: Column) -> Column:
    """A JSON list of scalars; empty when the key is absent, NULL when it is null."""
    return F.when(item.isNull(), F.array().cast("array<string>")).otherwise(
        F.try_variant_get(item, "$", "array<string>")
    )


def length(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def list_size(value: Column, path: str = "$") -> Column:
    """Number of elements, NULL when the value is not a list."""
    return F.size(F.try_variant_get(value, path, _SOME_LIST))


def is_list(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, _SOME_LIST).isNotNull()


def is_object(value: Column, path: str = "$") -> Column:
    return F.try_variant_get(value, path, _SOME_OBJECT).isNotNull()


def is_falsy(value: Column, path: str = "$") -> Column:
    """Absent, null, empty list or object, empty text, zero or false."""
    shown = F.to_json(child(value, path))
    return F.when(list_size(value, path) > 0, F.lit(False)).otherwise(
        F.coalesce(shown.rlike(_FALSY_JSON), F.lit(True))
    )


def first_truthy(*texts: Column) -> Column:
    """The first text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def not_a_list(value: Column, path: str = "$") -> Column:
    """Present, and not something a loop over list elements could run on.

    An empty object or empty text has no elements and is let through.
    """
    shown = F.to_json(child(value, path))
    return F.when(is_list(value, path), F.lit(False)).otherwise(
        F.coalesce(~shown.isin("{}", '""'), F.lit(False))
    )


def not_an_object(value: Column, path: str = "$") -> Column:
    """Present (null included) and not an object."""
    return ~is_object(value, path) & child(value, path).isNotNull()


def not_iterable(value: Column, path: str = "$") -> Column:
    """Present, and neither a list, an object nor a text."""
    other = F.coalesce(~F.to_json(child(value, path)).startswith('"'), F.lit(False))
    return ~is_list(value, path) & ~is_object(value, path) & other
