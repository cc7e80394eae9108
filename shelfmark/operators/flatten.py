"""Nested records to flat columns, CSV files, and plain appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import variants as V

def record_type(records: DataFrame, column: str = "v") -> T.StructType:
    """The merged type of all records: one aggregate over the whole input."""
    found = records.select(F.schema_of_variant_agg(column)).first()[0]
    merged = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))
    if not isinstance(merged, T.StructType):
        raise ValueError(f"records are not objects throughout: {found}")
    return merged


def flatten(
    records: DataFrame,
    column: str = "v",
    text: str | None = None,
    opaque: Sequence[str] = (),
    sep: str = "_",
    schema: T.StructType | None = None,
) -> DataFrame:
    """One column per scalar path, names joined by ``sep``; lists become JSON text.

    ``opaque`` names dotted paths kept as JSON text: objects whose keys are data, such as
    inverted indexes. If two paths give the same name, the key that comes later in the record
    wins; its order is read from ``text``, the column with the record's JSON text.
    """
    schema = schema or record_type(records, column)
    leaves = _leaves(schema, (), frozenset(opaque))
    named: dict[str, list] = {}
    for path, type_ in leaves:
        named.setdefault(sep.join(path), []).append((path, type_))
    origin = [c for c in records.columns if c.startswith("_")]
    return records.select(
        *origin, *[_column(column, found, text).alias(name) for name, found in named.items()]
    )


def _leaves(type_: T.DataType, path: tuple[str, ...], opaque: frozenset) -> list:
    if isinstance(type_, T.StructType) and ".".join(path) not in opaque:
        return [leaf for f in type_.fields for leaf in _leaves(f.dataType, (*path, f.name), opaque)]
    return [(path, type_)]


def _path(path: Sequence[str]) -> str:
    return "$" + "".join('["' + p.replace('"', '\\"') + '"]' for p in path)


def _value(column: str, path: tuple[str, ...], type_: T.DataType) -> Column:
    item = V.child(F.col(column), _path(path))
    if isinstance(type_, (T.ArrayType, T.StructType)):
        return V.json_text(item)
    if isinstance(type_, (T.NullType, T.VariantType)):
        return F.try_variant_get(item, "$", "string")
    name = "double" if isinstance(type_, T.DecimalType) else type_.simpleString()
    return F.try_variant_get(item, "$", name)


def _column(column: str, found: list, text: str | None) -> Column:
    if len(found) == 1:
        return _value(column, *found[0])
    if text is None:
        names = [".".join(path) for path, _ in found]
        raise ValueError(f"{' and '.join(names)} give the same column; pass the text column")
    shared = _shared([path for path, _ in found])
    level = F.get_json_object(F.col(text), _path(shared).replace('"', "'")) if shared else F.col(text)
    keys = F.json_object_keys(level)
    types = {t.simpleString() for _, t in found}
    chosen, place = F.lit(None), F.lit(-1)
    for path, type_ in found:
        here = F.coalesce(F.array_position(keys, path[len(shared)]), F.lit(0))
        present = ~V.is_absent(F.col(column), _path(path)) & (here > place)
        value = _value(column, path, type_)
        value = value if len(types) == 1 else value.cast("string")
        chosen = F.when(present, value).otherwise(chosen)
        place = F.when(present, here).otherwise(place)
    return chosen


def _shared(paths: Sequence[tuple[str, ...]]) -> tuple[str, ...]:
    shared = []
    for parts in zip(*paths):
        if len(set(parts)) > 1:
            break
        shared.append(parts[0])
    return tuple(shared)


_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; missing values stay empty, nested values become JSON text."""
    shown = [
        F.to_json(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        else F.col(f"`{f.name}`")
        for f in rows.schema.fields
    ]
    rows.select(*shown).write.mode(mode).options(**{k: v for k, v in _CSV.items() if k != "multiLine"}).csv(path)


def bulk_append(rows: DataFrame, path: str) -> None:
    """Append all rows as they are; keys are not looked at."""
    rows.write.mode("append").parquet(path)
