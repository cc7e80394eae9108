"""Nested records to relational tables.

``shape`` casts every record once into a typed nested row; that is the form to store. ``cut``
takes one table out of it, reading only the nested columns the table needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import scalars as S
from shelfmark.functions import variants as V
from shelfmark.operators.parse import FRAME, NO_ID, OK, RECORD, STRICT
from shelfmark.operators.strict import strict_reason
from shelfmark.plans.catalog import TABLES, entity as find_entity
from shelfmark.plans.model import Entity, Field, Table
from shelfmark.plans.record import element_schema, narrow, reading_schema, tables_of

MODES = ("lenient", "strict")


def shape(
    parsed: DataFrame, entity: str, mode: str = "lenient", tables=None, columns=None, lost: bool = False
) -> DataFrame:
    """One typed row per line: origin, ``status``, ``raw``, ``id`` and the record ``rec``.

    ``tables`` and ``columns`` limit what is read from the records. ``lost`` adds the values that no
    typed column can hold (`lost_values`) as column ``lost``.

    ``lenient`` sets aside malformed lines, non-objects and records without id; ``strict``
    also records whose containers have the wrong JSON type. No line is dropped.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spec = find_entity(entity)
    wanted = tables_of(spec, tables, columns)
    origin = [c for c in parsed.columns if c.startswith("_")]
    framed = F.col(FRAME)
    status = F.col("status")
    if mode == "strict":
        reason = F.when(status == OK, strict_reason(spec, framed, RECORD))
        status = F.coalesce(F.concat(F.lit(STRICT), reason), status)
    record_id = F.try_variant_get(framed, f"{RECORD}.id", "string")
    return parsed.select(
        *origin,
        status.alias("_status"),
        "raw",
        FRAME,
        record_id.alias("id"),
        *_presence_flags(wanted, framed),
        *([F.when(status == OK, lost_values(wanted, framed)).alias("lost")] if lost else []),
        # the one-element explode keeps the cast from being repeated in what uses its result
        F.explode(F.array(F.try_variant_get(framed, RECORD, reading_schema(wanted)))).alias("rec"),
    ).select(
        *origin,
        F.when((F.col("_status") == OK) & F.col("id").isNull(), NO_ID)
        .otherwise(F.col("_status"))
        .alias("status"),
        # lines refused here are shown as the JSON that was read
        F.when(F.col("raw").isNotNull(), F.col("raw"))
        .when((F.col("_status") != OK) | F.col("id").isNull(), F.to_json(V.child(F.col(FRAME), RECORD)))
        .alias("raw"),
        "id",
        *flag_names(wanted),
        *(["lost"] if lost else []),
        "rec",
    )


def flag_names(tables: list[Table]) -> list[str]:
    present = [f"has_{t.at}" for t in tables if t.rows == "present"]
    return present + [f"use_{t.fallback}" for t in tables if t.fallback]


def _presence_flags(tables: list[Table], framed: Column) -> list[Column]:
    """What a typed cast cannot tell: whether a container was there but empty."""
    flags = {}
    for t in tables:
        if t.rows == "present":
            flags[f"has_{t.at}"] = ~V.is_falsy(framed, f"{RECORD}.{t.at}")
        if t.fallback:
            flags[f"use_{t.fallback}"] = V.is_falsy(framed, f"{RECORD}.{t.at}") & ~V.is_falsy(
                framed, f"{RECORD}.{t.fallback}"
            )
    return [flags[name].alias(name) for name in flag_names(tables)]


def cut(
    shaped: DataFrame, table: str, mode: str = "lenient", good_keys: bool = True, columns=None
) -> DataFrame:
    """The rows of one table, with their origin (``_file``, ``_row``, ``_pos``).

    ``good_keys=False`` gives the rows whose key has a NULL part instead.
    """
    spec = narrow(TABLES[table], columns)
    origin = [c for c in shaped.columns if c.startswith("_")]
    good = shaped.where(F.col("status") == OK)
    has_lengths = any(f.how == "length" for f in spec.fields)
    record_type = shaped.schema["rec"].dataType if has_lengths else None
    if spec.rows in ("one", "present"):
        if spec.rows == "present":
            good = good.where(F.col(f"has_{spec.at}"))
        base = f"rec.{spec.at}" if spec.at else "rec"
        rows = good.select(
            *origin,
            F.lit(0).alias("_pos"),
            *[_fill(f, base, record_type, mode).alias(f.name) for f in spec.fields],
        )
    elif spec.rows == "many":
        carried = [f for f in spec.fields if f.how in ("record", "record_list")]
        rows = good.select(
            *origin,
            "id",
            *[_fill(f, "rec", record_type, mode).alias(f"rec_{f.name}") for f in carried],
            F.posexplode_outer(_elements(spec)).alias("_pos", "item"),
        ).where(F.col("_pos").isNotNull())
        rows = rows.select(
            *origin,
            "_pos",
            *[
                (F.col(f"rec_{f.name}") if f in carried else _fill(f, "item", None, mode)).alias(
                    f.name
                )
                for f in spec.fields
            ],
        )
    else:
        scalars = F.array_distinct(V.names_or_empty(F.col(f"rec.{spec.at}")))
        rows = good.select(
            *origin, "id", F.posexplode_outer(scalars).alias("_pos", "item")
        ).where(F.col("_pos").isNotNull())
        rows = rows.select(
            *origin,
            "_pos",
            *[
                (F.col("id") if f.how == "parent" else F.col("item")).alias(f.name)
                for f in spec.fields
            ],
        )
    complete = F.lit(True)
    for k in spec.key:
        complete = complete & F.col(k).isNotNull()
    return rows.where(complete if good_keys else ~complete)


def _elements(spec: Table) -> Column:
    listed = F.col(f"rec.{spec.at}")
    if not spec.fallback:
        return listed
    alone = F.try_variant_get(F.col(f"rec.{spec.fallback}"), "$", element_schema(spec))
    return F.when(F.col(f"use_{spec.fallback}"), F.array(alone)).otherwise(listed)


def _fill(f: Field, base: str, record_type: T.StructType | None, mode: str) -> Column:
    here = F.col(f"{base}.{f.source}") if f.how not in ("parent", "length") else None
    if f.how == "value":
        return here
    if f.how == "default":
        return V.presence_default(here, f.type, f.absent)
    if f.how == "json":
        return V.json_or_null(here, f.absent)
    if f.how == "list":
        return V.names_or_empty(here)
    if f.how == "map":
        return here
    if f.how == "first":
        head = V.first(here)
        return head[f.inner] if f.inner else head
    if f.how == "status":
        return S.oa_status(here)
    if f.how == "either":
        return V.first_truthy(here, F.col(f"{base}.{f.other}")).try_cast(f.type)
    if f.how == "parent":
        return F.col("id")
    if f.how == "record":
        return F.col(f"rec.{f.source}")
    if f.how == "record_list":
        return V.names_or_empty(F.col(f"rec.{f.source}"))
    if f.how == "length":
        items = F.col(f"rec.{f.path}")
        if isinstance(record_type[f.path].dataType, T.VariantType):
            return _raw_length(items, mode)
        return V.length(items)
    raise ValueError(f"unknown rule {f.how}")


def _raw_length(item: Column, mode: str) -> Column:
    size = F.size(F.try_variant_get(item, "$", "array<string>"))
    if mode == "strict":  # strict counts whatever has a length: members, characters
        members = F.size(F.map_keys(F.try_variant_get(item, "$", "map<string,string>")))
        size = F.coalesce(size, members, F.length(F.try_variant_get(item, "$", "string")))
    return F.coalesce(size, F.lit(0))


def shred(parsed: DataFrame, entity: str, mode: str = "lenient", tables=None) -> dict[str, DataFrame]:
    """All tables of an entity, plus ``quarantine`` (lines) and ``quarantine_child`` (rows)."""
    return cut_all(shape(parsed, entity, mode, tables), find_entity(entity), mode, tables)


def cut_all(shaped: DataFrame, spec: Entity, mode: str = "lenient", tables=None) -> dict[str, DataFrame]:
    wanted = tables_of(spec, tables)
    out = {t.name: cut(shaped, t.name, mode) for t in wanted}
    out["quarantine"] = quarantine(shaped, spec.name)
    children = [quarantine_child(shaped, t.name, mode) for t in wanted if t.rows == "many"]
    if children:
        merged = children[0]
        for c in children[1:]:
            merged = merged.unionByName(c)
        out["quarantine_child"] = merged
    return out


def quarantine(shaped: DataFrame, entity: str) -> DataFrame:
    """Lines that gave no record, with the reason and their text."""
    origin = [c for c in shaped.columns if c.startswith("_")]
    return shaped.where(F.col("status") != OK).select(
        F.lit(entity).alias("entity"), *origin, F.col("status").alias("reason"), "raw"
    )


_LOST = "struct<table_name: string, column_name: string, pos: int, value: string>"


def _entry(table: str, column: str, pos: Column, value: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), pos.cast("int").alias("pos"), F.to_json(value).alias("value"))


def _lost_of(t: Table, held: Column, base: str, pos: Column) -> list[Column]:
    """Entries for the typed columns of one row's object, NULL where nothing is lost."""
    found = []
    for f in t.fields:
        if f.type == "string" or f.how not in ("value", "default", "record", "either"):
            continue
        if f.how == "default" and base.startswith("$["):  # kept as VARIANT: `bad_values` looks at them
            continue
        if f.how == "record" and not base.startswith("$["):
            continue
        path = f"{RECORD}.{f.source}" if f.how == "record" else f"{base}.{f.source}"
        raw = V.child(held, path)
        if f.how == "either":
            other = V.child(held, f"{base}.{f.other}")
            raw = F.when(F.coalesce(F.try_variant_get(raw, "$", "string") != "", F.lit(False)), raw).otherwise(other)
        typed = F.try_variant_get(raw, "$", "string").try_cast(f.type) if f.how == "either" else F.try_variant_get(raw, "$", f.type)
        lost = typed.isNull()
        if f.type in ("smallint", "int", "bigint"):
            lost = lost | (F.try_variant_get(raw, "$", "double") != typed)
        empty = F.to_json(raw) == '""' if f.how == "either" else F.lit(False)
        found.append(F.when(raw.isNotNull() & ~F.is_variant_null(raw) & ~empty & lost, _entry(t.name, f.name, pos, raw)))
    return found


def _lost_of_element(t: Table) -> Callable[[Column, Column], Column]:
    """The entries of one element of a list table, by the element and its place."""

    def entries(item: Column, i: Column) -> Column:
        whole = F.when(~F.is_variant_null(item) & ~V.is_object(item), _entry(t.name, t.at, i, item))
        return F.array_compact(F.array(whole, *_lost_of(t, item, "$", i)))

    return entries


def lost_values(tables: list[Table], framed: Column) -> Column:
    """What of a record no typed column can hold: (table_name, column_name, pos, value as JSON text).

    Numbers with a fraction where whole ones belong, values of another kind, dates that are none, of the
    record, its objects and the elements of its lists (``pos`` is the element's place); list elements
    that are no objects (``column_name`` is that of the list); and values other than lists where a list of
    rows belongs (without ``pos``).
    """
    parts = []
    none = F.lit(None)
    for t in tables:
        at = f"{RECORD}.{t.at}" if t.at else RECORD
        if t.rows in ("one", "present"):
            found = _lost_of(t, framed, at, none)
            if found:
                parts.append(F.array_compact(F.array(*found)))
            continue
        held = V.child(framed, at)
        other = F.when(held.isNotNull() & ~F.is_variant_null(held) & ~V.is_list(held), _entry(t.name, t.at, none, held))
        parts.append(F.array_compact(F.array(other)))
        if t.rows == "many":
            items = F.try_variant_get(held, "$", "array<variant>")
            parts.append(F.coalesce(F.flatten(F.transform(items, _lost_of_element(t))).cast(f"array<{_LOST}>"), F.array().cast(f"array<{_LOST}>")))
    if not parts:
        return F.array().cast(f"array<{_LOST}>")
    return F.concat(*[p.cast(f"array<{_LOST}>") for p in parts])


def bad_values(shaped: DataFrame, entity: str) -> DataFrame:
    """Values of a record that a column can't hold, as JSON text with table, column and place in its list.

    These are values other than lists where a list of names is wanted, counts or flags of another kind
    or with a fraction, and what `shape` noted as lost, if it was asked to. The columns read NULL or the
    whole part, and a list table has no row of what is no element of a list; nothing else of the record
    is affected.
    """
    held = set(shaped.schema["rec"].dataType.names)
    found = []
    for t in find_entity(entity).tables:
        if t.rows not in ("one", "present") or (t.at and t.at not in held):
            continue
        place = shaped.schema["rec"].dataType[t.at].dataType if t.at else shaped.schema["rec"].dataType
        base = f"rec.{t.at}" if t.at else "rec"
        for f in t.fields:
            if f.how not in ("list", "default") or "." in f.source or f.source not in place.names:
                continue
            here = F.col(f"{base}.{f.source}")
            typed = _fill(f, base, None, "lenient")
            lost = typed.isNull()
            if f.type in ("int", "bigint"):
                lost = lost | (F.try_variant_get(here, "$", "double") != typed)
            present = here.isNotNull() & ~F.is_variant_null(here)
            found.append(F.when(present & lost, _entry(t.name, f.name, F.lit(None), here)))
    origin = [c for c in shaped.columns if c.startswith("_")]
    rows = shaped.where(F.col("status") == OK)
    values = F.array_compact(F.array(*found, F.lit(None).cast(_LOST)))
    if "lost" in shaped.columns:
        values = F.concat(values, F.coalesce("lost", F.array().cast(f"array<{_LOST}>")))
    return rows.select(*origin, "id", F.inline(values))


def quarantine_child(shaped: DataFrame, table: str, mode: str = "lenient") -> DataFrame:
    """Child rows that cannot be keyed, as JSON text."""
    rows = cut(shaped, table, mode, good_keys=False)
    origin = [c for c in rows.columns if c.startswith("_")]
    return rows.select(
        F.lit(table).alias("table_name"),
        *origin,
        F.to_json(F.struct(*TABLES[table].columns)).alias("row"),
    )
