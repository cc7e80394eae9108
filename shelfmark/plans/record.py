"""Plan-time reading schema: which JSON paths of a record the target tables need."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import replace

from shelfmark.plans.model import Entity, Field, Table

# What the leaf is read as; rules that must tell absent from null keep the raw VARIANT.
_LEAVES = {
    "default": "variant",
    "json": "variant",
    "list": "variant",
    "record_list": "variant",
    "status": "string",
    "either": "string",
}


def tables_of(
    entity: Entity, names: Collection[str] | None = None, columns: Collection[str] | None = None
) -> list[Table]:
    """The named tables (all by default), reduced to the given columns and their keys."""
    known = {t.name: t for t in entity.tables}
    unknown = [n for n in names or () if n not in known]
    if unknown:
        raise ValueError(f"{entity.name} has no table {', '.join(unknown)}")
    return [narrow(known[n], columns) for n in (known if names is None else names)]


def narrow(table: Table, columns: Collection[str] | None) -> Table:
    if columns is None:
        return table
    kept = tuple(f for f in table.fields if f.name in columns or f.name in table.key)
    return replace(table, fields=kept)


def reading_schema(tables: list[Table]) -> str:
    """The struct type that one cast of the whole record produces."""
    root: dict = {}
    _put(root, "id", "string")
    for table in tables:
        place = _row_place(root, table)
        for f in table.fields:
            _put_field(root, place, f)
        if table.fallback:
            _put(root, table.fallback, "variant")
    for f in (f for table in tables for f in table.fields if f.how == "length"):
        # Lists that are read for another column are in the tree by now.
        root.setdefault(f.path, "array<boolean>")
    return _struct(root)


def element_schema(table: Table) -> str:
    """The struct type of one element of a ``many`` table."""
    place: dict = {}
    for f in table.fields:
        _put_field({}, place, f)
    return _struct(place)


def _row_place(root: dict, table: Table) -> dict | None:
    if table.rows == "items":
        _put(root, table.at, "variant")
        return None
    if table.rows == "many":
        return root.setdefault(table.at, ("list", {}))[1]
    return root.setdefault(table.at, {}) if table.at else root


def _put_field(root: dict, place: dict | None, f: Field) -> None:
    if f.how in ("parent", "item", "length"):
        return
    if f.how in ("record", "record_list"):
        _put(root, f.path or f.name, _LEAVES.get(f.how, f.type))
        return
    if f.how == "first":
        leaf = ("list", {f.inner: "string"}) if f.inner else "array<string>"
        _put(place, f.source, leaf)
        return
    if f.how == "either":
        _put(place, f.other, "string")
    _put(place, f.source, _LEAVES.get(f.how, f.type))


def _put(place: dict, path: str, leaf) -> None:
    *parents, last = path.split(".")
    for name in parents:
        place = place.setdefault(name, {})
    held = place.get(last)
    if held is not None and held != leaf:
        raise ValueError(f"{path} is read both as {held} and as {leaf}")
    place[last] = leaf


def _struct(place: dict) -> str:
    return "struct<" + ",".join(f"`{n}`:{_type(t)}" for n, t in place.items()) + ">"


def _type(node) -> str:
    if isinstance(node, dict):
        return _struct(node)
    if isinstance(node, tuple):
        return f"array<{_struct(node[1])}>"
    return node
