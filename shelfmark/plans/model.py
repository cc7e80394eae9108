"""Declarative description of one relational table cut out of nested JSON records."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Field:
    """One output column and the rule that fills it.

    how      meaning (``path`` is relative to the row's object unless stated)
    -------  ---------------------------------------------------------------
    value    the value at ``path``, cast to ``type``; absent and null give NULL
    default  as ``value``, but an absent key gives ``absent`` (null stays NULL)
    json     the JSON value as VARIANT; absent gives the JSON text ``absent``, if any
    list     a JSON list of scalars as ARRAY<STRING>; absent gives an empty array
    map      a JSON object as MAP<STRING, ARRAY<INT>>
    first    first element of the list at ``path``; ``inner`` names a key inside it
    length   length of the list at ``path``, 0 when absent
    status   open-access status folded onto the allowed values
    either   first non-empty of ``path`` and ``other``
    record   as ``value``, but ``path`` starts at the record instead of the row's object
    record_list  as ``list``, from the record
    parent   the id of the record
    item     the element itself (tables made from a list of scalars)
    """

    name: str
    type: str = "string"
    how: str = "value"
    path: str = ""
    absent: object = None
    inner: str = ""
    other: str = ""

    @property
    def source(self) -> str:
        return self.path or self.name


@dataclass(frozen=True)
class Table:
    """A target table: where its rows come from, its columns, key and constraints.

    ``rows`` is ``one`` (a row per record, from the object at ``at``), ``present`` (as
    ``one``, but only if that object is not empty), ``many`` (a row per list element) or
    ``items`` (a row per distinct scalar of a list).
    """

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    rows: str = "one"
    at: str = ""
    fallback: str = ""
    policy: str = "last"
    references: tuple[tuple[str, str], ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    comment: str = ""

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)


@dataclass(frozen=True)
class Entity:
    """A kind of record, the tables cut from it, and what strict mode insists on.

    ``objects``: keys that must be objects when present. ``lists``: keys that must be lists
    when present. ``element_objects``: keys of list elements that must be objects when
    present, per list.
    """

    name: str
    tables: tuple[Table, ...]
    objects: tuple[str, ...] = ()
    lists: tuple[str, ...] = ()
    element_objects: dict[str, tuple[str, ...]] = field(default_factory=dict)


def text(*names: str) -> list[Field]:
    return [Field(n) for n in names]


def typed(type_: str, *names: str, path: str = "") -> list[Field]:
    return [Field(n, type_, path=path) for n in names]


def count(*names: str) -> list[Field]:
    """Counters: 0 when the key is absent."""
    return [Field(n, "int", "default", absent=0) for n in names]


def flag(*names: str) -> list[Field]:
    """Booleans: false when the key is absent."""
    return [Field(n, "boolean", "default", absent=False) for n in names]


def names_list(*names: str) -> list[Field]:
    return [Field(n, "array<string>", "list") for n in names]


def opaque(*names: str, absent: str | None = None) -> list[Field]:
    return [Field(n, "variant", "json", absent=absent) for n in names]


def parent(name: str) -> list[Field]:
    return [Field(name, how="parent")]


def from_record(*names: str, path: str = "") -> list[Field]:
    return [Field(n, how="record", path=path or n) for n in names]


def updated() -> list[Field]:
    return [Field("updated_date", "timestamp_ntz", "either", other="updated")]
