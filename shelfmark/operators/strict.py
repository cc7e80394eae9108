"""Strict mode: why a record would be refused because of the JSON type of a container."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions import variants as V
from shelfmark.plans.model import Entity


def strict_reason(entity: Entity, v: Column, root: str = "$") -> Column:
    """The first offending key of the record at ``root``, NULL when it is acceptable."""
    rules: list[tuple[str, Column]] = []
    for key in entity.lists:
        rules.append((key, V.not_a_list(v, f"{root}.{key}")))
    for key in entity.objects:
        rules.append((key, V.not_an_object(v, f"{root}.{key}")))
    for key in entity.lists:
        rules.append((key, _any_element(v, f"{root}.{key}", entity.element_objects.get(key, ()))))
    if entity.name == "works":
        rules.extend(_works_rules(v, root))
    return F.coalesce(*[F.when(broken, F.lit(key)) for key, broken in rules])


def _any_element(
    v: Column,
    path: str,
    objects: tuple[str, ...],
    others: tuple[str, ...] = (),
    more: Callable[[Column], Column] | None = None,
) -> Column:
    """Whether an element of the list is no object, or has a wrong value under ``objects``.

    One cast takes out just the keys that are looked at; an element that is no object comes
    out as NULL.
    """
    looked_at = "".join(f"`{name}`:variant," for name in (*objects, *others))
    elements = F.try_variant_get(v, path, f"array<struct<{looked_at}`_`:boolean>>")

    def broken(element: Column) -> Column:
        bad = element.isNull()
        for name in objects:
            bad = bad | _wrong_object(element[name])
        return bad if more is None else bad | more(element)

    return F.coalesce(F.exists(elements, broken), F.lit(False))


def _wrong_object(item: Column) -> Column:
    return item.isNotNull() & ~V.is_object(item)


def _works_rules(v: Column, root: str) -> list[tuple[str, Column]]:
    stand_in = ~V.is_falsy(v, f"{root}.primary_location") & V.is_falsy(v, f"{root}.locations")
    bad_stand_in = ~V.is_object(v, f"{root}.primary_location") | V.not_an_object(
        v, f"{root}.primary_location.source"
    )
    return [
        ("referenced_works", V.not_iterable(v, f"{root}.referenced_works")),
        ("locations", V.not_a_list(v, f"{root}.locations") & ~stand_in),
        ("locations", bad_stand_in & stand_in),
        ("locations", _any_element(v, f"{root}.locations", ("source",))),
        (
            "authorships",
            _any_element(
                v, f"{root}.authorships", (), ("raw_affiliation_strings", "institutions"), _bad_places
            ),
        ),
        ("biblio", ~V.is_object(v, f"{root}.biblio") & ~V.is_falsy(v, f"{root}.biblio")),
    ]


def _bad_places(authorship: Column) -> Column:
    places = authorship["institutions"]
    return V.not_iterable(authorship["raw_affiliation_strings"]) | (
        ~V.is_object(places, "$[0]") & ~V.is_falsy(places)
    )
