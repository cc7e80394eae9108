"""The relational target model: entities, tables, keys and constraints.

Fixed values: table names, column names, column types, keys, allowed values and JSON paths
are given by the public data format and must not change. Shared shapes (ids, yearly counts,
taxonomy levels, concepts) are produced by small rules.
"""

from __future__ import annotations

from shelfmark.plans.model import (
    Entity,
    Field,
    Table,
    count,
    flag,
    from_record,
    names_list,
    opaque,
    parent,
    text,
    typed,
    updated,
)

OA_STATUSES = ("diamond", "gold", "green", "bronze", "hybrid", "closed")
AUTHOR_POSITIONS = ("first", "middle", "last")
TAXONOMY = ("domains", "fields", "subfields", "topics")
MAX_ERRORS = 100


def _table(name, fields, key, **rest) -> Table:
    return Table(name, tuple(f for group in fields for f in group), tuple(key), **rest)


def _yearly(entity: str, own: str, counters: tuple[str, ...]) -> Table:
    return _table(
        f"{entity}_counts_by_year",
        [parent(own), typed("int", "year"), count(*counters)],
        (own, "year"),
        rows="many",
        at="counts_by_year",
        references=((own, entity),),
    )


def _ids(entity: str, own: str, fields) -> Table:
    return _table(
        f"{entity}_ids", [parent(own), *fields], (own,), at="ids", references=((own, entity),)
    )


def _concepts(entity: str, own: str, at: str, references=()) -> Table:
    return _table(
        f"{entity}_concepts",
        [
            parent(own),
            [Field("concept_id", path="id")],
            typed("float", "score"),
            text("display_name"),
            typed("smallint", "level"),
            text("wikidata"),
        ],
        (own, "concept_id"),
        rows="many",
        at=at,
        references=references,
    )


def _edges(at: str, other: str) -> Table:
    return _table(
        f"works_{at}",
        [parent("work_id"), [Field(other, how="item")]],
        ("work_id", other),
        rows="items",
        at=at,
        references=(("work_id", "works"),),
    )


def _self_id() -> list[Field]:
    """The ids tables of all entities but works repeat the record's own id."""
    return from_record("openalex", path="id")


_OF_WORK = (("work_id", "works"),)

WORKS = Entity(
    "works",
    tables=(
        _table(
            "works",
            [
                text("id", "doi", "doi_registration_agency", "display_name", "title"),
                typed("int", "publication_year"),
                text("publication_date", "type", "type_crossref", "type_id"),
                text("language", "language_id"),
                count("cited_by_count"),
                text("cited_by_api_url"),
                [Field("abstract_inverted_index", "map<string,array<int>>", "map")],
                opaque("cited_by_percentile_year"),
                flag("is_retracted", "is_paratext"),
                names_list("indexed_in"),
                flag("has_fulltext"),
                [
                    Field("authors_count", "int", "length", path="authorships"),
                    Field("concepts_count", "int", "length", path="concepts"),
                    Field("topics_count", "int", "length", path="topics"),
                    Field("referenced_works_count", "int", "length", path="referenced_works"),
                ],
                names_list("referenced_works", "related_works"),
                opaque("primary_location", "best_oa_location"),
                typed("int", "locations_count"),
                opaque("primary_topic"),
                opaque("sustainable_development_goals", "keywords", absent="[]"),
                typed("double", "fwci"),
                opaque("citation_normalized_percentile"),
                opaque("grants", absent="[]"),
                typed("double", "apc_list", "apc_paid"),
                typed("date", "created_date"),
                updated(),
            ],
            ("id",),
            comment="One row per scholarly work",
        ),
        _ids(
            "works",
            "work_id",
            [
                text("openalex"),
                from_record("doi"),
                typed("bigint", "mag"),
                text("pmid", "pmcid", "wikidata"),
            ],
        ),
        _table(
            "works_locations",
            [
                parent("work_id"),
                [Field("source_id", path="source.id")],
                text("landing_page_url", "pdf_url"),
                flag("is_oa"),
                text("version", "license"),
                flag("is_accepted", "is_published"),
            ],
            ("work_id", "source_id"),
            rows="many",
            at="locations",
            fallback="primary_location",
            policy="first",
        ),
        _table(
            "works_open_access",
            [
                parent("work_id"),
                flag("is_oa"),
                [Field("oa_status", how="status")],
                text("oa_url"),
                flag("any_repository_has_fulltext"),
            ],
            ("work_id",),
            at="open_access",
            policy="first",
            references=_OF_WORK,
            allowed={"oa_status": OA_STATUSES},
        ),
        _table(
            "works_authorships",
            [
                parent("work_id"),
                text("author_position"),
                [
                    Field("author_id", path="author.id"),
                    Field("institution_id", how="first", path="institutions", inner="id"),
                    Field("raw_author_name", path="author.display_name"),
                    Field("raw_affiliation_string", how="first", path="raw_affiliation_strings"),
                ],
                flag("is_corresponding"),
                names_list("countries", "country_ids"),
            ],
            ("work_id", "author_id"),
            rows="many",
            at="authorships",
            references=_OF_WORK,
            allowed={"author_position": AUTHOR_POSITIONS},
        ),
        _table(
            "works_biblio",
            [parent("work_id"), text("volume", "issue", "first_page", "last_page")],
            ("work_id",),
            rows="present",
            at="biblio",
            policy="first",
            references=_OF_WORK,
        ),
        _concepts("works", "work_id", at="concepts"),
        _table(
            "works_mesh",
            [
                parent("work_id"),
                text("descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name"),
                flag("is_major_topic"),
            ],
            ("work_id", "descriptor_ui", "qualifier_ui"),
            rows="many",
            at="mesh",
            policy="first",
            references=_OF_WORK,
        ),
        _table(
            "works_topics",
            [
                parent("work_id"),
                [Field("topic_id", path="id")],
                typed("float", "score"),
                text("display_name"),
                *[
                    [
                        Field(f"{level}_id", path=f"{level}.id"),
                        Field(f"{level}_display_name", path=f"{level}.display_name"),
                    ]
                    for level in ("field", "subfield", "domain")
                ],
            ],
            ("work_id", "topic_id"),
            rows="many",
            at="topics",
            policy="first",
        ),
        _edges("referenced_works", "referenced_work_id"),
        _edges("related_works", "related_work_id"),
        _yearly("works", "work_id", ("cited_by_count",)),
    ),
    objects=("ids", "open_access"),
    lists=("authorships", "concepts", "topics", "mesh", "counts_by_year"),
    element_objects={
        "authorships": ("author",),
        "topics": ("field", "subfield", "domain"),
    },
)

_BOTH = ("works_count", "cited_by_count")

AUTHORS = Entity(
    "authors",
    tables=(
        _table(
            "authors",
            [
                text("id", "orcid", "display_name"),
                names_list("display_name_alternatives"),
                count(*_BOTH),
                typed("string", "last_known_institution", path="last_known_institution.id"),
                text("works_api_url"),
                updated(),
                typed("date", "created_date"),
            ],
            ("id",),
            comment="One row per author",
        ),
        _ids(
            "authors",
            "author_id",
            [
                _self_id(),
                from_record("orcid"),
                text("scopus", "twitter", "wikipedia"),
                typed("bigint", "mag"),
            ],
        ),
        _yearly("authors", "author_id", _BOTH),
        _concepts("authors", "author_id", at="x_concepts", references=(("author_id", "authors"),)),
    ),
    objects=("last_known_institution", "ids"),
    lists=("counts_by_year", "x_concepts"),
)

SOURCES = Entity(
    "sources",
    tables=(
        _table(
            "sources",
            [
                text("id", "display_name", "host_organization", "host_organization_name"),
                names_list("host_organization_lineage"),
                text("publisher", "issn_l"),
                names_list("issn"),
                count(*_BOTH),
                flag("is_in_doaj", "is_oa"),
                text("homepage_url", "works_api_url", "type", "type_id"),
                updated(),
            ],
            ("id",),
            comment="One row per journal, repository or other venue",
        ),
        _ids(
            "sources",
            "source_id",
            [
                _self_id(),
                from_record("issn_l"),
                [Field("issn", "array<string>", "record_list")],
                typed("bigint", "mag"),
                text("wikidata", "fatcat"),
            ],
        ),
        _yearly("sources", "source_id", _BOTH),
    ),
    objects=("ids",),
    lists=("counts_by_year",),
)

_PICTURES = ("homepage_url", "image_url", "image_thumbnail_url")

INSTITUTIONS = Entity(
    "institutions",
    tables=(
        _table(
            "institutions",
            [
                text("id", "ror", "display_name", "country_code", "type", "type_id"),
                text(*_PICTURES),
                names_list("display_name_acronyms", "display_name_alternatives"),
                count(*_BOTH),
                text("works_api_url"),
                updated(),
            ],
            ("id",),
            comment="One row per research institution",
        ),
        _ids(
            "institutions",
            "institution_id",
            [
                _self_id(),
                from_record("ror"),
                text("grid", "wikipedia", "wikidata"),
                typed("bigint", "mag"),
            ],
        ),
        _table(
            "institutions_geo",
            [
                parent("institution_id"),
                text("city", "geonames_city_id", "region", "country_code", "country"),
                typed("double", "latitude", "longitude"),
            ],
            ("institution_id",),
            at="geo",
            references=(("institution_id", "institutions"),),
        ),
        _table(
            "institutions_associated_institutions",
            [
                parent("institution_id"),
                [Field("associated_institution_id", path="id")],
                text("relationship"),
            ],
            ("institution_id", "associated_institution_id"),
            rows="many",
            at="associated_institutions",
            references=(
                ("institution_id", "institutions"),
                ("associated_institution_id", "institutions"),
            ),
        ),
        _yearly("institutions", "institution_id", _BOTH),
    ),
    objects=("ids", "geo"),
    lists=("associated_institutions", "counts_by_year"),
)

PUBLISHERS = Entity(
    "publishers",
    tables=(
        _table(
            "publishers",
            [
                text("id", "display_name"),
                names_list("alternate_titles", "country_codes"),
                typed("int", "hierarchy_level"),
                text("parent_publisher"),
                count(*_BOTH, "sources_count"),
                text(*_PICTURES, "works_api_url"),
                updated(),
            ],
            ("id",),
            comment="One row per publishing organisation",
        ),
        _yearly("publishers", "publisher_id", _BOTH),
        _ids("publishers", "publisher_id", [_self_id(), text("ror", "wikidata")]),
    ),
    objects=("ids",),
    lists=("counts_by_year",),
)


def _taxonomy_level(name: str, above: str | None) -> Entity:
    """domains > fields > subfields > topics: each level points at the one above it."""
    own = f"{name[:-1]}_id"
    up = [] if above is None else typed("string", f"{above[:-1]}_id", path=f"{above[:-1]}.id")
    return Entity(
        name,
        tables=(
            _table(
                name,
                [text("id", "display_name", "description"), up, count(*_BOTH), updated()],
                ("id",),
                references=() if above is None else ((f"{above[:-1]}_id", above),),
                comment=f"Research taxonomy, level: {name}",
            ),
            _yearly(name, own, _BOTH),
        ),
        lists=("counts_by_year",),
    )


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        WORKS,
        AUTHORS,
        SOURCES,
        INSTITUTIONS,
        *[_taxonomy_level(n, a) for n, a in zip(TAXONOMY, (None, *TAXONOMY))],
        PUBLISHERS,
    )
}

_MERGE_FIELDS = [
    text("original_id", "merged_into_id", "entity_type"),
    typed("date", "merge_date"),
    text("merge_reason"),
]
_MERGE_REQUIRED = ("merged_into_id", "entity_type", "merge_date")

MERGES = (
    _table(
        "merged_entities",
        _MERGE_FIELDS,
        ("original_id",),
        required=_MERGE_REQUIRED,
        comment="Ids that were merged into another id",
    ),
    _table(
        "merged_entities_log",
        [text("log_id"), *_MERGE_FIELDS, typed("timestamp_ntz", "logged_at")],
        ("log_id",),
        required=("original_id", *_MERGE_REQUIRED),
    ),
)

TABLES: dict[str, Table] = {
    t.name: t for t in (*(t for e in ENTITIES.values() for t in e.tables), *MERGES)
}


def entity(name: str) -> Entity:
    """The entity called ``name``; unknown names fail before any job starts."""
    if name not in ENTITIES:
        raise ValueError(f"unknown entity {name!r}; known: {', '.join(ENTITIES)}")
    return ENTITIES[name]


def ensure_tables(spark, database: str, names=None) -> list[str]:
    """Create the missing tables of the model in ``database``; existing ones are kept."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = []
    for name in names or TABLES:
        spec = TABLES[name]
        columns = ", ".join(f"`{f.name}` {f.type}{_default(f)}" for f in spec.fields)
        comment = spec.comment.replace("'", "''")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) "
            f"USING parquet COMMENT '{comment}'"
        )
        made.append(name)
    return made


# The columns that have a default in the target tables.
_COLUMN_DEFAULTS = {
    ("is_retracted", "boolean"): "false",
    ("is_paratext", "boolean"): "false",
    ("has_fulltext", "boolean"): "false",
    ("is_corresponding", "boolean"): "false",
    ("logged_at", "timestamp_ntz"): "current_timestamp()",
}


def default_of(f: Field) -> str | None:
    """The SQL of a column's default in the target tables."""
    return _COLUMN_DEFAULTS.get((f.name, f.type))


def _default(f: Field) -> str:
    value = default_of(f)
    return f" DEFAULT {value}" if value else ""
