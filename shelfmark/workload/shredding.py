"""Shredding queries: records built from flat rows, shredded, compared with the flat rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import variants as V
from shelfmark.operators.hierarchy import assemble, taxonomy_path
from shelfmark.operators.parse import parse_lines
from shelfmark.operators.shred import shred
from shelfmark.operators.upsert import ARRIVAL, fold
from shelfmark.plans.catalog import ENTITIES, TAXONOMY
from shelfmark.session import stored
from shelfmark.workload import records as R
from shelfmark.workload.registry import big, load, num, query, shown

# The flat row under the names the record builder uses.
_L = """
WITH l AS (
  SELECT l_orderkey k, l_partkey p, l_suppkey s, l_linenumber n, l_quantity q, l_extendedprice ep,
         l_discount d, l_tax t, l_returnflag rf, l_linestatus ls,
         strftime(l_shipdate, '%Y-%m-%d') AS "day", year(l_shipdate) y,
         'W' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id
  FROM lineitem)
"""


def _work_table(spark, sf, table):
    return R.table_from(R.work_lines(spark, sf), "works", table)


@query(
    "q_works",
    _L
    + """
SELECT id, CASE WHEN n % 2 = 0 THEN 'doi/' || p END doi, 'line ' || rf || ls title,
       CAST(y AS BIGINT) publication_year, "day" publication_date, rf "type", ls "language",
       CAST(CASE WHEN n % 3 = 0 THEN 0 WHEN n % 3 = 2 THEN p % 1000 END AS BIGINT) cited_by_count,
       rf = 'R' is_retracted, FALSE is_paratext,
       CAST(2 AS BIGINT) authors_count, CAST(1 AS BIGINT) topics_count, CAST(2 AS BIGINT) concepts_count,
       CAST(CASE WHEN n % 4 = 0 THEN 0 ELSE 3 END AS BIGINT) referenced_works_count,
       CAST(CASE WHEN n % 4 = 0 THEN 0 ELSE 3 END AS BIGINT) n_referenced,
       'W' || (p + 1) first_related, ls || '|' || rf indexed_in, 'K' || n keyword_id,
       ROUND(ep, 4) fwci, ROUND(q, 4) apc_list, "day" created_date, "day" || ' 01:02:03' updated_date,
       NULL doi_registration_agency, NULL display_name, NULL type_crossref, NULL type_id, NULL language_id, NULL cited_by_api_url,
       NULL abstract_inverted_index, NULL cited_by_percentile_year, FALSE has_fulltext, 'W' || (p + 1) related_works,
       'P' || s primary_source, 'pdf/' || p primary_pdf, NULL best_oa_location, NULL locations_count, NULL primary_topic,
       '[]' sustainable_development_goals, NULL citation_normalized_percentile, '[]' grants, NULL apc_paid,
       CASE WHEN n % 4 <> 0 THEN 'W' || p || '|W' || s || '|W' || p ELSE '' END referenced_works, CAST(1 AS BIGINT) n_keywords
FROM l""",
)
def q_works(spark, sf):
    t = _work_table(spark, sf, "works")
    return t.select(
        "id", "doi", "title", big("publication_year"), "publication_date", "type", "language",
        big("cited_by_count"), "is_retracted", "is_paratext", big("authors_count"),
        big("topics_count"), big("concepts_count"), big("referenced_works_count"),
        F.size("referenced_works").cast("bigint").alias("n_referenced"),
        F.get("related_works", 0).alias("first_related"),
        F.array_join("indexed_in", "|").alias("indexed_in"),
        F.try_variant_get("keywords", "$[0].id", "string").alias("keyword_id"),
        num("fwci"), num("apc_list"), shown("created_date"), shown("updated_date"),
        "doi_registration_agency", "display_name", "type_crossref", "type_id", "language_id", "cited_by_api_url",
        *[F.to_json(c).alias(c) for c in (
            "abstract_inverted_index", "cited_by_percentile_year", "best_oa_location", "primary_topic",
            "sustainable_development_goals", "citation_normalized_percentile", "grants",
        )],
        "has_fulltext", F.array_join("related_works", "|").alias("related_works"),
        F.try_variant_get("primary_location", "$.source.id", "string").alias("primary_source"),
        F.try_variant_get("primary_location", "$.pdf_url", "string").alias("primary_pdf"),
        big("locations_count"), num("apc_paid"), F.array_join("referenced_works", "|").alias("referenced_works"),
        F.size(F.try_variant_get("keywords", "$", "array<variant>")).cast("bigint").alias("n_keywords"),
    )


@query(
    "q_works_ids",
    _L
    + """
SELECT id work_id, CASE WHEN n % 3 <> 0 THEN id END openalex, CASE WHEN n % 2 = 0 THEN 'doi/' || p END doi,
       CASE WHEN n % 3 <> 0 THEN p END mag, CASE WHEN n % 3 <> 0 THEN 'pm' || s END pmid
FROM l""",
)
def q_works_ids(spark, sf):
    return _work_table(spark, sf, "works_ids").select("work_id", "openalex", "doi", "mag", "pmid")


@query(
    "q_open_access",
    _L
    + """
SELECT id work_id, rf = 'A' is_oa,
       CASE WHEN rf = 'A' THEN 'gold' WHEN rf = 'R' THEN 'green' WHEN ls = 'O' THEN 'closed' END oa_status,
       FALSE any_repository_has_fulltext
FROM l""",
)
def q_open_access(spark, sf):
    t = _work_table(spark, sf, "works_open_access")
    return t.select("work_id", "is_oa", "oa_status", "any_repository_has_fulltext")


@query(
    "q_locations_fallback",
    _L
    + """
SELECT id work_id, 'P' || s source_id, 'pdf/' || p pdf_url, FALSE is_oa, NULL AS license FROM l WHERE n % 3 <> 2
UNION ALL SELECT id, 'S' || s, NULL, TRUE, ls FROM l WHERE n % 3 = 2
UNION ALL SELECT id, 'S' || (s + 1), NULL, FALSE, rf FROM l WHERE n % 3 = 2""",
)
def q_locations_fallback(spark, sf):
    t = _work_table(spark, sf, "works_locations")
    return t.select("work_id", "source_id", "pdf_url", "is_oa", "license")


@query(
    "q_authorships",
    _L
    + """
SELECT id work_id, 'A' || s author_id, 'first' author_position, 'I' || (p % 25) institution_id,
       'name ' || s raw_author_name, 'aff ' || rf raw_affiliation_string, TRUE is_corresponding, ls countries
FROM l
UNION ALL SELECT id, 'B' || p, 'last', NULL, NULL, NULL, FALSE, '' FROM l""",
)
def q_authorships(spark, sf):
    t = _work_table(spark, sf, "works_authorships")
    return t.select(
        "work_id", "author_id", "author_position", "institution_id", "raw_author_name",
        "raw_affiliation_string", "is_corresponding", F.array_join("countries", "|").alias("countries"),
    )


@query(
    "q_topics",
    _L
    + """
SELECT id work_id, 'T' || (p % 100) topic_id, ROUND(CAST(CAST(d AS FLOAT) AS DOUBLE), 4) score,
       'topic ' || (p % 100) display_name, 'F' || (p % 10) field_id, rf field_display_name,
       'SF' || (p % 50) subfield_id, CASE WHEN n % 2 = 0 THEN 'D' || (p % 5) END domain_id
FROM l""",
)
def q_topics(spark, sf):
    t = _work_table(spark, sf, "works_topics")
    return t.select(
        "work_id", "topic_id", num("score"), "display_name", "field_id", "field_display_name",
        "subfield_id", "domain_id",
    )


@query(
    "q_concepts",
    _L
    + """
SELECT id work_id, 'C' || n concept_id, ROUND(CAST(CAST(t AS FLOAT) AS DOUBLE), 4) score, ls display_name,
       CAST(n AS BIGINT) AS "level", NULL wikidata FROM l
UNION ALL SELECT id, 'C' || (n + 10), ROUND(CAST(CAST(d AS FLOAT) AS DOUBLE), 4), rf, NULL, 'Q1' FROM l""",
)
def q_concepts(spark, sf):
    t = _work_table(spark, sf, "works_concepts")
    return t.select("work_id", "concept_id", num("score"), "display_name", big("level"), "wikidata")


@query(
    "q_mesh",
    _L
    + """
SELECT id work_id, 'M' || p descriptor_ui, rf descriptor_name, 'Q' || n qualifier_ui, rf = 'A' is_major_topic
FROM l""",
)
def q_mesh(spark, sf):
    t = _work_table(spark, sf, "works_mesh")
    return t.select("work_id", "descriptor_ui", "descriptor_name", "qualifier_ui", "is_major_topic")


@query(
    "q_biblio",
    _L
    + """
SELECT id work_id, CAST(n AS VARCHAR) volume, NULL issue, CAST(p AS VARCHAR) first_page FROM l WHERE rf = 'R'""",
)
def q_biblio(spark, sf):
    return _work_table(spark, sf, "works_biblio").select("work_id", "volume", "issue", "first_page")


@query(
    "q_work_counts_by_year",
    _L
    + """
SELECT id work_id, CAST(y AS BIGINT) AS "year", CAST(p % 7 AS BIGINT) cited_by_count FROM l
UNION ALL SELECT id, CAST(y + 1 AS BIGINT), 0 FROM l""",
)
def q_work_counts_by_year(spark, sf):
    t = _work_table(spark, sf, "works_counts_by_year")
    return t.select("work_id", big("year"), big("cited_by_count"))


@query(
    "q_refs",
    _L
    + """
SELECT DISTINCT id work_id, other referenced_work_id
FROM (SELECT id, 'W' || p other FROM l WHERE n % 4 <> 0 UNION ALL SELECT id, 'W' || s FROM l WHERE n % 4 <> 0)""",
)
def q_refs(spark, sf):
    t = _work_table(spark, sf, "works_referenced_works")
    return t.select("work_id", "referenced_work_id")


@query(
    "q_assemble",
    _L
    + """
SELECT id work_id, CAST(0 AS BIGINT) page, CAST(1 AS BIGINT) n, 'C' || n concept_ids, ls display_names FROM l
UNION ALL SELECT id, 1, 1, 'C' || (n + 10), rf FROM l""",
)
def q_assemble(spark, sf):
    """Concepts back into one array per work, one concept to a page."""
    columns = ["work_id", "concept_id", "display_name"]
    rows = R.table_from(R.work_lines(spark, sf), "works", "works_concepts", columns)
    return _pages(rows, 1)


@query(
    "q_assemble_pages",
    _L
    + """
SELECT id work_id, CAST(0 AS BIGINT) page, CAST(2 AS BIGINT) n, 'C' || n || '|C' || (n + 10) concept_ids,
       ls || '|' || rf display_names FROM l""",
)
def q_assemble_pages(spark, sf):
    columns = ["work_id", "concept_id", "display_name"]
    return _pages(R.table_from(R.work_lines(spark, sf), "works", "works_concepts", columns), 1000)


def _pages(rows, size):
    return assemble(rows, "work_id", size).select(
        "work_id",
        "page",
        F.size("items").cast("bigint").alias("n"),
        F.array_join(F.col("items.concept_id"), "|").alias("concept_ids"),
        F.array_join(F.col("items.display_name"), "|").alias("display_names"),
    )


@query("q_related", _L + "SELECT id work_id, 'W' || (p + 1) related_work_id FROM l")
def q_related(spark, sf):
    return _work_table(spark, sf, "works_related_works").select("work_id", "related_work_id")


# ---------------------------------------------------------------- authors


def _author_table(spark, sf, table):
    return R.table_from(R.author_lines(spark, sf), "authors", table)


@query(
    "q_authors",
    """
SELECT 'A' || c_custkey id, 'orcid/' || c_custkey orcid, c_name display_name,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE c_name || '|' || c_mktsegment END alternatives,
       CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE c_custkey % 50 END works_count,
       CAST(0 AS BIGINT) cited_by_count,
       CASE WHEN c_nationkey % 3 <> 0 THEN 'I' || c_nationkey END last_known_institution,
       '2024-01-05 00:00:00' updated_date, '2020-02-03' created_date
FROM customer""",
)
def q_authors(spark, sf):
    return _author_table(spark, sf, "authors").select(
        "id", "orcid", "display_name", F.array_join("display_name_alternatives", "|").alias("alternatives"),
        big("works_count"), big("cited_by_count"), "last_known_institution",
        shown("updated_date"), shown("created_date"),
    )


@query(
    "q_authors_ids",
    """
SELECT 'A' || c_custkey author_id, 'A' || c_custkey openalex, 'orcid/' || c_custkey orcid,
       c_mktsegment scopus, NULL twitter, c_custkey mag
FROM customer""",
)
def q_authors_ids(spark, sf):
    t = _author_table(spark, sf, "authors_ids")
    return t.select("author_id", "openalex", "orcid", "scopus", "twitter", "mag")


@query(
    "q_author_counts",
    """
SELECT 'A' || c_custkey author_id, CAST(2000 + c_nationkey AS BIGINT) AS "year", c_custkey % 9 works_count, c_custkey % 11 cited_by_count
FROM customer
UNION ALL SELECT 'A' || c_custkey, 1999, 0, 1 FROM customer""",
)
def q_author_counts(spark, sf):
    t = _author_table(spark, sf, "authors_counts_by_year")
    return t.select("author_id", big("year"), big("works_count"), big("cited_by_count"))


@query(
    "q_author_concepts",
    """
SELECT 'A' || c_custkey author_id, 'C' || c_nationkey concept_id,
       ROUND(CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE), 2) score, c_mktsegment display_name, CAST(1 AS BIGINT) AS "level"
FROM customer""",
)
def q_author_concepts(spark, sf):
    t = _author_table(spark, sf, "authors_concepts")
    return t.select("author_id", "concept_id", num("score", digits=2), "display_name", big("level"))


# ---------------------------------------------------------------- sources


def _source_table(spark, sf, table):
    return R.table_from(R.source_lines(spark, sf), "sources", table)


@query(
    "q_sources",
    """
SELECT 'S' || s_suppkey id, s_name display_name, 'P' || s_nationkey || '|P-top' lineage, 'P' || s_nationkey publisher,
       '1000-' || s_suppkey issn_l, '1000-' || s_suppkey || '|2000-' || s_suppkey issn, s_suppkey % 40 works_count,
       CAST(0 AS BIGINT) cited_by_count, FALSE is_in_doaj, s_nationkey % 2 = 0 is_oa,
       CASE WHEN s_acctbal > 0 THEN 'journal' ELSE 'repository' END AS "type", '2024-02-01 00:00:00' updated_date
FROM supplier""",
)
def q_sources(spark, sf):
    return _source_table(spark, sf, "sources").select(
        "id", "display_name", F.array_join("host_organization_lineage", "|").alias("lineage"), "publisher",
        "issn_l", F.array_join("issn", "|").alias("issn"), big("works_count"), big("cited_by_count"),
        "is_in_doaj", "is_oa", "type", shown("updated_date"),
    )


@query(
    "q_sources_ids",
    """
SELECT 'S' || s_suppkey source_id, 'S' || s_suppkey openalex, '1000-' || s_suppkey issn_l,
       CAST(2 AS BIGINT) n_issn, CASE WHEN s_nationkey % 3 <> 0 THEN s_suppkey END mag,
       CASE WHEN s_nationkey % 3 <> 0 THEN s_name END fatcat
FROM supplier""",
)
def q_sources_ids(spark, sf):
    t = _source_table(spark, sf, "sources_ids")
    return t.select(
        "source_id", "openalex", "issn_l", F.size("issn").cast("bigint").alias("n_issn"), "mag", "fatcat"
    )


@query(
    "q_source_counts",
    """
SELECT 'S' || s_suppkey source_id, CAST(2010 AS BIGINT) AS "year", s_suppkey works_count,
       CAST(s_nationkey AS BIGINT) cited_by_count
FROM supplier""",
)
def q_source_counts(spark, sf):
    t = _source_table(spark, sf, "sources_counts_by_year")
    return t.select("source_id", big("year"), big("works_count"), big("cited_by_count"))


# ---------------------------------------------------------------- institutions


def _institution_table(spark, sf, table):
    return R.table_from(R.institution_lines(spark, sf), "institutions", table)


@query(
    "q_institutions",
    """
SELECT 'I' || c_custkey id, 'ror/' || c_custkey ror, c_name display_name, 'N' || c_nationkey country_code,
       lower(c_mktsegment) AS "type", left(c_mktsegment, 3) acronyms,
       CASE WHEN c_nationkey % 2 = 0 THEN c_name || '|' || upper(c_name) ELSE '' END alternatives,
       c_custkey % 100 works_count, CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE c_custkey END cited_by_count,
       '2024-03-01 10:00:00' updated_date
FROM customer""",
)
def q_institutions(spark, sf):
    return _institution_table(spark, sf, "institutions").select(
        "id", "ror", "display_name", "country_code", "type",
        F.array_join("display_name_acronyms", "|").alias("acronyms"),
        F.array_join("display_name_alternatives", "|").alias("alternatives"),
        big("works_count"), big("cited_by_count"), shown("updated_date"),
    )


@query(
    "q_institutions_ids",
    """
SELECT 'I' || c_custkey institution_id, 'I' || c_custkey openalex, 'ror/' || c_custkey ror,
       'grid.' || c_custkey grid, NULL wikipedia, c_custkey mag
FROM customer""",
)
def q_institutions_ids(spark, sf):
    t = _institution_table(spark, sf, "institutions_ids")
    return t.select("institution_id", "openalex", "ror", "grid", "wikipedia", "mag")


@query(
    "q_institutions_geo",
    """
SELECT 'I' || c_custkey institution_id, CASE WHEN c_nationkey % 5 <> 0 THEN c_mktsegment END city,
       CASE WHEN c_nationkey % 5 <> 0 THEN 'N' || c_nationkey END country_code,
       CASE WHEN c_nationkey % 5 <> 0 THEN ROUND(c_acctbal / 1000, 3) END latitude, CAST(NULL AS DOUBLE) longitude
FROM customer""",
)
def q_institutions_geo(spark, sf):
    t = _institution_table(spark, sf, "institutions_geo")
    return t.select(
        "institution_id", "city", "country_code", num("latitude", digits=3), num("longitude", digits=3)
    )


@query(
    "q_institutions_assoc",
    """
SELECT 'I' || c_custkey institution_id, 'I' || (c_custkey + 1) associated_institution_id, 'related' relationship
FROM customer""",
)
def q_institutions_assoc(spark, sf):
    t = _institution_table(spark, sf, "institutions_associated_institutions")
    return t.select("institution_id", "associated_institution_id", "relationship")


@query(
    "q_institution_counts",
    """
SELECT 'I' || c_custkey institution_id, CAST(2011 AS BIGINT) AS "year", CAST(c_nationkey AS BIGINT) works_count,
       CAST(0 AS BIGINT) cited_by_count
FROM customer""",
)
def q_institution_counts(spark, sf):
    t = _institution_table(spark, sf, "institutions_counts_by_year")
    return t.select("institution_id", big("year"), big("works_count"), big("cited_by_count"))


# ---------------------------------------------------------------- publishers


def _publisher_table(spark, sf, table):
    return R.table_from(R.publisher_lines(spark, sf), "publishers", table)


@query(
    "q_publishers",
    """
SELECT 'P' || p_partkey id, p_name display_name, p_name || '|' || p_type alternate_titles,
       CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END country_codes, CAST(p_size % 3 AS BIGINT) hierarchy_level,
       CASE WHEN p_size % 3 <> 0 THEN 'P' || p_size END parent_publisher, CAST(p_size AS BIGINT) works_count,
       CAST(0 AS BIGINT) cited_by_count, CAST(CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size * 2 END AS BIGINT) sources_count
FROM part""",
)
def q_publishers(spark, sf):
    return _publisher_table(spark, sf, "publishers").select(
        "id", "display_name", F.array_join("alternate_titles", "|").alias("alternate_titles"),
        F.array_join("country_codes", "|").alias("country_codes"), big("hierarchy_level"), "parent_publisher",
        big("works_count"), big("cited_by_count"), big("sources_count"),
    )


@query(
    "q_publishers_ids",
    """
SELECT 'P' || p_partkey publisher_id, 'P' || p_partkey openalex,
       CASE WHEN p_size % 7 <> 0 THEN 'ror/' || p_partkey END ror, CASE WHEN p_size % 7 <> 0 THEN p_brand END wikidata
FROM part""",
)
def q_publishers_ids(spark, sf):
    t = _publisher_table(spark, sf, "publishers_ids")
    return t.select("publisher_id", "openalex", "ror", "wikidata")


@query(
    "q_publisher_counts",
    """
SELECT 'P' || p_partkey publisher_id, CAST(2012 AS BIGINT) AS "year", CAST(0 AS BIGINT) works_count, CAST(p_size AS BIGINT) cited_by_count
FROM part
UNION ALL SELECT 'P' || p_partkey, 2013, 2, 0 FROM part""",
)
def q_publisher_counts(spark, sf):
    t = _publisher_table(spark, sf, "publishers_counts_by_year")
    return t.select("publisher_id", big("year"), big("works_count"), big("cited_by_count"))


# ---------------------------------------------------------------- taxonomy

_TAXONOMY = """
WITH domains AS (SELECT 'D' || (length(p_type) % 4) id, arg_max('domain ' || p_size, p_partkey) display_name,
                        arg_max(p_size, p_partkey) works_count, NULL parent_id FROM part GROUP BY 1),
fields AS (SELECT 'F' || p_type id, arg_max(p_type, p_partkey) display_name, arg_max(p_size, p_partkey) works_count,
                  arg_max('D' || (length(p_type) % 4), p_partkey) parent_id FROM part GROUP BY 1),
subfields AS (SELECT 'SF' || p_type || p_size id, arg_max(p_name, p_partkey) display_name, arg_max(p_size, p_partkey) works_count,
                     arg_max('F' || p_type, p_partkey) parent_id FROM part GROUP BY 1),
topics AS (SELECT 'T' || p_partkey id, p_name display_name, p_size works_count, 'SF' || p_type || p_size parent_id FROM part)
"""


def _current_level(spark, sf, level):
    rows = R.table_from(R.taxonomy_lines(spark, sf, level), level, level)
    return fold(rows, ["id"], "last", ARRIVAL)


@query(
    "q_taxonomy",
    _TAXONOMY
    + """
SELECT level, id, display_name, parent_id, CAST(works_count AS BIGINT) works_count FROM (
  SELECT 'domains' AS level, * FROM domains UNION ALL SELECT 'fields', * FROM fields
  UNION ALL SELECT 'subfields', * FROM subfields UNION ALL SELECT 'topics', * FROM topics)""",
)
def q_taxonomy(spark, sf):
    merged = None
    for above, level in zip((None, *TAXONOMY), TAXONOMY):
        up = F.col(f"{above[:-1]}_id") if above else F.lit(None).cast("string")
        rows = _current_level(spark, sf, level).select(
            F.lit(level).alias("level"), "id", "display_name", up.alias("parent_id"), big("works_count")
        )
        merged = rows if merged is None else merged.unionByName(rows)
    return merged


@query(
    "q_taxonomy_counts",
    """
SELECT level, id, CAST(2000 + yr AS BIGINT) AS "year", CAST(yr AS BIGINT) works_count, CAST(cited AS BIGINT) cited_by_count FROM (
  SELECT level, id, p_size yr, arg_max(p_partkey % 13, p_partkey) cited FROM (
    SELECT 'domains' AS level, 'D' || (length(p_type) % 4) id, * FROM part UNION ALL SELECT 'fields', 'F' || p_type, * FROM part
    UNION ALL SELECT 'subfields', 'SF' || p_type || p_size, * FROM part UNION ALL SELECT 'topics', 'T' || p_partkey, * FROM part)
  GROUP BY 1, 2, 3)""",
)
def q_taxonomy_counts(spark, sf):
    """Yearly counts of all four levels."""
    parts = []
    for level in TAXONOMY:
        key = f"{level[:-1]}_id"
        rows = R.table_from(R.taxonomy_lines(spark, sf, level), level, f"{level}_counts_by_year")
        last = fold(rows, [key, "year"], "last", ARRIVAL)
        parts.append(last.select(F.lit(level).alias("level"), F.col(key).alias("id"), big("year"), big("works_count"), big("cited_by_count")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "q_taxonomy_path",
    _TAXONOMY
    + """
SELECT t.id topic_id, t.display_name topic_name, s.id subfield_id, s.display_name subfield_name,
       f.id field_id, f.display_name field_name, d.id domain_id, d.display_name domain_name
FROM topics t LEFT JOIN subfields s ON t.parent_id = s.id LEFT JOIN fields f ON s.parent_id = f.id
LEFT JOIN domains d ON f.parent_id = d.id""",
)
def q_taxonomy_path(spark, sf):
    return taxonomy_path({level: _current_level(spark, sf, level) for level in TAXONOMY})


@query(
    "q_absent_vs_null",
    """
SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN NULL
         ELSE CAST(props->>'k' AS BIGINT) END k, event_type = 'view' absent, event_type = 'click' "null"
FROM events""",
)
def q_absent_vs_null(spark, sf):
    events = load(spark, sf, "events")
    text = F.expr("CASE event_type WHEN 'view' THEN '{}' WHEN 'click' THEN '{\"k\":null}' ELSE props END")
    parsed = events.select("event_id", F.try_parse_json(text).alias("v"))
    return parsed.select(
        "event_id",
        V.get_default(F.col("v"), "$.k", "bigint", 0).alias("k"),
        V.is_absent(F.col("v"), "$.k").alias("absent"),
        V.is_null(F.col("v"), "$.k").alias("null"),
    )


_YEARLY = "works authors sources institutions domains fields subfields topics publishers".split()


@query(
    "q_entities",
    " UNION ALL ".join(
        f"""SELECT '{e}' entity, '{e}' table_name, 'id' "key", count(*) n_rows, count(DISTINCT c_custkey) n_keys FROM customer
UNION ALL SELECT '{e}', '{e}_counts_by_year', '{e[:-1]}_id', count(*) + count(*) FILTER (c_nationkey % 2 = 0), count(DISTINCT c_custkey) FROM customer"""
        for e in _YEARLY
    ),
)
def q_entities(spark, sf):
    """One record a customer as each of the entities: rows and parents in the record's and the yearly table."""
    year = "named_struct('year', {}, 'works_count', c_nationkey, 'cited_by_count', 1)"
    years = f"if(c_nationkey % 2 = 0, array({year.format(2020)}, {year.format(2021)}), array({year.format(2022)}))"
    record = F.expr(f"to_json(named_struct('id', concat('X', c_custkey), 'display_name', c_name, 'counts_by_year', {years}))")
    lines = load(spark, sf, "customer").select(F.lit("f").alias("_file"), F.col("c_custkey").alias("_row"), record.alias("value"))
    parsed = stored(parse_lines(lines), "entities")
    parts = []
    for name, spec in ENTITIES.items():
        made = shred(parsed, name)
        for t in spec.tables:
            if t.name in (name, f"{name}_counts_by_year"):
                counts = made[t.name].agg(F.count("*").alias("n_rows"), F.count_distinct(t.key[0]).alias("n_keys"))
                parts.append(counts.select(F.lit(name).alias("entity"), F.lit(t.name).alias("table_name"), F.lit(t.key[0]).alias("key"), "n_rows", "n_keys"))
    return reduce(DataFrame.unionByName, parts)
