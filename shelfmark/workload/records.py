"""Nested JSON records derived row by row from the flat test tables.

Every input row becomes one record whose lists have a small fixed length, so building the
records needs no grouping and no shuffle. Optional keys are absent for some rows and null for
others, which is what the shredding rules must tell apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.parse import parse_lines
from shelfmark.operators.shred import cut, shape
from shelfmark.session import spread
from shelfmark.workload.registry import load

_LINE = (
    "l_orderkey AS k",
    "l_partkey AS p",
    "l_suppkey AS s",
    "l_linenumber AS n",
    "l_quantity AS q",
    "l_extendedprice AS ep",
    "l_discount AS d",
    "l_tax AS t",
    "l_returnflag AS rf",
    "l_linestatus AS ls",
    "date_format(l_shipdate, 'yyyy-MM-dd') AS day",
    "year(l_shipdate) AS y",
    "concat('W', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS line_id",
    "concat('W', l_orderkey) AS order_id",
)

# {id} and {author} are columns. to_json leaves NULL keys out; a VARIANT null stays as an explicit null.
_WORK = """
    to_json(named_struct(
      'id', {id}, 'doi', if(n % 2 = 0, concat('doi/', p), NULL), 'title', concat('line ', rf, ls),
      'publication_year', y, 'publication_date', day, 'type', rf, 'language', ls,
      'cited_by_count', CASE n % 3 WHEN 1 THEN parse_json('null') WHEN 2 THEN cast(p % 1000 AS variant) END,
      'biblio', CASE rf WHEN 'A' THEN parse_json('{{}}')
        WHEN 'R' THEN parse_json(concat('{{"volume":"', n, '","first_page":"', p, '"}}')) END,
      'is_retracted', if(rf = 'R', true, NULL), 'indexed_in', array(ls, rf),
      'referenced_works', if(n % 4 = 0, NULL, array(concat('W', p), concat('W', s), concat('W', p))),
      'related_works', array(concat('W', p + 1)),
      'keywords', array(named_struct('id', concat('K', n), 'score', d)),
      'fwci', ep, 'apc_list', q, 'created_date', day,
      'updated_date', if(n % 2 = 1, '', NULL), 'updated', concat(day, 'T01:02:03'),
      'ids', if(n % 3 = 0, NULL, named_struct('openalex', {id}, 'mag', cast(p AS string), 'doi', 'other', 'pmid', concat('pm', s))),
      'open_access', named_struct('is_oa', if(rf = 'N', NULL, rf = 'A'),
        'oa_status', CASE rf WHEN 'A' THEN 'Gold' WHEN 'R' THEN 'GREEN' ELSE if(ls = 'O', 'odd', '') END),
      'locations', CASE WHEN n % 3 = 0 THEN array() WHEN n % 3 = 1 THEN NULL ELSE array(
        named_struct('source', named_struct('id', concat('S', s)), 'license', ls, 'is_oa', true),
        named_struct('source', named_struct('id', concat('S', s + 1)), 'license', rf, 'is_oa', NULL)) END,
      'primary_location', named_struct('source', named_struct('id', concat('P', s)), 'pdf_url', concat('pdf/', p)),
      'authorships', array(
        named_struct('author', named_struct('id', {author}, 'display_name', concat('name ', s)),
          'author_position', 'first',
          'institutions', array(named_struct('id', concat('I', p % 25)), named_struct('id', 'I-other')),
          'raw_affiliation_strings', array(concat('aff ', rf), 'x'),
          'is_corresponding', true, 'countries', array(ls)),
        named_struct('author', named_struct('id', concat('B', p), 'display_name', NULL),
          'author_position', 'last', 'institutions', NULL, 'raw_affiliation_strings', array(),
          'is_corresponding', NULL, 'countries', NULL)),
      'topics', array(named_struct('id', concat('T', p % 100), 'score', d, 'display_name', concat('topic ', p % 100),
        'field', named_struct('id', concat('F', p % 10), 'display_name', rf),
        'subfield', named_struct('id', concat('SF', p % 50)),
        'domain', if(n % 2 = 0, named_struct('id', concat('D', p % 5)), NULL))),
      'concepts', array(
        named_struct('id', concat('C', n), 'score', t, 'display_name', ls, 'level', n, 'wikidata', NULL),
        named_struct('id', concat('C', n + 10), 'score', d, 'display_name', rf, 'level', NULL, 'wikidata', 'Q1')),
      'mesh', array(named_struct('descriptor_ui', concat('M', p), 'descriptor_name', rf,
        'qualifier_ui', concat('Q', n), 'is_major_topic', if(rf = 'A', true, NULL))),
      'counts_by_year', array(named_struct('year', y, 'cited_by_count', p % 7), named_struct('year', y + 1, 'cited_by_count', NULL))
    ))
"""


def work_lines(spark: SparkSession, sf_dir: str, versions: bool = False) -> DataFrame:
    """One work per line item. ``versions``: the items of an order are versions of one work."""
    ident, author = ("order_id", "concat('A', s % 10)") if versions else ("line_id", "concat('A', s)")
    rows = spread(load(spark, sf_dir, "lineitem")).selectExpr(*_LINE)
    work = _WORK.format(id=ident, author=author)
    return rows.selectExpr(
        "day AS _file", "(p * 1000000 + s) * 10 + n AS _row", f"{work} AS value"
    )


def author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One author per customer."""
    author = """
        to_json(named_struct(
          'id', concat('A', c_custkey), 'orcid', concat('orcid/', c_custkey), 'display_name', c_name,
          'display_name_alternatives', if(c_nationkey % 5 = 0, NULL, array(c_name, c_mktsegment)),
          'works_count', if(c_nationkey % 4 = 0, NULL, c_custkey % 50),
          'last_known_institution', if(c_nationkey % 3 = 0, NULL, named_struct('id', concat('I', c_nationkey))),
          'updated_date', '2024-01-05T00:00:00', 'created_date', '2020-02-03',
          'ids', named_struct('scopus', c_mktsegment, 'mag', c_custkey),
          'counts_by_year', array(
            named_struct('year', 2000 + c_nationkey, 'works_count', c_custkey % 9, 'cited_by_count', c_custkey % 11),
            named_struct('year', 1999, 'works_count', NULL, 'cited_by_count', 1)),
          'x_concepts', array(named_struct('id', concat('C', c_nationkey), 'score', c_acctbal, 'display_name', c_mktsegment, 'level', 1))
        ))
    """
    return spread(load(spark, sf_dir, "customer")).selectExpr(
        "'customer' AS _file", "c_custkey AS _row", f"{author} AS value"
    )


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per supplier."""
    source = """
        to_json(named_struct(
          'id', concat('S', s_suppkey), 'display_name', s_name, 'publisher', concat('P', s_nationkey),
          'host_organization_lineage', array(concat('P', s_nationkey), 'P-top'),
          'issn_l', concat('1000-', s_suppkey), 'issn', array(concat('1000-', s_suppkey), concat('2000-', s_suppkey)),
          'works_count', s_suppkey % 40, 'is_oa', if(s_nationkey % 2 = 0, true, NULL),
          'type', if(s_acctbal > 0, 'journal', 'repository'), 'updated', '2024-02-01T00:00:00',
          'ids', if(s_nationkey % 3 = 0, NULL, named_struct('mag', cast(s_suppkey AS string), 'fatcat', s_name)),
          'counts_by_year', array(named_struct('year', 2010, 'works_count', s_suppkey, 'cited_by_count', s_nationkey))
        ))
    """
    return spread(load(spark, sf_dir, "supplier")).selectExpr(
        "'supplier' AS _file", "s_suppkey AS _row", f"{source} AS value"
    )


def institution_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One institution per customer, placed by nation."""
    institution = """
        to_json(named_struct(
          'id', concat('I', c_custkey), 'ror', concat('ror/', c_custkey), 'display_name', c_name,
          'country_code', concat('N', c_nationkey), 'type', lower(c_mktsegment),
          'display_name_acronyms', array(left(c_mktsegment, 3)),
          'display_name_alternatives', if(c_nationkey % 2 = 0, array(c_name, upper(c_name)), NULL),
          'works_count', c_custkey % 100, 'cited_by_count', if(c_nationkey % 2 = 0, NULL, c_custkey),
          'updated_date', '2024-03-01T10:00:00',
          'ids', named_struct('grid', concat('grid.', c_custkey), 'mag', c_custkey),
          'geo', if(c_nationkey % 5 = 0, NULL, named_struct('city', c_mktsegment, 'country_code', concat('N', c_nationkey), 'latitude', c_acctbal / 1000)),
          'associated_institutions', array(named_struct('id', concat('I', c_custkey + 1), 'relationship', 'related')),
          'counts_by_year', array(named_struct('year', 2011, 'works_count', c_nationkey))
        ))
    """
    return spread(load(spark, sf_dir, "customer")).selectExpr(
        "'customer' AS _file", "c_custkey AS _row", f"{institution} AS value"
    )


def publisher_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One publisher per part."""
    publisher = """
        to_json(named_struct(
          'id', concat('P', p_partkey), 'display_name', p_name, 'alternate_titles', array(p_name, p_type),
          'country_codes', if(p_size % 2 = 0, array(p_brand), NULL), 'hierarchy_level', p_size % 3,
          'parent_publisher', if(p_size % 3 = 0, NULL, concat('P', p_size)),
          'works_count', p_size, 'sources_count', if(p_size % 5 = 0, NULL, p_size * 2),
          'updated_date', '2024-04-01T00:00:00',
          'ids', if(p_size % 7 = 0, NULL, named_struct('ror', concat('ror/', p_partkey), 'wikidata', p_brand)),
          'counts_by_year', array(
            named_struct('year', 2012, 'works_count', NULL, 'cited_by_count', p_size),
            named_struct('year', 2013, 'works_count', 2, 'cited_by_count', NULL))
        ))
    """
    return spread(load(spark, sf_dir, "part")).selectExpr(
        "'part' AS _file", "p_partkey AS _row", f"{publisher} AS value"
    )


# What each taxonomy level's record is made of: id, parent key and id, name.
_LEVELS = {
    "domains": ("concat('D', length(p_type) % 4)", None, "concat('domain ', p_size)"),
    "fields": ("concat('F', p_type)", ("domain", "concat('D', length(p_type) % 4)"), "p_type"),
    "subfields": ("concat('SF', p_type, p_size)", ("field", "concat('F', p_type)"), "p_name"),
    "topics": ("concat('T', p_partkey)", ("subfield", "concat('SF', p_type, p_size)"), "p_name"),
}


def taxonomy_lines(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """One record of the level per part; upper levels arrive in many versions."""
    ident, above, name = _LEVELS[level]
    up = f"'{above[0]}', named_struct('id', {above[1]})," if above else ""
    record = f"""
        to_json(named_struct('id', {ident}, 'display_name', {name}, {up}
          'description', p_brand, 'works_count', p_size, 'updated_date', '2024-05-01T00:00:00',
          'counts_by_year', array(named_struct('year', 2000 + p_size, 'works_count', p_size, 'cited_by_count', p_partkey % 13))))
    """
    return spread(load(spark, sf_dir, "part")).selectExpr(
        "'part' AS _file", "p_partkey AS _row", f"{record} AS value"
    )


def table_from(lines: DataFrame, entity: str, table: str, columns=None) -> DataFrame:
    """One shredded table, straight from lines."""
    shaped = shape(parse_lines(lines), entity, tables=[table], columns=columns)
    return cut(shaped, table, columns=columns)


def day_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The props of every event as a line, one file per day, some of them damaged.

    By event type: view lines lose their last character, error lines have junk behind them,
    signup lines are not objects; click and purchase lines get an id.
    """
    events = load(spark, sf_dir, "events")
    body = F.expr(
        """CASE event_type
             WHEN 'view' THEN left(props, length(props) - 1)
             WHEN 'error' THEN concat(props, ' } x')
             WHEN 'signup' THEN concat('[', props, ']')
             ELSE concat(left(props, length(props) - 1), ',"id":"E', event_id, '"}') END"""
    )
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("_file"), F.col("event_id").alias("_row"), body.alias("value")
    )
