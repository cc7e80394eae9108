"""Lookup, range, top-k, keyword, containment and inverted-index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.text import invert, placed_tokens, positions_of, rebuild_text
from shelfmark.operators import search
from shelfmark.workload import records as R
from shelfmark.workload.registry import big, load, num, query


@query(
    "q_lookup",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'FURNITURE'",
)
def q_lookup(spark, sf):
    rows = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return search.lookup(rows, "c_mktsegment", "FURNITURE")


@query(
    "q_range",
    """
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS "year", ROUND(o_totalprice, 2) total
FROM orders WHERE o_totalprice BETWEEN 100000 AND 150000 AND year(o_orderdate) BETWEEN 1996 AND 1998""",
)
def q_range(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"), "o_totalprice"
    )
    priced = search.in_range(rows, "o_totalprice", 100000.0, 150000.0)
    return search.in_range(priced, "year", 1996, 1998).select("o_orderkey", "year", num("o_totalprice", "total", 2))


@query(
    "q_topk",
    """
SELECT o_orderkey, ROUND(o_totalprice, 2) total FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def q_topk(spark, sf):
    rows = search.top_k(load(spark, sf, "orders"), "o_totalprice", 100, "o_orderkey")
    return rows.select("o_orderkey", num("o_totalprice", "total", 2))


@query(
    "q_topk_cited",
    """
SELECT 'W' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id,
       CAST(CASE l_linenumber % 3 WHEN 0 THEN 0 WHEN 2 THEN l_partkey % 1000 END AS BIGINT) cited_by_count
FROM lineitem ORDER BY 2 DESC NULLS LAST, 1 LIMIT 50""",
)
def q_topk_cited(spark, sf):
    works = R.table_from(R.work_lines(spark, sf), "works", "works", ["id", "cited_by_count"])
    return search.top_k(works, "cited_by_count", 50, "id").select("id", big("cited_by_count"))


_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query(
    "q_keyword_all",
    f"SELECT doc_id, lang FROM documents WHERE list_has_all({_TOKENS}, ['the', 'of', 'atha'])",
)
def q_keyword_all(spark, sf):
    docs = load(spark, sf, "documents")
    return search.keyword(docs, "text", ["the", "of", "atha"]).select("doc_id", "lang")


@query(
    "q_keyword_any",
    f"SELECT doc_id, lang FROM documents WHERE list_has_any({_TOKENS}, ['aiaux', 'ananble', 'atha'])",
)
def q_keyword_any(spark, sf):
    docs = load(spark, sf, "documents")
    return search.keyword(docs, "text", ["aiaux", "Ananble", "atha"], match="any").select("doc_id", "lang")


@query(
    "q_keyword_rank",
    f"""
SELECT doc_id, CAST(len(list_filter({_TOKENS}, lambda t: t IN ('the', 'that'))) AS BIGINT) hits
FROM documents WHERE list_has_any({_TOKENS}, ['the', 'that']) ORDER BY 2 DESC, 1 LIMIT 100""",
)
def q_keyword_rank(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    found = search.keyword(docs, "text", ["the", "that"], match="any", rank=True)
    return search.top_k(found, "hits", 100, "doc_id").select("doc_id", big("hits"))


@query(
    "q_contains",
    """
SELECT 'W' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id,
       l_partkey IN (1, 2) AND l_suppkey = 3 "all" FROM lineitem
WHERE l_linenumber % 4 <> 0 AND (l_partkey IN (1, 2, 3) OR l_suppkey IN (1, 2, 3))""",
)
def q_contains(spark, sf):
    """Works citing any of three works; ``all`` marks those citing W3 next to W1 or W2."""
    works = R.table_from(R.work_lines(spark, sf), "works", "works", ["id", "referenced_works"])
    any_of = search.contains(works, "referenced_works", ["W1", "W2", "W3"], match="any")
    cited = F.col("referenced_works")
    pair = (F.get(cited, 0).isin("W1", "W2")) & (F.get(cited, 1) == "W3")
    return any_of.select("id", pair.alias("all"))


@query(
    "q_contains_all",
    """
SELECT 'S' || s_suppkey id FROM supplier WHERE s_nationkey = 3""",
)
def q_contains_all(spark, sf):
    sources = R.table_from(R.source_lines(spark, sf), "sources", "sources")
    return search.contains(sources, "host_organization_lineage", ["P-top", "P3"]).select("id")


def _abstracts(spark, sf):
    """Documents as works whose abstract is stored as {word: [positions]}."""
    texts = load(spark, sf, "documents").where(F.col("text").isNotNull())
    # only texts move: those of one id (one, as a rule) are cut and inverted where they meet
    held = texts.groupBy("doc_id").agg(F.collect_list("text").alias("_texts"))
    inverted = held.select("doc_id", F.flatten(F.transform("_texts", placed_tokens)).alias("_placed"))
    inverted = invert(inverted.where(F.size("_placed") > 0), "_placed", ["doc_id"]).select(
        "doc_id", F.map_from_entries(F.transform("words", lambda w: F.struct(w["token"], w["positions"]))).alias("abstract_inverted_index")
    )
    lines = inverted.select(
        F.lit("documents").alias("_file"),
        F.col("doc_id").alias("_row"),
        F.to_json(F.struct(F.concat(F.lit("D"), "doc_id").alias("id"), "abstract_inverted_index")).alias("value"),
    )
    return R.table_from(lines, "works", "works", ["id", "abstract_inverted_index"])


@query(
    "q_keyword_scripts",
    f"SELECT doc_id, lang FROM documents WHERE list_has_any({_TOKENS}, ['für', 'für2021', '555', 'réeuxpa', 'ciónque', 'nicht'])",
)
def q_keyword_scripts(spark, sf):
    """Terms with accents, digits and blanks are cut as the texts are."""
    docs = load(spark, sf, "documents")
    terms = ["FÜR", "für2021", "555", "Réeuxpa ciónque", "nicht!"]
    return search.keyword(docs, "text", terms, match="any").select("doc_id", "lang")


@query(
    "q_contains_keywords",
    """
SELECT 'W' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey id
FROM lineitem WHERE l_linenumber IN (2, 5)""",
)
def q_contains_keywords(spark, sf):
    """Works that hold one of two keywords, in the JSON column."""
    works = R.table_from(R.work_lines(spark, sf), "works", "works", ["id", "keywords"])
    return search.contains(works, "keywords", [{"id": "K2"}, {"id": "K5"}], match="any").select("id")


@query(
    "q_inverted_index",
    f"""
SELECT 'D' || doc_id id, CAST(len(list_filter(t, lambda x: x = 'the')) AS BIGINT) n, CAST(list_position(t, 'the') - 1 AS BIGINT) first_at
FROM (SELECT doc_id, {_TOKENS} t FROM documents) WHERE list_contains(t, 'the')""",
)
def q_inverted_index(spark, sf):
    found = search.has_word(_abstracts(spark, sf), "abstract_inverted_index", "the")
    places = positions_of(F.col("abstract_inverted_index"), "the")
    return found.select(
        "id", F.size(places).cast("bigint").alias("n"), F.array_min(places).cast("bigint").alias("first_at")
    )


@query(
    "q_abstract_rebuild",
    f"""
SELECT 'D' || doc_id id, CAST(len(t) AS BIGINT) n_words, md5(array_to_string(t, ' ')) digest
FROM (SELECT doc_id, {_TOKENS} t FROM documents) WHERE len(t) > 0""",
)
def q_abstract_rebuild(spark, sf):
    rebuilt = _abstracts(spark, sf).select("id", rebuild_text(F.col("abstract_inverted_index")).alias("text"))
    return rebuilt.select(
        "id", F.size(F.split("text", " ")).cast("bigint").alias("n_words"), F.md5("text").alias("digest")
    )
