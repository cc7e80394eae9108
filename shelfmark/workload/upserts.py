"""Upsert, merge and recount queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators.flatten import bulk_append
from shelfmark.operators.hierarchy import compare_counts
from shelfmark.operators.merges import audit_merges, cycles, follow, redirect
from shelfmark.operators.parse import parse_lines
from shelfmark.operators.shred import bad_values, cut, shape
from shelfmark.operators.upsert import replace_children, upsert
from shelfmark.session import scratch, stored
from shelfmark.workload import records as R
from shelfmark.workload.registry import big, load, num, query, shown

# Line items of an order as versions of one work. The earlier ones are already loaded.
_SPLIT = "1998-01-01"

_V = f"""
WITH v AS (
  SELECT l_orderkey k, l_partkey p, l_suppkey s, l_linenumber n, l_extendedprice ep, l_tax t, l_discount d,
         l_returnflag rf, l_linestatus ls, strftime(l_shipdate, '%Y-%m-%d') AS "day",
         CASE WHEN strftime(l_shipdate, '%Y-%m-%d') >= '{_SPLIT}' THEN 1 ELSE 0 END turn,
         (l_partkey * 1000000 + l_suppkey) * 10 + l_linenumber rw
  FROM lineitem)
"""


def _versions(spark, sf, *tables, columns=None):
    """The shaped versions, stored as ingestion stores them: parsed once, cut many times."""
    parsed = parse_lines(R.work_lines(spark, sf, versions=True))
    return stored(shape(parsed, "works", tables=tables, columns=columns), "versions")


def _loaded_and_new(rows):
    return rows.where(F.col("_file") < _SPLIT), rows.where(F.col("_file") >= _SPLIT)


@query(
    "q_upsert_last",
    _V
    + """
SELECT 'W' || k id, 'line ' || rf || ls title, ROUND(ep, 4) fwci,
       CAST(CASE WHEN n % 3 = 0 THEN 0 WHEN n % 3 = 2 THEN p % 1000 END AS BIGINT) cited_by_count, "day" publication_date
FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY turn DESC, "day" DESC, rw DESC) = 1""",
)
def q_upsert_last(spark, sf):
    wanted = ["id", "title", "fwci", "cited_by_count", "publication_date"]
    works = cut(_versions(spark, sf, "works", columns=wanted), "works", columns=wanted)
    old, new = _loaded_and_new(works)
    merged = upsert(old, new, ["id"])
    return merged.select("id", "title", num("fwci"), big("cited_by_count"), "publication_date")


@query(
    "q_upsert_first",
    _V
    + """
SELECT 'W' || k work_id, rf = 'A' is_oa,
       CASE WHEN rf = 'A' THEN 'gold' WHEN rf = 'R' THEN 'green' WHEN ls = 'O' THEN 'closed' END oa_status
FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY turn, "day", rw) = 1""",
)
def q_upsert_first(spark, sf):
    rows = cut(_versions(spark, sf, "works_open_access"), "works_open_access")
    old, new = _loaded_and_new(rows)
    merged = upsert(old, new, ["work_id"], "first")
    return merged.select("work_id", "is_oa", "oa_status")


@query(
    "q_upsert_composite",
    _V
    + """
, a AS (SELECT 'W' || k work_id, 'A' || (s % 10) author_id, 'first' author_position, 'name ' || s raw_author_name,
               'I' || (p % 25) institution_id, turn, "day", rw, 0 pos FROM v
        UNION ALL SELECT 'W' || k, 'B' || p, 'last', NULL, NULL, turn, "day", rw, 1 FROM v)
SELECT work_id, author_id, author_position, raw_author_name, institution_id
FROM a QUALIFY row_number() OVER (PARTITION BY work_id, author_id ORDER BY turn DESC, "day" DESC, rw DESC, pos DESC) = 1""",
)
def q_upsert_composite(spark, sf):
    wanted = ["work_id", "author_id", "author_position", "raw_author_name", "institution_id"]
    shaped = _versions(spark, sf, "works_authorships", columns=wanted)
    old, new = _loaded_and_new(cut(shaped, "works_authorships", columns=wanted))
    key = ["work_id", "author_id"]
    return upsert(old, new, key).select(*wanted)


@query(
    "q_upsert_ids",
    _V
    + """
SELECT 'W' || k work_id, CASE WHEN n % 3 <> 0 THEN 'W' || k END openalex, CASE WHEN n % 3 <> 0 THEN CAST(p AS VARCHAR) END mag
FROM v QUALIFY row_number() OVER (PARTITION BY k ORDER BY turn DESC, "day" DESC, rw DESC) = 1""",
)
def q_upsert_ids(spark, sf):
    """The ids of a work are replaced as a whole by its last version."""
    old, new = _loaded_and_new(cut(_versions(spark, sf, "works_ids"), "works_ids"))
    return upsert(old, new, ["work_id"]).select("work_id", "openalex", "mag")


@query(
    "q_insert_absent",
    """
SELECT user_id, event_type, event_id, ROUND(value, 4) AS "value"
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def q_insert_absent(spark, sf):
    rows = load(spark, sf, "events").select("user_id", "event_type", "event_id", "value", F.col("ts").alias("_ts"), F.col("event_id").alias("_id"))
    return upsert(None, rows, ["user_id", "event_type"], "first", ["_ts", "_id"]).select(
        "user_id", "event_type", "event_id", num("value")
    )


@query(
    "q_upsert_newest",
    """
WITH n AS (SELECT user_id, event_type, ts, event_id, ROUND(value, 4) AS "value" FROM events)
SELECT user_id, strftime(ts, '%Y-%m-%d') AS "day", event_id, "value"
FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id DESC) = 1""",
)
def q_upsert_newest(spark, sf):
    """Arrival by event type, but the newest day wins whatever the arrival order."""
    rows = load(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", num("value"),
        F.col("event_id").alias("_id"),
    )
    views = F.col("day") < "2024-01-16"
    # the later half of the month is loaded first
    held = upsert(None, rows.where(~views), ["user_id"], "last", ["_id"], newest_by="day")
    return upsert(held, rows.where(views), ["user_id"], "last", ["_id"], newest_by="day")


@query(
    "q_replace_children",
    _V
    + """
, last_version AS (SELECT k, "day", rw, turn FROM v WHERE turn = 1
                   QUALIFY row_number() OVER (PARTITION BY k ORDER BY "day" DESC, rw DESC) = 1)
, c AS (SELECT v.* FROM v JOIN last_version u ON v.k = u.k AND v."day" = u."day" AND v.rw = u.rw
        UNION ALL SELECT v.* FROM v WHERE turn = 0 AND k NOT IN (SELECT k FROM last_version))
, rows AS (SELECT 'W' || k work_id, 'C' || n concept_id, ls display_name, turn, "day", rw, 0 pos FROM c
           UNION ALL SELECT 'W' || k, 'C' || (n + 10), rf, turn, "day", rw, 1 FROM c)
SELECT work_id, concept_id, display_name
FROM rows QUALIFY row_number() OVER (PARTITION BY work_id, concept_id ORDER BY turn DESC, "day" DESC, rw DESC, pos DESC) = 1""",
)
def q_replace_children(spark, sf):
    """A new version of a work takes the place of all its earlier concepts."""
    wanted = ["work_id", "concept_id", "display_name"]
    shaped = _versions(spark, sf, "works", "works_concepts", columns=wanted)
    key = ["work_id", "concept_id"]
    old, new = _loaded_and_new(cut(shaped, "works_concepts", columns=wanted))
    _, parents = _loaded_and_new(cut(shaped, "works", columns=wanted))
    return replace_children(old, new, parents, key, "work_id").select(*wanted)


@query(
    "q_bad_values",
    """
SELECT 'A' || c_custkey id, 'authors' table_name, 'works_count' column_name, c_custkey || '.5' AS "value" FROM customer WHERE c_nationkey % 2 = 0
UNION ALL SELECT 'A' || c_custkey, 'authors', 'display_name_alternatives', '"one name"' FROM customer WHERE c_nationkey % 3 = 0
UNION ALL SELECT 'A' || c_custkey, 'authors', 'cited_by_count', '"many"' FROM customer WHERE c_nationkey % 5 = 0""",
)
def q_bad_values(spark, sf):
    """Counts with fractions or as text, and a text where a list belongs."""
    line = F.concat(
        F.lit('{"id":"A'), "c_custkey", F.lit('","works_count":'), "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, ".5").otherwise(""),
        F.lit(',"display_name_alternatives":'), F.when(F.col("c_nationkey") % 3 == 0, '"one name"').otherwise('["a","b"]'),
        F.lit(',"cited_by_count":'), F.when(F.col("c_nationkey") % 5 == 0, '"many"').otherwise("null"), F.lit("}"),
    )
    lines = load(spark, sf, "customer").select(F.col("c_custkey").alias("_row"), line.alias("value"))
    found = bad_values(shape(parse_lines(lines), "authors"), "authors")
    return found.select("id", "table_name", "column_name", "value")


_COPIES = "(SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keeper FROM documents)"


def _duplicate_documents(spark, sf):
    """Exact copies of a text point at the smallest document id holding it."""
    docs = load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    keepers = docs.groupBy("digest").agg(F.min("doc_id").alias("keeper"))
    return docs.join(keepers, "digest").where("doc_id <> keeper").select(
        F.concat(F.lit("D"), F.col("doc_id")).alias("original_id"),
        F.concat(F.lit("D"), F.col("keeper")).alias("merged_into_id"),
        F.lit("works").alias("entity_type"),
        F.lit("2024-01-01").cast("date").alias("merge_date"),
        F.lit("same text").alias("merge_reason"),
    )


@query(
    "q_merge_audit",
    f"""
SELECT side, 'D' || doc_id original_id, 'D' || keeper merged_into_id, 'works' entity_type, '2024-01-01' merge_date
FROM {_COPIES}, (SELECT unnest(['log', 'table']) AS side) WHERE doc_id <> keeper""",
)
def q_merge_audit(spark, sf):
    merged, log = audit_merges(None, _duplicate_documents(spark, sf))
    wanted = ["original_id", "merged_into_id", "entity_type", shown("merge_date")]
    return merged.select(F.lit("table").alias("side"), *wanted).unionByName(
        log.select(F.lit("log").alias("side"), *wanted)
    )


@query(
    "q_merge_redirect",
    f"""
SELECT 'D' || coalesce(keeper, l.doc_id) doc, count(*) n, CAST(sum(quality) AS BIGINT) quality
FROM labels l LEFT JOIN {_COPIES} c ON l.doc_id = c.doc_id GROUP BY 1""",
)
def q_merge_redirect(spark, sf):
    labels = load(spark, sf, "labels").select(F.concat(F.lit("D"), F.col("doc_id")).alias("doc"), "quality")
    moved = redirect(labels, ["doc"], _duplicate_documents(spark, sf))
    return moved.groupBy("doc").agg(
        F.count("*").alias("n"), F.sum("quality").cast("bigint").alias("quality")
    )


@query(
    "q_merge_repeated",
    f"""
SELECT 'D' || coalesce(keeper, l.doc_id) doc, count(*) n, CAST(sum(quality) AS BIGINT) quality
FROM labels l LEFT JOIN {_COPIES} c ON l.doc_id = c.doc_id GROUP BY 1""",
)
def q_merge_repeated(spark, sf):
    """Every merge listed twice, an older one to another target among them: no fact is multiplied."""
    labels = load(spark, sf, "labels").select(F.concat(F.lit("D"), F.col("doc_id")).alias("doc"), "quality")
    merged = _duplicate_documents(spark, sf)
    older = merged.withColumn("merge_date", F.lit("2023-01-01").cast("date")).withColumn("merged_into_id", F.lit("D-gone"))
    moved = redirect(labels, ["doc"], merged.unionByName(merged).unionByName(older))
    return moved.groupBy("doc").agg(
        F.count("*").alias("n"), F.sum("quality").cast("bigint").alias("quality")
    )


@query(
    "q_merge_cycles",
    """
SELECT 'P' || p_partkey original_id, 'P' || (p_partkey - p_partkey % 3 + (p_partkey + 1) % 3) merged_into_id FROM part
WHERE p_partkey // 3 % 2 = 0 AND p_partkey // 3 < (SELECT max(p_partkey) // 3 FROM part)
  AND p_partkey // 3 > (SELECT min(p_partkey) // 3 FROM part)""",
)
def q_merge_cycles(spark, sf):
    """Parts in threes of neighbouring keys: every other three is a ring, the rest are chains."""
    parts = load(spark, sf, "part").select("p_partkey", F.expr("p_partkey div 3").alias("three"))
    ring = F.expr("p_partkey - p_partkey % 3 + (p_partkey + 1) % 3")
    edges = parts.agg(F.min("three").alias("lo"), F.max("three").alias("hi")).first()  # the outer threes are not whole
    into = F.when(F.col("three") % 2 == 0, ring).otherwise(F.lit(-1))
    inner = parts.where((F.col("three") > edges.lo) & (F.col("three") < edges.hi))
    return cycles(inner.select(F.concat(F.lit("P"), "p_partkey").alias("original_id"), F.concat(F.lit("P"), into).alias("merged_into_id")))


# Finished orders were merged into the order with half their id, which may be finished too.
_CHAIN = """
WITH RECURSIVE m AS (SELECT o_orderkey id, o_orderkey // 2 nxt FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 0),
walk(id, cur) AS (SELECT id, nxt FROM m UNION ALL SELECT w.id, m.nxt FROM walk w JOIN m ON w.cur = m.id),
ends AS (SELECT id original_id, cur final_id FROM walk WHERE cur NOT IN (SELECT id FROM m))
"""


def _merged_orders(spark, sf):
    orders = load(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderkey > 0")
    return orders.select(
        F.col("o_orderkey").alias("original_id"), F.expr("o_orderkey div 2").alias("merged_into_id")
    )


@query("q_merge_follow", _CHAIN + "SELECT original_id, final_id FROM ends")
def q_merge_follow(spark, sf):
    return follow(_merged_orders(spark, sf))


@query(
    "q_merge_chain",
    _CHAIN
    + """
SELECT coalesce(final_id, l_orderkey) order_id, count(*) n, ROUND(sum(l_quantity), 2) quantity
FROM lineitem LEFT JOIN ends ON l_orderkey = original_id GROUP BY 1""",
)
def q_merge_chain(spark, sf):
    """Line items counted under the order their own order ended up in."""
    lines = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_quantity")
    per_order = lines.groupBy("order_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    moved = redirect(per_order, ["order_id"], _merged_orders(spark, sf))
    return moved.groupBy("order_id").agg(
        F.sum("n").alias("n"), F.round(F.sum("q"), 2).alias("quantity")
    )


@query(
    "q_bulk_append",
    """
SELECT o_custkey, 2 * count(*) n, ROUND(2 * sum(o_totalprice), 2) total FROM orders GROUP BY 1""",
)
def q_bulk_append(spark, sf):
    """The same rows appended twice stay there twice."""
    target = scratch(spark, "append")
    orders = load(spark, sf, "orders").select("o_custkey", "o_totalprice")
    bulk_append(orders, target)
    bulk_append(orders, target)
    return spark.read.parquet(target).groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "q_counts_recompute",
    """
WITH declared AS (SELECT c_custkey id, CAST(c_custkey % 15 AS BIGINT) n FROM customer),
counted AS (SELECT o_custkey id, count(*) n FROM orders GROUP BY 1)
SELECT 'A' || coalesce(d.id, c.id) author_id, coalesce(d.n, 0) declared, coalesce(c.n, 0) counted
FROM declared d FULL JOIN counted c ON d.id = c.id WHERE coalesce(d.n, 0) <> coalesce(c.n, 0)""",
)
def q_counts_recompute(spark, sf):
    declared = load(spark, sf, "customer").select(
        F.concat(F.lit("A"), F.col("c_custkey")).alias("author_id"), F.expr("c_custkey % 15").alias("works_count")
    )
    works = load(spark, sf, "orders").select(F.concat(F.lit("A"), F.col("o_custkey")).alias("author_id"))
    return compare_counts(declared, works, ["author_id"], "works_count")
