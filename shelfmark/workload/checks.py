"""Quality queries: line and record rejects, error budgets, constraint audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import quality as Q
from shelfmark.operators.parse import parse_lines
from shelfmark.operators.shred import cut, quarantine, quarantine_child, shape
from shelfmark.plans.model import Field, Table
from shelfmark.session import spread, stored
from shelfmark.workload import records as R
from shelfmark.workload.registry import load, query


@query(
    "q_quarantine",
    """
SELECT strftime(ts, '%Y-%m-%d') AS "file", event_id AS "row",
       CASE event_type WHEN 'view' THEN 'malformed' WHEN 'error' THEN 'malformed' ELSE 'not_object' END reason,
       CASE event_type WHEN 'view' THEN left(props, length(props) - 1) WHEN 'error' THEN props || ' } x'
         ELSE '[' || props || ']' END raw
FROM events WHERE event_type IN ('view', 'error', 'signup')""",
)
def q_quarantine(spark, sf):
    shaped = shape(parse_lines(R.day_lines(spark, sf)), "works", tables=["works"])
    held = quarantine(shaped, "works")
    return held.select(F.col("_file").alias("file"), F.col("_row").alias("row"), "reason", "raw")


@query(
    "q_error_budget",
    """
SELECT strftime(ts, '%Y-%m-%d') AS "file", count(*) n_lines,
       count(*) FILTER (event_type IN ('click', 'purchase')) n_records,
       count(*) FILTER (event_type IN ('view', 'error')) n_malformed,
       count(*) FILTER (event_type = 'signup') n_rejected,
       count(*) FILTER (event_type IN ('view', 'error')) < 100 ok
FROM events GROUP BY 1""",
)
def q_error_budget(spark, sf):
    shaped = shape(parse_lines(R.day_lines(spark, sf)), "works", tables=["works"])
    return Q.error_budget(shaped).withColumnRenamed("_file", "file")


# Broken containers by return flag and line status; the same rows as in the SQL below.
_BROKEN = """
    concat('{"id":"', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '"', CASE
      WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN ',"authorships":null'
      WHEN l_returnflag = 'A' THEN ',"locations":[{"source":null}]'
      WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN ',"ids":null'
      WHEN l_returnflag = 'R' THEN ',"biblio":null,"locations":[]'
      WHEN l_linestatus = 'O' THEN concat(',"topics":[{"id":"T', l_partkey, '","field":null}]')
      ELSE concat(',"authorships":[{"author":{"id":"A', l_suppkey, '"},"institutions":null}]') END, '}')
"""


def _broken_lines(spark, sf):
    lines = load(spark, sf, "lineitem").selectExpr(
        "'f' AS _file", "(l_partkey * 1000000 + l_suppkey) * 10 + l_linenumber AS _row", f"{_BROKEN} AS value"
    )
    return spread(lines)


@query(
    "q_reject_strict",
    """
SELECT CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'strict:authorships' WHEN l_returnflag = 'A' THEN 'strict:locations'
            WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'strict:ids' WHEN l_returnflag = 'R' THEN 'ok'
            WHEN l_linestatus = 'O' THEN 'strict:topics' ELSE 'ok' END status,
       count(*) n, min(l_partkey) first_part
FROM lineitem GROUP BY 1""",
)
def q_reject_strict(spark, sf):
    shaped = shape(parse_lines(_broken_lines(spark, sf)), "works", "strict")
    part = F.expr("_row div 10000000")
    return shaped.groupBy("status").agg(F.count("*").alias("n"), F.min(part).alias("first_part"))


@query(
    "q_quarantine_child",
    """
SELECT 'works_locations' table_name, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey work_id
FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus <> 'O'""",
)
def q_quarantine_child(spark, sf):
    shaped = shape(parse_lines(_broken_lines(spark, sf)), "works", "lenient", ["works_locations"])
    held = quarantine_child(shaped, "works_locations")
    return held.select("table_name", F.get_json_object("row", "$.work_id").alias("work_id"))


@query(
    "q_pk_dups",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) l_linenumber, count(*) n
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def q_pk_dups(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    return Q.duplicate_keys(rows, ["l_orderkey", "l_linenumber"])


@query(
    "q_fk_orphans",
    """
SELECT l_orderkey, count(*) n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY 1""",
)
def q_fk_orphans(spark, sf):
    """Parents in one status are treated as not loaded."""
    parents = load(spark, sf, "orders").where("o_orderstatus <> 'F'")
    return Q.orphans(load(spark, sf, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query(
    "q_fk_whole",
    """
SELECT 'orders' child, count(*) n_rows, count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) n_orphans FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem
UNION ALL SELECT 'labels', count(*), count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM documents)) FROM labels""",
)
def q_fk_whole(spark, sf):
    """References of whole tables, as they are."""
    parts = []
    for child, key, parent, parent_key in (
        ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("labels", "doc_id", "documents", "doc_id"),
    ):
        rows = load(spark, sf, child)
        bad = Q.orphans(rows, key, load(spark, sf, parent), parent_key).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphans"))
        both = rows.agg(F.count("*").alias("n_rows")).unionByName(bad, allowMissingColumns=True)
        parts.append(both.agg(F.max("n_rows").alias("n_rows"), F.max("n_orphans").alias("n_orphans")).select(F.lit(child).alias("child"), "n_rows", "n_orphans"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "q_check",
    """
SELECT conv_id, turn, role FROM conversations WHERE role IS NOT NULL AND role NOT IN ('user', 'assistant')""",
)
def q_check(spark, sf):
    rows = load(spark, sf, "conversations").select("conv_id", "turn", "role")
    return Q.not_allowed(rows, "role", ("user", "assistant"))


@query(
    "q_notnull",
    """
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL""",
)
def q_notnull(spark, sf):
    joined = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    return Q.missing(joined, "quality").select("doc_id")


_TPCH = (
    Table(
        "orders",
        (Field("o_orderkey"), Field("o_orderstatus")),
        ("o_orderkey",),
        allowed={"o_orderstatus": ("F", "O")},
        references=(("o_custkey", "customer"),),
    ),
    Table(
        "lineitem",
        (Field("l_orderkey"),),
        ("l_orderkey", "l_linenumber"),
        references=(("l_orderkey", "orders"),),
        required=("l_quantity",),
    ),
)


@query(
    "q_validate",
    """
SELECT 'orders' table_name, 'primary_key' AS "constraint", count(*) - count(DISTINCT o_orderkey) n_bad FROM orders
UNION ALL SELECT 'orders', 'foreign_key:o_custkey', count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'orders', 'not_null:o_orderkey', count(*) FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'orders', 'check:o_orderstatus', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'lineitem', 'primary_key', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'lineitem', 'foreign_key:l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'not_null:l_orderkey', count(*) FROM lineitem WHERE l_orderkey IS NULL
UNION ALL SELECT 'lineitem', 'not_null:l_linenumber', count(*) FROM lineitem WHERE l_linenumber IS NULL
UNION ALL SELECT 'lineitem', 'not_null:l_quantity', count(*) FROM lineitem WHERE l_quantity IS NULL""",
)
def q_validate(spark, sf):
    tables = {
        "orders": load(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"),
        "customer": load(spark, sf, "customer").where("c_acctbal >= 0").withColumnRenamed("c_custkey", "id"),
        "lineitem": load(spark, sf, "lineitem"),
    }
    specs = [Table("orders", _TPCH[0].fields, ("id",), allowed=_TPCH[0].allowed, references=_TPCH[0].references), _TPCH[1]]
    return Q.validate(tables, specs).withColumn(
        "constraint", F.regexp_replace("constraint", "not_null:id", "not_null:o_orderkey")
    )


@query(
    "q_validate_works",
    """
WITH l AS (SELECT count(*) n, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey)) k FROM lineitem)
SELECT 'works' table_name, 'primary_key' AS "constraint", n - k n_bad FROM l
UNION ALL SELECT 'works', 'not_null:id', 0 FROM l
UNION ALL SELECT 'works_open_access', 'primary_key', n - k FROM l
UNION ALL SELECT 'works_open_access', 'foreign_key:work_id', 0 FROM l
UNION ALL SELECT 'works_open_access', 'not_null:work_id', 0 FROM l
UNION ALL SELECT 'works_open_access', 'check:oa_status', 0 FROM l""",
)
def q_validate_works(spark, sf):
    """The model's own constraints on shredded works: everything but repeated records holds."""
    wanted = ("works", "works_open_access")
    columns = ["id", "work_id", "oa_status"]
    shaped = shape(parse_lines(R.work_lines(spark, sf)), "works", tables=wanted, columns=columns)
    shaped = stored(shaped, "works")
    return Q.validate({t: cut(shaped, t, columns=columns) for t in wanted})
