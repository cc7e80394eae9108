"""Queries on stored tables: clustered bases, replaced children, postings, records put back together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import lookups, postings, report
from shelfmark.operators.hierarchy import reassemble
from shelfmark.operators.parse import parse_lines
from shelfmark.operators.publish import batch_counts, compact, find, merge, publish, resolve
from shelfmark.operators.quality import audit, violations
from shelfmark.operators.search import top_k
from shelfmark.operators.shred import bad_values, shape
from shelfmark.operators.similar import similar_names
from shelfmark.operators.upsert import ARRIVAL
from shelfmark.plans.model import Table, text
from shelfmark.session import scratch
from shelfmark.sources import snapshot
from shelfmark.streaming.ingest import manifest_of
from shelfmark.streaming.runs import checkpoint, log_of, run_entities
from shelfmark.workload.registry import big, load, query

#: Rows of a piece: small, so that the test tables have many.
PIECE = 2_000

_ID = "'A' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
_TOP = "o_orderkey >= (SELECT max(o_orderkey) FROM orders) * 0.99"


def _authors(rows: DataFrame, name: str) -> DataFrame:
    """Orders as rows of the authors table."""
    return rows.select(
        F.concat(F.lit("A"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("id"), F.expr(name).alias("display_name"),
        (F.col("o_custkey") % 1000).cast("int").alias("works_count"),
        F.lit("orders").alias("_file"), F.col("o_orderkey").alias("_row"), F.lit(0).alias("_pos"),
    )


def _clustered_orders(spark, sf):
    """A base of nine orders of ten, the newest hundredth merged into it, and a few scattered ones after that."""
    root, orders = scratch(spark, "tables"), load(spark, sf, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    publish(spark, root, 0, {"authors": _authors(orders.where("o_orderkey % 10 <> 0"), "o_orderpriority")})
    merge(spark, root, "authors", piece_rows=PIECE)
    publish(spark, root, 2, {"authors": _authors(orders.where(F.col("o_orderkey") >= last * 0.99), "'late'")})
    merge(spark, root, "authors", piece_rows=PIECE)
    publish(spark, root, 4, {"authors": _authors(orders.where("o_orderkey % 997 = 1"), "'odd'")})
    return root


@query(
    "q_merge_base",
    f"""
SELECT {_ID} id, CASE WHEN o_orderkey % 997 = 1 THEN 'odd' WHEN {_TOP} THEN 'late' ELSE o_orderpriority END display_name,
       CAST(o_custkey % 1000 AS BIGINT) works_count
FROM orders WHERE o_orderkey % 10 <> 0 OR {_TOP} OR o_orderkey % 997 = 1""",
)
def q_merge_base(spark, sf):
    """Two batches after a base cut by key: one merged into it, one met by its pieces at reading."""
    return resolve(spark, _clustered_orders(spark, sf), "authors").select("id", "display_name", big("works_count"))


@query(
    "q_find_key",
    f"""
SELECT {_ID} id, CASE WHEN o_orderkey % 997 = 1 THEN 'odd' WHEN {_TOP} THEN 'late' ELSE o_orderpriority END display_name
FROM orders WHERE o_orderkey IN (1, 2, 777, 998, (SELECT max(o_orderkey) FROM orders))""",
)
def q_find_key(spark, sf):
    """Some ids looked up in a clustered table: only pieces whose bounds hold one are opened."""
    last = load(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    wanted = [f"A{k:012d}" for k in (1, 2, 777, 998, last, 10**11)]
    return find(spark, _clustered_orders(spark, sf), "authors", wanted).select("id", "display_name")


@query(
    "q_lookup_index",
    f"""
WITH a AS (SELECT {_ID} id, CASE WHEN o_orderkey % 997 = 1 THEN 'odd' WHEN {_TOP} THEN 'late' ELSE o_orderpriority END display_name
           FROM orders WHERE o_orderkey % 10 <> 0 OR {_TOP} OR o_orderkey % 997 = 1)
SELECT id, display_name, 'equal' kind FROM a WHERE display_name IN ('1-URGENT', 'odd', 'nobody')
UNION ALL SELECT id, display_name, 'between' FROM a WHERE display_name >= '2' AND display_name <= '3'""",
)
def q_lookup_index(spark, sf):
    """Rows found by the values of a column other than the key, through an index of each part of the table."""
    root = _clustered_orders(spark, sf)
    equal = lookups.lookup(spark, root, "authors", "display_name", ["1-URGENT", "odd", "nobody"])
    range_ = lookups.between(spark, root, "authors", "display_name", "2", "3")
    found = equal.withColumn("kind", F.lit("equal")).unionByName(range_.withColumn("kind", F.lit("between")))
    return found.select("id", "display_name", "kind")


_TOPIC_OF = "'W' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') work_id, 'T' || l_partkey topic_id"


@query(
    "q_merge_base_first",
    f"""
SELECT {_TOPIC_OF}, l_returnflag display_name FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY CASE WHEN l_linenumber < 5 THEN 0 WHEN l_linenumber = 5 THEN 1 ELSE 2 END,
                           l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1""",
)
def q_merge_base_first(spark, sf):
    """Composite keys and the policy of the first row, over a base, a merge and an open batch."""
    order = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    text_of = F.concat_ws("|", *[F.lpad(F.col(c).cast("string"), 14, "0") for c in order])
    rows = load(spark, sf, "lineitem").select(
        "l_linenumber", F.concat(F.lit("W"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("work_id"),
        F.concat(F.lit("T"), "l_partkey").alias("topic_id"), F.col("l_returnflag").alias("display_name"),
        text_of.alias("_file"), F.lit(0).cast("bigint").alias("_row"), F.lit(0).alias("_pos"),
    )
    root, n = scratch(spark, "tables"), F.col("l_linenumber")
    for batch, part in ((0, n < 5), (2, n == 5), (4, n > 5)):
        publish(spark, root, batch, {"works_topics": rows.where(part).drop("l_linenumber")})
        if batch < 4:
            merge(spark, root, "works_topics", piece_rows=4 * PIECE)
    return resolve(spark, root, "works_topics").select("work_id", "topic_id", "display_name")


def _two_days(spark, sf):
    """Customers as authors with two concepts; on the second day every other one comes again with one of them and a new one."""
    line = F.to_json(
        F.struct(
            F.concat(F.lit("A"), "c_custkey").alias("id"), F.concat("c_name", F.col("day")).alias("display_name"),
            F.transform("concepts", lambda c: F.struct(c.alias("id"), F.lit(0.5).alias("score"))).alias("x_concepts"),
        )
    )
    rows = load(spark, sf, "customer")
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    first = F.array(F.concat(F.lit("C"), nation), F.concat(F.lit("D"), key % 7))
    again = F.array(F.concat(F.lit("E"), key % 3), F.concat(F.lit("C"), nation))
    one = rows.withColumns({"day": F.lit("2024-01-01"), "concepts": first})
    two = rows.where(nation % 2 == 0).withColumns({"day": F.lit("2024-01-02"), "concepts": again})
    return [day.select("day", line.alias("value")) for day in (one, two)]


def _write_day(lines: DataFrame, folder: str) -> None:
    named = lines.select(F.col("day").alias(snapshot.PARTITION), "value")
    named.write.mode("append").partitionBy(snapshot.PARTITION).option("compression", "gzip").text(folder)


def _replaced_authors(spark, sf):
    """Both days run one after the other, later versions replacing all their concepts, with a merge between."""
    path, root = scratch(spark, "snapshot"), scratch(spark, "tables")
    for n, day in enumerate(_two_days(spark, sf)):
        _write_day(day, f"{path}/authors")
        run_entities(spark, path, root, ("authors",), replace_children=True)
        if not n:
            merge(spark, root, "authors_concepts", piece_rows=PIECE // 4)
    return root


_CONCEPTS = """
SELECT 'A' || c_custkey author_id, unnest(CASE WHEN c_nationkey % 2 = 0 THEN ['E' || (c_custkey % 3), 'C' || c_nationkey]
       ELSE ['C' || c_nationkey, 'D' || (c_custkey % 7)] END) concept_id FROM customer"""


@query("q_replace_ingest", _CONCEPTS)
def q_replace_ingest(spark, sf):
    """Concepts that an author's later version lacks are gone."""
    return resolve(spark, _replaced_authors(spark, sf), "authors_concepts").select("author_id", "concept_id")


@query(
    "q_batch_counts",
    """
SELECT 'authors' table_name, count(*) + count(*) FILTER (c_nationkey % 2 = 0) n_rows FROM customer
UNION ALL SELECT 'authors_concepts', 2 * count(*) + 2 * count(*) FILTER (c_nationkey % 2 = 0) FROM customer""",
)
def q_batch_counts(spark, sf):
    """Rows that two runs have written, as observed on the writes themselves."""
    counts = batch_counts(spark, _replaced_authors(spark, sf)).where("kind = 'batch' AND table_name IN ('authors', 'authors_concepts')")
    return counts.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "q_author_positions",
    """
SELECT 'W' || l_orderkey work_id, 'A' || l_suppkey author_id, CASE l_returnflag WHEN 'R' THEN 'second' ELSE lower(l_linestatus) END author_position
FROM lineitem WHERE l_returnflag <> 'A'""",
)
def q_author_positions(spark, sf):
    """Authorships whose position is none of the allowed ones."""
    flag, status = F.col("l_returnflag"), F.lower("l_linestatus")
    rows = load(spark, sf, "lineitem").select(
        F.concat(F.lit("W"), "l_orderkey").alias("work_id"), F.concat(F.lit("A"), "l_suppkey").alias("author_id"),
        F.when(flag == "A", F.when(F.col("l_linenumber") % 4 == 0, None).otherwise("last")).when(flag == "R", "second").otherwise(status).alias("author_position"),
    )
    return violations({"works_authorships": rows}, "works_authorships", "check:author_position")


@query(
    "q_assemble_resolved",
    f"""
WITH c AS ({_CONCEPTS})
SELECT 'A' || c_custkey id, c_name || CASE WHEN c_nationkey % 2 = 0 THEN '2024-01-02' ELSE '2024-01-01' END display_name, CAST(0 AS BIGINT) AS "page",
       CASE WHEN c_nationkey % 2 = 0 THEN 'E' || (c_custkey % 3) || ',C' || c_nationkey ELSE 'C' || c_nationkey || ',D' || (c_custkey % 7) END concepts
FROM customer""",
)
def q_assemble_resolved(spark, sf):
    """Authors with their concepts in order, from tables that two runs and a compaction have written."""
    root = _replaced_authors(spark, sf)
    compact(spark, root, "authors_concepts")
    children = resolve(spark, root, "authors_concepts", keep=ARRIVAL)
    whole = reassemble(resolve(spark, root, "authors"), children, "author_id")
    names = F.array_join(F.transform("items", lambda c: c["concept_id"]), ",")
    return whole.select("id", "display_name", big("page"), names.alias("concepts"))


@query(
    "q_bad_child_values",
    """
WITH c AS (SELECT 'A' || c_custkey id, c_custkey k, c_nationkey n FROM customer)
SELECT id, 'authors_counts_by_year' table_name, 'works_count' column_name, CAST(0 AS BIGINT) pos, k || '.5' AS "value" FROM c WHERE n % 2 = 0
UNION ALL SELECT id, 'authors_counts_by_year', 'cited_by_count', 0, '"many"' FROM c WHERE n % 3 = 0
UNION ALL SELECT id, 'authors_counts_by_year', 'year', 1, '2021.5' FROM c WHERE n % 5 = 0
UNION ALL SELECT id, 'authors_counts_by_year', 'counts_by_year', 2, '7' FROM c WHERE n % 5 = 1
UNION ALL SELECT id, 'authors_concepts', 'x_concepts', NULL, '"none"' FROM c WHERE n % 4 = 1
UNION ALL SELECT id, 'authors_concepts', 'score', 1, '"high"' FROM c WHERE n % 4 = 2
UNION ALL SELECT id, 'authors', 'created_date', NULL, '"soon"' FROM c WHERE n % 7 = 0
UNION ALL SELECT id, 'authors', 'updated_date', NULL, '"someday"' FROM c WHERE n % 7 = 1""",
)
def q_bad_child_values(spark, sf):
    """Values that columns of list tables can't hold: fractions, texts, a text or a number instead of a list or an object, no dates."""
    n = F.col("c_nationkey")

    def either(when, odd, plain):
        return F.when(when, F.lit(odd)).otherwise(F.lit(plain))

    line = F.concat(
        F.lit('{"id":"A'), "c_custkey", F.lit('","counts_by_year":[{"year":2020,"works_count":'), "c_custkey", either(n % 2 == 0, ".5", ""),
        F.lit(',"cited_by_count":'), either(n % 3 == 0, '"many"', "null"), F.lit('},{"year":'), either(n % 5 == 0, "2021.5", "2021"), F.lit("}"),
        either(n % 5 == 1, ",7", ""), F.lit('],"x_concepts":'),
        F.when(n % 4 == 1, F.lit('"none"')).when(n % 4 == 2, F.lit('[{"id":"C1","score":1},{"id":"C2","score":"high"}]')).otherwise(F.lit("null")),
        F.lit(',"created_date":'), either(n % 7 == 0, '"soon"', '"2020-01-01"'), F.lit(',"updated_date":'), either(n % 7 == 1, '"someday"', '""'), F.lit("}"),
    )
    lines = load(spark, sf, "customer").select(F.col("c_custkey").alias("_row"), line.alias("value"))
    found = bad_values(shape(parse_lines(lines), "authors", lost=True), "authors")
    return found.select("id", "table_name", "column_name", big("pos"), "value")


@query("q_run_names", "SELECT 'A' || c_custkey id, 'completed' status FROM customer")
def q_run_names(spark, sf):
    """Files whose names hold brackets, braces, wildcards, per cent signs and blanks are read as any other."""
    path, root = scratch(spark, "snapshot"), scratch(spark, "tables")
    _write_day(_two_days(spark, sf)[0].repartition(5), f"{path}/authors")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/authors/{snapshot.PARTITION}=2024-01-01")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(s.getPath().getName() for s in store.listStatus(folder) if s.getPath().getName().endswith(".gz"))
    for name, odd in zip(parts, ("part[1].gz", "part{a,b}.gz", "50%25 [x.gz", "what?*.gz", "plain.gz"), strict=True):
        store.rename(spark._jvm.org.apache.hadoop.fs.Path(folder, name), spark._jvm.org.apache.hadoop.fs.Path(folder, odd))
    state = run_entities(spark, path, root, ("authors",)).first()
    return resolve(spark, root, "authors").select("id", F.lit(state.status).alias("status"))


def _indexed_documents(spark, sf):
    """Documents as works, their texts as titles: two of three in a base, the rest in a batch that also replaces some of them."""
    root, docs = scratch(spark, "tables"), load(spark, sf, "documents")
    work = [
        F.concat(F.lit("D"), "doc_id").alias("id"), F.col("text").alias("title"), F.lit("docs").alias("_file"),
        F.col("doc_id").alias("_row"), F.lit(0).alias("_pos"),
    ]
    publish(spark, root, 0, {"works": docs.where("doc_id % 3 > 0").select(*work)})
    merge(spark, root, "works", piece_rows=PIECE)
    postings.index(spark, root, "works", "title")
    other = docs.where("doc_id % 3 = 0 OR doc_id % 10 = 1").withColumn("text", F.when(F.col("doc_id") % 10 == 1, F.lit("The new Atha, the")).otherwise(F.col("text")))
    publish(spark, root, 2, {"works": other.select(*work)})
    return root


_WORDS = r"""
WITH d AS (SELECT 'D' || doc_id id, regexp_extract_all(lower(CASE WHEN doc_id % 10 = 1 THEN 'The new Atha, the' ELSE text END), '[\p{L}\p{N}]+') t FROM documents)
"""


@query("q_postings_all", _WORDS + "SELECT id FROM d WHERE list_has_all(t, ['the', 'atha'])")
def q_postings_all(spark, sf):
    """Texts with all of the words, by postings; those of replaced texts don't count."""
    return postings.search(spark, _indexed_documents(spark, sf), "works", "title", ["the Atha"]).select("id")


@query(
    "q_postings_rank",
    _WORDS + "SELECT id, CAST(len(list_filter(t, lambda x: x IN ('the', 'that', 'atha'))) AS BIGINT) hits FROM d ORDER BY 2 DESC, 1 LIMIT 100",
)
def q_postings_rank(spark, sf):
    """The hundred texts in which the words stand most often."""
    found = postings.search(spark, _indexed_documents(spark, sf), "works", "title", ["the", "That", "atha"], match="any")
    return top_k(found, "hits", 100, "id").select("id", big("hits"))


_LABEL = "p_name || ' ' || p_brand || ' ' || p_type"


@query(
    "q_fuzzy_names",
    f"""
WITH n AS (SELECT DISTINCT {_LABEL} AS name FROM part),
g AS (SELECT name, list_distinct(list_transform(range(1, length(name) + 3), lambda i: substr('  ' || lower(name) || '  ', i, 3))) AS g FROM n),
p AS (SELECT x.name a, y.name b, CAST(len(list_intersect(x.g, y.g)) AS BIGINT) shared, CAST(len(x.g) + len(y.g) AS BIGINT) sizes FROM g x JOIN g y ON x.name < y.name)
SELECT a, b, shared, sizes - shared total FROM p WHERE 100 * shared >= 80 * (sizes - shared)""",
)
def q_fuzzy_names(spark, sf):
    """Different labels of parts that are nearly the same."""
    labels = load(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("label"))
    return similar_names(labels, "label", 80).select("a", "b", big("shared"), big("total"))


_STAR = (
    Table("region", tuple(text("id", "r_name")), ("id",), required=("r_name",)),
    Table("nation", tuple(text("id", "n_name", "n_regionkey")), ("id",), references=(("n_regionkey", "region"),)),
    Table("customer", tuple(text("id", "c_nationkey")), ("id",), references=(("c_nationkey", "nation"),), allowed={"c_mktsegment": ("BUILDING", "MACHINERY")}),
    Table("supplier", tuple(text("id", "s_nationkey")), ("id",), references=(("s_nationkey", "nation"),)),
    Table("part", tuple(text("id")), ("id",), allowed={"p_type": ("ECONOMY", "PROMO", "SMALL")}),
    Table("orders", tuple(text("id", "o_custkey")), ("id",), references=(("o_custkey", "customer"),), allowed={"o_orderstatus": ("F", "O")}),
    Table(
        "lineitem", tuple(text("l_orderkey", "l_linenumber")), ("l_orderkey", "l_linenumber"), required=("l_shipdate",),
        references=(("l_orderkey", "orders"), ("l_partkey", "part"), ("l_suppkey", "supplier")), allowed={"l_returnflag": ("A", "N")},
    ),
    Table("events", tuple(text("id", "user_id")), ("id",), references=(("user_id", "customer"),), required=("value",)),
)
_STAR_KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "events": "event_id"}


def _star_sql() -> str:
    parts = []
    for t in _STAR:
        key = [_STAR_KEYS[t.name]] if t.name in _STAR_KEYS else list(t.key)
        checks = {"primary_key": f"SELECT count(*) - count(DISTINCT ({', '.join(key)}{', 0' if len(key) == 1 else ''})) FROM {t.name}"}
        for column, parent in t.references:
            checks[f"foreign_key:{column}"] = f"SELECT count(*) FROM {t.name} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {_STAR_KEYS[parent]} FROM {parent})"
        for name, column in zip((*t.key, *t.required), (*key, *t.required), strict=True):
            checks[f"not_null:{name}"] = f"SELECT count(*) FROM {t.name} WHERE {column} IS NULL"
        for column, allowed in t.allowed.items():
            checks[f"check:{column}"] = f"SELECT count(*) FROM {t.name} WHERE {column} IS NOT NULL AND {column} NOT IN ({', '.join(repr(v) for v in allowed)})"
        parts += [f"SELECT '{t.name}' table_name, '{c}' AS \"constraint\", ({sql}) n_bad" for c, sql in checks.items()]
    return " UNION ALL ".join(parts)


@query("q_audit", _star_sql())
def q_audit(spark, sf):
    """Keys, references, allowed values and NOT NULL of eight whole tables, in one pass and one shuffle."""
    tables = {t.name: load(spark, sf, t.name) for t in _STAR}
    tables = {n: rows.withColumnRenamed(_STAR_KEYS[n], "id") if n in _STAR_KEYS else rows for n, rows in tables.items()}
    return audit(tables, _STAR)


@query(
    "q_log_checkpoint",
    """
SELECT 'authors' entity, 'completed' status, count(*) n_rows, TRUE same FROM customer""",
)
def q_log_checkpoint(spark, sf):
    """The log and the list of batches folded between two runs: the state stays the same."""
    path, root = scratch(spark, "snapshot"), scratch(spark, "tables")
    one, two = _two_days(spark, sf)
    _write_day(one, f"{path}/authors")
    run_entities(spark, path, root, ("authors",), files_per_batch=1)
    before = {tuple(r) for r in _told(log_of(spark, root)).collect()}
    checkpoint(spark, root)
    same = before == {tuple(r) for r in _told(manifest_of(spark, root)).collect()}
    state = run_entities(spark, path, root, ("authors",))
    return state.select("entity", "status", "n_rows", F.lit(same).alias("same"))


def _told(log: DataFrame) -> DataFrame:
    return log.where("event = 'done'").select("seq", "entity", "file", "n_rows")


@query(
    "q_catalog_stats",
    """
SELECT 'authors' table_name, count(*) row_count, CAST(0 AS BIGINT) n_problems FROM customer
UNION ALL SELECT 'authors_concepts', 2 * count(*), 0 FROM customer
UNION ALL SELECT 'authors_ids', count(*), 0 FROM customer UNION ALL SELECT 'authors_counts_by_year', 0, 0""",
)
def q_catalog_stats(spark, sf):
    """A run's tables in the catalog: rows as its statistics say, and columns that differ from the model."""
    database = f"filled_{scratch(spark, 'x')[-8:]}"
    report.fill_tables(spark, _replaced_authors(spark, sf), database)
    problems = report.compare_with_model(spark, database).groupBy("table_name").agg(F.count("*").alias("n_problems"))
    found = report.analysed(spark, database).join(problems, "table_name", "left")
    return found.select("table_name", "row_count", F.coalesce("n_problems", F.lit(0)).alias("n_problems"))


@query(
    "q_failed_batch",
    f"""
SELECT 'after failure' state, {_ID} id, o_orderpriority display_name FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'after replay', {_ID}, CASE o_orderstatus WHEN 'P' THEN 'second' WHEN 'O' THEN 'second' ELSE o_orderpriority END FROM orders""",
)
def q_failed_batch(spark, sf):
    """A batch that fails after its first table was written stays hidden; written again it is whole."""
    root, orders = scratch(spark, "tables"), load(spark, sf, "orders")
    publish(spark, root, 0, {"authors": _authors(orders.where("o_orderstatus <> 'P'"), "o_orderpriority")})
    second = _authors(orders.where("o_orderstatus IN ('O', 'P')"), "'second'")
    broken = second.withColumn("display_name", F.raise_error(F.lit("the disk is full")).cast("string"))
    try:
        publish(spark, root, 1, {"authors": second, "topics": broken})
    except Exception as problem:  # noqa: BLE001
        if "the disk is full" not in str(problem):
            raise
    failed = resolve(spark, root, "authors").withColumn("state", F.lit("after failure"))
    publish(spark, root, 1, {"authors": second, "topics": second})
    replayed = resolve(spark, root, "authors").withColumn("state", F.lit("after replay"))
    return failed.unionByName(replayed).select("state", "id", "display_name")
