"""Queries that go through files: snapshot scans, CSV, and the file stream.

The files are derived from the test tables and written below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.flatten import flatten, write_csv
from shelfmark.operators.parse import FRAME, RECORD, parse_lines, records
from shelfmark.operators import manifest
from shelfmark.operators.publish import resolve
from shelfmark.session import scratch, spread, stored
from shelfmark.sources import snapshot
from shelfmark.sources.files import scan_csv
from shelfmark.streaming.ingest import ingest_stream
from shelfmark.streaming.runs import log_of, note, run_entities
from shelfmark.workload import records as R
from shelfmark.workload.registry import big, load, num, query, shown


def _as_snapshot(spark, lines: DataFrame, partition: str, entity: str) -> str:
    """Write (``partition``, ``value``) as ``<root>/<entity>/updated_date=.../*.gz``."""
    path = f"{scratch(spark, 'snapshot')}/{entity}"
    named = lines.select(F.col(partition).alias(snapshot.PARTITION), "value")
    named.write.partitionBy(snapshot.PARTITION).option("compression", "gzip").text(path)
    return path


def _event_files(spark, sf):
    events = load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("props").alias("value")
    )
    return _as_snapshot(spark, spread(events), "day", "events")


@query(
    "q_scan_lines",
    """
SELECT strftime(ts, '%Y-%m-%d') AS "partition", count(*) n_lines, count(*) last_lines,
       CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) k
FROM events GROUP BY 1""",
)
def q_scan_lines(spark, sf):
    lines = snapshot.scan_jsonl(spark, _event_files(spark, sf))
    wanted = lines.select("_partition", "_file", "_row", F.try_variant_get(FRAME, f"{RECORD}.k", "bigint").alias("k"))
    numbered = snapshot.number_lines(wanted, wanted)
    per_file = numbered.groupBy("_partition", "_file").agg(
        F.count("*").alias("n"), F.max("line").alias("last"), F.sum("k").alias("k")
    )
    return per_file.groupBy(shown("_partition", "partition")).agg(
        F.sum("n").alias("n_lines"), F.sum("last").alias("last_lines"), F.sum("k").alias("k")
    )


@query(
    "q_window_partition",
    """
SELECT strftime(ts, '%Y-%m-%d') AS "partition", count(*) n FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' GROUP BY 1""",
)
def q_window_partition(spark, sf):
    lines = snapshot.scan_lines(spark, _event_files(spark, sf), start="2024-01-10", end="2024-01-15")
    return lines.groupBy(shown("_partition", "partition")).agg(F.count("*").alias("n"))


@query(
    "q_latest_files",
    """
SELECT max(strftime(ts, '%Y-%m-%d')) AS "partition", count(DISTINCT strftime(ts, '%Y-%m-%d')) n_partitions FROM events""",
)
def q_latest_files(spark, sf):
    """The newest partition by the file listing alone; nothing is read."""
    files = snapshot.list_files(spark, _event_files(spark, sf), "events")
    total = files.select(F.count_distinct("partition")).scalar()
    newest = snapshot.latest_partition(files).select(shown("partition")).distinct()
    return newest.withColumn("n_partitions", total)


def _customer_records(spark, sf):
    """Customers as nested records for flattening."""
    record = """
        to_json(named_struct('key', c_custkey, 'name', c_name,
          'place', named_struct('nation', c_nationkey, 'geo', if(c_nationkey % 2 = 0, named_struct('balance', c_acctbal), NULL)),
          'tags', array(c_mktsegment, 'x'), 'flag', c_nationkey % 3 = 0))
    """
    return spread(load(spark, sf, "customer")).selectExpr("c_custkey AS _row", f"{record} AS value")


_FLAT = """
SELECT c_custkey AS "key", c_name AS "name", CAST(c_nationkey AS BIGINT) place_nation,
       CASE WHEN c_nationkey % 2 = 0 THEN ROUND(c_acctbal, 2) END place_geo_balance,
       '["' || c_mktsegment || '","x"]' tags, c_nationkey % 3 = 0 flag
FROM customer"""

_FLAT_COLUMNS = ["key", "name", "place_nation", "tags", "flag"]


@query("q_flatten", _FLAT)
def q_flatten(spark, sf):
    flat = flatten(records(parse_lines(_customer_records(spark, sf))))
    return flat.select(*_FLAT_COLUMNS, num("place_geo_balance", digits=2))


@query("q_csv_roundtrip", _FLAT)
def q_csv_roundtrip(spark, sf):
    path = scratch(spark, "csv")
    flat = flatten(records(parse_lines(_customer_records(spark, sf))))
    write_csv(flat.drop("_row"), path)
    ddl = "key bigint, name string, place_nation bigint, place_geo_balance double, tags string, flag boolean"
    return scan_csv(spark, path, ddl).select(*_FLAT_COLUMNS, num("place_geo_balance", digits=2))


@query(
    "q_flatten_clash",
    """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_id ELSE CAST(props->>'k' AS BIGINT) END a_b FROM events""",
)
def q_flatten_clash(spark, sf):
    """Two keys flatten to a_b; the one that comes later in the record wins."""
    nested = F.concat(F.lit('"a":{"b":'), F.get_json_object("props", "$.k"), F.lit("}"))
    plain = F.concat(F.lit('"a_b":'), "event_id")
    late_plain = F.col("event_type").isin("click", "view")
    body = F.when(late_plain, F.concat(nested, F.lit(","), plain)).otherwise(F.concat(plain, F.lit(","), nested))
    records = load(spark, sf, "events").select(
        F.col("event_id").alias("_id"), F.concat(F.lit("{"), body, F.lit("}")).alias("text")
    )
    parsed = records.withColumn("v", F.try_parse_json("text"))
    return flatten(parsed, text="text").select(F.col("_id").alias("event_id"), "a_b")


@query(
    "q_stream_ingest",
    """
SELECT 'A' || c_custkey id, c_name display_name, CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE c_custkey % 50 END works_count,
       CASE WHEN c_nationkey % 3 <> 0 THEN 'I' || c_nationkey END last_known_institution, CAST(2 AS BIGINT) n_years
FROM customer""",
)
def q_stream_ingest(spark, sf):
    """Customers as author files, loaded file by file into all author tables."""
    records = R.author_lines(spark, sf).select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("_row"), F.lit(4))).alias("day"), "value"
    )
    path = _as_snapshot(spark, records, "day", "authors")
    root = scratch(spark, "tables")
    ingest_stream(spark, path, "authors", root, f"{root}/_stream", files_per_trigger=12).awaitTermination()
    years = resolve(spark, root, "authors_counts_by_year").groupBy(F.col("author_id").alias("id")).agg(
        F.count("*").alias("n_years")
    )
    authors = resolve(spark, root, "authors").select(
        "id", "display_name", big("works_count"), "last_known_institution"
    )
    return authors.join(years, "id", "left")


@query(
    "q_stream_upsert",
    """
WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS "day", max(event_id) event_id FROM events GROUP BY 1, 2)
SELECT 'A' || user_id id, arg_max("day", "day") AS "day", arg_max(event_id, "day") works_count FROM d GROUP BY 1""",
)
def q_stream_upsert(spark, sf):
    """The last event of every user and day as a version of an author; the newest day wins."""
    daily = load(spark, sf, "events").groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.max("event_id").alias("event_id")
    )
    record = F.to_json(
        F.struct(
            F.concat(F.lit("A"), "user_id").alias("id"),
            F.col("event_id").alias("works_count"),
            F.concat("day", F.lit("T00:00:00")).alias("updated_date"),
        )
    )
    path = _as_snapshot(spark, daily.select("day", record.alias("value")), "day", "authors")
    root = scratch(spark, "tables")
    ingest_stream(spark, path, "authors", root, f"{root}/_stream", files_per_trigger=100).awaitTermination()
    current = resolve(spark, root, "authors", newest_by="updated_date")
    return current.select("id", F.date_format("updated_date", "yyyy-MM-dd").alias("day"), big("works_count"))


def _daily_authors(spark, sf):
    """Customers as author records of four days."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("_row"), F.lit(4)))
    return R.author_lines(spark, sf).select(day.cast("string").alias("day"), "value")


def _snapshot_of(spark, **entities):
    """Write the records (``day``, ``value``) of some entities as one snapshot; its folder."""
    path = scratch(spark, "snapshot")
    for entity, lines in entities.items():
        _write_days(lines, f"{path}/{entity}")
    return path


def _write_days(lines, path):
    named = lines.select(F.col("day").alias(snapshot.PARTITION), "value")
    named.write.mode("append").partitionBy(snapshot.PARTITION).option("compression", "gzip").text(path)


@query(
    "q_run_retry",
    """
SELECT 'A' || c_custkey id, c_name display_name, 'in_progress' before, 'completed' after FROM customer""",
)
def q_run_retry(spark, sf):
    """One day comes damaged: its files fail and are left out. Sent again, the next run reads them."""
    lines = stored(_daily_authors(spark, sf), "authors")
    late = F.col("day") == "2024-01-04"
    path = _snapshot_of(spark, authors=lines.where(~late))
    _write_days(lines.where(late).withColumn("value", F.concat("value", F.lit("}"))), f"{path}/authors")
    root = scratch(spark, "tables")
    before = run_entities(spark, path, root, ("authors",), max_errors=1).first()
    lines.where(late).select("value").write.mode("overwrite").option("compression", "gzip").text(
        f"{path}/authors/{snapshot.PARTITION}=2024-01-04"
    )
    after = run_entities(spark, path, root, ("authors",), max_errors=1).first()
    authors = resolve(spark, root, "authors").select("id", "display_name")
    return authors.select("*", F.lit(before.status).alias("before"), F.lit(after.status).alias("after"))


@query(
    "q_run_reset",
    """
SELECT 'authors' entity, 'completed' status, TRUE has_last, count(*) n_rows, 2 * count(*) n_read, count(*) n_authors FROM customer""",
)
def q_run_reset(spark, sf):
    """An entity that is reset is read again as a whole, and its tables stay the same."""
    path, root = _snapshot_of(spark, authors=_daily_authors(spark, sf)), scratch(spark, "tables")
    run_entities(spark, path, root, ("authors",))
    note(spark, root, "authors", "reset")
    state = run_entities(spark, path, root, ("authors",))
    read = log_of(spark, root).where("event = 'done'").agg(F.sum("n_rows")).first()[0]
    return state.select(
        "entity", "status", F.col("last_file").isNotNull().alias("has_last"), "n_rows", F.lit(read).alias("n_read"),
        F.lit(resolve(spark, root, "authors").count()).cast("bigint").alias("n_authors"),
    )


@query(
    "q_run_resume",
    """
SELECT unnest(['authors', 'domains']) entity, unnest(['in_progress', 'completed']) status, unnest([count(*), 5]) n_rows
FROM customer WHERE c_custkey % 2 = 0""",
)
def q_run_resume(spark, sf):
    """A run stops after some files of the first entity: the next one reads the rest and goes on.

    Half of the customers came before the stop; the others are damaged, so their files fail again.
    """
    halves = R.author_lines(spark, sf).withColumn("late", F.col("_row") % 2 == 1)
    day = F.when(F.col("late"), "2024-01-02").otherwise("2024-01-01").alias("day")
    value = F.when(F.col("late"), F.concat("value", F.lit("}"))).otherwise(F.col("value")).alias("value")
    regions = load(spark, sf, "region").select(
        F.lit("2024-01-01").alias("day"),
        F.to_json(F.struct(F.concat(F.lit("D"), "r_regionkey").alias("id"), F.col("r_name").alias("display_name"))).alias("value"),
    )
    path = _snapshot_of(spark, authors=halves.select(day, value), domains=regions)
    root = scratch(spark, "tables")
    run_entities(spark, path, root, ("authors",), max_errors=1)
    state = run_entities(spark, path, root, ("authors", "domains"), max_errors=1)
    todo = manifest.resume(log_of(spark, root), ("authors", "domains")).first()
    return state.where(F.lit(todo.entity == "authors")).select("entity", "status", "n_rows")


@query(
    "q_csv_mixed",
    """
SELECT c_custkey AS "key", c_name AS "name", CASE WHEN c_nationkey % 2 = 0 THEN ROUND(c_acctbal, 2) END balance FROM customer""",
)
def q_csv_mixed(spark, sf):
    """Files with different headers in one folder: each is read by its own."""
    path = scratch(spark, "csv")
    rows = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_nationkey")
    even = F.col("c_nationkey") % 2 == 0
    write_csv(rows.where(even).select("balance", "key", "name"), path)
    write_csv(rows.where(~even).select("key", "name"), path, mode="append")
    return scan_csv(spark, path, "key bigint, name string, balance double").select("key", "name", num("balance", digits=2))
