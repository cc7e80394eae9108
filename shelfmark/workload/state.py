"""Ingestion state queries: the events table read as a log of ingestion events."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import scalars as S
from shelfmark.operators import manifest as M
from shelfmark.operators import report
from shelfmark.plans.catalog import ENTITIES
from shelfmark.sources import files as FL
from shelfmark.sources.snapshot import latest_partition
from shelfmark.workload.registry import load, num, query, shown

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# event type -> manifest event; an expensive purchase ends its entity, a very expensive
# error resets it. The entity is one of the model's nine, the file one per user and day.
_EVENT = """CASE WHEN event_type = 'click' THEN 'in_progress' WHEN event_type = 'view' THEN 'done'
  WHEN event_type = 'purchase' AND value > 200 THEN 'entity_done' WHEN event_type = 'purchase' THEN 'failed'
  WHEN event_type = 'error' AND value > 250 THEN 'reset' WHEN event_type = 'error' THEN 'error'
  ELSE 'in_progress' END"""
_ENTITY_LIST = ", ".join(f"'{e}'" for e in ENTITIES)

_LOG = f"""
WITH log AS (
  SELECT event_id seq, ([{_ENTITY_LIST}])[1 + CAST(user_id % 9 AS INT)] entity,
         'f' || user_id || '-' || strftime(ts, '%d') AS "file", {_EVENT} AS "event", ts AS "at",
         CAST(floor(value) AS BIGINT) n_rows
  FROM events),
live AS (
  SELECT l.* FROM log l LEFT JOIN (SELECT entity, max(seq) r FROM log WHERE "event" = 'reset' GROUP BY 1) x
    ON l.entity = x.entity WHERE r IS NULL OR seq > r)
"""


def _log(spark, sf):
    events = load(spark, sf, "events")
    entity = F.get(F.array(*[F.lit(e) for e in ENTITIES]), (F.col("user_id") % 9).cast("int"))
    return events.select(
        F.col("event_id").alias("seq"),
        entity.alias("entity"),
        F.to_date("ts").alias("partition"),
        F.concat(F.lit("f"), "user_id", F.lit("-"), F.date_format("ts", "dd")).alias("file"),
        F.expr(_EVENT).alias("event"),
        F.col("ts").alias("at"),
        F.floor("value").alias("n_rows"),
        F.lit(0).cast("bigint").alias("n_malformed"),
        F.lit(0).cast("bigint").alias("n_rejected"),
        F.col("event_type").alias("message"),
    )


_PER_ENTITY = """
, s AS (
  SELECT entity, count(DISTINCT "file") FILTER ("event" = 'done') n_files, count(*) FILTER ("event" = 'done') n_reports,
         coalesce(arg_max(CASE WHEN "event" = 'entity_done' THEN 'completed' ELSE 'in_progress' END, seq)
           FILTER ("event" IN ('in_progress', 'entity_done')), 'not_started') status,
         arg_max("file", seq) FILTER ("event" = 'in_progress') last_file, max("at") last_updated
  FROM live GROUP BY 1),
d AS (SELECT entity, CAST(sum(n) AS BIGINT) n_rows FROM (
  SELECT entity, "file", arg_max(n_rows, seq) n FROM live WHERE "event" = 'done' GROUP BY 1, 2) GROUP BY 1)
"""


@query(
    "q_state_summary",
    _LOG
    + _PER_ENTITY
    + """
SELECT s.entity, status, last_file, n_files, n_reports, coalesce(n_rows, 0) n_rows,
       strftime(last_updated, '%Y-%m-%d %H:%M:%S') last_updated
FROM s LEFT JOIN d ON s.entity = d.entity""",
)
def q_state_summary(spark, sf):
    return M.summary(_log(spark, sf)).withColumn(
        "last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "q_state_reset",
    _LOG + """SELECT entity, "event", count(*) n, min(seq) first_seq FROM live GROUP BY 1, 2""",
)
def q_state_reset(spark, sf):
    live = M.since_reset(_log(spark, sf))
    return live.groupBy("entity", "event").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


@query(
    "q_state_current",
    _LOG
    + """
SELECT entity, "file", arg_max("event", seq) AS "event", max(seq) seq, arg_max(n_rows, seq) n_rows
FROM live GROUP BY 1, 2""",
)
def q_state_current(spark, sf):
    return M.state(_log(spark, sf)).select("entity", "file", "event", "seq", "n_rows")


@query(
    "q_completed_set",
    _LOG + """SELECT DISTINCT entity, "file" FROM live WHERE "event" = 'done'""",
)
def q_completed_set(spark, sf):
    return M.completed_files(_log(spark, sf))


@query(
    "q_new_files",
    _LOG
    + """
SELECT DISTINCT entity, "file" FROM log l
WHERE NOT EXISTS (SELECT 1 FROM live d WHERE d."event" = 'done' AND d.entity = l.entity AND d."file" = l."file")""",
)
def q_new_files(spark, sf):
    log = _log(spark, sf)
    return M.new_files(log.select("entity", "file").distinct(), log)


@query(
    "q_resume",
    _LOG
    + _PER_ENTITY
    + f"""
, o AS (SELECT unnest(range(9)) place, unnest([{_ENTITY_LIST}]) entity),
p AS (SELECT place, o.entity, coalesce(status, 'not_started') status FROM o LEFT JOIN s ON o.entity = s.entity)
SELECT place, entity, status FROM p WHERE place >= (SELECT coalesce(min(place) FILTER (status <> 'completed'), 0) FROM p)""",
)
def q_resume(spark, sf):
    return M.resume(_log(spark, sf)).withColumn("place", F.col("place").cast("bigint"))


@query(
    "q_error_tail",
    """
SELECT event_id seq, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "at", ROUND(value, 4) AS "value"
FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 100""",
)
def q_error_tail(spark, sf):
    errors = load(spark, sf, "events").where("event_type = 'error'")
    newest = M.tail_errors(errors, at="ts", tie="event_id")
    return newest.select(F.col("event_id").alias("seq"), S.iso(F.col("ts")).alias("at"), num("value"))


# Snapshots are named by the time of an event, some names are damaged.
_NAMES = """
WITH snap AS (SELECT CASE WHEN event_type = 'error' THEN 'state_backup_' || event_id || '.json'
    WHEN event_id % 7 = 1 THEN 'state_backup_' || strftime(ts, '%Y%m%d_%H%M%S') || '9.json'
    WHEN event_id % 7 = 2 THEN 'keep_' || strftime(ts, '%Y%m%d_%H%M%S') || '_manual.json'
    ELSE 'state_backup_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' END AS "name", event_id, event_type, ts FROM events)
"""


def _snapshots(spark, sf):
    plain = F.concat(F.lit("state_backup_"), F.col("event_id"), F.lit(".json"))
    stamped = F.concat(F.lit("state_backup_"), S.stamp(F.col("ts")), F.lit(".json"))
    longer = F.concat(F.lit("state_backup_"), S.stamp(F.col("ts")), F.lit("9.json"))
    by_hand = F.concat(F.lit("keep_"), S.stamp(F.col("ts")), F.lit("_manual.json"))
    seventh = F.col("event_id") % 7
    name = F.when(F.col("event_type") == "error", plain).when(seventh == 1, longer).when(seventh == 2, by_hand)
    return load(spark, sf, "events").select(name.otherwise(stamped).alias("name"), "event_id")


@query(
    "q_retention_newest",
    _NAMES + """SELECT "name" FROM snap ORDER BY "name" DESC LIMIT 10""",
)
def q_retention_newest(spark, sf):
    return M.retain_newest(_snapshots(spark, sf)).select("name")


@query(
    "q_retention_days",
    _NAMES
    + """
SELECT event_id, "name" FROM snap
WHERE event_type <> 'error' AND event_id % 7 NOT IN (1, 2) AND floor((epoch(TIMESTAMP '2024-02-10 12:00:00') - floor(epoch(ts))) / 86400) > 30""",
)
def q_retention_days(spark, sf):
    now = F.lit("2024-02-10 12:00:00").cast("timestamp")
    return M.expired(_snapshots(spark, sf), now).select("event_id", "name")


@query(
    "q_table_stats",
    " UNION ALL ".join(
        f"SELECT '{t}' table_name, count(*) row_count, FALSE in_model FROM {t}" for t in _TABLES
    ),
)
def q_table_stats(spark, sf):
    stats = report.table_stats({t: load(spark, sf, t) for t in _TABLES})
    return stats.select("table_name", "row_count", "in_model")


@query(
    "q_schema_diff",
    """
WITH have AS (SELECT DISTINCT o_orderpriority table_name, o_orderstatus column_name FROM orders),
want AS (SELECT DISTINCT o_orderpriority table_name, column_name FROM orders, (SELECT unnest(['F', 'O', 'X']) column_name))
SELECT table_name, column_name, 'missing' problem FROM want WHERE (table_name, column_name) NOT IN (SELECT (table_name, column_name) FROM have)
UNION ALL SELECT table_name, column_name, 'unknown' FROM have WHERE (table_name, column_name) NOT IN (SELECT (table_name, column_name) FROM want)""",
)
def q_schema_diff(spark, sf):
    """Priorities as tables, statuses as columns."""
    found = load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table_name"), F.col("o_orderstatus").alias("column_name")
    )
    names = found.select("table_name").distinct()
    wanted = names.select("table_name", F.explode(F.array(*[F.lit(c) for c in "FOX"])).alias("column_name"))
    return report.column_diff(wanted, found.distinct())


@query(
    "q_log_scan",
    """
SELECT "value" FROM (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - ' || CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END || ' - ' || event_id AS "value"
  FROM events ORDER BY ts DESC, event_id DESC LIMIT 50) WHERE "value" LIKE '%ERROR%'""",
)
def q_log_scan(spark, sf):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    lines = load(spark, sf, "events").select(
        "ts", "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), level, F.lit(" - "), "event_id").alias("value"),
    )
    return FL.error_lines(lines, ["ts", "event_id"]).select("value")


@query(
    "q_alerts",
    """
SELECT CAST(user_id AS VARCHAR) AS "file", event_type metric, ROUND(max(value), 4) AS "value",
       CAST(CASE event_type WHEN 'click' THEN 150 ELSE 200 END AS DOUBLE) threshold
FROM events GROUP BY user_id, event_type HAVING max(value) > CASE event_type WHEN 'click' THEN 150 ELSE 200 END""",
)
def q_alerts(spark, sf):
    metrics = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    metrics = metrics.select(F.col("user_id").cast("string").alias("file"), F.col("event_type").alias("metric"), "value")
    return report.alerts(metrics, {"click": 150.0}, default=200.0).withColumn("value", F.round("value", 4))


@query(
    "q_newest_per_source",
    """SELECT source, max(doc_id) doc_id, arg_max(n_chars, doc_id) n_chars FROM documents GROUP BY 1""",
)
def q_newest_per_source(spark, sf):
    docs = load(spark, sf, "documents")
    newest = FL.newest_file(docs, at="doc_id", name="doc_id", by=("source",))
    return newest.join(docs, ["source", "doc_id"]).select("source", "doc_id", "n_chars")


@query(
    "q_format",
    """
SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') parsed,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') iso, ROUND(event_id * 1000000.0 / 1073741824, 2) gb,
       CASE WHEN event_id < 10240 THEN event_id || ' bytes'
            WHEN (event_id + 512) // 1024 < 10240 THEN ((event_id + 512) // 1024) || ' kB'
            ELSE ((event_id + 524288) // 1048576) || ' MB' END pretty
FROM events""",
)
def q_format(spark, sf):
    events = load(spark, sf, "events")
    stamped = events.select("event_id", "ts", S.stamp(F.col("ts")).alias("stamp"))
    return stamped.select(
        "event_id", "stamp",
        F.date_format(S.stamp_of(F.concat(F.lit("state_backup_"), "stamp", F.lit(".json"))), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
        S.iso(F.col("ts")).alias("iso"),
        S.gigabytes(F.col("event_id") * F.lit(1000000.0)).alias("gb"),
        S.pretty_size(F.col("event_id")).alias("pretty"),
    )


@query(
    "q_latest_partition",
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS "partition" FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def q_latest_partition(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.to_date("ts").alias("partition"))
    return latest_partition(events).select("event_id", shown("partition"))


_FIVE = "[" + ", ".join(f"'{e}'" for e in list(ENTITIES)[:5]) + "]"


@query(
    "q_state_all",
    f"""
WITH log AS (
  SELECT event_id seq, ({_FIVE})[list_position(['view', 'signup', 'click', 'error', 'purchase'], event_type)] entity,
         'f' || user_id AS "file", floor(value)::BIGINT n_rows, value > 300 AS over, value < 100 AS started FROM events),
ends AS (SELECT entity, "file", arg_max(n_rows, seq) n FROM log WHERE NOT started GROUP BY 1, 2),
s AS (SELECT entity, count(*) FILTER (NOT started) n_reports, bool_or(started) AS any_started, arg_max("file", seq) FILTER (started) last_file FROM log GROUP BY 1)
SELECT o.entity, CASE WHEN any_started THEN 'in_progress' ELSE 'not_started' END status, last_file,
       (SELECT count(*) FROM ends e WHERE e.entity = o.entity) n_files, coalesce(n_reports, 0) n_reports,
       coalesce((SELECT CAST(sum(n) AS BIGINT) FROM ends e WHERE e.entity = o.entity), 0) n_rows
FROM (SELECT unnest([{_ENTITY_LIST}]) entity) o LEFT JOIN s ON o.entity = s.entity""",
)
def q_state_all(spark, sf):
    """All nine entities, of which five have events: the others are in their initial state."""
    kinds = F.array(*[F.lit(k) for k in ("view", "signup", "click", "error", "purchase")])
    names = F.array(*[F.lit(e) for e in list(ENTITIES)[:5]])
    log = _log(spark, sf).withColumns(
        {
            "entity": F.get(names, F.array_position(kinds, F.col("message")).cast("int") - 1),
            "file": F.regexp_extract("file", "^[^-]+", 0),
        }
    )
    values = load(spark, sf, "events").select(F.col("event_id").alias("seq"), "value")
    what = F.when(F.col("value") < 100, "in_progress").otherwise("done")
    return M.overview(log.join(values, "seq").withColumn("event", what).drop("value")).drop("last_updated")


@query(
    "q_done_flags",
    _LOG
    + _PER_ENTITY
    + """
SELECT l.entity, l."file", count(*) FILTER (live."event" = 'done') > 0 file_done, coalesce(bool_or(s.status = 'completed'), FALSE) entity_done
FROM (SELECT DISTINCT entity, "file" FROM log) l LEFT JOIN live ON l.entity = live.entity AND l."file" = live."file"
LEFT JOIN s ON l.entity = s.entity GROUP BY 1, 2""",
)
def q_done_flags(spark, sf):
    """Whether each file, and its entity, is done."""
    log = _log(spark, sf)
    return M.done(log.select("entity", "file").distinct(), log)


@query(
    "q_progress",
    _LOG
    + """
, w AS (
  SELECT entity, time_bucket(INTERVAL 300 SECOND, "at", TIMESTAMP '1970-01-01') since, count(*) n_files,
         CAST(coalesce(sum(n_rows) FILTER ("event" = 'done'), 0) AS BIGINT) n_rows
  FROM log WHERE "event" IN ('done', 'failed') GROUP BY 1, 2)
SELECT entity, strftime(since, '%Y-%m-%d %H:%M:%S') since, n_files, n_rows, CAST(0 AS BIGINT) n_bad, ROUND(n_rows / 300.0, 4) rows_per_second,
       CAST(sum(n_files) OVER b AS BIGINT) all_files, CAST(sum(n_rows) OVER b AS BIGINT) all_rows
FROM w WINDOW b AS (PARTITION BY entity ORDER BY since)""",
)
def q_progress(spark, sf):
    """Files and rows per five minutes, and up to then."""
    told = M.progress(_log(spark, sf))
    return told.withColumns({"since": F.date_format("since", "yyyy-MM-dd HH:mm:ss"), "rows_per_second": F.round("rows_per_second", 4)})


@query(
    "q_run_report",
    _LOG
    + _PER_ENTITY
    + """
, t AS (SELECT 'events' "name", (SELECT count(*) FROM events) n UNION ALL SELECT 'orders', (SELECT count(*) FROM orders)),
e AS (SELECT * FROM log WHERE "event" IN ('error', 'failed') ORDER BY "at" DESC, seq DESC LIMIT 100),
now_ AS (SELECT entity, "file", arg_max("event", seq) AS "event" FROM live GROUP BY 1, 2),
m AS (SELECT "file" FROM now_ WHERE "event" IN ('done', 'failed'))
SELECT 'tables' section, "name", unnest(['row_count', 'size']) metric, unnest([n::VARCHAR, NULL]) AS "value" FROM t
UNION ALL SELECT 'state', s.entity, unnest(['status', 'last_file', 'n_files', 'n_rows']), unnest([status, last_file, n_files::VARCHAR, coalesce(n_rows, 0)::VARCHAR])
  FROM s LEFT JOIN d ON s.entity = d.entity
UNION ALL SELECT 'errors', "file", unnest(['entity', 'message']), unnest([entity, CASE WHEN "event" = 'error' THEN 'error' ELSE 'purchase' END]) FROM e
UNION ALL SELECT 'alerts', "file", unnest(['metric', 'value', 'threshold']), unnest(['bad_share', '0.0', '-1.0']) FROM m""",
)
def q_run_report(spark, sf):
    """All sections of the report; the alert's limit is below every share, so each ended file has one."""
    tables = {t: load(spark, sf, t) for t in ("events", "orders")}
    return report.report_rows(report.run_report(_log(spark, sf), tables, {"bad_share": -1.0}))
