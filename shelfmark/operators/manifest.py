"""Ingestion state as an append-only log of events; every view of it is a fold.

Event columns: ``seq`` (total order), ``entity``, ``partition``, ``file``, ``event`` (one of
in_progress, done, failed, entity_done, reset, error), ``at``, ``n_rows``, ``n_malformed``,
``n_rejected`` and ``message``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.scalars import stamp_of
from shelfmark.plans.catalog import ENTITIES

EVENTS = ("in_progress", "done", "failed", "entity_done", "reset", "error")
SCHEMA = (
    "seq bigint, entity string, partition date, file string, event string, at timestamp, "
    "n_rows bigint, n_malformed bigint, n_rejected bigint, message string"
)

# Status names, and how many errors and snapshots are kept for how long.
NOT_STARTED, IN_PROGRESS, COMPLETED = "not_started", "in_progress", "completed"
KEPT_ERRORS = 100
KEPT_SNAPSHOTS = 10
KEPT_DAYS = 30


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def event(spark: SparkSession, seq: int, entity: str, what: str, at, **rest) -> DataFrame:
    """One event row, to be appended to the log."""
    if what not in EVENTS:
        raise ValueError(f"unknown event {what!r}")
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    values = {"seq": seq, "entity": entity, "event": what, "at": at, **rest}
    return spark.createDataFrame([tuple(values.get(n) for n in names)], SCHEMA)


def since_reset(log: DataFrame) -> DataFrame:
    """Events after the last reset of their entity.

    The right-hand side has one row per entity ever reset; adaptive execution sees its size
    and sends it to the log instead of moving the log.
    """
    resets = (
        log.where(F.col("event") == "reset")
        .groupBy("entity")
        .agg(F.max("seq").alias("_reset"))
    )
    return (
        log.join(resets, "entity", "left")
        .where(F.col("_reset").isNull() | (F.col("seq") > F.col("_reset")))
        .drop("_reset")
    )


def completed_files(log: DataFrame) -> DataFrame:
    """(entity, file) once per finished file, however often it was reported."""
    return since_reset(log).where(F.col("event") == "done").select("entity", "file").distinct()


def new_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files that are not finished yet."""
    return files.join(completed_files(log), ["entity", "file"], "left_anti")


def summary(log: DataFrame) -> DataFrame:
    """Per entity: status, last file started, finished files, finish reports, rows, last change.

    Two shuffles of partial aggregates: per file, then per entity.
    """
    live = since_reset(log)
    is_done = F.col("event") == "done"
    sets_status = F.col("event").isin("in_progress", "entity_done")
    status = F.when(F.col("event") == "entity_done", COMPLETED).otherwise(IN_PROGRESS)
    per_file = live.groupBy("entity", "file").agg(
        F.max(F.when(sets_status, F.struct("seq", status.alias("status")))).alias("status"),
        F.max(F.when(F.col("event") == "in_progress", F.col("seq"))).alias("started"),
        F.count_if(is_done).alias("n_reports"),
        F.coalesce(F.max_by(F.when(is_done, F.col("n_rows")), F.when(is_done, F.col("seq"))), F.lit(0)).alias("n_rows"),
        F.max("at").alias("at"),
    )
    finished = F.col("n_reports") > 0
    return (
        per_file.groupBy("entity")
        .agg(
            F.max("status").alias("status"),
            F.max(F.when(F.col("started").isNotNull(), F.struct("started", "file"))).alias("last"),
            F.count_if(finished).alias("n_files"),
            F.sum("n_reports").alias("n_reports"),
            F.sum(F.when(finished, F.col("n_rows")).otherwise(0)).alias("n_rows"),
            F.max("at").alias("last_updated"),
        )
        .select(
            "entity",
            F.coalesce("status.status", F.lit(NOT_STARTED)).alias("status"),
            F.col("last.file").alias("last_file"),
            "n_files",
            "n_reports",
            "n_rows",
            "last_updated",
        )
    )


def overview(log: DataFrame, order: Sequence[str] = tuple(ENTITIES)) -> DataFrame:
    """:func:`summary` of every entity in ``order``; those without an event are in their initial state."""
    places = log.sparkSession.createDataFrame([(e,) for e in order], "entity string")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_files", "n_reports", "n_rows")}
    known = places.join(summary(log), "entity", "left").withColumns(zero)
    return known.withColumn("status", F.coalesce("status", F.lit(NOT_STARTED)))


def progress(log: DataFrame, seconds: int = 300) -> DataFrame:
    """What each entity finished in each stretch of ``seconds``, and all it had finished by its end.

    (entity, since, n_files, n_rows, n_bad, rows_per_second, all_files, all_rows): files that were done or
    failed, rows of the done ones, lines refused. Events before a reset count, as their work was done.
    Stretches in which nothing ended have no row. Events are added up per stretch before the running sums.
    """
    ended = log.where(F.col("event").isin("done", "failed") & F.col("at").isNotNull())
    since = F.window("at", f"{seconds} seconds")["start"].alias("since")
    rows = F.when(F.col("event") == "done", F.col("n_rows"))
    bad = F.coalesce("n_malformed", F.lit(0)) + F.coalesce("n_rejected", F.lit(0))
    per = ended.groupBy("entity", since).agg(
        F.count("*").alias("n_files"), F.coalesce(F.sum(rows), F.lit(0)).alias("n_rows"), F.sum(bad).alias("n_bad")
    )
    before = Window.partitionBy("entity").orderBy("since")
    return per.withColumns(
        {
            "rows_per_second": F.col("n_rows") / F.lit(float(seconds)),
            "all_files": F.sum("n_files").over(before),
            "all_rows": F.sum("n_rows").over(before),
        }
    )


def state(log: DataFrame) -> DataFrame:
    """The newest event of every (entity, file) since the last reset."""
    live = since_reset(log)
    rest = [c for c in live.columns if c not in ("entity", "file", "seq")]
    newest = live.groupBy("entity", "file").agg(
        F.max_by(F.struct(*rest), "seq").alias("_event"), F.max("seq").alias("seq")
    )
    return newest.select("entity", "file", "seq", "_event.*")


def folded(log: DataFrame, kept_errors: int = KEPT_ERRORS) -> DataFrame:
    """The events that every view of the log still needs.

    Left out are events before the last reset of their entity (the reset itself stays), starts of a file
    and ends of an entity that came again, and errors beyond the newest ``kept_errors`` unless they are
    the last word on their file. What is left grows with the files, not with the runs.
    """
    is_error = F.col("event").isin("failed", "error")
    again = is_error | F.col("event").isin("in_progress", "entity_done")
    live = since_reset(log).where(F.col("event") != "reset")
    live = live.withColumn("_newest", F.max("seq").over(Window.partitionBy("entity", "file")))
    live = live.withColumn("_of_kind", F.max("seq").over(Window.partitionBy("entity", "file", "event")))
    last_word = F.col("seq") == F.col("_newest")
    kept = live.where(last_word | ~again | (~is_error & (F.col("seq") == F.col("_of_kind")))).select(*log.columns)
    errors = log.where(is_error).orderBy(F.desc("at"), F.desc("seq")).limit(kept_errors)
    resets = log.where(F.col("event") == "reset").withColumn("_newest", F.max("seq").over(Window.partitionBy("entity"))).where(last_word)
    return kept.unionByName(errors).unionByName(resets.select(*log.columns)).dropDuplicates(["seq"])


def resume(log: DataFrame, order: Sequence[str] = tuple(ENTITIES)) -> DataFrame:
    """Entities still to be run: the first in ``order`` that is not completed, and all after it.

    When all are completed the run starts over with the first one.
    """
    spark = log.sparkSession
    places = spark.createDataFrame(list(enumerate(order)), "place int, entity string")
    status = summary(log).select("entity", "status")
    placed = places.join(status, "entity", "left").select(
        "place", "entity", F.coalesce("status", F.lit(NOT_STARTED)).alias("status")
    )
    # ``order`` is a fixed, short list, so all of it fits in one row
    listed = placed.agg(
        F.array_sort(F.collect_list(F.struct("place", "entity", "status"))).alias("all"),
        F.coalesce(
            F.min(F.when(F.col("status") != COMPLETED, F.col("place"))), F.lit(0)
        ).alias("start"),
    )
    return listed.select(F.inline(F.filter("all", lambda e: e["place"] >= F.col("start"))))


def done(files: DataFrame, log: DataFrame) -> DataFrame:
    """``files`` (entity, file, and more) with ``file_done`` and ``entity_done``: all asked at once."""
    finished = completed_files(log).withColumn("file_done", F.lit(True))
    whole = summary(log).select("entity", (F.col("status") == COMPLETED).alias("entity_done"))
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("file_done", "entity_done")}
    return files.join(finished, ["entity", "file"], "left").join(whole, "entity", "left").withColumns(flags)


def is_file_done(log: DataFrame, entity: str, file: str) -> bool:
    found = completed_files(log).where((F.col("entity") == entity) & (F.col("file") == file))
    return not found.isEmpty()


def is_entity_done(log: DataFrame, entity: str) -> bool:
    found = summary(log).where((F.col("entity") == entity) & (F.col("status") == COMPLETED))
    return not found.isEmpty()


def tail_errors(errors: DataFrame, n: int = KEPT_ERRORS, at: str = "at", tie: str = "seq") -> DataFrame:
    """The newest ``n`` errors."""
    return errors.orderBy(F.desc(at), F.desc(tie)).limit(n)


def retain_newest(snapshots: DataFrame, n: int = KEPT_SNAPSHOTS, name: str = "name") -> DataFrame:
    """The newest ``n`` snapshots by name order (names carry their time stamp)."""
    return snapshots.orderBy(F.desc(name)).limit(n)


def expired(snapshots: DataFrame, now, days: int = KEPT_DAYS, name: str = "name") -> DataFrame:
    """Snapshots more than ``days`` whole days old; names without a valid stamp are kept."""
    moment = stamp_of(F.col(name))
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp(moment)) / 86400)
    return snapshots.where(age > days)
