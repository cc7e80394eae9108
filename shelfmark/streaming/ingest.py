"""Snapshot files to published tables, as a stream of files."""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from shelfmark.operators import manifest
from shelfmark.operators.parse import OK, parse_lines
from shelfmark.operators.publish import publish, remove, replaced_name
from shelfmark.operators.quality import error_budget
from shelfmark.operators.shred import bad_values, cut_all, shape
from shelfmark.plans.catalog import MAX_ERRORS, entity as find_entity
from shelfmark.session import prepare, spread
from shelfmark.sources.snapshot import stream_lines

FILES_PER_TRIGGER = 1000


def ingest_batch(
    spark: SparkSession,
    lines: DataFrame,
    entity: str,
    root: str,
    batch: int,
    mode: str = "lenient",
    max_errors: int = MAX_ERRORS,
    replace_children: bool = False,
) -> list[str]:
    """Load the files of one batch: parse once, judge each file, cut all tables, publish.

    The typed records are stored before anything is cut from them, so each line is parsed
    once; they are removed when the tables are published. Files over their error budget are left
    out as a whole: they are returned. Everything written carries the batch number, so running a
    batch again replaces what a failed run left behind. With ``replace_children`` the batch marks its
    records as replaced, so that list rows of earlier versions are gone (`resolve`); else
    they stay until a row of the same key comes.
    """
    spec = find_entity(entity)
    stored = f"{root}/_records/{entity}/batch={batch:012d}"
    numbered = lines.withColumn("_row", F.monotonically_increasing_id())
    # numbered before they are dealt out: a few large files, which can't be split, are parsed by all cores
    shape(parse_lines(spread(numbered)), entity, mode, lost=True).write.mode("overwrite").parquet(stored)
    shaped = spark.read.parquet(stored)

    # one row per file, at most maxFilesPerTrigger of them
    verdicts = error_budget(shaped, max_errors).collect()
    failed = [v["_file"] for v in verdicts if not v["ok"]]
    loaded = shaped.where(~F.col("_file").isin(failed)) if failed else shaped
    tables = cut_all(loaded, spec, mode)
    tables[f"quarantine_{entity}"] = tables.pop("quarantine")
    if "quarantine_child" in tables:
        tables[f"quarantine_child_{entity}"] = tables.pop("quarantine_child")
    tables[f"quarantine_value_{entity}"] = bad_values(loaded, entity)
    if replace_children:
        tables[replaced_name(entity)] = loaded.where(F.col("status") == OK).select("id", "_file", "_row")
    publish(spark, root, batch, tables)

    # the manifest follows the data: a file is done once its rows are visible
    now, first = time.time(), next_seq(len(verdicts))
    events = [
        (
            first + i,
            entity,
            v["_file"],
            "done" if v["ok"] else "failed",
            now,
            v["n_records"],
            v["n_malformed"],
            v["n_rejected"],
        )
        for i, v in enumerate(sorted(verdicts, key=lambda v: v["_file"]))
    ]
    if events:
        made = spark.createDataFrame(
            events,
            "seq bigint, entity string, file string, event string, at double, "
            "n_rows bigint, n_malformed bigint, n_rejected bigint",
        ).withColumn("at", F.timestamp_seconds("at"))
        names = [c.split()[0] for c in manifest.SCHEMA.split(", ")]
        made = made.withColumns(
            {
                "partition": F.regexp_extract("file", "updated_date=([^/]+)", 1).try_cast("date"),
                "message": F.when(F.col("event") == "failed", F.lit("too many malformed lines")),
            }
        )
        made.select(*names).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/_manifest/{entity}-{batch:012d}"
        )
    remove(spark, stored)
    return sorted(failed)


_newest_seq = 0


def next_seq(n: int = 1) -> int:
    """The first of ``n`` new event numbers: microseconds, and above all this driver gave before.

    One order holds for all events of all entities, whoever writes them; a batch has far fewer
    files than a write takes microseconds.
    """
    global _newest_seq
    first = max(_newest_seq + 1, time.time_ns() // 1000)
    _newest_seq = first + n - 1
    return first


def manifest_of(spark: SparkSession, root: str) -> DataFrame:
    """The event log that the ingestion below ``root`` has written: its checkpoint, and what came after it."""
    log = spark.read.schema(manifest.SCHEMA).option("recursiveFileLookup", "true").parquet(f"{root}/_manifest")
    newest = newest_checkpoint(spark, root)
    if newest is None:
        return log
    own = F.col("_metadata.file_path").contains(f"/{CHECKPOINT}={newest:020d}/")
    return log.where(own | (F.col("seq") > newest))


CHECKPOINT = "checkpoint"


def newest_checkpoint(spark: SparkSession, root: str) -> int | None:
    """The last event that the newest whole checkpoint of the log covers."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifest")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{CHECKPOINT}=*/_SUCCESS"))
    return max((int(s.getPath().getParent().getName().split("=")[1]) for s in done or []), default=None)


def ingest_stream(
    spark: SparkSession,
    path: str,
    entity: str,
    root: str,
    checkpoint: str,
    mode: str = "lenient",
    max_errors: int = MAX_ERRORS,
    files_per_trigger: int = FILES_PER_TRIGGER,
    replace_children: bool = False,
) -> StreamingQuery:
    """Load every file below ``path`` that was not loaded before, then stop.

    The checkpoint remembers the files; batches are numbered by the stream and replayed under
    the same number after a failure. Keep one checkpoint per entity and root.
    """
    find_entity(entity)
    prepare(spark)

    def load(lines: DataFrame, batch: int) -> None:
        ingest_batch(lines.sparkSession, lines, entity, root, batch, mode, max_errors, replace_children)

    return (
        stream_lines(spark, path, files_per_trigger)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class Progress(StreamingQueryListener):
    """Keeps (batch, input rows, rows per second) of the last batches of the running streams."""

    def __init__(self, kept: int = 10_000):
        self.rows: deque[tuple[int, int, float]] = deque(maxlen=kept)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.rows.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
