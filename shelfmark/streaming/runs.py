"""Whole runs: every entity of a snapshot, and the flat CSV route."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import manifest
from shelfmark.operators.flatten import bulk_append, flatten, write_csv
from shelfmark.functions.scalars import partition_date
from shelfmark.operators.parse import parse_lines, records
from shelfmark.operators.publish import fold_list, next_batch, path_exists, remove
from shelfmark.plans.catalog import ENTITIES, MAX_ERRORS
from shelfmark.session import prepare, stored
from shelfmark.sources.files import scan_csv
from shelfmark.sources.snapshot import list_files, literal, scan_lines
from shelfmark.streaming.ingest import (
    CHECKPOINT,
    FILES_PER_TRIGGER,
    ingest_batch,
    manifest_of,
    newest_checkpoint,
    next_seq,
)

_LOG = logging.getLogger(__name__)


def note(
    spark: SparkSession, root: str, entity: str, what: str, message: str | None = None, files: Sequence[str] = ()
) -> None:
    """Append one event about an entity, or about each of some of its files, to the manifest below ``root``."""
    now = dt.datetime.now(dt.timezone.utc)
    first = next_seq(max(1, len(files)))
    names = [c.split()[0] for c in manifest.SCHEMA.split(", ")]
    rows = []
    for i, file in enumerate(files or [None]):
        values = {"seq": first + i, "entity": entity, "file": file, "event": what, "at": now, "message": message}
        rows.append(tuple(values.get(n) for n in names))
    made = spark.createDataFrame(rows, manifest.SCHEMA)
    made = made.withColumn("partition", F.coalesce("partition", partition_date(F.col("file"))))
    made.coalesce(1).write.mode("append").parquet(f"{root}/_manifest/{entity}-events")


def log_of(spark: SparkSession, root: str) -> DataFrame:
    """The manifest below ``root``, empty before the first run."""
    return manifest_of(spark, root) if path_exists(spark, f"{root}/_manifest") else manifest.empty(spark)


def checkpoint(spark: SparkSession, root: str) -> int | None:
    """Write the folded log as a numbered checkpoint and delete the files it covers; the last event in it.

    The list of published batches is folded too, so that the number of files below ``_manifest`` and
    ``_batches`` does not grow with the batches between two calls. Readers use the newest whole checkpoint
    and the events after it, so a call that fails halfway changes nothing for them, and events that are
    appended meanwhile stay.
    """
    if not path_exists(spark, f"{root}/_manifest"):
        return None
    log = manifest_of(spark, root)
    files, former = log.inputFiles(), newest_checkpoint(spark, root)
    last = log.select(F.max("seq")).scalar()
    newest = spark.range(1).select(last).first()[0]
    if newest is None or newest == former:
        return former
    rows = manifest.folded(log.where(F.col("seq") <= newest))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest/{CHECKPOINT}={newest:020d}")
    covered = spark.read.schema(manifest.SCHEMA).parquet(*[literal(unquote(f)) for f in files])
    per_file = covered.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max("seq").alias("last"))
    for r in per_file.where(F.col("last") <= newest).collect():  # files since the last checkpoint
        remove(spark, unquote(r.file))
    if path_exists(spark, f"{root}/_batches"):
        fold_list(spark, root)
    return newest


def run_entities(
    spark: SparkSession,
    snapshot: str,
    root: str,
    entities: tuple[str, ...] = tuple(ENTITIES),
    mode: str = "lenient",
    files_per_batch: int = FILES_PER_TRIGGER,
    max_errors: int = MAX_ERRORS,
    replace_children: bool = False,
) -> DataFrame:
    """Load the entity folders of a snapshot as the manifest says, and return the state afterwards.

    The run starts with the first entity that is not completed; if all are, with the first one
    (`manifest.resume`). Of an entity the listed files that are not finished are loaded, oldest
    partition first, and each is noted as started before and as done or failed after its batch. So
    a file that failed, was added or belongs to an entity that was reset is read by the next run,
    and one that is done is not. An entity is completed if no file of it failed; one that fails
    is noted and does not keep the others from being loaded. ``replace_children``: see `ingest_batch`.
    """
    prepare(spark)
    order = [r.entity for r in manifest.resume(log_of(spark, root), entities).orderBy("place").collect()]
    for entity in order:
        folder = f"{snapshot}/{entity}"
        if not path_exists(spark, folder):
            continue
        try:
            failed = []
            new = manifest.new_files(list_files(spark, folder, entity), log_of(spark, root))
            # names of files: what one run has to load
            files = [r.file for r in new.orderBy("partition", "file").select("file").collect()]
            for at in range(0, len(files), files_per_batch):
                part = files[at : at + files_per_batch]
                note(spark, root, entity, "in_progress", files=part)
                lines = scan_lines(spark, folder, files=part).drop("_row")
                failed += ingest_batch(spark, lines, entity, root, next_batch(spark, root), mode, max_errors, replace_children)
                _note_empty(spark, root, entity, part)
            if not failed:
                note(spark, root, entity, "entity_done")
        except Exception as problem:  # noqa: BLE001
            _LOG.exception("loading %s failed", entity)
            note(spark, root, entity, "error", str(problem))
    return manifest.summary(log_of(spark, root))


def _note_empty(spark: SparkSession, root: str, entity: str, files: Sequence[str]) -> None:
    """Files without a line give no verdict; they are done."""
    state = manifest.state(log_of(spark, root)).where((F.col("entity") == entity) & (F.col("event") == "in_progress"))
    open_ = {r.file for r in state.select("file").collect()} & set(files)
    if open_:
        note(spark, root, entity, "done", files=sorted(open_))


def flat_load(
    spark: SparkSession, path: str, csv_path: str, table_path: str, ddl: str, opaque: tuple[str, ...] = ()
) -> DataFrame:
    """The flat route: JSON Lines to flat CSV files to a typed table, by column name.

    Returns the appended rows as read back from the CSV files.
    """
    prepare(spark)
    # read twice: for the schema and for the rows; of clashing names the later key wins
    read = stored(records(parse_lines(scan_lines(spark, path), keep_lines=True), text="line"), "flat")
    flat = flatten(read, text="line", opaque=opaque)
    write_csv(flat.drop("_partition", "_file", "_row"), csv_path)
    rows = scan_csv(spark, csv_path, ddl)
    bulk_append(rows, table_path)
    return rows

