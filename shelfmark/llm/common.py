"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text or vectors that a Python worker handles at once.
SLICE_BYTES = 4 << 20
#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 8 << 20
#: Settings of Python workers: large arrays go back to the system when they are freed, so that what one
#: stage needed doesn't stay with the worker while others run.
WORKER = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(2 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes, as rows may be very long, and let Python workers find the package.

    Workers on this machine find it where the driver did; clusters get it by --py-files.
    """
    settings = {**WORKER, "PYTHONPATH": str(Path(__file__).resolve().parents[2])}
    for name, value in settings.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # a grouping above a union must not rely on how both sides were dealt out: that gave wrong rows
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table of ``sf_dir``."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def by_bytes(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words one after another, bounds of each text's): runs of other than ASCII white space.

    Null texts have none. (Arrow's own split at white space reads beyond the end of its input.)
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    for blank in "\t\n\x0b\x0c\r":
        if pc.any(pc.match_substring(texts, blank)).as_py():
            texts = pc.replace_substring(texts, blank, " ")
    pieces = pc.split_pattern(texts, " ")
    bounds = pieces.offsets.to_numpy().astype(np.int64)
    flat = pieces.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), offsets(real.to_numpy(zero_copy_only=False))[bounds - bounds[0]]


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i]:starts[i] + lens[i]]`` one after another."""
    total = int(lens.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(lens)
    index = np.repeat(starts - (ends - lens), lens)
    index += np.arange(total, dtype=index.dtype)
    return flat[index]


def offsets(lens: np.ndarray) -> np.ndarray:
    """Prefix sums with a leading zero."""
    out = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    return out


def decimals(numbers: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[bytes, list[int]]:
    """(decimal spelling of all ``numbers``, where each run between ``bounds`` starts in it).

    Each number is followed by its character of ``ends`` (uint8; 0 for none).
    """
    if not len(numbers):
        return b"", [0] * len(bounds)
    top = int(numbers.max()) + 1
    width = len(str(top))
    spelled = np.zeros((len(numbers), width + 1), np.uint8)
    table = np.array([str(n) for n in range(top)], f"S{width}").view(np.uint8).reshape(top, width) if top < 1 << 17 else None
    if table is None:
        table, numbers = np.array([str(n) for n in numbers.tolist()], f"S{width}").view(np.uint8).reshape(len(numbers), width), np.arange(len(numbers))
    spelled[:, :width] = table[numbers]
    lens = np.count_nonzero(table, axis=1)[numbers]
    spelled[np.arange(len(numbers)), lens] = ends
    starts = offsets(lens + (ends > 0))[bounds]
    return spelled[spelled > 0].tobytes(), starts.tolist()
