"""Token ids as flat unsigned integer files with 64-bit document offsets.

A folder holds, for each partition ``p`` of the documents in ascending id order,

``p.ids``   the ids of its documents, one after another, unsigned 16 or 32-bit little-endian
``p.off``   unsigned 64-bit starts of its documents in ``p.ids``, and the end of the last
``p.key``   signed 64-bit document ids
``p.nul``   one byte a document: 1 if its id is null (such documents come first)

and ``manifest``, a Parquet table with one row a partition: ``base``, the ids in all partitions
before it, comes from prefix sums. All files can be memory-mapped.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import by_bytes
from shelfmark.llm.library import library_encoder

#: Documents that one batch of a read holds.
READ_DOCS = 2_000
_PARTS = {"off": "<u8", "key": "<i8", "nul": "u1"}


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _put(store: fs.FileSystem, path: str, data: bytes) -> None:
    """Write under a name of this attempt's own, then rename: readers see whole files only."""
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(data)
    store.move(own, path)


def _map(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return np.frombuffer(f.read_buffer(), kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def write(
    docs: DataFrame, out: str, tokenizer: str, end_id: int, width: int = 4,
    id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None,
) -> DataFrame:
    """Tokenize ``docs``, append ``end_id`` to each, write the folder ``out``; its manifest.

    ``width`` is 2 or 4 bytes an id; an id that doesn't fit fails the write. Null and empty texts
    have the end id alone. Documents of one id stand beside each other, ordered by their texts;
    repeated rows stay. Columns other than the two named are not read. A retried task writes the
    same files again.
    """
    spark = docs.sparkSession
    store, root = _place(out)
    store.create_dir(root, recursive=True)
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = library_encoder(tokenizer), TaskContext.get().partitionId()
        store, root = _place(out)
        name = f"{root}/{part:06d}"
        own = f"{name}.ids.{uuid.uuid4().hex}"
        at, keys, nulls, ends = 0, [], [], [np.zeros(1, np.int64)]
        with store.open_output_stream(own) as f:
            for batch in by_bytes(batches, "t"):
                ids, bounds = encoder.texts(batch.column("t"))
                ids = np.insert(ids, bounds[1:], end_id)
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"id {ids.max()} needs more than {width} bytes")
                f.write(ids.astype(kind).tobytes())
                keys.append(batch.column("i").fill_null(0).to_numpy(zero_copy_only=False))
                nulls.append(batch.column("i").is_null().to_numpy(zero_copy_only=False))
                ends.append(at + bounds[1:] + np.arange(1, len(bounds)))
                at = int(ends[-1][-1])
        if not keys:
            store.delete_file(own)
            return
        store.move(own, f"{name}.ids")
        for end, data in (("off", ends), ("key", keys), ("nul", nulls)):
            _put(store, f"{name}.{end}", np.concatenate(data).astype(_PARTS[end]).tobytes())
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "n_docs": sum(map(len, keys)), "n_tokens": at}],
            schema=pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
        )

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = docs.select(docs[id_col].cast("long").alias("i"), docs[text_col].alias("t"))
    order = ["i", F.xxhash64("t"), "t"]
    counts = wanted.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order)
    counts.mapInArrow(run, "part int, n_docs long, n_tokens long").write.mode("overwrite").parquet(f"{out}/counts")
    # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{out}/counts").select(
        "part", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), F.lit(width).alias("width")
    )
    manifest.write.mode("overwrite").parquet(f"{out}/manifest")
    return spark.read.parquet(f"{out}/manifest")


def read(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files alone, in parallel."""
    return _scan(spark, out, "ids array<long>", lambda runs: pa.array([r.astype(np.int64) for r in runs], pa.list_(pa.int64())))


def checksums(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it; the checksum is of the ids as
    little-endian unsigned 32-bit integers.
    """
    return _scan(
        spark, out, "ids_crc32 long",
        lambda runs: pa.array([zlib.crc32(r.astype("<u4").tobytes()) for r in runs], pa.int64()),
    )


def _scan(spark: SparkSession, out: str, column: str, make) -> DataFrame:
    name = column.split(" ")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(out)
        for row in (r for b in batches for r in b.to_pylist()):
            path = f"{root}/{row['part']:06d}"
            ids = _map(store, f"{path}.ids", f"<u{row['width']}")
            off, key, nul = (_map(store, f"{path}.{end}", kind) for end, kind in _PARTS.items())
            off = off.astype(np.int64)
            for a in range(0, row["n_docs"], READ_DOCS):
                b = min(a + READ_DOCS, row["n_docs"])
                cuts = off[a : b + 1].tolist()
                runs = [ids[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[a:b], pa.int64(), mask=nul[a:b].astype(bool)),
                        pa.array(row["base"] + off[a:b]),
                        pa.array(np.diff(off[a : b + 1])),
                        make(runs),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    manifest = spark.read.parquet(f"{out}/manifest")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "part").mapInArrow(run, f"doc_id long, start long, n_tokens long, {column}")
