"""Token ids of documents as Arrow files of equal-length sequences with masks.

A data set is a folder of shards, each for a range of document ids in ascending order:

- ``shard-00000.arrow``: Arrow file format, each record batch ``BATCH_ROWS`` rows of two
  fixed-size lists, ``ids`` and ``mask`` (true for an id, false for padding). The documents of the
  shard run on through its sequences; only the last sequence is padded. As every list has the same
  length and nothing is compressed, row r of batch b is found by arithmetic in a memory map.
- ``shard-00000.docs.arrow``: one row per document with its first position in the shard and its
  number of ids.
- ``manifest``: a Parquet table with one row per shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.llm.common import slices, width
from riskflow.llm.tokens import encoder

BATCH_ROWS = 256
MANIFEST = "shard int, documents long, ids long, sequence_length int"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


@dataclass(frozen=True)
class Shard:
    """Names of a shard's files; ``folder`` is a path or URI that Arrow's file systems open."""

    folder: str
    number: int

    def _place(self, suffix: str):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.folder)
        return system, f"{root}/shard-{self.number:05d}{suffix}"

    def _open(self, suffix: str) -> pa.RecordBatchFileReader:
        from pyarrow import fs

        system, path = self._place(suffix)
        local = isinstance(system, fs.LocalFileSystem)
        return pa.ipc.open_file(pa.memory_map(path) if local else system.open_input_file(path))

    def sequences(self) -> pa.RecordBatchFileReader:
        return self._open(".arrow")

    def documents(self) -> pa.Table:
        return self._open(".docs.arrow").read_all()

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence; the ids are a view of the file's memory."""
        batch = self.sequences().get_batch(row // BATCH_ROWS)
        ids, mask = (batch.column(c)[row % BATCH_ROWS].values for c in ("ids", "mask"))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def write(self, suffix: str, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> None:
        """Write under a name of this attempt, then rename: a reader never meets half a file."""
        system, path = self._place(suffix)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        draft = f"{path}.{TaskContext.get().taskAttemptId()}"
        with system.open_output_stream(draft) as out, pa.ipc.new_file(out, schema) as writer:
            for batch in batches:
                writer.write_batch(batch)
        if system.get_file_info(path).type.name != "NotFound":
            system.delete_file(path)  # of an earlier attempt, with the same content
        system.move(draft, path)


def _sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length)),
    ])


def _sequence_batch(schema: pa.Schema, ids: np.ndarray, length: int) -> pa.RecordBatch:
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, dtype=ids.dtype)
    padded[:len(ids)] = ids
    lists = (pa.FixedSizeListArray.from_arrays(pa.array(x), length)
             for x in (padded, np.arange(rows * length) < len(ids)))
    return pa.RecordBatch.from_arrays(list(lists), schema=schema)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id",
    text_col: str = "text", sequence_length: int = 2048, shards: int | None = None,
) -> DataFrame:
    """Encode whole texts, end each with ``end_id``, write them in ascending id order.

    Returns the manifest: a row per shard. A null text counts as empty (its only id is the end); a
    null id comes first; repeated rows are kept, each a document of its own; an empty table gives
    an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    # The ranges cut through an id with very many rows, by its texts and then by row.
    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("key"), F.asc_nulls_first("row")]
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(text_col).alias("key"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(shards or width(spark), *order)
        .sortWithinPartitions(*order).select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        shard = Shard(folder, TaskContext.get().partitionId())
        schema = _sequence_schema(words.dtype, sequence_length)
        end = np.array([end_id], dtype=words.dtype)
        doc_rows: list[pa.RecordBatch] = []
        block = BATCH_ROWS * sequence_length
        total = 0

        def sequences() -> Iterator[pa.RecordBatch]:
            nonlocal total
            held: list[np.ndarray] = []
            size = 0
            for batch in slices(batches, "text"):
                ids, offsets = words.encode(batch.column("text"))
                counts = np.diff(offsets) + 1
                ids = np.insert(ids, offsets[1:], end)
                doc_rows.append(pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(total + np.cumsum(counts) - counts),
                     pa.array(counts)], schema=DOCS,
                ))
                total += len(ids)
                held.append(ids)
                size += len(ids)
                if size >= block:
                    ready = np.concatenate(held)
                    for at in range(0, size - size % block, block):
                        yield _sequence_batch(schema, ready[at:at + block], sequence_length)
                    held, size = [ready[size - size % block:]], size % block
            if size:
                yield _sequence_batch(schema, np.concatenate(held), sequence_length)

        shard.write(".arrow", schema, sequences())
        shard.write(".docs.arrow", DOCS, iter(doc_rows))
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard.number], pa.int32()),
            "documents": [sum(b.num_rows for b in doc_rows)], "ids": [total],
            "sequence_length": pa.array([sequence_length], pa.int32()),
        })

    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a data set from its files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; ids_crc32 is over its ids as little-endian
    32-bit integers. One task reads one shard, a batch of sequences at a time.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").where("ids > 0")
    # One row per shard, so the running total over all of them is a small job.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    jobs = manifest.select(
        "shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")
    ).repartitionByRange(width(spark), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from _shard_documents(Shard(folder, number), base)

    return jobs.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _shard_documents(shard: Shard, base: int) -> Iterator[pa.RecordBatch]:
    docs = shard.documents()
    reader = shard.sequences()
    stops = np.cumsum(docs["n_tokens"].to_numpy())
    crcs = np.zeros(len(stops), dtype=np.int64)
    doc, at, crc = 0, 0, 0
    for b in range(reader.num_record_batches):
        batch = reader.get_batch(b)
        ids = batch.column("ids").flatten().to_numpy()
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        wide = ids[mask].astype("<u4")
        until = at + len(wide)
        while doc < len(stops) and stops[doc] <= until:
            crcs[doc] = zlib.crc32(wide[max(at, _first(stops, doc)) - at:stops[doc] - at], crc)
            doc, crc = doc + 1, 0
        if doc < len(stops):
            crc = zlib.crc32(wide[max(at, _first(stops, doc)) - at:], crc)
        at = until
    yield pa.RecordBatch.from_arrays(
        [docs["doc_id"].combine_chunks(), pa.array(base + docs["start"].to_numpy()),
         docs["n_tokens"].combine_chunks(), pa.array(crcs)],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def _first(stops: np.ndarray, doc: int) -> int:
    return int(stops[doc - 1]) if doc else 0
