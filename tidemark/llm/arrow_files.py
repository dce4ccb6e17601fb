"""Token ids as Arrow files of equal-length sequences.

Documents are cut into ranges of their ids. Each range becomes one file in Arrow's file format: batches of a
fixed number of rows, each row a sequence of ``length`` ids in a fixed-size list beside two masks of the same
length, one for ids that are no padding and one for the last id of a document, and the ids of the documents that
end in it. Nothing is compressed, so a reader that maps the file gets any sequence as a view of the mapped bytes.
A document may run over several sequences; only the last sequence of a file is padded.

A task writes under a name of its own and returns it as a row. Names in the written manifest are those of tasks
that succeeded, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, stored
from tidemark.llm.textbytes import in_chunks, text_bytes
from tidemark.llm.tokens import piece_tokenizer
from tidemark.session import scratch_path
from tidemark.sources.archives import open_filesystem

LENGTH = 2048
ROWS_PER_BATCH = 256
TASK_BYTES = 8 << 20


def file_schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema(
        [
            ("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("ends", pa.list_(pa.bool_(), length)),
            ("documents", pa.list_(pa.int64())),
        ]
    )


class SequenceWriter:
    """Takes documents in turn and writes full batches of sequences."""

    def __init__(self, path: str, length: int, wide: bool):
        filesystem, name = open_filesystem(path)
        self.schema, self.length = file_schema(length, wide), length
        self.stream = filesystem.open_output_stream(name)
        self.out = pa.ipc.new_file(self.stream, self.schema)
        self.kind = np.uint32 if wide else np.uint16
        self.ids: list[np.ndarray] = []
        self.last: list[np.ndarray] = []
        self.held = self.tokens = self.sequences = 0
        self.documents: list[int | None] = []

    def add(self, ids: np.ndarray, starts: np.ndarray, documents: list[int | None]) -> None:
        most = np.iinfo(self.kind).max
        if len(ids) and ids.max() > most:
            raise ValueError(f"id {ids.max()} is over {most}; write with wide=True")
        last = np.zeros(len(ids), dtype=bool)
        last[starts[1:] - 1] = True
        self.ids.append(ids.astype(self.kind))
        self.last.append(last)
        self.documents += documents
        self.held += len(ids)
        self.tokens += len(ids)
        if self.held >= self.length * ROWS_PER_BATCH:
            self._flush(False)

    def _flush(self, closing: bool) -> None:
        ids, last = np.concatenate(self.ids), np.concatenate(self.last)
        step, at, used = self.length * ROWS_PER_BATCH, 0, 0
        while len(ids) - at >= step or (closing and at < len(ids)):
            part, ends = ids[at : at + step], last[at : at + step]
            rows = -(-len(part) // self.length)
            pad = rows * self.length - len(part)
            mask = np.ones(rows * self.length, dtype=bool)
            if pad:
                mask[-pad:] = False
                part, ends = np.pad(part, (0, pad)), np.pad(ends, (0, pad))
            per_row = ends.reshape(rows, self.length).sum(axis=1)
            offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
            documents = pa.array(self.documents[used : used + int(offsets[-1])], pa.int64())
            used += int(offsets[-1])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask, ends)]
            self.out.write_batch(
                pa.RecordBatch.from_arrays([*lists, pa.ListArray.from_arrays(pa.array(offsets), documents)], schema=self.schema)
            )
            self.sequences += rows
            at += step
        self.ids, self.last, self.documents = [ids[at:]], [last[at:]], self.documents[used:]
        self.held = max(0, len(ids) - at)

    def close(self) -> None:
        if self.held:
            self._flush(True)
        self.out.close()
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one file. On a local or mounted disk, arrays are views of mapped memory."""

    def __init__(self, path: str):
        filesystem, name = open_filesystem(path)
        local = isinstance(filesystem, pafs.LocalFileSystem)
        self.source = pa.memory_map(name) if local else filesystem.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)

    def batch(self, number: int) -> pa.RecordBatch:
        return self.reader.get_batch(number)

    def __len__(self) -> int:
        batches = self.reader.num_record_batches
        return (batches - 1) * ROWS_PER_BATCH + self.batch(batches - 1).num_rows if batches else 0

    def __getitem__(self, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of a sequence."""
        batch, inside = self.batch(row // ROWS_PER_BATCH), row % ROWS_PER_BATCH
        return batch.column("ids")[inside].values.to_numpy(), batch.column("mask")[inside].values


def write_sequences(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    *,
    doc: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    length: int = LENGTH,
    wide: bool = False,
    special: bool = False,
) -> DataFrame:
    """Files of the ids of all documents in ascending id order, ``end_id`` behind each, and their manifest.

    Returns a stored row per file: ``part, path, documents, tokens, sequences, first_token`` where
    ``first_token`` counts the ids in the files before. ``wide`` keeps 32-bit ids, for vocabularies over 65,536;
    without it such an id is an error.
    ``special`` gives special marks inside texts their own ids, as the tokenizer does when loaded.

    NULL and empty texts give the end id alone. NULL document ids come first; rows with equal ids stay separate,
    in the order of their texts' hashes. No documents: no files and an empty manifest.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "sequences")
    picked = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = picked.repartitionByRange(F.col("doc").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc").asc_nulls_first(), tie, "text")
    fields = "part int, path string, documents bigint, tokens bigint, sequences bigint"

    def write(batches: Batches) -> Batches:
        part, encode = TaskContext.get().partitionId(), piece_tokenizer(tokenizer, special)
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        out, documents = None, 0
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in in_chunks(offsets, TASK_BYTES):
                if out is None:
                    filesystem, name = open_filesystem(folder)
                    filesystem.create_dir(name, recursive=True)
                    out = SequenceWriter(path, length, wide)
                ids, starts = encode.ids(batch.column("text").slice(a, b - a), end_id)
                out.add(ids, starts, batch.column("doc").slice(a, b - a).to_pylist())
                documents += b - a
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": path, "documents": documents, "tokens": out.tokens, "sequences": out.sequences}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), *((k, pa.int64()) for k in ("documents", "tokens", "sequences"))]),
            )

    files = stored(ordered.mapInArrow(write, fields), "sequence-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.withColumn("first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest alone."""
    files = max(1, manifest.count())
    fields = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("first_token").to_pylist()):
                file, crc, size = SequenceFile(path), 0, 0
                for number in range(file.reader.num_record_batches):
                    rows = file.batch(number)
                    mask = rows.column("mask").values.to_numpy(zero_copy_only=False)
                    ids = rows.column("ids").values.to_numpy()[mask].astype("<u4")
                    ends = np.flatnonzero(rows.column("ends").values.to_numpy(zero_copy_only=False)[mask]) + 1
                    crcs, sizes, done = [], [], 0
                    for end in ends.tolist():
                        crcs.append(zlib.crc32(ids[done:end], crc))
                        sizes.append(size + end - done)
                        done, crc, size = end, 0, 0
                    crc, size = zlib.crc32(ids[done:], crc), size + len(ids) - done
                    sizes = np.array(sizes, dtype=np.int64)
                    starts = at + np.cumsum(sizes) - sizes
                    at += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("documents").flatten(), pa.array(starts), pa.array(sizes), pa.array(crcs, pa.int64())], schema=fields
                    )

    return manifest.select("path", "first_token").repartition(files).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
