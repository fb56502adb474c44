"""Token ids as Arrow files of fixed-size lists.

Documents are put in ascending id order by a range shuffle.  Each task writes
its stretch of the token stream as one Arrow file whose record batches hold
fixed-size lists: ``ids`` and ``mask``, one row per sequence (the last row is
padded, the mask tells), and a second Arrow file with the documents' starts.
Files are memory-mapped (or opened through pyarrow's file systems), so any
sequence or document is reached without copying.

A task names its files by a fresh id and reports them in a manifest row; only
the rows of successful attempts reach the written manifest, so retried tasks
and lost executors leave no trace in the result.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import shared_path, small_batches, written
from parley.llm.tokens import default_tokenizer, text_slices, worker_encoder

BATCH_ROWS = 256
MANIFEST = "part int, tokens_path string, docs_path string, n_docs long, n_tokens long"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a Hadoop-style path."""
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


class TokenFileWriter:
    """Writes ids as fixed-size-list batches, ``BATCH_ROWS`` sequences each."""

    def __init__(self, path: str, length: int, wide: bool):
        filesystem, plain = open_fs(path)
        self.length, self.kind = length, np.dtype("<u4" if wide else "<u2")
        value = pa.uint32() if wide else pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(value, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = filesystem.open_output_stream(plain)
        self.file = ipc.new_file(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = self.total = 0

    def append(self, ids: np.ndarray) -> None:
        self.pending.append(ids.astype(self.kind, copy=False))
        self.held += len(ids)
        self.total += len(ids)
        room = BATCH_ROWS * self.length
        if self.held >= room:
            ids = np.concatenate(self.pending)
            whole = len(ids) // room * room
            for at in range(0, whole, room):
                self._batch(ids[at : at + room])
            self.pending, self.held = [ids[whole:].copy()], len(ids) - whole

    def _batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.kind)
        padded[: len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (padded, mask)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._batch(np.concatenate(self.pending))
        self.file.close()
        self.sink.close()


class TokenFile:
    """Random access to one token file; local files are memory-mapped."""

    def __init__(self, path: str):
        filesystem, plain = open_fs(path)
        local = isinstance(filesystem, fs.LocalFileSystem)
        self.source = pa.memory_map(plain) if local else filesystem.open_input_file(plain)
        self.file = ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.values = -1, np.zeros(0, np.uint16)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        batch = self.file.get_batch(i // BATCH_ROWS)
        row = slice(i % BATCH_ROWS * self.length, (i % BATCH_ROWS + 1) * self.length)
        ids = batch.column(0).flatten().to_numpy()
        return ids[row], batch.column(1).flatten().to_numpy(zero_copy_only=False)[row]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids of the stream from ``start``: a view within one batch."""
        room, parts = BATCH_ROWS * self.length, []
        while n > 0:
            if start // room != self.at:
                self.at = start // room
                self.values = self.file.get_batch(self.at).column(0).flatten().to_numpy()
            inside = start % room
            parts.append(self.values[inside : inside + n])
            n -= min(n, room - inside)
            start += min(len(parts[-1]), room - inside)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 1,
) -> DataFrame:
    """Write the files below ``folder``; returns the written manifest with the
    ids before each file (``base``)."""
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col), F.col(text_col))
    # Ties of the id are dealt by the text, so one frequent id is no hot range.
    ordered = rows.repartitionByRange(F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)).sortWithinPartitions(
        F.col(id_col).asc_nulls_first()
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        tokens = index = sink = None
        start = n_docs = 0
        for whole in batches:
            for batch in text_slices(whole):
                ids, offsets = encoder.encode(batch.column(1), end_id)
                if tokens is None:
                    filesystem, plain = open_fs(folder)
                    filesystem.create_dir(plain, recursive=True)
                    tokens_path, docs_path = f"{folder}/{name}.tokens.arrow", f"{folder}/{name}.docs.arrow"
                    wide = encoder.tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
                    tokens = TokenFileWriter(tokens_path, length, wide)
                    schema = pa.schema([("id", batch.column(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                    filesystem, plain = open_fs(docs_path)
                    sink = filesystem.open_output_stream(plain)
                    index = ipc.new_file(sink, schema)
                tokens.append(ids)
                columns = [batch.column(0), pa.array(start + offsets[:-1]), pa.array(np.diff(offsets))]
                index.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
                start += int(offsets[-1])
                n_docs += batch.num_rows
        if tokens is not None:
            tokens.close()
            index.close()
            sink.close()
            values = ([part], [tokens_path], [docs_path], [n_docs], [start])
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["part", "tokens_path", "docs_path", "n_docs", "n_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    with small_batches(docs.sparkSession):
        manifest = written(ordered.mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("bigint")))
    return written(based, "manifest")


def read_token_files(manifest: DataFrame, id_col: str, id_type: T.DataType) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the files of a
    manifest; a task reads whole files."""
    fields = T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for row in listed.to_pylist():
                tokens = TokenFile(row["tokens_path"])
                filesystem, plain = open_fs(row["docs_path"])
                index = ipc.open_file(filesystem.open_input_file(plain))
                for i in range(index.num_record_batches):
                    docs = index.get_batch(i)
                    start, n = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    crc = [
                        zlib.crc32(np.ascontiguousarray(tokens.ids(s, k), "<u4"))
                        for s, k in zip(start.tolist(), n.tolist(), strict=True)
                    ]
                    columns = [docs.column(0), pa.array(start + row["base"]), docs.column(2), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=fields.names)

    files = max(1, manifest.count())
    return manifest.select("tokens_path", "docs_path", "base").repartition(files).mapInArrow(read, fields)


def token_files_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write all documents as token files in the shared folder and read the
    documents back from them.

    Returns id, start, n_tokens (with the end id), ids_crc32.  NULL and empty
    texts are the end id alone; NULL ids come first; repeated rows are
    documents of their own; an empty table writes no file and gives an empty
    result; very long texts may span many sequences.
    """
    manifest = write_token_files(docs, shared_path(docs.sparkSession, "tokens"), id_col, text_col, **options)
    return read_token_files(manifest, id_col, docs.select(F.col(id_col)).schema[0].dataType)
