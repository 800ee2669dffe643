"""Token ids in Arrow files of fixed-size lists (operator 6).

Documents are dealt out by ranges of their id and sorted, each partition
encodes its own and writes two Arrow IPC files to the shared folder:

* ``tokens``: record batches of ``input_ids`` fixed_size_list<uint16>[L] (uint32
  for a vocabulary of more than 65,536 ids) and ``mask`` fixed_size_list<bool>[L];
  the id stream of the partition cut into sequences of L ids, the last one
  padded and masked false;
* ``index``: the id, start in the partition's stream and token count of each
  document, in stream order.

Sequence i of a file is row i % B of batch i // B, at a fixed place of a
memory map, so any sequence or document is read without copying or decoding.
File names carry a fresh id; the manifest (one row per partition, as returned
by the tasks that ended well) says which files count, so a task that is run
again after an executor loss, or twice, leaves nothing wrong behind.

Defined cases: null text is empty (its end id alone remains); null ids come
first; equal ids are ordered by text; an empty table writes no files and reads
as no rows; other columns are not read. Memory per task: one batch of sequences
plus the longest text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.llm.common import materialize, read_table, text_or_empty
from larch.llm.tokens import encode_bytes, tokenizer_path, vocabulary_size
from larch.session import unique_path

SEQUENCE_LENGTH = 2048
BATCH_SEQUENCES = 256
INDEX_ROWS = 16_384
END_ID = 0
MANIFEST = "part long, tokens_path string, index_path string, n_docs long, n_tokens long"


def _file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)


def _open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    fs, p = _file_system(path)
    return pa.ipc.open_file(pa.memory_map(p) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(p))


class SequenceWriter:
    """Cuts a stream of ids into fixed-size sequences and writes them in batches."""

    def __init__(self, sink, length: int, batch: int, id_type: str) -> None:
        self.length, self.batch, self.parts, self.held, self.total = length, batch, [], 0, 0
        self.dtype = np.dtype(id_type)
        ids = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("input_ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.held += len(ids) // 4
        self.total += len(ids) // 4
        if self.held >= self.length * self.batch:
            self._write(False)

    def _write(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), dtype="<u4")
        step = self.length * self.batch
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self._batch(ids[at:at + step], step)
        rest = ids[whole:]
        if last and len(rest):
            size = -(-len(rest) // self.length) * self.length
            self._batch(np.concatenate([rest, np.zeros(size - len(rest), dtype="<u4")]), len(rest))
            rest = rest[:0]
        self.parts, self.held = [rest.tobytes()], len(rest)

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.writer.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(ids.astype(self.dtype)), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        self._write(True)
        self.writer.close()


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID,
                      length: int = SEQUENCE_LENGTH, batch: int = BATCH_SEQUENCES,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files under ``root``; the manifest, in stream order of ``part``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    id_type = "uint16" if vocabulary_size(tokenizer) <= 1 << 16 else "uint32"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out, index, n_docs, starts = TaskContext.get().partitionId(), None, None, 0, ([], [], [])

        def flush_index() -> None:
            if starts[0]:
                index.write_batch(pa.record_batch([
                    pa.array(starts[0], index_type), pa.array(starts[1], pa.int64()), pa.array(starts[2], pa.int64())],
                    schema=index_schema))
                for x in starts:
                    x.clear()

        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs, base = _file_system(root)
                fs.create_dir(base, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
                index_type = b.schema.field(0).type
                index_schema = pa.schema([("doc_id", index_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                sinks = [fs.open_output_stream(f"{base}/{name}.{kind}.arrow") for kind in ("tokens", "index")]
                out, index = SequenceWriter(sinks[0], length, batch, id_type), pa.ipc.new_file(sinks[1], index_schema)
            for i, text in zip(b.column(0), b.column(1), strict=True):
                ids = encode_bytes(text.as_py(), tokenizer) + end
                starts[0].append(i.as_py())
                starts[1].append(out.total)
                starts[2].append(len(ids) // 4)
                out.add(ids)
                if len(starts[0]) >= INDEX_ROWS:
                    flush_index()
            n_docs += b.num_rows
        if out:
            flush_index()
            out.close()
            index.close()
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict({
                "part": [part], "tokens_path": [f"{root}/{name}.tokens.arrow"], "index_path": [f"{root}/{name}.index.arrow"],
                "n_docs": [n_docs], "n_tokens": [out.total]})

    ordered = (
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    )
    return materialize(ordered.mapInArrow(run, MANIFEST), "token_manifest")


def read_documents(tokens_path: str, index_path: str) -> Iterator[tuple[object, int, int, int]]:
    """(doc_id, start in this file, n_tokens, crc32 of the ids) of each document."""
    tokens, index = _open_file(tokens_path), _open_file(index_path)
    at, first, ids = 0, 0, None  # ids: batch `at - 1`, whose first id is number `first`
    for k in range(index.num_record_batches):
        docs = index.get_batch(k)
        for doc, start, n in zip(*(docs.column(c).to_pylist() for c in range(3)), strict=True):
            crc, pos, stop = 0, start, start + n
            while pos < stop:
                while ids is None or pos >= first + len(ids):
                    first += 0 if ids is None else len(ids)
                    ids = tokens.get_batch(at).column(0).flatten().to_numpy(zero_copy_only=True)
                    at += 1
                part = ids[pos - first:stop - first]
                crc = zlib.crc32(part.astype("<u4"), crc)
                pos += len(part)
            yield doc, start, n, crc


def token_digests(manifest: DataFrame, id_type: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 of every document.

    The manifest has one row per partition; the running total of its token
    counts is taken on the driver."""
    spark = manifest.sparkSession
    files, total = [], 0
    for r in manifest.orderBy("part").collect():
        files.append((len(files), r["tokens_path"], r["index_path"], total))
        total += r["n_tokens"]
    table = spark.createDataFrame(files, "k long, tokens_path string, index_path string, base long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for b in batches:
            for f in b.to_pylist():
                if schema is None:
                    kind = _open_file(f["index_path"]).schema.field(0).type
                    schema = pa.schema([("doc_id", kind), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
                held: list[tuple] = []
                for doc, start, n, crc in read_documents(f["tokens_path"], f["index_path"]):
                    held.append((doc, f["base"] + start, n, crc))
                    if len(held) >= INDEX_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return table.repartitionByRange(max(1, len(files)), "k").mapInArrow(
        run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def op6_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, unique_path(spark, "llm", "token_files"), tokenizer_path())
    return token_digests(manifest, dict(docs.dtypes)["doc_id"])
