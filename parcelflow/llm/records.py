"""Length-delimited binary records of token ids, with a separate offset index.

A record is: payload length (u64), masked checksum of those 8 bytes (u32),
payload, masked checksum of the payload (u32); all little-endian. The payload is
one flag byte (1: doc_id is null), doc_id (i64), then the ids (u16 each where
the vocabulary allows it, which the flag's second bit says, else u32).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.columns import by_bytes, texts_of
from parcelflow.llm.pieces import BLOCK, id_encoder
from parcelflow.session import new_work_dir

_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_PAYLOAD = struct.Struct("<Bq")
_NULL, _WIDE = 1, 2

#: A file is closed once it holds so many bytes.
FILE_BYTES = 64 << 20


def masked(data: bytes) -> int:
    """A checksum turned and shifted, so that checksums of data holding checksums stay sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    payload = _PAYLOAD.pack((doc_id is None) * _NULL + wide * _WIDE, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()
    length = len(payload).to_bytes(8, "little")
    return _HEAD.pack(len(payload), masked(length)) + payload + _TAIL.pack(masked(payload))


def unframed(record: bytes) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of one record; raises ValueError if a length or checksum is wrong."""
    size, check = _HEAD.unpack_from(record)
    payload = record[_HEAD.size : _HEAD.size + size]
    if check != masked(record[:8]) or len(record) != _HEAD.size + size + _TAIL.size or _TAIL.unpack_from(record, _HEAD.size + size)[0] != masked(payload):
        raise ValueError("damaged record")
    flags, doc_id = _PAYLOAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & _WIDE else "<u2", offset=_PAYLOAD.size)
    return None if flags & _NULL else doc_id, ids.astype("<u4")


_INDEX = "part int, record long, file string, at long, size long, doc_id long, before long, n_tokens long"


def write_records(docs: DataFrame, tokenizer_path: str, folder: str, kind: str = "byte", end_id: int = 2) -> DataFrame:
    """Write every text's ids in ascending doc_id order below ``folder``; returns the stored index.

    Rows are range-partitioned and sorted by doc_id (nulls first) and, for equal
    doc_ids, by the text's hash. A task writes files under names of its own, and
    the index names the files of those attempts that Spark committed, so retried
    tasks leave no trace in it. Null and empty texts hold the end id only;
    repeated rows are written each; an empty table gives an empty index.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_encoder(tokenizer_path, kind)
        store, root = pa.fs.FileSystem.from_uri(f"{folder}/data")
        store.create_dir(root)
        part, record, before, out, name, at = TaskContext.get().partitionId(), 0, 0, None, "", 0
        try:
            for batch in by_bytes(batches, "text", BLOCK):
                rows = []
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch)), strict=True):
                    ids = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id))
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.rec", 0
                        out = store.open_output_stream(name)
                    data = framed(doc_id, ids)
                    out.write(data)
                    rows.append((part, record, name, at, len(data), doc_id, before, len(ids)))
                    record, at, before = record + 1, at + len(data), before + len(ids)
                out.flush()
                kinds = (pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, _INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read the records an index names, in whatever order: doc_id, start, n_tokens, ids_crc32, checked."""
    ends = index.groupBy("part").agg(F.sum("n_tokens").alias("_tokens"))
    bases = ends.select("part", (F.sum("_tokens").over(Window.orderBy("part")) - F.col("_tokens")).alias("_base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pa.fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for file, at, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size", "start")), strict=True):
                if file != name:
                    name, source = file, store.open_input_file(file)
                doc_id, ids = unframed(source.read_at(size, at))
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = index.join(bases, "part").select("file", "at", "size", (F.col("_base") + F.col("before")).alias("start"))
    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_records(docs: DataFrame, tokenizer_path: str, kind: str = "byte", end_id: int = 2) -> DataFrame:
    """Write ``docs`` as records in the shared folder and read them back."""
    folder = new_work_dir(docs.sparkSession, "records")
    return read_records(write_records(docs, tokenizer_path, folder, kind, end_id), folder)
