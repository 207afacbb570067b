"""Packing documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from parcelflow.llm.columns import by_bytes, texts_of
from parcelflow.llm.pieces import id_encoder
from parcelflow.session import new_work_dir

_PIECE = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, kind: str, end_id: int, size: int) -> DataFrame:
    """One row per piece: a document's ids and its end id, cut only where longer than ``size``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_encoder(tokenizer_path, kind)
        end = end_id.to_bytes(4, "little")
        for batch in by_bytes(batches, "text"):
            rows = []
            for k, ids in enumerate(encoder.encode(texts_of(batch))):
                ids += end
                rows += [(k, n, at // 4, len(part := ids[at : at + 4 * size]) // 4, zlib.crc32(part)) for n, at in enumerate(range(0, len(ids), 4 * size))]
            of, *columns = zip(*rows, strict=True)
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {doc_id}, {_PIECE}")


class OpenBins:
    """A bounded number of open bins, found by free space through a bitset.

    ``place`` puts an item into the bin it fills best and opens a bin if none
    has room. With too many open, the fullest is closed.
    """

    def __init__(self, size: int, most: int):
        self._size, self._most = size, most
        self._free = 0  # bit f: some open bin has f free places
        self._bins: list[list[int]] = [[] for _ in range(size + 1)]
        self._open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The number of the bin and the place of the item in it."""
        fits = self._free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self._size, self.made
            self.made += 1
        left = free - length
        if left:
            self._bins[left].append(number)
            self._free |= 1 << left
            self._open += 1
            if self._open > self._most:
                self._take((self._free & -self._free).bit_length() - 1)
        return number, self._size - free

    def _take(self, free: int) -> int:
        number = self._bins[free].pop()
        self._open -= 1
        if not self._bins[free]:
            self._free &= ~(1 << free)
        return number


def best_fit(pieces: DataFrame, size: int, open_bins: int) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``size``, partition by partition."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            numbers = pa.array([base + n for n, _ in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers, pa.array([at for _, at in placed], pa.int64())], [*batch.schema.names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.mapInArrow(pack, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, kind: str = "word", end_id: int = 0, size: int = 2048, open_bins: int = 4096, per_task: int = 100_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every token in one sequence.

    Tokens are counted first and their pieces written as a narrow table in the
    shared folder, so a lost executor costs no second encoding. The pieces are
    then dealt evenly over tasks of about ``per_task`` each; a task keeps at most
    ``open_bins`` bins in memory and can leave that many not quite full. Null and
    empty texts are one piece holding the end id; repeated rows are packed each;
    an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "pieces")
    token_pieces(docs, tokenizer_path, kind, end_id, size).write.parquet(folder)
    pieces = spark.read.parquet(folder)
    tasks = -(-pieces.count() // per_task)
    return best_fit(pieces.repartition(max(1, tasks)), size, open_bins)
