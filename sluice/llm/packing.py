"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bounded-space online best fit: each task keeps a fixed number of open bins. A bitset has one bit for each amount of free
space that some open bin has, so the fullest bin that still takes a piece is the lowest set bit from the piece's length
on. When all bins are open and none fits, the fullest is closed. Pieces go in as their documents come; only documents
longer than a sequence are cut.

Each task packs the documents that it reads, so the ids of a document are made where they are used. A task holds the
pieces of its open bins, ``OPEN_BINS`` sequences at most, until these close. When it ends, bins with more than
``TOLERANCE`` free tokens are taken apart, and their pieces, with ids, go through the same best fit a second time, in as few
tasks as ``SECOND_TOKENS`` allows. So the number of sequences hardly depends on the number of partitions, and the second
pass shuffles a bounded amount for each task. Both passes are over stored rows in a fixed order, so a task that runs again
gives the same sequences.

Edge cases: a null or empty text is a document of its end token alone. Ids that are null or repeat do no harm, every row
is a document. Other columns are never read. An empty table has no sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import tokens, worker
from sluice.session import scratch_folder, through_table

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 1024
#: Free tokens with which a task leaves a bin as it is.
TOLERANCE = 8
#: Tokens that a task of the second pass places.
SECOND_TOKENS = 4 << 20
#: Tokens that a task gathers before it gives out those of closed bins, and pieces in a batch that it gives out.
GATHERED, BATCH = 2 << 20, 1 << 14
PIECE = "piece int, start long, length long, ids binary, sequence_id long, offset long"


class Bins:
    """Open bins by free space. ``place`` gives the bin of a piece and where in it the piece begins; ``free`` has the space
    that is left in every open bin."""

    def __init__(self, size: int = SEQUENCE, most: int = OPEN_BINS):
        self.size, self.most = size, most
        self._bits = 0
        self._by_space: list[list[int]] = [[] for _ in range(size + 1)]
        self.free: dict[int, int] = {}
        self.used = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self._bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if len(self.free) == self.most:
                self._take((self._bits & -self._bits).bit_length() - 1)
            space, number = self.size, self.used
            self.used += 1
        if left := space - length:
            self._by_space[left].append(number)
            self._bits |= 1 << left
            self.free[number] = left
        return number, self.size - space

    def _take(self, space: int) -> int:
        bins = self._by_space[space]
        number = bins.pop()
        del self.free[number]
        if not bins:
            self._bits &= ~(1 << space)
        return number


class Packer:
    """Places pieces, and gives them out as their bins close. Columns are the key and those of ``PIECE`` up to the ids."""

    def __init__(self, key: str, size: int, most: int, first_number: int):
        self._bins, self._first = Bins(size, most), first_number
        self._names = [key, *(c.split()[0] for c in PIECE.split(", ")), "settled"]
        self._waiting: list[pa.RecordBatch] = []
        self._tokens = self._held = 0

    def add(self, columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        lengths = columns[3].to_numpy()
        places = np.array([self._bins.place(n) for n in lengths.tolist()], np.int64).reshape(-1, 2)
        settled = pa.array(np.ones(len(lengths), bool))
        batch = [*columns, pa.array(places[:, 0]), pa.array(places[:, 1]), settled]
        self._waiting.append(pa.RecordBatch.from_arrays(batch, self._names))
        self._tokens += int(lengths.sum())
        if self._tokens > self._held + GATHERED:
            yield from self._closed()

    def _closed(self) -> Iterator[pa.RecordBatch]:
        is_open = np.fromiter(self._bins.free, np.int64, len(self._bins.free))
        kept, self._held = [], 0
        for batch in self._waiting:
            stays = np.isin(batch.column(5).to_numpy(), is_open)
            if stays.any():
                kept.append(batch.filter(pa.array(stays)))
                self._held += int(kept[-1].column(3).to_numpy().sum())
            yield from self._numbered(batch.filter(pa.array(~stays)))
        # Held pieces in one batch, so that no slice keeps a batch that is given out.
        self._waiting = [pa.Table.from_batches(kept).combine_chunks().to_batches()[0]] if kept else []
        self._tokens = self._held

    def _numbered(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows:
            numbers = pa.array(batch.column(5).to_numpy() + self._first)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], numbers, *batch.columns[6:]], self._names)

    def end(self, tolerance: int) -> Iterator[pa.RecordBatch]:
        """What is still held; pieces of bins with more free space than ``tolerance`` are not settled."""
        loose = np.array([b for b, left in self._bins.free.items() if left > tolerance], np.int64)
        for batch in self._waiting:
            settled = pa.array(~np.isin(batch.column(5).to_numpy(), loose))
            yield from self._numbered(pa.RecordBatch.from_arrays([*batch.columns[:7], settled], self._names))
        self._waiting = []


def cut(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, number within it, and length of every piece; all pieces but a document's last are full."""
    pieces = np.maximum(-(-lengths // size), 1)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return doc, number, np.minimum(lengths[doc] - number * size, size)


def with_end(ids: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with one id after each."""
    n = len(at) - 1
    out = np.full(len(ids) + n, end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(at))] = ids
    return out, at + np.arange(n + 1)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, size: int = SEQUENCE, bins: int = OPEN_BINS, end: int = END_ID) -> DataFrame:
    """One row per piece: key, ``piece``, ``start`` in its document, ``length``, ``ids`` (little-endian 32-bit numbers),
    ``sequence_id`` and ``offset`` in that sequence."""
    path = path or tokens.vocabulary_path()

    @worker.tidy
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = tokens.encoder(path), Packer(key, size, bins, _numbers())
        for batch in batches:
            first = 0
            for ids, at in encode.chunks(batch.column(1)):
                ids, at = with_end(ids, at, end)
                keys = batch.column(0).slice(first, len(at) - 1)
                for columns in _pieces(keys, ids, at, size):
                    yield from packer.add(columns)
                first += len(at) - 1
        yield from packer.end(TOLERANCE)

    @worker.tidy
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(key, size, bins, _numbers() | 1 << 62)
        for batch in batches:
            yield from packer.add(batch.columns)
        yield from packer.end(size)

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, {PIECE}, settled boolean"
    stored = through_table(docs.select(key, text).mapInArrow(encoded, schema), scratch_folder(docs.sparkSession, "packed"))
    loose = stored.where("not settled").select(*stored.columns[:5])
    tasks = -(-(loose.agg(F.sum("length")).first()[0] or 0) // SECOND_TOKENS)
    # Long pieces first: the second pass has all its pieces at hand.
    ordered = loose.repartition(max(tasks, 1)).sortWithinPartitions(F.desc("length"))
    return stored.where("settled").unionByName(ordered.mapInArrow(again, schema)).drop("settled")


def _numbers() -> int:
    """Where the numbers of this task's sequences begin."""
    return (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36


def _pieces(keys: pa.Array, ids: np.ndarray, at: np.ndarray, size: int) -> Iterator[list[pa.Array]]:
    """Key, number, start, length and ids of the pieces of some documents, in batches."""
    doc, number, length = cut(np.diff(at), size)
    begin = at[doc] + number * size
    raw = pa.py_buffer(ids.astype("<u4", copy=False))
    for lo in range(0, len(doc), BATCH):
        part = slice(lo, lo + BATCH)
        bounds = np.append(begin[part], begin[part][-1] + length[part][-1])
        own = raw.slice(int(bounds[0]) * 4, int(bounds[-1] - bounds[0]) * 4)
        binary = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(((bounds - bounds[0]) * 4).astype(np.int32)), own])
        yield [keys.take(pa.array(doc[part])), pa.array(number[part].astype(np.int32)), pa.array(number[part] * size), pa.array(length[part]), binary]


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: where every piece lies, and a checksum of its ids."""
    return pack(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
