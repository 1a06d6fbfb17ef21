"""Line dedup by two Bloom filters: lines that many documents share go.

A line's key is the line without white space at its ends, with A-Z as small letters. The steps:

1. Each task puts the keys of its documents, each once a document, into two Bloom filters: of what it has met once, and of
   what it has met twice. A bit that is set again in the first is set in the second. Filters of tasks are merged in pieces
   in the same way: what is in the first of both is in the second. So a key of two documents is in the second for certain.
2. Only keys that the second filter has, the suspects, are shuffled, as SHA-256 digests that are counted before the
   shuffle. That confirms exactly in how many documents a key is, and finds the first of these.
3. The documents are read again and lose their lines with a confirmed key; with ``keep_first`` the first line of it in the
   document with the least id stays.

The filters' size follows from the number of lines, up to ``MAX_BITS``; the second one is sent to all tasks, 16 MB at most.
A corpus of more lines than that has too many for a filter, and all its keys are suspects: counting digests is then all
that can be done, and the results are the same. Confirmed keys go to all tasks when they are at most ``BROADCAST_KEYS``;
beyond that the lines meet them by a join on the digest. A line that a third of all documents have is one digest, added up
in each task, and a hot key of the join is on the side that adaptive execution can split.

Edge cases: a null or empty text is one empty line, and an empty key is never dropped. Each row is a document, so rows that
repeat an id or a text count each. A text of millions of lines, or a line of megabytes, is handled as whole. Other columns
are never read by ``counted``, and ``clean`` returns them as they are. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import words, worker
from sluice.session import scratch_folder, through_table

DOCUMENTS = 10
#: Bits of the filters for each line, and the largest and smallest size; sizes are powers of two.
BITS_PER_LINE, MAX_BITS, MIN_BITS = 16, 1 << 27, 1 << 16
#: Bits of a piece of a filter.
PIECE_BITS = 1 << 16
#: Confirmed keys, of some 40 bytes each, that are sent to all tasks.
BROADCAST_KEYS = 500_000


class Lines:
    """All lines of a column of texts, and their keys."""

    def __init__(self, texts: pa.Array):
        self.data, at = words.buffer(texts)
        n = len(at) - 1
        ends = np.flatnonzero(self.data == 0x0A)
        owner = np.concatenate([np.arange(n), np.searchsorted(at, ends, "right") - 1])
        start = np.concatenate([at[:-1], ends + 1])
        order = np.lexsort((start, owner))
        self.text, self.start = owner[order], start[order]
        self.first = np.searchsorted(self.text, np.arange(n + 1))
        self.end = np.append(self.start[1:] - 1, 0)
        self.end[self.first[1:] - 1] = at[1:]
        filled = np.flatnonzero(words.NOT_SPACE[self.data])
        lo, hi = np.searchsorted(filled, self.start), np.searchsorted(filled, self.end)
        self.has_key = hi > lo
        self.key_start, self.key_end = np.zeros((2, len(lo)), np.int64)
        self.key_start[self.has_key] = filled[lo[self.has_key]]
        self.key_end[self.has_key] = filled[hi[self.has_key] - 1] + 1
        self.low = words.LOWER[self.data]
        self.hash = words.hashes(self.low, self.key_start, self.key_end)

    def digest(self, line: int) -> bytes:
        return hashlib.sha256(self.low[self.key_start[line] : self.key_end[line]].tobytes()).digest()

    def once_a_text(self) -> np.ndarray:
        """The first line of every different key of each text."""
        line = np.flatnonzero(self.has_key)
        order = line[np.lexsort((line, self.hash[line], self.text[line]))]
        new = np.ones(len(order), bool)
        new[1:] = (self.hash[order][1:] != self.hash[order][:-1]) | (self.text[order][1:] != self.text[order][:-1])
        return order[new]


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each key."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask]).astype(np.int64)


def has(bitset: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitset[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def put(bitset: np.ndarray, at: np.ndarray) -> None:
    """Sets bits; their numbers are in order and none repeats."""
    if len(at):
        byte = at >> 3
        begin = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        bitset[byte[begin]] |= np.bitwise_or.reduceat(np.left_shift(1, at & 7).astype(np.uint8), begin)


class Twice:
    """The filters of what was met once and twice."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = np.zeros((2, bits // 8), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        at, count = np.unique(positions(hashes, self.bits), return_counts=True)
        put(self.twice, at[(count > 1) | has(self.once, at)])
        put(self.once, at)

    def pieces(self) -> Iterator[tuple[int, bytes, bytes]]:
        once, twice = (x.reshape(-1, min(PIECE_BITS, self.bits) // 8) for x in (self.once, self.twice))
        for k in np.flatnonzero(once.any(axis=1)).tolist():
            yield k, zlib.compress(once[k].tobytes(), 1), zlib.compress(twice[k].tobytes(), 1)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _repeated(texts: DataFrame, bits: int) -> DataFrame:
    """``piece`` and ``twice`` of the merged filter of what was met twice."""
    names, kinds = ["piece", "once", "twice"], [pa.int32(), pa.binary(), pa.binary()]
    schema = "piece int, once binary, twice binary"

    @worker.tidy
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Twice(bits)
        for batch in batches:
            for part in words.slices(batch.column(0)):
                lines = Lines(part)
                own.add(lines.hash[lines.once_a_text()])
        for piece in own.pieces():
            yield _batch([piece], names, kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order of pieces, so one piece at a time is held.
        piece, once, twice = None, None, None
        for batch in batches:
            for k, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if k != piece:
                    if piece is not None:
                        yield _batch([(piece, b"", zlib.compress(twice.tobytes(), 1))], names, kinds)
                    piece, once, twice = k, o.copy(), t.copy()
                else:
                    twice |= t | (once & o)
                    once |= o
        if piece is not None:
            yield _batch([(piece, b"", zlib.compress(twice.tobytes(), 1))], names, kinds)

    return texts.mapInArrow(fill, schema).repartition("piece").sortWithinPartitions("piece").mapInArrow(merge, schema)


def _filter(docs: DataFrame, text: str) -> np.ndarray | None:
    """The second filter as bytes, or none where a filter could not hold the lines."""
    content = F.coalesce(F.col(text), F.lit(""))
    n = docs.agg(F.sum(F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    if n > MAX_BITS:
        return None
    bits = min(max(1 << max(int(n) * BITS_PER_LINE - 1, 1).bit_length(), MIN_BITS), MAX_BITS)
    merged = np.zeros((max(bits // PIECE_BITS, 1), min(PIECE_BITS, bits) // 8), np.uint8)
    for row in _repeated(docs.select(text), bits).select("piece", "twice").collect():
        merged[row["piece"]] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return merged.ravel()


def _suspected(lines: Lines, line: np.ndarray, twice: np.ndarray | None) -> np.ndarray:
    if twice is None:
        return line
    return line[has(twice, positions(lines.hash[line], 8 * len(twice))).all(axis=0)]


def shared(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """``digest`` and ``hash`` of every key that at least ``documents`` documents have, and how many have it as ``n``; with
    ``keep_first`` also the least id of these as ``first``."""
    return _confirmed(docs, key, text, documents, keep_first, _sent(docs, _filter(docs, text)))


def _sent(docs: DataFrame, value):
    return docs.sparkSession.sparkContext.broadcast(value)


def _confirmed(docs: DataFrame, key: str, text: str, documents: int, keep_first: bool, twice) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    @worker.tidy
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(1)):
                lines = Lines(part)
                line = _suspected(lines, lines.once_a_text(), twice.value)
                keys = batch.column(0).slice(done, len(part)).take(pa.array(lines.text[line]))
                digests = pa.array([lines.digest(k) for k in line.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([keys, digests, pa.array(lines.hash[line].view(np.int64))], ["key", "digest", "hash"])
                done += len(part)

    rows = docs.select(key, text).mapInArrow(suspects, f"key {kind}, digest binary, hash long")
    first = [F.min("key").alias("first")] if keep_first else []
    return rows.groupBy("digest", "hash").agg(F.count("*").alias("n"), *first).where(F.col("n") >= documents)


def _without(lines: Lines, dropped: np.ndarray) -> list[bytes]:
    """The texts without some of their lines."""
    out, data = [], lines.data
    lost = np.append(0, np.cumsum(dropped))[lines.first]
    for k in range(len(lines.first) - 1):
        a, b = lines.first[k], lines.first[k + 1]
        if lost[k] == lost[k + 1]:
            out.append(data[lines.start[a] : lines.end[b - 1]].tobytes())
        else:
            out.append(b"\n".join(data[lines.start[i] : lines.end[i]].tobytes() for i in (a + np.flatnonzero(~dropped[a:b])).tolist()))
    return out


RESULT, NAMES = "n_lines long, n_dropped long, kept string", ["n_lines", "n_dropped", "kept"]


def _result(texts: pa.Array, lines: Lines, dropped: np.ndarray) -> list[pa.Array]:
    total = np.append(0, np.cumsum(dropped))[lines.first]
    kept = pa.array(_without(lines, dropped), pa.binary()).cast(pa.string())
    return [pa.array(np.diff(lines.first)), pa.array(np.diff(total)), pc.if_else(texts.is_valid(), kept, None)]


def _leading(lines: Lines, line: np.ndarray) -> np.ndarray:
    """Which of some lines are the first with their key in their text."""
    return np.isin(line, lines.once_a_text())


def _shortened(docs: DataFrame, key: str, text: str, documents: int, keep_first: bool, *rest: Column) -> DataFrame:
    """``key``, the columns of ``rest``, and ``n_lines``, ``n_dropped`` and ``kept`` of every row."""
    twice = _sent(docs, _filter(docs, text))
    confirmed = through_table(_confirmed(docs, key, text, documents, keep_first, twice), scratch_folder(docs.sparkSession, "lines"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *rest)
    if confirmed.count() > BROADCAST_KEYS:
        return _by_join(rows, confirmed, keep_first, twice)
    found = confirmed.orderBy("hash").select("hash", "digest", *(["first"] if keep_first else [])).collect()
    known = _sent(docs, (np.array([r["hash"] for r in found], np.int64), [bytes(r["digest"]) for r in found], [r["first"] for r in found] if keep_first else None))

    @worker.tidy
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, digests, first = known.value
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(1)):
                lines, row = Lines(part), batch.slice(done, len(part))
                keys, own = row.column(0), lines.hash.view(np.int64)
                dropped = np.zeros(len(lines.start), bool)
                place = np.searchsorted(table, own)
                met = np.flatnonzero(lines.has_key & (np.append(table, 0)[place] == own) & (place < len(table)))
                leads = _leading(lines, met) if keep_first else None
                for m, line in enumerate(met.tolist()):
                    digest, at = lines.digest(line), place[line]
                    while at < len(table) and table[at] == own[line]:
                        if digests[at] == digest:
                            dropped[line] = not (keep_first and leads[m] and keys[int(lines.text[line])].as_py() == first[at])
                        at += 1
                yield pa.RecordBatch.from_arrays([keys, *row.columns[2:], *_result(part, lines, dropped)], [*names, *NAMES])
                done += len(part)

    names = [c for c in rows.columns if c != "text"]
    return rows.mapInArrow(drop, T.StructType([f for f in rows.schema if f.name != "text"] + list(T.StructType.fromDDL(RESULT))))


def _by_join(rows: DataFrame, confirmed: DataFrame, keep_first: bool, twice) -> DataFrame:
    """The same where the confirmed keys are too many to send: lines meet them by digest, and texts the numbers of their
    lines that go by a number of the row."""
    spark, names = rows.sparkSession, [c for c in rows.columns if c != "text"]
    rows = through_table(rows.withColumn("row", F.monotonically_increasing_id()), scratch_folder(spark, "rows"))
    kind = rows.schema["key"].dataType.simpleString()

    @worker.tidy
    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(2)):
                lines = Lines(part)
                line = _suspected(lines, np.flatnonzero(lines.has_key), twice.value)
                place = pa.array(lines.text[line])
                of_row = [batch.column(k).slice(done, len(part)).take(place) for k in (0, 1)]
                digests = pa.array([lines.digest(k) for k in line.tolist()], pa.binary())
                number = pa.array(line - lines.first[lines.text[line]])
                yield pa.RecordBatch.from_arrays([*of_row, digests, number, pa.array(_leading(lines, line))], ["row", "key", "digest", "line", "leads"])
                done += len(part)

    met = rows.select("row", "key", "text").mapInArrow(suspects, f"row long, key {kind}, digest binary, line long, leads boolean")
    met = met.join(confirmed.drop("hash", "n"), "digest")
    if keep_first:
        met = met.where(~(F.col("leads") & F.col("key").eqNullSafe(F.col("first"))))
    lost = met.groupBy("row").agg(F.collect_list("line").alias("lost")).withColumnRenamed("row", "of")

    @worker.tidy
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(0)):
                lines, row = Lines(part), batch.slice(done, len(part))
                dropped = np.zeros(len(lines.start), bool)
                for k, numbers in enumerate(row.column(1).to_pylist()):
                    dropped[lines.first[k] + np.array(numbers or [], np.int64)] = True
                yield pa.RecordBatch.from_arrays([*row.columns[2:], *_result(part, lines, dropped)], [*names, *NAMES])
                done += len(part)

    both = rows.join(lost, F.col("row") == F.col("of"), "left").select("text", "lost", *names)
    return both.mapInArrow(drop, T.StructType(list(both.schema)[2:] + list(T.StructType.fromDDL(RESULT))))


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """One row per document: its key, ``n_lines``, ``n_dropped`` and the text that is left as ``kept``, null for a null."""
    return _shortened(docs, key, text, documents, keep_first).withColumnRenamed("key", key)


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, keep_first: bool = False) -> DataFrame:
    """All documents with their own columns and what is left of their texts."""
    others = F.struct(F.col(key).alias("k"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text))
    out = _shortened(docs, key, text, documents, keep_first, others.alias("rest"))
    return out.select(*(F.col("kept").alias(c) if c == text else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(docs.columns)))


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: lines, dropped lines, and a checksum of what is left of every document."""
    return counted(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
    SELECT doc_id, i, lines[i] AS line,
        translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM split, generate_series(1, len(lines)) g(i)
), often AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often.k) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN often USING (k) GROUP BY doc_id
"""
