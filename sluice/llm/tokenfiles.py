"""Token ids in plain binary shards, and a minimal perfect hash index over them.

A data set is a folder of

* ``shard-00000.ids``: the ids of its documents one after another and nothing else, as little-endian unsigned numbers of
  16 bits, or of 32 where the vocabulary is larger;
* ``shard-00000.at``: where each document begins in it, counted in ids, little-endian 64-bit, one entry more than documents;
* ``index-00000.mph``: for the keys that hash to it, a minimal perfect hash and a table of one slot per key with the
  key's fingerprint, shard, first document in that shard and number of documents;
* ``manifest.json``: bytes per id, the number of index files, and documents and ids of every shard. It is written last.

Documents lie in ascending order of their keys (nulls first, equal keys by text) across the shards. A lookup hashes the
key, reads one pilot and one slot, compares the fingerprint, and so finds the ids in constant time.

The shuffle that orders documents carries texts; each task then encodes and writes its shard as it reads, holding one
chunk. Files get their names when complete, so a task that runs again replaces equal files. An index file is made by one
task from at most about ``INDEX_KEYS`` keys. The driver sees one small row per shard.

Edge cases: a null or empty text is its end id alone. A null key is a key. Rows that share a key lie together, in one
shard, and its slot counts them; a key that a large part of all rows shares makes its shard large, though not its
task's memory. Other columns are never read. Without rows there is one empty shard and an empty index.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import packing, tokens
from sluice.session import scratch_folder, through_table

END_ID = 1
SHARD_BYTES = 64 << 20
INDEX_KEYS = 50_000
KEYS_PER_PILOT = 2
READ_IDS = 1 << 20
#: Documents whose places are held at once when files are read.
READ_ROWS = 100_000
HEADER = np.dtype([("keys", "<i8"), ("pilots", "<i8")])
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<i4"), ("first", "<i8"), ("count", "<i8")])


def _place(folder: str, name: str = "") -> tuple[pa.fs.FileSystem, str]:
    system, path = pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    return system, f"{path.rstrip('/')}/{name}" if name else path


class _Whole:
    """A file under another name until it is complete."""

    def __init__(self, folder: str, name: str):
        self._system, self._path = _place(folder, name)
        self._draft = f"{self._path}.{uuid.uuid4().hex}"
        self.file = self._system.open_output_stream(self._draft)

    def close(self) -> None:
        self.file.close()
        self._system.move(self._draft, self._path)


def _read(folder: str, name: str) -> bytes:
    system, path = _place(folder, name)
    with system.open_input_file(path) as f:
        return f.read()


def key_text(key: object) -> str:
    """A key as text; a null key has one of its own, which no number or plain text has."""
    return "\x00" if key is None else str(key)


def _hash(texts: list[str], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in texts), np.uint64, len(texts))


class PerfectHash:
    """Different keys to the numbers from 0 on, without a gap.

    Keys fall into small groups; each has a pilot. That of a group of several is the number of the hash function that
    puts all its keys on free slots, tried in order, the largest groups first. A single key takes a slot that is left,
    and its pilot is that slot, negative and less one.
    """

    def __init__(self, pilots: np.ndarray, keys: int):
        self.pilots, self.keys = pilots, keys

    @staticmethod
    def _slots(first: np.ndarray, second: np.ndarray, pilot: np.ndarray, keys: int) -> np.ndarray:
        x = first + (pilot.astype(np.uint64) + np.uint64(1)) * (second | np.uint64(1))
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return (x % np.uint64(max(keys, 1))).astype(np.int64)

    @classmethod
    def build(cls, texts: list[str]) -> PerfectHash:
        n = len(texts)
        first, second = _hash(texts, 1), _hash(texts, 2)
        groups = n // KEYS_PER_PILOT + 1
        group = (first % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        size = np.bincount(group, minlength=groups)
        begin = np.cumsum(size) - size
        pilots, free = np.zeros(groups, np.int64), np.ones(n, bool)
        by_size = np.argsort(-size, kind="stable")
        by_size = by_size[size[by_size] > 0]
        for g in by_size[size[by_size] > 1]:
            own = order[begin[g] : begin[g] + size[g]]
            pilots[g], slots = cls._pilot(first[own], second[own], free, n)
            free[slots] = False
        single = by_size[size[by_size] == 1]
        pilots[single] = -np.flatnonzero(free) - 1
        return cls(pilots, n)

    @classmethod
    def _pilot(cls, first: np.ndarray, second: np.ndarray, free: np.ndarray, n: int) -> tuple[int, np.ndarray]:
        tries, begin = 16, 0
        while True:
            pilot = np.arange(begin, begin + tries)
            slots = cls._slots(first[None, :], second[None, :], pilot[:, None], n)
            good = free[slots].all(axis=1)
            for k in np.flatnonzero(good):
                if len(np.unique(slots[k])) == len(first):
                    return int(pilot[k]), slots[k]
            begin, tries = begin + tries, min(2 * tries, 4096)
            if begin > 1 << 26:
                raise RuntimeError("two keys have the same hashes")

    def slots(self, texts: list[str]) -> np.ndarray:
        if not self.keys:
            return np.zeros(len(texts), np.int64)
        first, second = _hash(texts, 1), _hash(texts, 2)
        pilot = self.pilots[(first % np.uint64(len(self.pilots))).astype(np.int64)]
        return np.where(pilot < 0, -pilot - 1, self._slots(first, second, np.maximum(pilot, 0), self.keys))


def fingerprints(texts: list[str]) -> np.ndarray:
    return (_hash(texts, 3) >> np.uint64(32)).astype(np.uint32)


def _part(texts: list[str], parts: int) -> np.ndarray:
    return (_hash(texts, 4) % np.uint64(parts)).astype(np.int32)


def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END_ID) -> dict:
    """Write the data set of all documents; gives its manifest."""
    spark, path = docs.sparkSession, path or tokens.vocabulary_path()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    system, at = _place(folder)
    system.create_dir(at, recursive=True)
    width = 2 if max(tokens.encoder(path).size - 1, end) < 1 << 16 else 4

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode = TaskContext.get().partitionId(), tokens.encoder(path)
        ids_file, at_file = _Whole(folder, f"shard-{shard:05d}.ids"), _Whole(folder, f"shard-{shard:05d}.at")
        at_file.file.write(np.zeros(1, "<i8").tobytes())
        done = docs_done = 0
        for batch in batches:
            first = 0
            for ids, begin in encode.chunks(batch.column(1)):
                ids, begin = packing.with_end(ids, begin, end)
                n = len(begin) - 1
                ids_file.file.write(ids.astype(f"<u{width}").tobytes())
                at_file.file.write((begin[1:] + done).astype("<i8").tobytes())
                texts = [key_text(k) for k in batch.column(0).slice(first, n).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts), pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(docs_done, docs_done + n)), pa.array(np.diff(begin))],
                    ["key", "shard", "place", "ids"],
                )
                done, docs_done, first = done + int(begin[-1]), docs_done + n, first + n
        ids_file.close()
        at_file.close()

    shards = int(size // SHARD_BYTES) + 1
    ordered = rows.repartitionByRange(shards, F.asc_nulls_first("key")).sortWithinPartitions(F.asc_nulls_first("key"), F.asc_nulls_first("text"))
    written = through_table(ordered.mapInArrow(write_shard, "key string, shard int, place long, ids long"), scratch_folder(spark, "tokens"))
    per_shard = written.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("ids").alias("ids")).collect()  # one row per shard
    parts = sum(r["docs"] for r in per_shard) // INDEX_KEYS + 1

    def write_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, schema=pa.schema([("part", pa.int32()), ("key", pa.string()), ("shard", pa.int32()), ("first", pa.int64()), ("count", pa.int64())]))
        for part in np.unique(table["part"].to_numpy()):
            own = table.filter(pa.compute.equal(table["part"], part))
            texts = own["key"].to_pylist()
            function, slots = PerfectHash.build(texts), np.zeros(len(texts), SLOT)
            at = function.slots(texts)
            slots["fingerprint"][at] = fingerprints(texts)
            for name in ("shard", "first", "count"):
                slots[name][at] = own[name].to_numpy()
            out = _Whole(folder, f"index-{part:05d}.mph")
            out.file.write(np.array([(len(texts), len(function.pilots))], HEADER).tobytes())
            out.file.write(function.pilots.astype("<i8").tobytes())
            out.file.write(slots.tobytes())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(texts)], pa.int64())], ["part", "keys"])

    def with_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_part(b.column(0).to_pylist(), parts)), *b.columns], ["part", *b.schema.names])

    entries = written.groupBy("key", "shard").agg(F.min("place").alias("first"), F.count("*").alias("count"))
    entries = entries.mapInArrow(with_part, "part int, key string, shard int, first long, count long").repartition(parts, "part")
    through_table(entries.mapInArrow(write_index, "part int, keys long"), scratch_folder(spark, "index"))
    manifest = {"width": width, "parts": parts, "shards": [[r["shard"], r["docs"], r["ids"]] for r in sorted(per_shard, key=lambda r: r["shard"])]}
    out = _Whole(folder, "manifest.json")
    out.file.write(json.dumps(manifest).encode())
    out.close()
    return manifest


class Index:
    """Keyed access to a data set. Index files and shards are opened as they are needed; the last ones stay."""

    def __init__(self, folder: str):
        self._folder = folder
        self.manifest = json.loads(_read(folder, "manifest.json"))
        self._parts: dict[int, tuple[PerfectHash, np.ndarray]] = {}

    def _load(self, part: int) -> tuple[PerfectHash, np.ndarray]:
        if part not in self._parts:
            system, path = _place(self._folder, f"index-{part:05d}.mph")
            if system.get_file_info(path).type == pa.fs.FileType.NotFound:
                self._parts = {part: (PerfectHash(np.zeros(1, np.int64), 0), np.zeros(1, SLOT))}
                return self._parts[part]
            raw = _read(self._folder, f"index-{part:05d}.mph")
            keys, pilots = np.frombuffer(raw, HEADER, 1)[0].tolist()
            middle = HEADER.itemsize + 8 * pilots
            function = PerfectHash(np.frombuffer(raw[HEADER.itemsize : middle], "<i8"), keys)
            self._parts = {part: (function, np.frombuffer(raw[middle:], SLOT))}
        return self._parts[part]

    def find(self, keys: list) -> np.ndarray:
        """Slots of the keys, in their order; ``count`` is 0 for a key that is not there."""
        texts = [key_text(k) for k in keys]
        part, out = _part(texts, self.manifest["parts"]), np.zeros(len(texts), SLOT)
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            own = [texts[k] for k in at]
            function, slots = self._load(int(p))
            got = slots[function.slots(own)].copy()
            got["count"][(got["fingerprint"] != fingerprints(own)) | (function.keys == 0)] = 0
            out[at] = got
        return out

    def ids(self, key: object) -> list[np.ndarray]:
        """The ids of every document with the key."""
        slot = self.find([key])[0]
        if not slot["count"]:
            return []
        at = _range(self._folder, f"shard-{slot['shard']:05d}.at", int(slot["first"]) * 8, (int(slot["count"]) + 1) * 8, "<i8")
        width = self.manifest["width"]
        ids = _range(self._folder, f"shard-{slot['shard']:05d}.ids", int(at[0]) * width, int(at[-1] - at[0]) * width, f"<u{width}")
        return [ids[a - at[0] : b - at[0]] for a, b in zip(at[:-1], at[1:], strict=True)]


def _range(folder: str, name: str, begin: int, size: int, kind: str) -> np.ndarray:
    system, path = _place(folder, name)
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read_at(size, begin), kind)


def read_all(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the files hold of every document of ``keys``, found through the index: key, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32``."""
    manifest = json.loads(_read(folder, "manifest.json"))
    base, before = {}, 0
    for shard, _, ids in manifest["shards"]:
        base[shard], before = before, before + ids
    kind, parts, width = keys.schema[key].dataType.simpleString(), manifest["parts"], manifest["width"]

    def with_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [key_text(k) for k in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(_part(texts, parts)), b.column(0)], ["part", key])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(folder)
        for b in batches:
            got = index.find(b.column(1).to_pylist())
            if not got["count"].all():
                raise KeyError(f"not in the index: {b.column(1).to_pylist()[int(np.argmin(got['count']))]}")
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(np.ascontiguousarray(got[n])) for n in ("shard", "first", "count"))], [key, "shard", "first", "count"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards, first, count = (b.column(k).to_numpy() for k in (1, 2, 3))
            for shard in np.unique(shards):
                rows = np.flatnonzero(shards == shard)
                yield from _digests(folder, width, int(shard), base[int(shard)], b.column(0).take(pa.array(rows)), first[rows], count[rows], key)

    # Keys meet the index file that holds them, and then the shard; both rows are a few numbers wide.
    found = keys.select(key).distinct().mapInArrow(with_part, f"part int, `{key}` {kind}").repartition(parts, "part").sortWithinPartitions("part")
    found = found.mapInArrow(find, f"`{key}` {kind}, shard int, first long, count long")
    near = found.repartition(max(len(base), 1), "shard").sortWithinPartitions("shard", "first")
    return near.mapInArrow(read, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long")


def _digests(folder: str, width: int, shard: int, base: int, keys: pa.Array, first: np.ndarray, count: np.ndarray, key: str) -> Iterator[pa.RecordBatch]:
    """The documents of some slots of one shard, ``READ_ROWS`` at a time, so that a key with very many takes no more memory;
    of these, runs of about ``READ_IDS`` ids are read at once."""
    ends = np.cumsum(count)
    for lo in range(0, int(ends[-1]), READ_ROWS):
        n = np.arange(lo, min(lo + READ_ROWS, int(ends[-1])))
        slot = np.searchsorted(ends, n, "right")
        place = first[slot] + n - (ends - count)[slot]
        low = int(place.min())
        at = _range(folder, f"shard-{shard:05d}.at", low * 8, (int(place.max()) - low + 2) * 8, "<i8")
        begin, end = at[place - low], at[place - low + 1]
        checks = np.zeros(len(place), np.int64)
        system, path = _place(folder, f"shard-{shard:05d}.ids")
        with system.open_input_file(path) as f:
            k = 0
            while k < len(place):
                # Rows are in the order of the file, so a run of them is one read.
                last = max(k + 1, int(np.searchsorted(end, begin[k] + READ_IDS, "right")))
                run = f.read_at(int(end[last - 1] - begin[k]) * width, int(begin[k]) * width)
                run = memoryview(np.frombuffer(run, f"<u{width}").astype("<u4").tobytes())  # checksums are of 32-bit ids
                for j in range(k, last):
                    checks[j] = zlib.crc32(run[int(begin[j] - begin[k]) * 4 : int(end[j] - begin[k]) * 4])
                k = last
        yield pa.RecordBatch.from_arrays([keys.take(pa.array(slot)), pa.array(begin + base), pa.array(end - begin), pa.array(checks)], [key, "start", "n_tokens", "ids_crc32"])


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: write all documents, and read them all back through the index."""
    folder = scratch_folder(docs.sparkSession, "token-files")
    write(docs, folder)
    return read_all(docs.sparkSession, folder, docs)
