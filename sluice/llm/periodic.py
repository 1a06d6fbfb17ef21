"""Periodic runs: stretches of words that repeat with a period, four times over or more.

A run is a stretch of words, as long as it can be, in which words a smallest period apart are equal. The steps for a column
of texts, whose words are numbered and lie in one array with a separator of its own after each text:

1. Harmonic grid. A run of at least four periods q holds some place i that is a multiple of q with i + q, i + 2q and i + 3q.
   For every q these places are n / q, so all of them are n log n, and three comparisons leave few.
2. Difference cover. In the texts that have such places only suffixes that begin at a residue of a perfect difference
   cover are sorted, by doubling of blocks as long as the cover's modulus. For any two places some shift below the modulus
   puts both on sorted suffixes. Longest common extensions compare the few words up to there, ask a sparse table for the
   least common prefix of the neighbours between both, and compare the words of the last block. The same on the reversed
   array extends to the left.
3. Extensions of each place give a run; of those with the same stretch the smallest period counts.

Every document is judged by itself: no shuffle, and a lost task runs again.

Edge cases: a null or empty text has no words and no run. Rows that repeat an id are judged each. A very long text is
handled as a whole, in n log n time. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import words, worker

TIMES = 4
LEAST = 6
#: A perfect difference cover: every difference modulo 31 is that of two of these six.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Places of the grid that are compared at once.
GRID = 1 << 19
#: Pairs that are extended at once.
PAIRS = 1 << 12


def _shifts() -> np.ndarray:
    """For two residues the least shift that takes both into the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    return np.array([[next(d for d in range(MODULUS) if inside[a + d] and inside[b + d]) for b in range(MODULUS)] for a in range(MODULUS)])


_SHIFT = _shifts()
_PLACE = np.full(MODULUS, -1)
_PLACE[list(COVER)] = np.arange(len(COVER))


class Extension:
    """Longest common extensions to the right in an array of numbers that ends with one that is nowhere else."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        blocks = n // MODULUS + 1
        self._n = n
        self._codes = np.append(codes, np.full(2 * MODULUS, -1, codes.dtype))
        at = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        at = at[at < n]
        rank, step = self._block_ranks(at, int(codes.max()) + 2), len(COVER)
        levels = [rank]
        while int(rank.max()) < len(at) - 1 and step < 2 * len(at):
            after = np.zeros_like(rank)
            after[: max(len(at) - step, 0)] = rank[step:] + 1
            _, rank = np.unique(rank * (len(at) + 1) + after, return_inverse=True)
            levels.append(rank)
            step *= 2
        self._rank = rank
        order = np.empty(len(at), np.int64)
        order[rank] = np.arange(len(at))
        self._least = self._sparse(self._neighbours(order, levels))

    def _block_ranks(self, at: np.ndarray, most: int) -> np.ndarray:
        """Order of the blocks at some places: as many words in a number as fit, and these in turn."""
        bits = most.bit_length()
        fit = 62 // bits
        keys = []
        for first in range(0, MODULUS, fit):
            key = np.zeros(len(at), np.int64)
            for k in range(first, min(first + fit, MODULUS)):
                key = (key << bits) | (self._codes[at + k] + 1)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    @staticmethod
    def _neighbours(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """How many whole blocks neighbours in order have in common."""
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(len(order) - 1, 0), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            rank, inside = np.append(levels[k], -1), len(order)
            same = (a < inside) & (b < inside) & (rank[np.minimum(a, inside)] == rank[np.minimum(b, inside)])
            common[same] += 1 << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        return common

    @staticmethod
    def _sparse(values: np.ndarray) -> list[np.ndarray]:
        table, width = [values], 1
        while 2 * width <= len(values):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def _compared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from two places on, up to the modulus."""
        steps = np.arange(MODULUS)
        same = self._codes[np.minimum(i, self._n)[:, None] + steps] == self._codes[np.minimum(j, self._n)[:, None] + steps]
        return np.where(same.all(axis=1), MODULUS, same.argmin(axis=1))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from places ``i`` and ``j`` on, which differ."""
        shift = _SHIFT[i % MODULUS, j % MODULUS]
        out = self._compared(i, j)
        far = np.flatnonzero(out >= shift)
        a, b = i[far] + shift[far], j[far] + shift[far]
        # Beyond the end there is nothing more to compare.
        inside = (a < self._n) & (b < self._n)
        far, a, b = far[inside], a[inside], b[inside]
        one, two = (self._rank[x // MODULUS * len(COVER) + _PLACE[x % MODULUS]] for x in (a, b))
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp((high - low).astype(float))[1] - 1
        blocks = np.zeros(len(far), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            table = self._least[k]
            blocks[of] = np.minimum(table[low[of]], table[high[of] - (1 << int(k))])
        beyond = blocks * MODULUS
        out[far] = shift[far] + beyond + self._compared(a + beyond, b + beyond)
        return out


def _grid(codes: np.ndarray, text: np.ndarray, longest: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods with equal words at ``times`` places of the grid in a row, in one text."""
    places, periods, q, n = [], [], 1, len(codes)
    most = longest // times
    while q <= most:
        last = q
        total = n // q + 1
        while last < most and total + n // (last + 1) + 1 <= GRID:
            last += 1
            total += n // last + 1
        every = np.arange(q, last + 1)
        size = np.maximum((n - 1 - (times - 1) * every) // every + 1, 0)
        period = np.repeat(every, size)
        place = (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)) * period
        for k in range(1, times):
            same = codes[place] == codes[place + k * period]
            place, period = place[same], period[same]
        same = text[place] == text[place + (times - 1) * period]
        places.append(place[same])
        periods.append(period[same])
        q = last + 1
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, periods))


def _separated(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of words with one of its own before each text and one at the end; the text of each place, and where each
    text begins."""
    n, texts = len(codes), len(first) - 1
    begin = first + np.arange(1, texts + 2)
    out = np.empty(n + texts + 1, np.int64)
    out[begin - 1] = codes.max(initial=-1) + 1 + np.arange(texts + 1)
    of = words.of_text(first)
    out[np.arange(n) + of + 1] = codes
    text = np.append(np.repeat(np.arange(texts), np.diff(first) + 1), texts)
    return out, text, begin


def find(codes: np.ndarray, first: np.ndarray, times: int = TIMES, least: int = LEAST) -> np.ndarray:
    """Text, start, length and period of every run, in this order, of texts of numbered words; text k has those from
    ``first[k]`` on."""
    size = np.diff(first)
    nothing = np.zeros((0, 4), np.int64)
    if not len(codes):
        return nothing
    every, text, begin = _separated(codes, first)
    place, period = _grid(every, text, int(size.max()), times)
    if not len(place):
        return nothing
    # From here on only the texts that have such places.
    chosen = np.unique(text[place])
    keep = np.zeros(len(size), bool)
    keep[chosen] = True
    own = codes[keep[words.of_text(first)]]
    own_first = np.append(0, np.cumsum(size[chosen]))
    rank = np.searchsorted(chosen, text[place])
    text_of = chosen[rank]
    codes, text, own_begin = _separated(np.unique(own, return_inverse=True)[1], own_first)
    place = place - begin[text_of] + own_begin[rank]
    right, left, n = Extension(codes), Extension(codes[::-1].copy()), len(codes)
    runs = []
    for k in range(0, len(place), PAIRS):
        i, q = place[k : k + PAIRS], period[k : k + PAIRS]
        after, before = right.common(i, i + q), left.common(n - i, n - i - q)
        runs.append(np.stack([text_of[k : k + PAIRS], i - before - own_begin[rank[k : k + PAIRS]], before + after + q, q], axis=1))
    found = np.unique(np.concatenate(runs), axis=0)
    found = found[found[:, 2] >= np.maximum(least, times * found[:, 3])]
    # Rows are in order, so of a stretch the smallest period comes first; a run's start and length say what stretch it is.
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """One row per document: its key, ``n_words``, ``runs`` by start and period, and its words but those that a run has after
    its first period, joined by spaces, as ``collapsed``."""
    kind = docs.schema[key].dataType.simpleString()

    @worker.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(1)):
                data, at = words.buffer(part)
                starts, ends, first = words.spans(data, at, words.NOT_SPACE)
                codes = np.unique(words.hashes(data, starts, ends), return_inverse=True)[1]
                found = find(codes, first, times, least)
                edge = np.zeros(len(codes) + 1, np.int64)
                begin = first[found[:, 0]] + found[:, 1]
                np.add.at(edge, begin + found[:, 3], 1)
                np.add.at(edge, begin + found[:, 2], -1)
                kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                collapsed = words.joined_texts(data, starts, ends, kept, np.searchsorted(kept, first))
                bounds = np.searchsorted(found[:, 0], np.arange(len(first)))
                listed = pa.StructArray.from_arrays([pa.array(found[:, k].copy()) for k in (1, 2, 3)], ["start", "length", "period"])
                of_text = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), listed)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(np.diff(first)), of_text, collapsed], [key, "n_words", "runs", "collapsed"])
                done += len(part)

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {RESULT}")


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents with the texts that the contract judges: in a tenth of them, by the checksum of the id, the words from some
    place on repeat those that follow it."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("int")
    own = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, own).alias("w"))
    n = F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    planted = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), n - F.col("a")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def _line(run: Column) -> Column:
    return F.concat(F.concat_ws(",", *(run[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: the longest run and checksums of all runs and of what is left of every document."""
    found = runs(with_periods(docs))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr("-longest.start").alias("start"),
        F.col("longest.length").alias("length"), F.expr("-longest.period").alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", _line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
