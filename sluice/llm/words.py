"""Words of whole Arrow text columns as numpy arrays: where they start and end, and 64-bit hashes of them.

A column's texts lie one after another in one byte buffer, so every function here works on a buffer and the places where
texts begin in it (one more than there are texts). A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Multiplier of the polynomial hash and of the finishing steps: fixed odd numbers, any would do.
BASE = 0x9E3779B97F4A7C15
STEP = 0xBF58476D1CE4E5B9
LAST = 0x94D049BB133111EB
BLOCK = 1 << 16
CHUNK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of a word between white space.
NOT_SPACE = ~SPACE
#: Bytes of a word of digits, letters and everything beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins; the last entry is the end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[pa.Array]:
    """The column in runs of rows of at most ``most`` bytes, or of one row."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    end, first = np.cumsum(size), 0
    while first < len(texts):
        before = end[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(end, before + most, "right")))
        yield texts.slice(first, last - first)
        first = last


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes in ``inside``, and the number of runs before each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begin, stop = word.copy(), word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    stop[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, at)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(STEP)
    x ^= x >> np.uint64(27)
    x *= np.uint64(LAST)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(BASE, BLOCK), _powers(pow(BASE, -1, 1 << 64), BLOCK)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span: a polynomial over them, taken from one running sum over the buffer."""
    blocks = len(data) // BLOCK + 1
    up = _powers(pow(BASE, BLOCK, 1 << 64), blocks)
    down = _powers(pow(BASE, -BLOCK, 1 << 64), blocks)
    total = np.zeros(len(data) + 1, np.uint64)
    for i in range(blocks):
        part = data[i * BLOCK : (i + 1) * BLOCK]
        np.multiply(part.astype(np.uint64) + np.uint64(1), _UP[: len(part)] * up[i], out=total[1 + i * BLOCK : 1 + i * BLOCK + len(part)])
    np.cumsum(total, out=total)
    value = (total[ends] - total[starts]) * _DOWN[starts % BLOCK] * down[starts // BLOCK]
    return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(STEP))


def joined(*parts: np.ndarray) -> np.ndarray:
    """One hash of several in order."""
    out = parts[0]
    for x in parts[1:]:
        out = mixed(out * np.uint64(BASE) + x)
    return out


def windows(values: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and the index of their first word."""
    if len(values) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    whole = np.ones(len(values) - size + 1, bool)
    ends = first[1:]
    for k in range(1, size):
        cut = ends - k
        whole[cut[(cut >= 0) & (cut < len(whole))]] = False
    at = np.flatnonzero(whole)
    # A text of fewer than size words leaves only cut places; those that reach back into the text before are cut there too.
    return joined(*(values[k : k + len(whole)] for k in range(size)))[at], at


def of_text(first: np.ndarray) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def distinct_per_text(keys: np.ndarray, text: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of each text, ordered by text and key, and where each text's begin."""
    order = np.lexsort((keys, text)) if len(keys) else np.zeros(0, np.int64)
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], np.searchsorted(text[new], np.arange(texts + 1))


def joined_texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of the words numbered in ``word``, with one space between; text k has those from ``first[k]`` on."""
    size = ends[word] - starts[word]
    at = np.zeros(len(word) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    out = np.full(at[-1], 0x20, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[:-1], size) + within] = data[np.repeat(starts[word], size) + within]
    # The space after a text's last word goes.
    filled = first[1:] > first[:-1]
    keep = np.ones(len(out), bool)
    keep[at[first[1:][filled]] - 1] = False
    bounds = at[first] - np.append(0, np.cumsum(filled))
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(bounds), pa.py_buffer(out[keep])).cast(pa.string())
