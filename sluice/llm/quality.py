"""Quality rules from tokeniser fertility.

A public vocabulary that falls back to bytes is run over every whole text. Three measures say how well the text suits
the language that its script is used for: characters per token, the share of tokens that are bytes of unknown
characters, and the entropy of the text's own token counts. Each script has a band for each measure; a text outside one
is rejected. Plain counts of words, symbols, repeated lines and repeated word windows come with them.

Every row is judged by itself, so the work is one pass without a shuffle and a lost task is simply run again.

Edge cases: a null or empty text has zero counts and fails the base rules. Other columns, nulls in them included, are
never read. Repeated rows are judged alike. A very long text is encoded in pieces that end at single spaces, which gives
the same tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm import words, worker

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
PIECE_CHARS = 1 << 18

SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "other")
#: By script: fewest and most characters per token, largest share of byte tokens, least entropy as a share of what as
#: many different tokens could have. Production values; alphabets that the vocabulary hardly knows have wide bands.
BANDS = {
    "latin": (1.50, 6.5, 0.10, 0.50),
    "greek": (0.60, 6.5, 0.30, 0.40),
    "cyrillic": (0.90, 6.5, 0.20, 0.40),
    "hebrew": (0.50, 6.5, 0.60, 0.35),
    "arabic": (0.50, 6.5, 0.60, 0.35),
    "indic": (0.25, 6.5, 0.95, 0.30),
    "kana": (0.30, 6.5, 0.90, 0.35),
    "han": (0.30, 6.5, 0.95, 0.35),
    "hangul": (0.25, 6.5, 0.98, 0.30),
    "other": (0.25, 6.5, 1.00, 0.30),
}
#: Texts of fewer tokens say too little about a language.
MIN_TOKENS = 30

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
    "chars_per_token double, byte_share double, entropy double, script string, base_failed boolean, kept boolean"
)

_CONTINUED = (np.arange(256) & 0xC0) == 0x80
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))


def _lead_scripts() -> np.ndarray:
    """The script of a letter by the first byte of its UTF-8 form; -1 where it starts no letter."""
    out = np.full(256, -1, np.int8)
    for name, lead in (
        ("latin", [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]),
        ("greek", range(0xCD, 0xD0)),
        ("cyrillic", range(0xD0, 0xD4)),
        ("hebrew", range(0xD6, 0xD8)),
        ("arabic", range(0xD8, 0xDC)),
        ("indic", [0xE0]),
        ("kana", [0xE3]),
        ("han", range(0xE4, 0xEA)),
        ("hangul", range(0xEA, 0xEE)),
        ("other", [*range(0xCA, 0xCD), 0xD4, 0xD5, *range(0xDC, 0xE0), 0xE1, *range(0xF0, 0xF5)]),
    ):
        out[list(lead)] = SCRIPTS.index(name)
    return out


_LEAD = _lead_scripts()


def _counted(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[at])


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, repeated lines with a word, and words in repeated windows, of each text."""
    data, at = words.buffer(texts)
    n = len(at) - 1
    starts, ends, first = words.spans(data, at, words.NOT_SPACE)
    inside = words.NOT_SPACE[data]
    line_start, line_end, line_first = words.spans(data, at, np.arange(256) != 0x0A)
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=total[1:])
    filled = total[line_end] > total[line_start]
    text = words.of_text(line_first)[filled]
    lines = words.hashes(data, line_start[filled], line_end[filled])
    _, different = words.distinct_per_text(lines, text, n)

    runs, run_at = words.windows(words.hashes(data, starts, ends), first, WINDOW)
    runs = words.joined(words.of_text(first)[run_at].astype(np.uint64), runs)
    in_order = np.sort(runs)
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    repeated = np.zeros(len(starts) + 1, np.int64)
    if len(twice):
        place = np.searchsorted(twice, runs)
        again = run_at[twice[np.minimum(place, len(twice) - 1)] == runs]
        repeated[again] = 1
        np.subtract.at(repeated, again + WINDOW, 1)
    covered = np.cumsum(repeated[:-1]) > 0
    return {
        "n_words": np.diff(first),
        "word_chars": _counted(inside & ~_CONTINUED[data], at),
        "n_symbols": _counted(_SYMBOL[data], at),
        "n_dup_lines": np.bincount(text, minlength=n) - np.diff(different),
        "n_repeat_words": _counted(covered, first),
        "n_chars": _counted(~_CONTINUED[data], at),
        "script": _scripts(data, at),
    }


def _scripts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The script of most letters of each text; the first of the list where there are none."""
    met = np.unique(_LEAD[np.flatnonzero(np.bincount(data, minlength=256))])
    met = met[met >= 0]
    if len(met) < 2:
        return np.full(len(at) - 1, met[0] if len(met) else 0)
    lead = _LEAD[data]
    return met[np.argmax([_counted(lead == k, at) for k in met], axis=0)]


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """A text in parts that have its tokens: cut at a single space after ``most`` characters, which goes."""
    begin = 0
    while len(text) - begin > most:
        cut = begin + most
        while (cut := text.find(" ", cut)) >= 0 and (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace()):
            cut += 1
        if cut < 0 or cut + 1 >= len(text):
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


class Fertility:
    """Token measures by a vocabulary with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.get_piece_size()
        byte = np.array([self._model.is_byte(i) for i in range(size)])
        # White space has no piece of its own; its bytes say nothing about unknown characters.
        for b in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20):
            byte[self._model.piece_to_id(f"<0x{b:02X}>")] = False
        self._byte = byte

    def measure(self, text: str) -> tuple[int, int, float]:
        """Tokens, byte tokens, and the entropy of the token counts in bits."""
        n, unknown, count = 0, 0, np.zeros(0, np.int64)
        for part in pieces(text):
            ids = np.array(self._model.encode(part, num_threads=1), np.int64)
            here = np.bincount(ids)
            n += len(ids)
            unknown += int(self._byte[ids].sum())
            if len(here) > len(count):
                count, here = here, count
            count[: len(here)] += here
        share = count[count > 0] / max(n, 1)
        return n, unknown, float(-(share * np.log2(share)).sum()) + 0.0


def fertility(path: str) -> Fertility:
    """The worker's model of a vocabulary file."""
    return worker.model(Fertility, path)


def verdicts(texts: pa.Array, path: str, bands: dict = BANDS) -> dict[str, np.ndarray | list]:
    """All measures and both verdicts of each text."""
    out = base_counts(texts)
    model = fertility(path)
    got = [model.measure(t or "") for t in texts.to_pylist()]
    n = np.array([g[0] for g in got], np.int64)
    unknown, entropy = np.array([g[1] for g in got], np.int64), np.array([g[2] for g in got], float)
    script = out.pop("script")
    chars = out.pop("n_chars") / np.maximum(n, 1)
    share = unknown / np.maximum(n, 1)
    low, high, most, least = np.array([bands[s] for s in SCRIPTS]).T[:, script]
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    # As many different tokens as the text could have, at most 1,024: long texts repeat their common words.
    full = np.log2(np.clip(n, 2, 1024))
    strange = (n >= MIN_TOKENS) & ((chars < low) | (chars > high) | (share > most) | (entropy < least * full))
    return out | {
        "n_tokens": n, "chars_per_token": chars, "byte_share": share, "entropy": entropy,
        "script": [SCRIPTS[k] for k in script], "base_failed": failed, "kept": ~failed & ~strange,
    }


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, bands: dict = BANDS) -> DataFrame:
    """One row per document: its key, all measures, ``base_failed`` and ``kept``."""
    path = path or vocabulary_path()

    @worker.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_slices(batch):
                got = verdicts(part.column(1), path, bands)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, got.values())], [key, *got])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {MEASURES}")


def keep(docs: DataFrame, text: str = "text", path: str | None = None, bands: dict = BANDS) -> DataFrame:
    """The documents that pass, with their own columns."""
    path, place = path or vocabulary_path(), docs.columns.index(text)

    @worker.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _row_slices(batch, place):
                yield part.filter(pa.array(verdicts(part.column(place), path, bands)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def _row_slices(batch: pa.RecordBatch, place: int = 1) -> Iterator[pa.RecordBatch]:
    first = 0
    for part in words.slices(batch.column(place)):
        yield batch.slice(first, len(part))
        first += len(part)


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: base counts and verdicts of all documents."""
    return assess(docs)
