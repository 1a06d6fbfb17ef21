"""Token ids of whole text columns by a public vocabulary, with each different word encoded once.

The vocabulary drops white space before it forms words, so a text's ids are those of its white-space separated parts in
order. ASCII capitals are folded by it too. A part of letters and then plain punctuation is two words to it; any other
part, and a text that holds one of its special strings, is left as it is. A word of letters that its rules neither change
nor cut goes to the vocabulary's merges at once; the rules are asked for these letters when the vocabulary is read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluice.llm import words, worker

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
#: Different words kept with their ids in a Python worker, some 40 bytes each; beyond it those go that were not met again.
KNOWN_WORDS = 500_000
CHUNK_BYTES = 1 << 20
#: Letters or digits and then plain punctuation, which the vocabulary's own rule cuts between.
TAIL = ",.;:!?*$%&#|<>=()/_-"
STEM_AND_TAIL = rf"^(?P<stem>[\p{{L}}\p{{N}}]+)(?P<tail>[{TAIL}]+)$"

#: A part that is one word to the vocabulary. Many go in one call, since the last token of a word is marked as such.
ONE_WORD = r"^\p{L}+$"
WORD_END = "</w>"
#: Where letters are looked for that the vocabulary's rules leave alone: Latin, Greek and Cyrillic.
ALPHABETS = range(0x61, 0x530)
#: Another order of the bytes, for a second hash of a word.
OTHER = np.random.default_rng(20_240_131).permutation(256).astype(np.uint8)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts; keeps the ids of words that it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.size = self._tokenizer.get_vocab_size()
        self._model, self._symbols = self._tokenizer.model, self._plain_letters()
        self._plain = f"^[{''.join(map(chr, self._symbols))}]+$"
        self._ends = np.array([(self._tokenizer.id_to_token(k) or "").endswith(WORD_END) for k in range(self.size)])
        self._clear()

    def _plain_letters(self) -> dict[int, str]:
        """Letters that the rules leave alone inside a word, and what the merges know each by."""
        symbols = {}
        for letter in map(chr, ALPHABETS):
            word = f"a{letter}a"
            cut = self._tokenizer.pre_tokenizer.pre_tokenize_str(word)
            if len(cut) == 1 and self._tokenizer.normalizer.normalize_str(word) == word:
                symbols[ord(letter)] = cut[0][0][1:-1]
        return symbols

    def _clear(self) -> None:
        # Words are known by two hashes, in order of the first; ids of the word at a place lie between two entries of _at.
        self._hash, self._check = np.zeros((2, 0), np.uint64)
        self._place = np.zeros(0, np.int32)
        self._again = np.zeros(0, bool)
        self._ids = np.zeros(0, np.uint32)
        self._at = np.zeros(1, np.int64)

    def chunks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of rows: all ids, and where each row's begin (one entry more than rows)."""
        for part in words.slices(texts, CHUNK_BYTES):
            yield self._encode(pc.fill_null(part, ""))

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        low = pc.ascii_lower(texts)
        special, data = pa.array(np.zeros(len(texts), bool)), words.buffer(low)[0].tobytes()
        for s in self._special:
            if s.lower().encode() in data:
                special = pc.or_(special, pc.match_substring(low, s.lower()))
        parts = pc.ascii_split_whitespace(pc.if_else(special, texts, low))
        n = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), out=n[1:])
        coded = parts.flatten().dictionary_encode()
        stripped = pc.equal(pc.binary_length(pc.ascii_rtrim(coded.dictionary, TAIL)), pc.binary_length(coded.dictionary))
        split = pc.extract_regex(pc.if_else(stripped, None, coded.dictionary), STEM_AND_TAIL)
        stem = pc.if_else(split.is_valid(), split.field("stem"), coded.dictionary)
        tail = pc.if_else(split.is_valid(), split.field("tail"), "")
        units = pa.concat_arrays([stem, tail]).dictionary_encode()
        unit = self._places(units.dictionary)[units.indices.to_numpy()].reshape(2, -1).T.ravel()
        ids, end = self._of(unit)
        # The ids of each different word, taken in the order of the texts.
        taken = pa.ListArray.from_arrays(pa.array(end[::2].astype(np.int32)), pa.array(ids)).take(coded.indices)
        return taken.flatten().to_numpy(), taken.offsets.to_numpy()[n].astype(np.int64)

    def _places(self, parts: pa.Array) -> np.ndarray:
        data, at = words.buffer(parts)
        own, check = (words.hashes(x, at[:-1], at[1:]) for x in (data, OTHER[data]))
        place = self._found(own, check)
        if (place < 0).any() and len(self._place) + (place < 0).sum() > KNOWN_WORDS:
            self._forget(int((place < 0).sum()))
            place = self._found(own, check)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = self._learned(parts.take(pa.array(new)))
            self._hash = np.concatenate([self._hash, own[new]])
            order = np.argsort(self._hash, kind="stable")
            self._hash = self._hash[order]
            self._check = np.concatenate([self._check, check[new]])[order]
            self._place = np.concatenate([self._place, place[new].astype(np.int32)])[order]
            self._again = np.concatenate([self._again, np.zeros(len(new), bool)])[order]
        return place

    def _of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words at some places, and where each word's begin."""
        size = self._at[place + 1] - self._at[place]
        at = np.zeros(len(place) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        return self._ids[np.arange(at[-1]) + np.repeat(self._at[place] - at[:-1], size)], at

    def _forget(self, new: int) -> None:
        """Drops words that were not met again since they were learned or last kept; all, if that frees less than a quarter
        or less than the new words need."""
        kept = np.flatnonzero(self._again)
        if len(kept) > min(KNOWN_WORDS * 3 // 4, KNOWN_WORDS - new):
            self._clear()
            return
        self._ids, self._at = self._of(self._place[kept])
        self._hash, self._check = self._hash[kept], self._check[kept]
        self._place = np.arange(len(kept), dtype=np.int32)
        self._again = np.zeros(len(kept), bool)

    def _found(self, own: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Places of words by their hashes, -1 for words that are not known."""
        if not len(self._hash):
            return np.full(len(own), -1)
        at = np.minimum(np.searchsorted(self._hash, own), len(self._hash) - 1)
        known = (self._hash[at] == own) & (self._check[at] == check)
        self._again[at[known]] = True
        return np.where(known, self._place[at], -1).astype(np.int64)

    def _learned(self, parts: pa.Array) -> np.ndarray:
        """Encodes words and gives their places."""
        plain, one = (pc.match_substring_regex(parts, x).to_numpy(zero_copy_only=False) for x in (self._plain, ONE_WORD))
        texts, rest = parts.to_numpy(zero_copy_only=False).tolist(), np.flatnonzero(~one & ~plain).tolist()
        letters, turn, ids, sizes = np.flatnonzero(one & ~plain).tolist(), [], [], []
        if some := np.flatnonzero(plain).tolist():
            got, ends = [], [0]
            for word in (texts[k] if texts[k].isascii() else texts[k].translate(self._symbols) for k in some):
                got += [t.id for t in self._model.tokenize(word)]
                ends.append(len(got))
            turn.append(some)
            ids.append(np.array(got, np.uint32))
            sizes.append(np.diff(ends))
        for i in range(0, len(letters), 2048):
            some = letters[i : i + 2048]
            got = np.array(self._tokenizer.encode(" ".join(texts[k] for k in some), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self._ends[got]) + 1
            if len(ends) == len(some):
                turn.append(some)
                ids.append(got)
                sizes.append(np.diff(ends, prepend=0))
            else:
                rest += some
        for i in range(0, len(rest), 2048):
            some = rest[i : i + 2048]
            got = [e.ids for e in self._tokenizer.encode_batch_fast([texts[k] for k in some], add_special_tokens=False)]
            turn.append(some)
            ids.append(np.array([x for own in got for x in own], np.uint32))
            sizes.append(np.array([len(own) for own in got]))
        place = np.empty(len(texts), np.int64)
        place[np.concatenate(turn)] = len(self._at) - 1 + np.arange(len(texts))
        self._ids = np.concatenate([self._ids, *ids])
        self._at = np.concatenate([self._at, self._at[-1] + np.cumsum(np.concatenate(sizes))])
        return place


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return worker.model(Encoder, path)
