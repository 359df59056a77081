"""Token ids of a public BPE vocabulary inside a task, encoding each distinct word once.

The vocabulary drops white space and never merges across it, so the ids of a text are those
of its words in order. It also ignores case, and marks behind a word of letters are tokens of
their own; so texts are lower-cased and such marks split off before words are told apart, which
leaves a fraction of the distinct words. A worker keeps the words it has met, up to ``CACHED``.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tallystream.llm.words import KEPT

VOCABULARY = "word_bpe_49k.json"
CACHED = 350_000
LASTING = 220_000  # the first words met, mostly the frequent ones, stay
JOINED = 256

# Letters that lower-casing and NFC leave single letters.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įĲ-ɏ]+")
# Marks that form a token run of their own after a letter.
_MARKS = ".,:;!?*#$%&|"
_TAILED = rf"([{_LETTERS.pattern[1:-2]}])([{_MARKS}]+)([ \t-\r]|$)"


class WordEncoder:
    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, int] = {}
        self.start, self.length, self.flat = array("q"), array("q"), array("i")

    def _forget(self) -> None:
        self.known = {word: i for word, i in self.known.items() if i < LASTING}
        del self.flat[self.start[LASTING] :], self.start[LASTING:], self.length[LASTING:]

    def _add(self, word: bytes, ids) -> None:
        self.known[word] = len(self.start)
        self.start.append(len(self.flat))
        self.length.append(len(ids))
        self.flat.extend(ids)

    def _ids_of(self, word: bytes) -> array:
        i = self.known[word]
        return self.flat[self.start[i] : self.start[i] + self.length[i]]

    def _encode_each(self, words: list[bytes]) -> None:
        for word, encoded in zip(words, self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)):
            self._add(word, encoded.ids)

    def _encode_letters(self, words: list[str]) -> None:
        """Words of letters only give one run each, so joined ones can be told apart by the end mark."""
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = encoded.ids
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(part):
                self._encode_each([w.encode() for w in part])
                continue
            begin = 0
            for word, end in zip(part, cuts):
                self._add(word.encode(), ids[begin:end])
                begin = end

    def _learn(self, unknown: set[bytes]) -> None:
        cores, tails, compound, odd = set(), set(), [], []
        for word in unknown:
            text = word.decode()
            core = text.rstrip(_MARKS)
            if not _LETTERS.fullmatch(core):
                odd.append(word)
                continue
            low, tail = core.lower(), text[len(core) :]
            cores.add(low)
            if tail or low != text:
                compound.append((word, low.encode(), tail.encode()))
                tails.add(tail.encode())
        self._encode_letters([w for w in cores if w.encode() not in self.known])
        self._encode_each([w for w in tails if w and w not in self.known])
        for word, core, tail in compound:
            self._add(word, self._ids_of(core) + self._ids_of(tail) if tail else self._ids_of(core))
        self._encode_each([w for w in odd if w not in self.known])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has. Give it a few MB at a time."""
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), _TAILED, r"\1 \2\3"))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHED:
            self._forget()
        if unknown := set(distinct).difference(self.known):
            self._learn(unknown)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        start, length = np.frombuffer(self.start, np.int64)[at], np.frombuffer(self.length, np.int64)[at]
        upto = np.concatenate([[0], np.cumsum(length)])
        where = np.repeat(start - upto[:-1], length) + np.arange(upto[-1])
        ids = np.frombuffer(self.flat, np.int32)[where] if len(where) else np.empty(0, np.int32)
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return ids, np.diff(upto[edges])


def encoder(vocabulary: str = VOCABULARY) -> WordEncoder:
    """One per worker while it tokenizes. ``vocabulary``: a name in the public package, or a path."""
    if vocabulary not in KEPT:
        KEPT.clear()
        KEPT[vocabulary] = WordEncoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    return KEPT[vocabulary]
