"""Exact token ids of whole texts, with a bounded cache of pre-token encodings.

The vocabulary file's own pre-tokeniser splits at white space and between
letters, digits and other characters, so the ids of a text are the ids of its
pre-tokens one after another. Words repeat, so each worker encodes a word once
and keeps its ids as little-endian uint32 bytes. Three paths give the same ids
as ``Tokenizer.encode`` (tested on every text of a table):

* texts of Latin-1 characters: lower-cased and split here by the same classes;
* other texts: cut at spaces and line ends, each part encoded by the library;
* texts holding ``<|`` (special-token strings): encoded whole by the library.
"""

from __future__ import annotations

import os
import re

import numpy as np

# The pre-token classes of the vocabulary file, for lower-cased Latin-1 text.
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = " \\t\\n\\x0b\\x0c\\r\u0085 "
# No two of the first three classes begin alike, so the most frequent one is tried first.
PRETOKEN = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACE}{_LETTER}{_NUMBER}]+")

ENTRY = 240  # bytes of a cached word beyond its characters and ids: two objects and its place in the table
SEGMENT = 1 << 20  # characters tokenised at a time: bounds the memory of one long text
_CUT = re.compile(r"[ \n]")


def _is_pretoken(word: str) -> bool:
    """Whether ``word`` is exactly one pre-token by the classes of lower-cased Latin-1 text."""
    return PRETOKEN.fullmatch(word) is not None and (word.isascii() or max(word) <= "\xff") and word == word.lower()


class WordIds(dict):
    """Word -> ids as bytes. An unknown word gets a place that ``fill`` fills with the rest of its group."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__()
        self.older = older
        self.waiting: list[tuple[str, bytearray]] = []

    def __missing__(self, word: str):
        known = self.older.get(word)
        if known is None:
            known = bytearray()
            self.waiting.append((word, known))
        self[word] = known
        return known


class TokenCache:
    """Encoder with a two-generation cache: at most ``2 * generation`` words of ``2 * held`` bytes, objects included, are kept."""

    def __init__(self, path: str, generation: int = 700_000, held: int = 128 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # words are kept here, not twice
        self.generation, self.held, self.size = generation, held, 0
        self.words = WordIds({})
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)  # ids that close a pre-token
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of many words. Those known to be one pre-token share one call: each closes with one word-end id.

        A part cut at spaces from a text that is not Latin-1 can hold no pre-token or several; it is encoded on its own.
        """
        single = [_is_pretoken(w) for w in words]
        if all(single):
            return self._joined(words)
        joined = iter(self._joined([w for w, one in zip(words, single) if one]))
        direct = iter(self._direct([w for w, one in zip(words, single) if not one]))
        return [next(joined if one else direct) for one in single]

    def _joined(self, words: list[str]) -> list[bytes]:
        fast = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(fast[0].ids, dtype="<u4")
        stop = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stop) != len(words):
            return self._direct(words)
        data, at = ids.tobytes(), [0, *stop.tolist()]
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _fill(self) -> None:
        """Encode the words met for the first time; lists that hold their places see the ids."""
        waiting, self.words.waiting = self.words.waiting, []
        for i in range(0, len(waiting), 5000):
            part = waiting[i:i + 5000]
            words = [w for w, _ in part]
            encoded = self._encoded(words)
            for (_, place), ids in zip(part, encoded):
                place[:] = ids
            self.words.update(zip(words, encoded))
            self.size += sum(map(len, words)) + sum(map(len, encoded)) + ENTRY * len(words)

    def _parts(self, text: str) -> list[str] | None:
        """Pre-tokens of a piece of text, or None when the library must see it whole."""
        if "<|" in text:
            return None
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return [p for p in _CUT.split(text) if p]
        return PRETOKEN.findall(text.lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        pieces: list[tuple[int, str]] = []
        for i, t in enumerate(texts):
            if len(t) <= SEGMENT or "<|" in t:
                pieces.append((i, t))
            else:
                pieces.extend((i, p) for p in segments(t))
        out: list[list[bytes]] = [[] for _ in texts]
        at = 0
        while at < len(pieces):
            group, size = [], 0
            while at < len(pieces) and (not group or size + len(pieces[at][1]) <= 2 * SEGMENT):
                group.append(pieces[at])
                size += len(pieces[at][1])
                at += 1
            look = self.words.__getitem__
            held = [None if words is None else list(map(look, words)) for words in (self._parts(p) for _, p in group)]
            self._fill()
            for (i, p), ids in zip(group, held):
                out[i].append(self._direct([p])[0] if ids is None else b"".join(ids))
            if len(self.words) > self.generation or self.size > self.held:
                self.words.older = {}
                self.words, self.size = WordIds(self.words), 0
        return [b[0] if len(b) == 1 else b"".join(b) for b in out]


def segments(text: str):
    """Cut a long text just before white space, which no token crosses."""
    at, n = 0, len(text)
    while at < n:
        end = at + SEGMENT
        if end < n:
            m = _CUT.search(text, end)
            end = m.start() if m else n
        else:
            end = n
        yield text[at:end]
        at = end


_CACHES: dict[str, TokenCache] = {}


def cache_for(path: str) -> TokenCache:
    """This worker's encoder for a vocabulary file; reused by later tasks of the worker."""
    if path not in _CACHES:
        _CACHES[path] = TokenCache(path)
    return _CACHES[path]


def release() -> None:
    """Give up this worker's encoders: for tasks that follow an encoding and have no use for its memory."""
    _CACHES.clear()
