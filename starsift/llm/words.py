"""Exact tokenization of texts from a memo of their words.

For these tokenizers white space ends a token, is itself dropped, and neither
normalization nor added tokens reach across it. So a position between an ASCII
space, tab or line end and another character is a proven stable cut: the ids of a
text are the ids of its words, one after the other.
"""

from __future__ import annotations

import os
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of the younger half of a memo; with the older half, at most twice as many are held,
#: some 140 bytes each.
MEMO_WORDS = 250_000
ID_BYTES = array("i").itemsize
#: Longer words are encoded and not kept.
MEMO_CHARS = 64


def load_tokenizer(path: str):
    """A tokenizer file without truncation and padding, once for each worker process."""
    tokenizer = _LOADED.get(path)
    if tokenizer is None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _LOADED[path] = tokenizer
    return tokenizer


_LOADED: dict[str, object] = {}
_MEMOS: dict[tuple[str, int], WordMemo] = {}


def word_memo(path: str, entries: int | None = None) -> WordMemo:
    """The memo of this worker process for a tokenizer file and a number of entries."""
    key = (path, entries or MEMO_WORDS)
    if key not in _MEMOS:
        _MEMOS[key] = WordMemo(*key)
    return _MEMOS[key]


class WordMemo:
    """Word -> ids, encoded by the library in batches, with a bound on the entries held.

    Ids are kept as native 32-bit integers in one bytes object. Two generations: a
    word found in the older one moves to the younger; when the younger is full, it
    becomes the older one and what was not used again goes.
    """

    def __init__(self, path: str, entries: int | None = None):
        self.entries = entries or MEMO_WORDS
        self.tokenizer = load_tokenizer(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the younger generation lacks."""
        found, new = {}, []
        for w in words:
            ids = self.old.get(w)
            if ids is None:
                new.append(w)
            else:
                found[w] = ids
        for at in range(0, len(new), 1024):
            part = new[at : at + 1024]
            texts = [w.decode("utf-8", "replace") for w in part]
            encodings = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for w, e in zip(part, encodings, strict=True):
                found[w] = array("i", e.ids).tobytes()
        return found

    def lookup(self, words: list[bytes]) -> dict[bytes, bytes]:
        """A mapping that holds every one of the words."""
        missing = set(words).difference(self.young)
        if not missing:
            return self.young
        found = self._learn(list(missing))
        if len(self.young) + len(found) > self.entries:
            used = {w: self.young[w] for w in set(words) if w in self.young}
            self.old, self.young = self.young, {}
            found.update(used)
        kept = {w: ids for w, ids in found.items() if len(w) <= MEMO_CHARS}
        if len(kept) == len(found) and len(kept) <= self.entries:
            self.young.update(kept)
            return self.young
        both = {**self.young, **found}
        self.young.update(dict(list(kept.items())[: self.entries]))
        return both

    def encode(self, text: bytes) -> bytes:
        """The ids of a text, one after the other, as 32-bit integers."""
        words = text.split()
        out = list(map(self.young.get, words))
        if None in out:
            out = list(map(self.lookup(words).__getitem__, words))
        return b"".join(out)

    def count(self, text: bytes) -> int:
        return len(self.encode(text)) // ID_BYTES
