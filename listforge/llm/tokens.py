"""Token ids of whole texts by a public tokenizer file, with a per-worker word cache.

The tokenizer (``word_bpe_49k.json``) drops white space and never joins across it, so the ids of a text are the ids of
its words one behind the other; words repeat, so most come from the cache. The cache is emptied when its bytes reach the bound; a word longer than
``KEEP`` isn't kept.
"""

from __future__ import annotations

import os
import unicodedata
from array import array

#: The cache of a worker: bytes of its words and ids, with what Python adds to each.
CACHE_BYTES, ENTRY_BYTES = 192 << 20, 200
KEEP = 4096
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def byte_characters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class WordIds(dict):
    """word (UTF-8 bytes) -> its ids as unsigned 32-bit bytes of a little-endian machine."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.alphabet = byte_characters()
        self.held = 0

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters: one pre-token, so that only the merges are left to do
            low = word.lower()
            ids = self.merged(word.decode()) if low == word else self[low]
        elif word[-1] in b",." and len(word) > 1 and word[-2] in _LETTERS and b"<|" not in word:
            ids = self[word[:-1]] + self[word[-1:]]  # a letter run and a punctuation run are separate pre-tokens
        else:
            ids = self.other(word)
        if len(word) <= KEEP:
            self.held += len(word) + len(ids) + ENTRY_BYTES
            if self.held > CACHE_BYTES:
                self.clear()
                self.held = len(word) + len(ids) + ENTRY_BYTES
            self[word] = ids
        return ids

    def merged(self, characters: str) -> bytes:
        return array("I", [t.id for t in self.merge(characters)]).tobytes()

    def other(self, word: bytes) -> bytes:
        """Words with more than ASCII letters in them."""
        s = word.decode("utf-8", "replace")
        if s.isalpha() and unicodedata.is_normalized("NFC", s):
            small = "".join(map(str.lower, s))
            if small == s:
                return self.merged("".join([self.alphabet[b] for b in word]))
            if small.isalpha() and unicodedata.is_normalized("NFC", small):
                return self[small.encode()]
        return array("I", self.encode(s, add_special_tokens=False).ids).tobytes()

    def text(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, raw.split()))


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's cache for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
