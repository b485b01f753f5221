"""Encoding of many texts with a tokenizer file, word by word with a bounded memory of words."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

#: Words that each of the two halves of the memory holds.
REMEMBERED = 200_000

_TAIL = re.compile(r"^([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)$")


def _byte_names() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 as is, the others from 256 up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """Ids of whole texts for a tokenizer that drops white space, so that words can be encoded one by one.

    ``ordinary_specials`` reads the strings of special tokens in a text as ordinary text. Words of letters with
    punctuation after them skip normaliser and splitter: their parts go to the library's model directly. All others
    go through the library as they are. :meth:`encode` gives ids in the smallest unsigned type that fits.
    """

    def __init__(self, path: str, ordinary_specials: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = ordinary_specials
        spec = json.loads(self._tokenizer.to_str())
        self._direct = "Lowercase" in str(spec["normalizer"]) and "ByteLevel" in str(spec["pre_tokenizer"])
        if "Removed" not in str(spec["pre_tokenizer"]):
            raise ValueError("this tokenizer keeps white space; its words can't be encoded one by one")
        self.size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._names = _byte_names()
        self._code = next(c for c in "HIL" if array(c).itemsize == self.dtype.itemsize)
        self._model = self._tokenizer.model
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _part(self, part: str) -> list[int]:
        named = part if part.isascii() else "".join(map(self._names.__getitem__, part.encode()))
        return [t.id for t in self._model.tokenize(named)]

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        match = _TAIL.match(text) if self._direct else None
        # a letter whose lower case depends on its place, or is longer, is left to the library
        if match and match[1].isalpha() and (text.isascii() or unicodedata.is_normalized("NFC", text) and "Σ" not in text and "İ" not in text):
            head, tail = match.groups()
            ids = self._part(head.lower())
            if tail:
                ids += self._part(tail)
        else:
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return self._bytes(ids)

    def encode(self, text: bytes) -> bytes:
        """Ids of one UTF-8 text as little-endian bytes of ``dtype``."""
        words, young, old = text.split(), self._young, self._old
        for word in set(words).difference(young):
            young[word] = old.get(word) or self._word(word)
        out = b"".join(map(young.__getitem__, words))
        if len(young) > REMEMBERED:
            self._old, self._young = young, {}
        return out


@lru_cache(maxsize=2)
def encoder(path: str, ordinary_specials: bool = False) -> WordEncoder:
    """One encoder per Python worker and tokenizer, so that its memory serves all tasks of the worker."""
    return WordEncoder(path, ordinary_specials)
