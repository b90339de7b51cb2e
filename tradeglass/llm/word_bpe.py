"""Token ids of a word-level BPE tokenizer file, word by word.

The tokenizer lower-cases, cuts text at white space and merges each word by itself, so the ids of a text are
those of its words.  Most words come again and again: each Python worker keeps the ids of words met last, in
a table of bounded size.  Words of printable ASCII and Latin-1 letters are cut and merged here by the
tokenizer's model; any other word goes through the whole tokenizer.  A part of a cut word is a word of its own,
with the same ids, so one table serves both.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import numpy as np
import regex
from tokenizers import Tokenizer

# Words whose ids a worker keeps, and as many again that it met before those.
CACHED = 1 << 18
# Fixed value: how the tokenizer cuts a lower-cased word.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# White space for Python only: the tokenizer does not cut there.
_CONTROL = "\x1c\x1d\x1e\x1f"
_PAIR = struct.Struct("<H").pack


def _letters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Made(dict):
    """Results of a function, made when first asked for.  A full table becomes the older one, and words that
    are asked for again move back from there."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.older = dict(self)
            self.clear()
        made = self.older.pop(word, None)
        if made is None:
            made = self.make(word)
        self[word] = made
        return made


class WordBPE:
    """ids of texts, as little-endian 16-bit numbers."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.model = self.tokenizer.model
        self.letters = _letters()
        self._words = _Made(self._word)

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _CONTROL):
            return self._whole(text)
        return b"".join(map(self._words.__getitem__, text.split()))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii() and not _PLAIN.fullmatch(word):
            return self._whole(word)
        known = self._words
        low = word.lower()
        # Mostly letters, and perhaps a mark at the end: then nothing has to be searched for.
        letters = low if low.isalpha() else low[:-1]
        if letters.isalpha():
            mark = low[len(letters) :]
            if not mark.isalnum():
                if mark:
                    return known[letters] + known[mark]
                return known[letters] if letters != word else self._part(word)
        parts = _PARTS.findall(low)
        return b"".join([known[part] if part != word else self._part(part) for part in parts])

    def _part(self, part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return b"".join([_PAIR(token.id) for token in self.model.tokenize(spelled)])


_loaded: dict[str, WordBPE] = {}


def loaded(definition: str) -> WordBPE:
    """The tokenizer of a definition, built once in each Python worker."""
    if definition not in _loaded:
        _loaded[definition] = WordBPE(definition)
    return _loaded[definition]
