"""Token ids of whole texts, each distinct word encoded once per worker.

Only for tokenizers that treat ASCII white space as nothing but a border of tokens.
"""

from __future__ import annotations

import os
import re
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import regex

WORD_BPE = "word_bpe_49k.json"
_ASCII_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: What the tokenizer splits a word into (its own pattern), used on Latin words only.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _byte_chars() -> list[str]:
    """The character that byte-level tokenizers write for each byte: itself if printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_BYTE_CHARS = _byte_chars()
#: Words whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 800_000


def words_of(text: str) -> list[str]:
    """Runs without ASCII white space; ``str.split`` where no other white space occurs."""
    if _ODD_SPACE.search(text):
        return [w for w in _ASCII_SPACE.split(text) if w]
    return text.split()


class WordIds:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(WORD_BPE))
        self.memory: dict[str, bytes] = {}
        self.model = self.tokenizer.model

    def _raw(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _part(self, part: str) -> bytes:
        """Ids of one lower case part, from the tokenizer's model alone."""
        got = self.memory.get(part)
        if got is None:
            word = part if part.isascii() else "".join(map(_BYTE_CHARS.__getitem__, part.encode()))
            got = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(word)])
            self.memory[part] = got
        return got

    def _unknown(self, words: list[str]) -> None:
        if len(self.memory) + 2 * len(words) > REMEMBERED:
            self.memory.clear()
        for w in words:
            if w[-1] < "\u0250" and max(w) < "\u0250" and min(w) >= " " and is_normalized("NFC", w):
                low = w.lower()
                if low.isalpha():
                    got = self._part(low)
                elif low[:-1].isalpha() and low[-1] in ".,;:!?":
                    got = self._part(low[:-1]) + self._part(low[-1])
                else:
                    got = b"".join(map(self._part, _PARTS.findall(low)))
            else:
                got = self._raw(w).tobytes()
            self.memory[w] = got

    def by_word(self, text: str | None) -> list[bytes]:
        """Ids of each word of a text."""
        words = words_of(text) if text else []
        found = list(map(self.memory.get, words))
        if None in found:
            unknown = list(dict.fromkeys(w for w, f in zip(words, found) if f is None))
            for i in range(0, len(unknown), REMEMBERED // 8):
                part = unknown[i:i + REMEMBERED // 8]
                self._unknown(part)
                at = dict(zip(part, map(self.memory.__getitem__, part)))
                found = [at.get(w) if f is None else f for w, f in zip(words, found)]
        return found

    def ids(self, text: str | None) -> bytes:
        if text and "<|" in text:  # names of special tokens stand for their ids, whatever surrounds them
            return self._raw(text).tobytes()
        return b"".join(self.by_word(text))
