"""Token ids of whole texts with a public word-level BPE vocabulary.

The vocabulary's own splitting never crosses white space, so a text's ids are
those of its words in order.  A worker remembers the ids of the words it has
seen; a batch then is one dictionary look-up per word and one numpy gather.
Words of printable ASCII and Latin-1 letters go to the vocabulary's merge model
directly, all others through the complete tokenizer.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

from tickbars.llm.common import remembered

#: Words a worker remembers; past this the memory is emptied.
MEMORY = 600_000
#: Id that ends every document.
END = 0

_LETTER = "a-zß-öø-ÿ"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The vocabulary file's split pattern, for the characters of _PLAIN in lower case.
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^0-9{_LETTER}]+")


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class WordBpe(dict):
    """word (bytes) -> row of ``start`` and ``count`` in the flat list of ids."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        letters = byte_letters()
        self.table = [letters[b] for b in range(256)]
        self.pieces: dict[str, list[int]] = {}
        self.clear()

    def clear(self):
        super().clear()
        self.pieces.clear()
        self.flat, self.start, self.count = array("I", [END]), array("q", [0]), array("q", [1])
        self[b""] = 0  # the end of a document

    def __missing__(self, word: bytes) -> int:
        ids = self.ids(word.decode("utf-8"))
        row = self[word] = len(self.start)
        self.start.append(len(self.flat))
        self.count.append(len(ids))
        self.flat.extend(ids)
        return row

    def ids(self, word: str) -> list[int]:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            return self.whole.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for piece in _SPLIT.findall(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                shown = piece if piece.isascii() else "".join(self.table[b] for b in piece.encode())
                ids = self.pieces[piece] = [t.id for t in self.model.tokenize(shown)]
            out += ids
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with END after each, end position of each text)."""
        if len(self) > MEMORY:
            self.clear()
        words: list[bytes] = []
        ends = np.empty(len(texts), np.int64)
        for k, t in enumerate(texts):
            words += t.split()
            words.append(b"")
            ends[k] = len(words)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        flat, start, count = (np.array(x) for x in (self.flat, self.start, self.count))
        count = count[rows]
        upto = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(start[rows] - upto[:-1], count) + np.arange(upto[-1])
        return flat[at].astype("<u4"), upto[ends]


_LOADED: dict[str, WordBpe] = remembered("word bpe", {})


def word_bpe(path: str) -> WordBpe:
    """The worker's tokenizer of a vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
