"""Numbers that describe the passages of texts, from their bytes, for many texts at a time.

A passage is a line, or a part of PART bytes of a longer line. Nothing here is language-bound.
"""

from __future__ import annotations

import string

import numpy as np

PART = 1024
_WORD_REACH = 32  # bytes of a word that take part in its hash by place; later ones share the last


def _classes() -> tuple[np.ndarray, int]:
    """A class for every byte: white space, letters, digits, each ASCII mark, UTF-8 starts and rest."""
    out = np.zeros(256, dtype=np.int64)
    marks = string.punctuation
    for b in range(256):
        c = chr(b)
        if b in b" \t\r\v\f\n":
            out[b] = 0
        elif c in string.ascii_lowercase:
            out[b] = 1
        elif c in string.ascii_uppercase:
            out[b] = 2
        elif c in string.digits:
            out[b] = 3
        elif c in marks:
            out[b] = 8 + marks.index(c)
        elif b < 128:
            out[b] = 4
        else:
            out[b] = 5 if b < 0xC0 else 6 if b < 0xE0 else 7
    return out, 8 + len(marks)


CLASS, CLASSES = _classes()
FEATURES = CLASSES + 5
_ZOBRIST = np.random.default_rng(3).integers(0, 2**63, (_WORD_REACH, 256)).astype(np.uint64)


class Passages:
    """The passages of a batch of texts and their words.

    owner: text of each passage, ascending, every text has one at least. features: a row for each
    passage. words: hashes of the words in order; stems: hashes of their first four bytes; word_owner:
    the text of each word.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        data = np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", dtype=np.uint8)
        text_start = np.cumsum(sizes) - sizes
        # a passage starts at a text, after a line feed, and at every PART bytes of a line
        line_start = np.unique(np.concatenate([text_start, np.flatnonzero(data == 10) + 1]))
        line_start = line_start[line_start < len(data)]
        line_size = np.diff(np.append(line_start, len(data)))
        parts = np.maximum(1, -(-(line_size - 1) // PART))
        first = np.repeat(line_start, parts)
        nth = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = first + nth * PART
        self.owner = np.searchsorted(text_start, start, side="right") - 1
        size = np.diff(np.append(start, len(data)))
        passage = np.repeat(np.arange(len(start)), size)

        kind = CLASS[data]
        counts = np.bincount(passage * CLASSES + kind, minlength=len(start) * CLASSES)
        shares = counts.reshape(-1, CLASSES) / np.maximum(size, 1)[:, None]

        solid = kind != 0
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        word_start = np.flatnonzero(begins)
        at = np.flatnonzero(solid)
        word_of = np.cumsum(begins)[at] - 1
        place = np.minimum(at - word_start[word_of], _WORD_REACH - 1) if len(at) else at
        value = _ZOBRIST[place, data[at]]
        offsets = np.searchsorted(at, word_start)
        if len(word_start):
            self.words = np.add.reduceat(value, offsets)
            self.stems = np.add.reduceat(np.where(place < 4, value, np.uint64(0)), offsets)
        else:
            self.words = self.stems = np.zeros(0, dtype=np.uint64)
        home = passage[word_start]
        self.word_owner = self.owner[home]
        n = np.bincount(home, minlength=len(start))
        same = np.zeros(len(word_start), dtype=bool)
        same[1:] = (self.words[1:] == self.words[:-1]) & (home[1:] == home[:-1])
        repeats = np.bincount(home, weights=same, minlength=len(start))
        pair = np.sort((home.astype(np.uint64) << np.uint64(32)) | (self.words >> np.uint64(32)))
        fresh = np.ones(len(pair), dtype=bool)
        fresh[1:] = pair[1:] != pair[:-1]
        distinct = np.bincount((pair[fresh] >> np.uint64(32)).astype(np.int64), minlength=len(start))
        many = np.maximum(n, 1)
        solid_bytes = np.bincount(passage, weights=solid, minlength=len(start))
        self.features = np.column_stack([
            shares, np.log1p(n), solid_bytes / many / 10, distinct / many, repeats / many, n == 0])

    def texts_mean(self, count: int) -> np.ndarray:
        """The mean of each text's passages."""
        total = np.zeros((count, self.features.shape[1]))
        np.add.at(total, self.owner, self.features)
        return total / np.maximum(1, np.bincount(self.owner, minlength=count))[:, None]


def sections(texts: list[bytes], most: int = 1 << 19) -> list[tuple[int, int]]:
    """Ranges of texts of at most `most` bytes together, or of one longer text."""
    out, start, held = [], 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            out.append((start, i))
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        out.append((start, len(texts)))
    return out
