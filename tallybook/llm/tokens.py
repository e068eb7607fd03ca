"""Token ids of whole texts from a public tokenizer file.

A byte-level tokenizer first cuts a text by a pattern of letters, digits, other signs and white
space, and never joins bytes across such a cut. Some of the cuts can be seen from two or three
bytes: at a single space or line feed between characters that are no white space, and between a
Latin letter and an ASCII sign. Texts are cut there, each distinct piece is encoded once by the
tokenizers library, and the ids are put together again by index. Words that the file adds to the
vocabulary are found before all else, so each is a piece of its own. The result is the library's own
for the whole text.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tallybook.llm.arrow_text import slices, text_buffer, word_hashes

# Memory for the pieces a worker remembers; when it is used up it forgets all and goes on.
REMEMBERED_BYTES = 64 << 20
# A slice's index arrays take some 25 times its bytes.
SLICE_BYTES = 1 << 21

# Two sets of factors for hashes of pieces that tell A from a.
_FACTORS = np.random.default_rng(20241108).integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LETTER, _SIGN, _LEAD, _WHITE, _UNSURE = 1, 2, 3, 4, 0
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _UNSURE
_KIND[ord("'")] = _UNSURE
_KIND[0x41:0x5B] = _LETTER
_KIND[0x61:0x7B] = _LETTER
# C3 leads the letters from U+00C0 on; C2 and E1 to E3 also lead white space outside ASCII.
_KIND[0xC3] = _LEAD
_KIND[[0x20, 0x0A]] = _WHITE


def added_words(data: np.ndarray, limits: np.ndarray, pattern: re.Pattern) -> list[tuple[int, int]]:
    """Start and end of each added word that lies within one row."""
    found, text, at = [], data.tobytes(), 0
    while match := pattern.search(text, at):
        start, at = match.span()
        if at <= limits[np.searchsorted(limits, start, "right")]:
            found.append((start, at))
        else:
            at = start + 1
    return found


def cuts(data: np.ndarray, limits: np.ndarray, pattern: re.Pattern | None = None) -> np.ndarray:
    """Places at which a piece begins, the start of every row that has text included."""
    n = len(data)
    kind = _KIND[data]
    # The second byte of a letter led by C3, but for the signs U+00D7 and U+00F7.
    second = np.flatnonzero(kind[:-1] == _LEAD) + 1
    kind[second] = np.where((data[second] == 0x97) | (data[second] == 0xB7), _UNSURE, _LETTER)
    printed = (kind == _LETTER) | (kind == _SIGN) | (kind == _LEAD)
    printed |= (data >= 0x30) & (data < 0x3A) | (data == 0x27)
    edge = np.zeros(n + 1, dtype=bool)
    edge[limits] = True
    # White space on its own, both neighbours in the same row and printed.
    alone = np.zeros(n, dtype=bool)
    alone[1:-1] = (kind[1:-1] == _WHITE) & printed[:-2] & printed[2:] & ~edge[1:-2] & ~edge[2:-1]
    cut = alone
    feed = alone & (data == 0x0A)
    sign = (kind[1:] == _SIGN) & (kind[:-1] == _LETTER)
    cut[1:] |= sign | feed[:-1]
    for start, end in added_words(data, limits, pattern) if pattern else ():
        cut[start + 1:end] = False
        cut[start] = True
        cut[end:end + 1] = True
    cut[limits[:-1][limits[1:] > limits[:-1]]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes batches of texts; one per worker process and tokenizer file."""

    def __init__(self, path: str):
        # A task has one core; the library's threads would take more, and memory each.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(x.lstrip or x.rstrip or x.single_word for x in added):
            raise ValueError(f"{path}: added words that depend on their surroundings are not supported")
        longest_first = sorted((x.content.encode() for x in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros((2, 0), np.uint64)  # two hashes of each piece, by the first
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes new pieces and puts them among the known ones; where each one's ids begin, and how many."""
        found, count = [], []
        for k in range(0, len(pieces), 1024):
            part = [x.ids for x in self.tokenizer.encode_batch_fast(pieces[k:k + 1024], add_special_tokens=False)]
            count.append(np.fromiter(map(len, part), np.int32, len(part)))
            found.append(np.fromiter(chain.from_iterable(part), np.int32, int(count[-1].sum())))
        count = np.concatenate(count)
        begin = len(self.ids) + np.cumsum(count, dtype=np.int64) - count
        self.ids = np.concatenate([self.ids, *found])
        order = np.argsort(hashes[0], kind="stable")
        at = np.searchsorted(self.known[0], hashes[0][order], "right")
        self.known = np.insert(self.known, at, hashes[:, order], axis=1)
        self.begin = np.insert(self.begin, at, begin[order])
        self.count = np.insert(self.count, at, count[order])
        return begin, count

    def _places(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin, and how many there are."""
        text, limits = text_buffer(distinct)
        hashes = np.stack([word_hashes(text, limits[:-1], limits[1:], x) for x in _FACTORS])
        if self.ids.nbytes + self.known.nbytes + self.begin.nbytes + self.count.nbytes > REMEMBERED_BYTES:
            self.forget()
        size = self.known.shape[1]
        at = np.minimum(np.searchsorted(self.known[0], hashes[0]), max(0, size - 1))
        alike = self.known[:, at] == hashes if size else np.zeros(hashes.shape, dtype=bool)
        there = alike.all(axis=0)
        if (alike[0] & ~there).any():  # another piece with the same first hash
            self.forget()
            there[:] = False
        new = np.flatnonzero(~there)
        begin, count = np.zeros(len(there), np.int64), np.zeros(len(there), np.int64)
        begin[there], count[there] = self.begin[at[there]], self.count[at[there]]
        if len(new):
            begin[new], count[new] = self._learn(hashes[:, new], distinct.take(pa.array(new)).to_pylist())
        return begin, count

    def encode(self, data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in sequence and the limits of each row in them."""
        rows = len(limits) - 1
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        starts = cuts(data, limits, self.added)
        edges = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts),
                                       [None, pa.py_buffer(edges), pa.py_buffer(data)])
        table = pieces.dictionary_encode()
        begin, lengths = (x[np.asarray(table.indices)] for x in self._places(table.dictionary))
        ends = np.cumsum(lengths)
        place = np.repeat(begin - ends + lengths, lengths)
        place += np.arange(len(place))
        before = np.concatenate([[0], ends])
        return self.ids[place], before[np.searchsorted(starts, limits)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def token_slices(column: pa.Array, path: str):
    """(first row, row after the last, ids, limits) for bounded runs of a batch's rows."""
    data, limits = text_buffer(column)
    for start, end in slices(limits, SLICE_BYTES):
        part = limits[start:end + 1]
        yield start, end, *encoder(path).encode(data[part[0]:part[-1]], part - part[0])
