"""Vectorised cutting and hashing of the words of an Arrow text column.

The byte buffer of a whole record batch is cut at once with numpy; a word is a maximal run of
bytes of one class. Nothing is decoded and no Python object is made per word. Words are named
by a 64-bit hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; bounds the temporary arrays to a few MB.
WINDOW = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """Another, independent hash of 64-bit hashes for each seed."""
    return mix(x + np.uint64((seed * 0xD1B54A32D192ED03 + 0x2545F4914F6CDD1D) & _MASK))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _powers(base: int) -> np.ndarray:
    out = np.full(WINDOW, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BASE), _powers(_BASE_INVERSE)

SPACE, LETTER, DIGIT, SYMBOL = 0, 1, 2, 3


def _classes(separators: bytes, fallback: int = LETTER) -> np.ndarray:
    table = np.full(256, fallback, np.uint8)
    table[list(separators)] = SPACE
    return table


#: ``[^\x20\x09-\x0D]+``: words between ASCII white space.
BLANK_WORDS = _classes(b" \t\n\x0b\x0c\r")
#: Runs of letters and digits (every byte from 0x80 on counts as a letter).
ALNUM_WORDS = _classes(bytes(c for c in range(128) if not chr(c).isalnum()))


def _units() -> np.ndarray:
    table = _classes(b" \t\n\x0b\x0c\r", SYMBOL)
    table[[c for c in range(256) if c >= 128 or chr(c).isalpha()]] = LETTER
    table[[ord(c) for c in "0123456789"]] = DIGIT
    return table


#: Runs of letters, of digits and of other signs; white space separates.
UNITS = _units()

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a batch in text order: ``hashes[first[i]:first[i + 1]]`` belong to row i."""

    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and each text's first byte; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.large_string():
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    first = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if data is None or first[-1] == first[0]:
        return np.zeros(0, np.uint8), first - first[0]
    return np.frombuffer(data, np.uint8)[first[0] : first[-1]], first - first[0]


def slices(batch: pa.RecordBatch, texts: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about so much text in column ``texts``.

    Arrays that are made per word or byte stay small, however large Spark's batches are.
    """
    ends = np.cumsum(np.diff(text_bytes(batch.column(texts))[1]))
    row = 0
    while row < batch.num_rows:
        to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + most_bytes, "right")))
        yield batch.slice(row, to - row)
        row = to


def pieces(batches: Iterable[pa.RecordBatch], texts: int = 0, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """All batches in ``slices``."""
    for batch in batches:
        yield from slices(batch, texts, most_bytes)


def spans(data: np.ndarray, first: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of all words; no word crosses from one text to the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes[data]
    change = np.empty(len(data) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[first] = True
    cuts = np.flatnonzero(change)
    word = kind[cuts[:-1]] != SPACE
    return cuts[:-1][word], cuts[1:][word]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial over byte codes from prefix sums, then mixed."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, begin + WINDOW, "right")))
        if ends[at] - begin > WINDOW:  # one huge word: piece by piece
            total = np.uint64(0)
            for k, low in enumerate(range(int(begin), int(ends[at]), WINDOW)):
                piece = hash_spans(data, np.array([low]), np.array([min(low + WINDOW, int(ends[at]))]), fold)
                total = seeded(total ^ piece, k)[0]
            out[at] = total
            at += 1
            continue
        part = data[begin : ends[to - 1]]
        codes = _BYTE_CODE[part if fold is None else fold[part]] * _POWERS[: len(part)]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(codes, out=sums[1:])
        s, e = starts[at:to] - begin, ends[at:to] - begin
        out[at:to] = mix((sums[e] - sums[s]) * _INVERSES[s] + (e - s).astype(np.uint64))
        at = to
    return out


def hashed_words(texts: pa.Array, classes: np.ndarray = BLANK_WORDS, fold: np.ndarray | None = None) -> Words:
    data, first = text_bytes(texts)
    starts, ends = spans(data, first, classes)
    return Words(hash_spans(data, starts, ends, fold), np.searchsorted(starts, first, "left"))


def row_chunks(first: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows with about ``most`` words together (a longer row stands alone)."""
    row, rows = 0, len(first) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(first, first[row] + most, "right")) - 1)
        yield row, min(to, rows)
        row = to


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for each i; zero for an empty segment."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return out
