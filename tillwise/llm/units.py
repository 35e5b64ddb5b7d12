"""Cutting texts, with a space before them, into units that tokenizers treat on their own.

A unit begins with a text or with a space that follows a character that is no white space. Byte-level
models with the usual word pattern cut there before they merge, and merge-type models whose pieces
hold spaces only in front never join across. So ids of a text are those of its units one after
another, and each distinct unit of a batch is worked on once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tillwise.llm import words as W

#: First two bytes of three-byte characters among which are white space and the sign for a space.
_BLANK_LEADS = (0xE19A, 0xE1A0, 0xE280, 0xE281, 0xE296, 0xE380)


@dataclass
class Units:
    """Units of a batch: ``inverse[first[i]:first[i + 1]]`` number those of text i among the distinct ones."""

    hashes: np.ndarray
    inverse: np.ndarray
    first: np.ndarray
    #: Of a distinct unit's first occurrence in the bytes of all texts.
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def text(self, which: np.ndarray) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode() for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]


def with_space(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each but the empty ones behind one space, and where each begins."""
    data, first = W.text_bytes(texts)
    full = np.diff(first) > 0
    data = np.insert(data, first[:-1][full], 32)
    return data, first + np.concatenate([[0], np.cumsum(full)])


def unit_starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where units begin; a text's first one with the text."""
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    before = data[at - 1]
    cut = before > 32
    wide = np.flatnonzero(before >= 0x80)  # a character that may be white space keeps the unit whole
    if len(wide):
        place = at[wide]
        one, two, three = (data[np.maximum(place - k, 0)].astype(np.uint32) for k in (1, 2, 3))
        blank = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
        cut[wide] = ~(blank | np.isin((three << np.uint32(8)) | two, _BLANK_LEADS))
    begins = first[:-1][np.diff(first) > 0]
    return np.union1d(at[cut], begins)


def units_of(texts: pa.Array) -> Units:
    data, first = with_space(texts)
    starts = unit_starts(data, first)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    hashes, once, inverse = np.unique(W.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
    return Units(hashes, inverse, np.searchsorted(starts, first, "left"), starts[once], ends[once], data)


class Known:
    """Numbers of the units a worker remembers, by hash."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.numbers = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] != hashes

    def add(self, hashes: np.ndarray) -> None:
        """Sorted hashes, none of them known; they get the next numbers."""
        at = np.searchsorted(self.hashes, hashes)
        numbers = np.arange(len(self.hashes), len(self.hashes) + len(hashes))
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes), np.insert(self.numbers, at, numbers)

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        return self.numbers[np.searchsorted(self.hashes, hashes)]
