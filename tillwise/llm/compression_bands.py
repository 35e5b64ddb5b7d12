"""Quality rules: compression bands.

A text is compressed with zstandard as a whole and in fixed chunks. The share of bytes left tells
repetitive text (too low) from noise (too high). Short texts hardly compress and long ones compress
better, so the limits depend on length: ``BANDS`` is a piecewise-linear curve over log2 of the
byte length. A text is kept if it passes the base rules and all its ratios lie in their bands.

Null texts have no words, like empty ones: they fail the base rules (fewer than 50 words) and are
not kept. Ids may be null or repeated; one row comes back for each row that goes in.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.words import pieces

#: (log2 of bytes, least ratio, greatest ratio); between the points the limits are interpolated.
#: They follow clean prose: texts of sf0.1 with quality 1 that are not held out and pass the base rules, their
#: beginnings of 200 to 9,000 bytes and their chunks. In each half octave the least ratio lies 0.007 or more
#: below the least of these (0.02 or more from 2^13 bytes on, where they are few), the greatest 0.015 or more
#: above their greatest. Beyond 2^15 bytes, where none is that long, the lower limit goes on falling.
BANDS = (
    (0, 0.0, 99.0), (7, 0.64, 0.92), (7.5, 0.633, 0.88), (8, 0.586, 0.85), (8.5, 0.537, 0.80), (9, 0.532, 0.74), (9.5, 0.513, 0.70),
    (10, 0.486, 0.62), (10.5, 0.468, 0.58), (11, 0.452, 0.55), (11.5, 0.441, 0.535), (12, 0.425, 0.503), (12.5, 0.415, 0.487),
    (13, 0.405, 0.474), (13.5, 0.395, 0.465), (14, 0.385, 0.456), (14.5, 0.375, 0.448), (15, 0.367, 0.448), (17, 0.335, 0.448), (20, 0.300, 0.448),
)
#: Bytes of a chunk; a last piece shorter than half of it is joined to the one before.
CHUNK_BYTES = 4096
#: A text is rejected if more than this share of its chunks is out of band.
MOST_BAD_CHUNKS = 0.25
LEVEL = 3
_SYMBOLS = b"#*$%&|<>"
_BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes that do not start a code point.
_CONTINUATION = bytes(range(0x80, 0xC0))

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, n_chunks long, n_bad_chunks long, in_band boolean"


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()  # bytes split at ASCII white space only
    word_chars = len(text.translate(None, _BLANKS + _CONTINUATION))
    n_symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.split()] if text.count(b"\n") else []
    n_dup_lines = len(lines) - len(set(lines))
    return len(words), word_chars, n_symbols, n_dup_lines, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    again = np.fromiter((found[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def band(n_bytes: int) -> tuple[float, float]:
    """Least and greatest ratio of a text or chunk of so many bytes."""
    x, low, high = zip(*BANDS)
    at = np.log2(max(n_bytes, 1))
    return float(np.interp(at, x, low)), float(np.interp(at, x, high))


def chunk_ends(n_bytes: int) -> list[int]:
    ends = list(range(CHUNK_BYTES, n_bytes, CHUNK_BYTES)) + [n_bytes]
    if len(ends) > 1 and n_bytes - ends[-2] < CHUNK_BYTES // 2:
        del ends[-2]
    return ends


def compression(text: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """Ratio of the whole text, chunks, chunks out of band, verdict."""
    if not text:
        return 0.0, 0, 0, False
    ratio = len(compressor.compress(text)) / len(text)
    low, high = band(len(text))
    whole = low <= ratio <= high
    start, bad, ends = 0, 0, chunk_ends(len(text))
    if len(ends) == 1:
        return ratio, 1, int(not whole), whole
    for end in ends:
        low, high = band(end - start)
        bad += not low <= len(compressor.compress(text[start:end])) / (end - start) <= high
        start = end
    return ratio, len(ends), bad, whole and bad <= MOST_BAD_CHUNKS * len(ends)


def measure_texts(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA for every row: base counts, compression ratios and the method's verdict."""

    def measured(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in pieces(batches, 1):
            rows = []
            for value in batch.column(1).cast(pa.binary()):
                data = value.as_py() or b""
                rows.append((*base_counts(data), *compression(data, compressor)))
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(measured, SCHEMA)


def judge_texts(documents: DataFrame) -> DataFrame:
    """Base counts, base_failed and kept for every row; the ratios follow."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure_texts(documents).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("in_band")).alias("kept"), "ratio", "n_chunks", "n_bad_chunks",
    )
