"""Token-ID output: directly addressable codes.

An id is cut into bytes, lowest first. Level 0 holds the lowest byte of every id; a bitmap tells
which ids go on, and the next level holds the next byte of just those. A rank directory over each
bitmap counts the set bits before every 512th, so that the place of any id in every level is found
with one directory entry and a few bytes of bitmap: any token is read without decoding others.

Files: a Parquet table of segments, one binary payload each (layout below), written by Spark to a
folder that any of its file systems can hold. Segments hold whole documents in ascending id order,
with about ``SEGMENT_TOKENS`` tokens each. ``part`` and ``seq`` order them.

Payload, little-endian: magic ``DAC1``; uint32 documents; uint64 tokens; uint32 levels; uint64
document starts (documents + 1); doc ids as int64 and a byte each (1: null); then for each level
uint64 count, the bytes, the bitmap and the directory (absent in the last level).

Null texts count as empty: they have the end id alone. Null ids sort first. Rows with equal ids
stay separate documents, in the order of a hash of their text and then of the text; they, too, are dealt
out over many tasks. Strings of special tokens in a text are read as the library reads them.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.tables import shared_folder

END_ID = 1
SEGMENT_TOKENS = 1 << 20
#: Texts encoded at a time.
CHUNK_BYTES = 8 << 20
#: Words whose ids a Python worker remembers; when full it starts anew.
CACHE_WORDS = 2_000_000
RANK_BITS = 512
MAGIC = b"DAC1"
_BITS_IN_BYTE = np.array([bin(b).count("1") for b in range(256)], np.uint8)

SCHEMA = "part int, seq int, n_docs int, n_tokens long, payload binary"


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space.

    Such a tokenizer gives a text the ids of its blank-separated words one after another, so each
    distinct word is encoded once. No special token holds white space, so those within a text are
    read word by word as well. Another tokenizer is refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self._check()
        self._forget()

    def _check(self) -> None:
        """Whether texts of several words have the ids of their words, whatever blanks are between them."""
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        words = ["a", "the", "x7,", "don't", *specials]
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        apart = [i for w in words for i in ids(w)]
        if any(any(c.isspace() for c in t) for t in specials) or any(ids(blank + blank.join(words) + blank) != apart for blank in (" ", "  ", "\n", "\t \r\n")):
            raise ValueError(f"{self.path}: ids of a text are not those of its words")

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted
        self.place = np.zeros(0, np.int64)  # of a known word in starts
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.known) + len(hashes) > CACHE_WORDS:
            self._forget()
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        place = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(words))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.uint32)])
        at = np.searchsorted(self.known, hashes)
        self.place = np.insert(self.place, at, place)
        self.known = np.insert(self.known, at, hashes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and each text's first one."""
        data, offsets = W.text_bytes(texts)
        starts, ends = W.spans(data, offsets, W.BLANK_WORDS)
        first = np.searchsorted(starts, offsets, "left")
        hashes, once, inverse = np.unique(W.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > CACHE_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            raw = data.tobytes()
            self._learn(hashes[new], [raw[s:e].decode() for s, e in zip(starts[once[new]].tolist(), ends[once[new]].tolist())])
        place = self.place[np.searchsorted(self.known, hashes)]
        length = np.diff(self.starts)[place][inverse] if len(hashes) else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(length)])
        take = np.arange(before[-1]) + np.repeat(self.starts[:-1][place][inverse] - before[:-1], length) if len(hashes) else np.zeros(0, np.int64)
        return self.ids[take], before[first]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One for each worker process: its cache serves all tasks that the process runs."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pack_segment(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """The payload of documents with ``ids[starts[k]:starts[k + 1]]``."""
    levels, rest = [], np.ascontiguousarray(ids, "<u4")
    while True:
        more = rest >= 256
        levels.append((rest.astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [MAGIC, struct.pack("<IQI", len(doc_ids), len(ids), len(levels)), starts.astype("<u8").tobytes()]
    out += [np.array([i or 0 for i in doc_ids], "<i8").tobytes(), bytes(i is None for i in doc_ids)]
    for k, (low, more) in enumerate(levels):
        out += [struct.pack("<Q", len(low)), low.tobytes()]
        if k < len(levels) - 1:
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(_BITS_IN_BYTE[bits], np.arange(0, len(bits), RANK_BITS // 8), dtype=np.uint64)
            out += [bits.tobytes(), np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4").tobytes()]
    return b"".join(out)


class Segment:
    """Random access to a payload; nothing is decoded up front."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.n_docs, self.n_tokens, n_levels = struct.unpack_from("<IQI", payload, 4)
        at = 20
        self.starts = np.frombuffer(payload, "<u8", self.n_docs + 1, at).astype(np.int64)
        at += 8 * (self.n_docs + 1)
        values = np.frombuffer(payload, "<i8", self.n_docs, at)
        nulls = payload[at + 8 * self.n_docs : at + 9 * self.n_docs]
        self.doc_ids = [None if null else int(v) for v, null in zip(values, nulls)]
        at += 9 * self.n_docs
        self.levels = []
        for k in range(n_levels):
            (count,) = struct.unpack_from("<Q", payload, at)
            low = np.frombuffer(payload, np.uint8, count, at + 8)
            at += 8 + count
            bits = ranks = None
            if k < n_levels - 1:
                bits = np.frombuffer(payload, np.uint8, (count + 7) // 8, at)
                at += len(bits)
                ranks = np.frombuffer(payload, "<u4", (count + RANK_BITS - 1) // RANK_BITS, at)
                at += 4 * len(ranks)
            self.levels.append((low, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before the i-th bit of a level's bitmap."""
        _, bits, ranks = self.levels[level]
        block = min(i // RANK_BITS, len(ranks) - 1)
        byte = i // 8
        ones = int(ranks[block]) + int(_BITS_IN_BYTE[bits[block * RANK_BITS // 8 : byte]].sum())
        return ones + (bin(int(bits[byte]) & ((1 << (i % 8)) - 1)).count("1") if i % 8 else 0)

    def token(self, i: int) -> int:
        """The i-th id of the segment."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (low, bits, _) in enumerate(self.levels):
            value |= int(low[i]) << (8 * level)
            if bits is None or not bits[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to ``end`` (exclusive): one slice of each level."""
        out, own = np.zeros(end - start, np.uint32), np.arange(end - start)
        for level, (low, bits, _) in enumerate(self.levels):
            out[own] |= low[start:end].astype(np.uint32) << np.uint32(8 * level)
            if bits is None or start == end:
                break
            more = np.unpackbits(bits[start // 8 : (end + 7) // 8], bitorder="little")[start % 8 :][: end - start].astype(bool)
            own, start = own[more], self._rank(level, start)
            end = start + len(own)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.tokens(int(self.starts[k]), int(self.starts[k + 1]))


def write_codes(documents: DataFrame, path: str, tokenizer: str | None = None, id_column: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append END_ID, write segments in ascending id order."""
    tokenizer = tokenizer or _tokenizer_path()

    def segments(batches):
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def packed():
            starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            columns = [[part], [seq], [len(doc_ids)], [size], [pack_segment(doc_ids, starts, np.concatenate(ids))]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "seq", "n_docs", "n_tokens", "payload"])

        for batch in W.pieces(batches, 1, CHUNK_BYTES):
            found, first = encoder.encode(batch.column(1))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                doc_ids.append(doc_id)
                ids.append(np.append(found[first[k] : first[k + 1]], np.uint32(END_ID)))
                size += len(ids[-1])
                if size >= SEGMENT_TOKENS:
                    yield packed()
                    doc_ids, ids, size, seq = [], [], 0, seq + 1
        if doc_ids:
            yield packed()

    # Rows of one id are told apart by their text, and equal rows, whose order is nobody's concern, by their place.
    (
        documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("name"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "name", "place")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "name", "text")
        .select("doc_id", "text")
        .mapInArrow(segments, SCHEMA)
        .write.option("compression", "none")
        .parquet(path)
    )


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a folder."""
    return spark.read.schema(SCHEMA).parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """part, seq and the number of ids before each segment; payloads are not read."""
    # Two short windows: over the parts (one row for each writing task), then inside each part.
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(in_order), F.lit(0)).alias("part_before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inside"))
    return places.join(parts, "part").select("part", "seq", (F.col("inside") + F.col("part_before")).alias("before"))


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the segments' payloads.

    Payloads are decoded where they are read; only the documents' few numbers are shuffled.
    """
    names = ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"]

    def digests(batches):
        for batch in batches:
            for part, seq, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                segment = Segment(payload.as_py())
                ids = segment.tokens(0, segment.n_tokens).astype("<u4")
                raw, starts = memoryview(ids.tobytes()), segment.starts
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                same = [pa.array([k] * len(crcs), pa.int32()) for k in (part, seq)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(segment.doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], names)

    found = segments.select("part", "seq", "payload").mapInArrow(digests, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(segment_starts(segments), ["part", "seq"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the codes to a fresh shared folder and read the documents' digests back."""
    path = shared_folder(documents.sparkSession)
    write_codes(documents, path, tokenizer)
    return document_digests(read_codes(documents.sparkSession, path))
