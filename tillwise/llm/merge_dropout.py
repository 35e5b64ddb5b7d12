"""SentencePiece encoding and decoding with seeded merge-dropout.

A merge-type model joins neighbouring symbols, best candidate first. Here each candidate merge that
comes up on the agenda is skipped if a keyed hash of it falls below the dropout rate. The hash takes
the seed, the document's id, the unit of text (a run of spaces and what follows it), the unit's
place in the text, and the place and size of the candidate. So a text always gets the same
segmentation under one seed, and different ones under others, and each occurrence of a unit is
segmented on its own. At rate 0 the ids are those of the library's own encoder.

Pieces never hold a space behind another character, so units are independent and are segmented
side by side in numpy; at rate 0 each distinct unit of a batch once. Very long units use the agenda
itself, a heap.

Decoding is lossless: unknown characters, and the sign that stands for a space, become bytes.
Null and empty texts have no ids; null decodes to null's stand-in, the empty text.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W

RATE = 0.1
SEED = 2024
#: Units with more symbols than this go through the heap.
LONG_UNIT = 256
#: Bytes of text segmented at a time.
CHUNK_BYTES = 2 << 20
_SPACE_SIGN = "▁"
_NONE = np.int32(2**31 - 1)


def _model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """Vocabulary of a merge-type model, as arrays."""

    #: Id of each single character's piece.
    character: dict[int, int]
    #: Id of the first byte piece.
    byte_zero: int
    #: Sorted (left id, right id) keys, and for each the joined piece and its place in merge order.
    pair_keys: np.ndarray
    pair_piece: np.ndarray
    pair_rank: np.ndarray
    #: Bytes of all pieces one after another, and where each begins.
    data: np.ndarray
    first: np.ndarray

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joined piece and rank for each pair of symbols; rank _NONE if they do not join."""
        key = left.astype(np.int64) * len(self.first) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        joins = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return self.pair_piece[at], np.where(joins, self.pair_rank[at], _NONE)


def read_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    text = [model.id_to_piece(i) for i in range(size)]
    ids = {t: i for i, t in enumerate(text) if plain[i]}
    order = {i: rank for rank, i in enumerate(sorted(ids.values(), key=lambda i: (-model.get_score(i), i)))}
    keys = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                keys.append((left * size + right, i, order[i]))
    keys.sort()
    bytes_of = [text[i].replace(_SPACE_SIGN, " ").encode() if plain[i] else b"" for i in range(size)]
    byte_zero = next(i for i in range(size) if model.is_byte(i))
    for b in range(256):
        bytes_of[byte_zero + b] = bytes([b])
    columns = np.array(keys, np.int64)
    return Pieces(
        {ord(t.replace(_SPACE_SIGN, " ")): i for t, i in ids.items() if len(t) == 1},
        byte_zero,
        columns[:, 0],
        columns[:, 1].astype(np.int32),
        columns[:, 2].astype(np.int32),
        np.frombuffer(b"".join(bytes_of), np.uint8),
        np.concatenate([[0], np.cumsum([len(b) for b in bytes_of])])[:-1].astype(np.int64),
    )


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """Read once for each worker process."""
    if path not in _pieces:
        _pieces[path] = read_pieces(path)
    return _pieces[path]


def _skipped(unit: np.ndarray, start: np.ndarray, cut: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate that joins characters start..cut and cut..end of a unit is skipped."""
    place = (start.astype(np.uint64) << np.uint64(42)) ^ (cut.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
    return (W.mix(unit ^ W.mix(place + np.uint64(1))) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < rate


def agenda(pieces: Pieces, symbols: np.ndarray, unit: np.uint64, rate: float) -> np.ndarray:
    """Ids of one unit by the agenda itself: best candidate first, leftmost of equals."""
    n = len(symbols)
    symbol, start = symbols.tolist(), list(range(n))
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        rights = [after[i] for i in lefts]
        joined, rank = pieces.pairs(np.array([symbol[i] for i in lefts]), np.array([symbol[j] for j in rights]))
        left, cut, stop = (np.array(x) for x in (lefts, rights, [end[j] for j in rights]))
        ok = (rank != _NONE) & ~_skipped(np.full(len(lefts), unit), left, cut, stop, rate)
        for k in np.flatnonzero(ok).tolist():
            heapq.heappush(heap, (int(rank[k]), lefts[k], rights[k], int(stop[k]), int(joined[k])))

    offer(start[:-1])
    gone = [False] * n
    while heap:
        _, i, j, stop, joined = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j or end[j] != stop:
            continue  # one of its sides has grown since
        symbol[i], end[i], after[i], gone[j] = joined, stop, after[j], True
        if after[i] < n:
            before[after[i]] = i
        offer([before[i], i])
    return np.array([s for s, g in zip(symbol, gone) if not g], np.int64)


def segment_units(pieces: Pieces, symbols: np.ndarray, first: np.ndarray, unit: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of many units (``symbols[first[k]:first[k + 1]]``) joined; the same form comes back.

    Every round joins the best candidate of each unit that still has one, which is what each
    unit's own agenda would do next.
    """
    length = np.diff(first)
    result: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # unit numbers, lengths, symbols
    for k in np.flatnonzero(length > LONG_UNIT).tolist():
        ids = agenda(pieces, symbols[first[k] : first[k + 1]], unit[k], rate)
        result.append((np.array([k]), np.array([len(ids)]), ids))
    live = np.flatnonzero(length <= LONG_UNIT)
    inside = np.repeat(length <= LONG_UNIT, length)
    symbol, length = symbols[inside].astype(np.int32), length[live]
    start = symbol if not len(live) else (np.arange(len(symbol)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
    end = start + 1

    def ranks(left: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined, rank = pieces.pairs(symbol[left], symbol[left + 1])
        open_ = np.flatnonzero(rank != _NONE)
        skip = _skipped(key[open_], start[left[open_]], start[left[open_] + 1], end[left[open_] + 1], rate)
        rank[open_[skip]] = _NONE
        return joined, rank

    rank, joined = np.full(len(symbol), _NONE, np.int32), np.zeros(len(symbol), np.int32)
    owner = np.repeat(np.arange(len(live)), length)
    left = np.flatnonzero(owner[1:] == owner[:-1])
    joined[left], rank[left] = ranks(left, unit[live][owner[left]])
    while len(live):
        heads = np.concatenate([[0], np.cumsum(length)[:-1]])
        best = np.minimum.reduceat(rank, heads)
        done = best == _NONE
        if done.any():
            keep = np.repeat(~done, length)
            result.append((live[done], length[done], symbol[~keep]))
            symbol, start, end, rank, joined = (x[keep] for x in (symbol, start, end, rank, joined))
            live, length, best = live[~done], length[~done], best[~done]
            if not len(live):
                break
            heads = np.concatenate([[0], np.cumsum(length)[:-1]])
        at = np.flatnonzero(rank == np.repeat(best, length))
        owner = np.searchsorted(heads, at, "right") - 1
        at = at[np.concatenate([[True], owner[1:] != owner[:-1]])]  # leftmost of each unit
        symbol[at], end[at] = joined[at], end[at + 1]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, start, end, rank, joined = (x[keep] for x in (symbol, start, end, rank, joined))
        at -= np.arange(len(at))  # one symbol left each unit before it
        length = length - 1
        heads = np.concatenate([[0], np.cumsum(length)[:-1]])
        key = unit[live]
        last = at == heads + length - 1
        rank[at[last]] = _NONE
        for left, own in ((at[~last], key[~last]), (at[at > heads] - 1, key[at > heads])):
            joined[left], rank[left] = ranks(left, own)
    numbers = np.concatenate([r[0] for r in result]) if result else np.zeros(0, np.int64)
    lengths = np.concatenate([r[1] for r in result]) if result else np.zeros(0, np.int64)
    flat = np.concatenate([r[2] for r in result]) if result else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    order = np.argsort(numbers)
    return gather(flat, starts[order], lengths[order])


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces ``values[starts[k]:starts[k] + lengths[k]]`` one after another, and where each begins."""
    first = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.arange(first[-1]) + np.repeat(starts - first[:-1], lengths)], first


def _code_points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")


def _symbols(pieces: Pieces, points: np.ndarray) -> np.ndarray:
    """Piece of each character; minus one and less for characters without one."""
    known, inverse = np.unique(points, return_inverse=True)
    table = np.array([pieces.character.get(int(p), -1 - int(p)) for p in known], np.int64)
    return table[inverse]


def _bytes_for_unknown(pieces: Pieces, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unknown = ids < 0
    if not unknown.any():
        return ids, first
    points, inverse = np.unique(-1 - ids[unknown], return_inverse=True)
    raw = [chr(int(p)).encode() for p in points]
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + pieces.byte_zero
    lengths = np.ones(len(ids), np.int64)
    size = np.array([len(r) for r in raw])
    lengths[unknown] = size[inverse]
    source = np.concatenate([ids, flat])
    starts = np.arange(len(ids))
    starts[unknown] = len(ids) + (np.cumsum(size) - size)[inverse]
    out, begins = gather(source, starts, lengths)
    return out, begins[first]


def encode_texts(pieces: Pieces, texts: pa.Array, keys: np.ndarray, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every text and where each text's begin. keys: a 64-bit name of each text's document."""
    data, first = W.text_bytes(texts)
    # The space that the model puts before a text, as long as it is not empty.
    padded = np.flatnonzero(np.diff(first) > 0)
    data = np.insert(data, first[:-1][padded], 32)
    first = first + np.concatenate([[0], np.cumsum(np.diff(first) > 0)])
    blank = data == 32
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[first[:-1][padded]] = True
    starts = np.flatnonzero(head)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    hashes = W.hash_spans(data, starts, ends)
    of_text = np.searchsorted(starts, first, "left")
    if rate > 0:
        text = np.repeat(np.arange(len(first) - 1), np.diff(of_text))
        place = (np.arange(len(starts)) - of_text[:-1][text]).astype(np.uint64)
        hashes = W.seeded(hashes ^ W.seeded(keys.astype(np.uint64)[text] + W.mix(place), seed), seed)
    units, once, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    raw, begins = gather(data, starts[once], ends[once] - starts[once])
    points = _code_points(raw.tobytes())
    is_start = np.flatnonzero((raw & 0xC0) != 0x80)
    symbols, of_unit = segment_units(pieces, _symbols(pieces, points), np.searchsorted(is_start, begins), units, rate)
    symbols, of_unit = _bytes_for_unknown(pieces, symbols, of_unit)
    ids, begins = gather(symbols, of_unit[:-1][inverse], np.diff(of_unit)[inverse])
    return ids.astype(np.int32), begins[of_text]


def decode_ids(pieces: Pieces, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every text (the model's own first space taken off) and where each text's begin."""
    ends = np.append(pieces.first[1:], len(pieces.data))
    data, begins = gather(pieces.data, pieces.first[ids], (ends - pieces.first)[ids])
    begins = begins[first]
    keep = np.ones(len(data), bool)
    full = np.diff(begins) > 0
    keep[begins[:-1][full]] = False
    return data[keep], begins - np.concatenate([[0], np.cumsum(full)])


def _document_keys(column: pa.Array) -> np.ndarray:
    return W.mix(column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def encode(documents: DataFrame, model_file: str | None = None, rate: float = RATE, seed: int = SEED, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens and lossless (the ids decode to the very text) for every row."""
    path = model_file or _model_file()

    def encoded(batches):
        pieces = pieces_of(path)
        for part in W.pieces(batches, 1, CHUNK_BYTES):
            ids, first = encode_texts(pieces, part.column(1), _document_keys(part.column(0)), rate, seed)
            data, begins = decode_ids(pieces, ids, first)
            source, offsets = W.text_bytes(part.column(1))
            lossless = np.diff(begins) == np.diff(offsets)
            if not (lossless.all() and np.array_equal(data, source)):
                lossless = np.array([np.array_equal(data[a:b], source[c:d]) for a, b, c, d in zip(begins, begins[1:], offsets, offsets[1:])])
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(np.diff(first)), pa.array(lossless)], ["doc_id", "ids", "n_tokens", "lossless"])

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encoded, "doc_id long, ids array<int>, n_tokens long, lossless boolean")


def decode(encoded: DataFrame, model_file: str | None = None) -> DataFrame:
    """doc_id and text of every row with ids (null ids decode to the empty text)."""
    path = model_file or _model_file()

    def decoded(batches):
        pieces = pieces_of(path)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            data, begins = decode_ids(pieces, ids, first)
            raw = data.tobytes()
            texts = [raw[a:b].decode(errors="replace") for a, b in zip(begins.tolist(), begins[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")
