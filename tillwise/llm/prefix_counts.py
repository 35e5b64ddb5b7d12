"""Token counts: prefix dynamic programming.

For a merge-type model the tokens of a text's beginning are those of a shorter beginning and one
token more. Which token that is follows from pairs alone: two tokens stand side by side in some
segmentation exactly if the model segments their joined text into the two. So one pass over a text,
keeping the last token and the number of tokens of every beginning, gives the exact token count of
each: for every piece that ends at a character, look whether it may follow the last token before it;
exactly one may. The counts are stored, and any question on where a text exceeds a budget, or what
its first k characters cost, is read from them without encoding again.

The pass runs side by side in numpy over the distinct units of a batch (``units``), and what it
learns of pairs and units is kept for the worker's later batches, up to ``CACHE_UNITS``.

Payload of a row's counts: a zstandard frame of one int8 (or little-endian int32, if the frame's
size says so) for each code point: by how much the count grows with it.

Counts equal the library's for every text: the sign that stands for a space is a space, characters
without a piece are as many tokens as bytes, an empty text has none. Null texts count as empty.
Every row gives one row, whatever its id; null and repeated ids are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.merge_dropout import Pieces, gather, pieces_of, segment_units
from tillwise.llm.units import Known, units_of

LIMIT = 4096
#: Bytes of text at a time.
CHUNK_BYTES = 4 << 20
#: Units and pairs that a worker remembers; when full it starts anew.
CACHE_UNITS = 2_000_000
CACHE_PAIRS = 4_000_000
#: Longer units go through the pass one by one.
LONG_UNIT = 64
_SPACE_SIGN = 0x2581
#: Last token of the empty beginning and of one that ends with a character without a piece.
_WALL = -1

SCHEMA = "doc_id long, n_bytes long, n_chars long, n_tokens long, counts binary"


class PrefixCounter:
    """Counts for all beginnings of units, and what was learned of them."""

    def __init__(self, path: str):
        self.pieces = pieces_of(path)
        self._read_trie()
        self.pair_keys, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.forget()
        size = np.arange(len(self.pieces.first))
        plain = self.lengths > 0
        self.alone = np.zeros(len(size), bool)
        self.alone[plain] = self._keeps(np.full(plain.sum(), _WALL), size[plain])

    def _read_trie(self) -> None:
        """Sorted (node, character) keys with the node each leads to, and the piece of each node."""
        pieces: Pieces = self.pieces
        single = np.array([symbol for _, symbol in sorted(pieces.character.items())])
        known = np.array(sorted(pieces.character))
        ends = np.append(pieces.first[1:], len(pieces.data))
        special = set(range(pieces.byte_zero, pieces.byte_zero + 256))
        children: dict[tuple[int, int], int] = {}
        node_piece, spelled, lengths = [-1], [], np.zeros(len(pieces.first), np.int64)
        for piece, (a, b) in enumerate(zip(pieces.first.tolist(), ends.tolist())):
            if a == b or piece in special:
                spelled.append(np.zeros(0, np.int64))
                continue
            node, points = 0, [ord(c) for c in pieces.data[a:b].tobytes().decode()]
            for point in points:
                if point not in pieces.character:
                    raise ValueError(f"piece {piece} holds a character without a piece of its own")
                if (node, point) not in children:
                    children[node, point] = len(node_piece)
                    node_piece.append(-1)
                node = children[node, point]
            node_piece[node] = piece
            spelled.append(single[np.searchsorted(known, points)])
            lengths[piece] = len(points)
        keys = np.array([node * 0x110000 + point for node, point in children], np.int64)
        order = np.argsort(keys)
        self.trie_keys, self.trie_nodes = keys[order], np.fromiter(children.values(), np.int64, len(keys))[order]
        self.node_piece, self.lengths = np.array(node_piece), lengths
        self.spelled = np.concatenate(spelled)
        self.spelled_first = np.cumsum(lengths) - lengths

    def forget(self) -> None:
        self.known = Known()
        #: Growth of the count with each character of the known units, and where each unit's begins.
        self.growth, self.first = np.zeros(0, np.int8), np.zeros(1, np.int64)

    def _keeps(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the joined text of each pair is segmented into the pair; a wall on the left adds nothing."""
        joined = np.maximum(left, 0)
        left_size = np.where(left < 0, 0, self.lengths[joined])
        size = np.stack([left_size, self.lengths[right]], 1).ravel()
        begin = np.stack([self.spelled_first[joined], self.spelled_first[right]], 1).ravel()
        symbols, first = gather(self.spelled, begin, size)
        tokens, of_pair = segment_units(self.pieces, symbols, first[::2], np.zeros(len(left), np.uint64), 0.0)
        count = np.diff(of_pair)
        ok = (count == 1 + (left >= 0)) & (tokens[of_pair[1:] - 1] == right)
        return ok & ((left < 0) | (tokens[of_pair[:-1]] == left))

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For pairs of tokens; pairs met for the first time are segmented and remembered."""
        out = self.alone[right]
        pair = np.flatnonzero((left >= 0) & out)
        key = left[pair] * np.int64(len(self.lengths)) + right[pair]
        at = np.minimum(np.searchsorted(self.pair_keys, key), max(len(self.pair_keys) - 1, 0))
        new = self.pair_keys[at] != key if len(self.pair_keys) else np.ones(len(key), bool)
        if new.any():
            if len(self.pair_keys) > CACHE_PAIRS:
                self.pair_keys, self.pair_ok, new = np.zeros(0, np.int64), np.zeros(0, bool), np.ones(len(key), bool)
            fresh = np.unique(key[new])
            ok = self._keeps(*np.divmod(fresh, len(self.lengths)))
            place = np.searchsorted(self.pair_keys, fresh)
            self.pair_keys, self.pair_ok = np.insert(self.pair_keys, place, fresh), np.insert(self.pair_ok, place, ok)
            at = np.searchsorted(self.pair_keys, key)
        out[pair] = self.pair_ok[at] if len(key) else False
        return out

    def _matches(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (exclusive) and piece of every piece found; ``left``: characters to the unit's end."""
        at, node, found = np.arange(len(points)), np.zeros(len(points), np.int64), []
        for length in range(1, int(self.lengths.max()) + 1):
            key = node * 0x110000 + points[at + length - 1]
            place = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
            hit = self.trie_keys[place] == key
            at, node = at[hit], self.trie_nodes[place[hit]]
            piece = self.node_piece[node]
            whole = piece >= 0
            found.append((at[whole], at[whole] + length, piece[whole]))
            more = left[at] > length
            at, node = at[more], node[more]
            if not len(at):
                break
        start, end, piece = (np.concatenate(c) for c in zip(*found))
        return start, end, piece

    def counts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Token count of the beginning of its unit that ends with each code point.

        Unit k holds ``points[first[k]:first[k + 1]]``. Step i looks at the i-th character of all
        units that are long enough.
        """
        points = np.where(points == _SPACE_SIGN, 32, points).astype(np.int64)
        length = np.diff(first)
        place = np.arange(len(points)) - np.repeat(first[:-1], length)
        start, end, piece = self._matches(points, np.repeat(length, length) - place)
        covered = np.zeros(len(points), bool)
        covered[end - 1] = True
        count = np.zeros(len(points) + 1, np.int64)  # the last one stands for empty beginnings
        last = np.full(len(points) + 1, _WALL, np.int64)
        bare = np.flatnonzero(~covered)
        width = 1 + (points[bare] > 0x7F) + (points[bare] > 0x7FF) + (points[bare] > 0xFFFF)
        # Matches and bare characters in the order of the character of their unit at which they end.
        ends = np.concatenate([end - 1, bare])
        before = np.concatenate([start, bare]) - 1
        before[place[before + 1] == 0] = -1
        token = np.concatenate([piece, np.full(len(bare), _WALL)])
        more = np.concatenate([np.ones(len(piece), np.int64), width])
        order = np.argsort(place[ends], kind="stable")
        ends, before, token, more = (x[order] for x in (ends, before, token, more))
        steps = np.searchsorted(place[ends], np.arange(int(length.max(initial=0)) + 1))
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist()):
            ok = token[a:b] < 0
            ok[~ok] = self.may_follow(last[before[a:b][~ok]], token[a:b][~ok])
            to, come = ends[a:b][ok], before[a:b][ok]
            count[to], last[to] = count[come] + more[a:b][ok], token[a:b][ok]
        return count[:-1]

    def learn(self, hashes: np.ndarray, units: list[str]) -> None:
        raw = "".join(units).encode("utf-32-le")
        points = np.frombuffer(raw, "<u4")
        first = np.concatenate([[0], np.cumsum([len(u) for u in units], dtype=np.int64)])
        length = np.diff(first)
        count = np.zeros(len(points), np.int64)
        short = length <= LONG_UNIT
        inside = np.repeat(short, length)
        count[inside] = self.counts(points[inside], np.concatenate([[0], np.cumsum(length[short])]))
        for k in np.flatnonzero(~short).tolist():
            count[first[k] : first[k + 1]] = self.counts_of_long(points[first[k] : first[k + 1]])
        growth = np.diff(count, prepend=0)
        growth[first[:-1]] = count[first[:-1]]  # no unit is empty
        if self.growth.dtype == np.int8 and len(growth) and (growth.min() < -128 or growth.max() > 127):
            self.growth = self.growth.astype(np.int32)
        self.growth = np.concatenate([self.growth, growth.astype(self.growth.dtype)])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])
        self.known.add(hashes)

    def counts_of_long(self, points: np.ndarray) -> np.ndarray:
        """The same for one long unit: character by character, pairs of each block of characters together."""
        points = np.where(points == _SPACE_SIGN, 32, points).astype(np.int64)
        start, end, piece = self._matches(points, len(points) - np.arange(len(points)))
        order = np.argsort(end, kind="stable")
        start, piece = start[order].tolist(), piece[order].tolist()
        steps = np.searchsorted(end[order], np.arange(1, len(points) + 2)).tolist()
        count, last, ok = [0] * (len(points) + 1), [_WALL] * (len(points) + 1), {}
        for at in range(len(points)):
            for k in range(steps[at], steps[at + 1]):
                pair = last[start[k]], piece[k]
                if pair not in ok:
                    ok[pair] = bool(self.may_follow(np.array(pair[:1]), np.array(pair[1:]))[0])
                if ok[pair]:
                    count[at + 1], last[at + 1] = count[start[k]] + 1, piece[k]
                    break
            else:
                count[at + 1] = count[at] + len(chr(points[at]).encode())
        return np.array(count[1:], np.int64)

    def growths(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """By how much each code point of the texts raises the count, and where each text's begin."""
        units = units_of(texts)
        new = self.known.missing(units.hashes)
        if len(self.known) + new.sum() > CACHE_UNITS:
            self.forget()
            new[:] = True
        if new.any():
            self.learn(units.hashes[new], units.text(np.flatnonzero(new)))
        number = self.known.numbers_of(units.hashes)[units.inverse]
        growth, first = gather(self.growth, self.first[number], self.first[number + 1] - self.first[number])
        begins = first[units.first]
        full = np.flatnonzero(np.diff(begins) > 0)
        own = begins[:-1][full]  # the space before the text is no character of it: the next one stands for both
        growth[own + 1] += growth[own]
        keep = np.ones(len(growth), bool)
        keep[own] = False
        return growth[keep], begins - np.concatenate([[0], np.cumsum(np.diff(begins) > 0)])


_counters: dict[str, PrefixCounter] = {}


def counter_of(path: str) -> PrefixCounter:
    """One for each worker process: what it learned serves all tasks that the process runs."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PrefixCounts:
    """Answers from a stored payload."""

    def __init__(self, payload: bytes, n_chars: int):
        raw = zstandard.ZstdDecompressor().decompress(payload)
        self.count = np.cumsum(np.frombuffer(raw, np.int8 if len(raw) == n_chars else "<i4"), dtype=np.int64)

    def tokens(self, chars: int) -> int:
        """Tokens of the text's first so many code points."""
        return int(self.count[chars - 1]) if chars else 0

    def longest(self, budget: int) -> int:
        """Code points of the longest beginning with no more tokens than the budget."""
        fits = np.flatnonzero(self.count <= budget)
        return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(documents: DataFrame, model_file: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA for every row: sizes, the count of the whole text and the counts of all beginnings."""
    path = model_file or _model_file()
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def counted(batches):
        counter, compressor = counter_of(path), zstandard.ZstdCompressor(level=1)
        for batch in W.pieces(batches, 1, CHUNK_BYTES):
            growth, first = counter.growths(batch.column(1))
            raw, size = memoryview(growth.tobytes()), growth.dtype.itemsize
            payloads = [compressor.compress(raw[size * a : size * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            n_bytes = np.diff(W.text_bytes(batch.column(1))[1])
            n_tokens = W.segment_sums(growth, first)
            columns = [pa.array(c, pa.int64()) for c in (n_bytes, np.diff(first), n_tokens)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(payloads, pa.binary())], names)

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, SCHEMA)


def token_budget(counts: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and fit_chars (code points of the longest beginning within the limit).

    Reads stored counts; nothing is encoded.
    """

    def answered(batches):
        for batch in batches:
            n_chars, n_tokens = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            over = [n > limit for n in n_tokens]
            fit = [PrefixCounts(batch.column(4)[k].as_py(), n).longest(limit) if over[k] else n for k, n in enumerate(n_chars)]
            columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(over, pa.bool_()), pa.array(fit, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return counts.mapInArrow(answered, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
