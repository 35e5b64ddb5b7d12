"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters may differ in up to k places (``ERROR_RATE`` of m). Cut into k + 1
pieces, at least one of them is untouched wherever the item occurs within that budget. So an
Aho-Corasick automaton finds all exact piece hits in one pass over a text, and Myers' bit-parallel
algorithm measures the edit distance only around hits. Nothing within the budget is missed.

Texts are compared in lower case with runs of white space as one space; spans are in code points
of the text as it stands.

Items come in blocks of ``BLOCK_CHARACTERS``, each with an automaton of bounded size. The documents are
read once: a task takes a stretch of about ``CHUNK_BYTES`` of texts through all blocks, one automaton in
memory at a time. Blocks are sent packed, ``PASS_CHARACTERS`` of items at most; an item table that is
longer takes another pass for each so many, after which what was sent before is given up. So neither
the driver nor a task ever holds more than that, however long the table is.

Null and empty texts and items match nothing. Repeated items give a row each. A row is one
document and one item, with the best match (the leftmost of equals).
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.tables import stored

ERROR_RATE = 0.08
#: Pieces are not shorter than this; very short items have a smaller budget.
LEAST_PIECE = 8
BLOCK_CHARACTERS = 1 << 20
PASS_CHARACTERS = 32 << 20
#: Bytes of texts that meet one block after another.
CHUNK_BYTES = 16 << 20

SCHEMA = "doc_id long, item_id long, distance int, budget int, start long, end long"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    """Edits allowed in an item of so many characters."""
    return max(0, min(int(ERROR_RATE * length), length // LEAST_PIECE - 1))


def pieces(item: str) -> list[tuple[int, str]]:
    """The item in budget + 1 pieces of nearly equal length, each with its place."""
    n = budget(len(item)) + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit-parallel edit distance of one pattern to all substrings of a text."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.where: dict[str, int] = defaultdict(int)
        for k, c in enumerate(pattern):
            self.where[c] |= 1 << k

    def best(self, text: str) -> tuple[int, int]:
        """Least distance of the pattern to a substring, and the end of the first such substring."""
        m = self.length
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        best, at = m, 0
        where = self.where
        for k, c in enumerate(text):
            eq = where.get(c, 0)
            diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
            up, down = minus | (~(diagonal | plus) & full), plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
            up, down = (up << 1) & full, (down << 1) & full
            plus = down | (~(diagonal | up) & full)
            minus = up & diagonal
            if score < best:
                best, at = score, k + 1
        return best, at


@dataclass
class Item:
    item_id: int | None
    text: str


class Matcher:
    """All items of a block: their pieces in one automaton."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, item in enumerate(items):
            for offset, piece in pieces(item.text):
                places[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    def _windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """For each item hit, the stretches of text that can hold it; overlapping ones are joined."""
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for k, offset in where:
                m = len(self.items[k].text)
                edits = budget(m)
                begin = last + 1 - size - offset - edits
                end = begin + m + 2 * edits
                windows = found.setdefault(k, [])
                if windows and begin <= windows[-1][1]:
                    windows[-1] = (min(begin, windows[-1][0]), max(end, windows[-1][1]))
                else:
                    windows.append((begin, end))
        return found

    def matches(self, text: str) -> Iterator[tuple[int | None, int, int, int, int]]:
        """item_id, distance, budget, start, end in the normalised text, for every item within budget."""
        if not self.items or not text:
            return
        for k, windows in sorted(self._windows(text).items()):
            item = self.items[k].text
            if k not in self.patterns:
                self.patterns[k] = Pattern(item), Pattern(item[::-1])
            forward, backward = self.patterns[k]
            edits, best = budget(len(item)), None
            for begin, end in windows:
                begin, end = max(begin, 0), min(end, len(text))
                distance, stop = forward.best(text[begin:end])
                if distance <= edits and (best is None or distance < best[0]):
                    best = distance, begin, begin + stop
            if best is not None:
                distance, begin, stop = best
                _, size = backward.best(text[begin:stop][::-1])
                yield self.items[k].item_id, distance, edits, stop - size, stop


def original_places(text: str) -> list[int]:
    """For each character of the normalised text, its place in the text, and at last the end."""
    places: list[int] = []
    gap = None
    for k, c in enumerate(text):
        for low in c.lower():
            if low.isspace():
                gap = k if gap is None else gap
            else:
                if gap is not None and places:
                    places.append(gap)
                gap = None
                places.append(k)
    return [*places, (places[-1] + 1) if places else 0]


_matchers: dict[tuple[str, int], Matcher] = {}


def _matcher(name: str, number: int, block: bytes) -> Matcher:
    """A block's automaton; a worker process keeps the latest only."""
    if (name, number) not in _matchers:
        _matchers.clear()
        _matchers[name, number] = Matcher(unpacked(block))
    return _matchers[name, number]


def packed(block: list[Item]) -> bytes:
    return zstandard.ZstdCompressor().compress(json.dumps([[i.item_id, i.text] for i in block]).encode())


def unpacked(block: bytes) -> list[Item]:
    return [Item(*i) for i in json.loads(zstandard.ZstdDecompressor().decompress(block))]


def item_blocks(items: DataFrame) -> Iterator[list[Item]]:
    """The items in blocks of about BLOCK_CHARACTERS, one block in memory at a time."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        text = normalised(row["text"])
        if not text:
            continue
        if block and size + len(text) > BLOCK_CHARACTERS:
            yield block
            block, size = [], 0
        block.append(Item(row["item_id"], text))
        size += len(text)
    if block:
        yield block


def passes(items: DataFrame) -> Iterator[list[bytes]]:
    """Packed blocks, as many at a time as one pass over the documents takes."""
    blocks, size = [], 0
    for block in item_blocks(items):
        length = sum(len(i.text) for i in block)
        if blocks and size + length > PASS_CHARACTERS:
            yield blocks
            blocks, size = [], 0
        blocks.append(packed(block))
        size += length
    if blocks:
        yield blocks


def find_leaks(documents: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA: every (document, item) whose item occurs in the text within its budget."""
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def of_pass(sent: Broadcast, name: str) -> DataFrame:
        def matched(batches):
            for batch in W.pieces(batches, 1, CHUNK_BYTES):
                ids, texts, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
                plain = [normalised(t) if t else "" for t in texts]
                for number, block in enumerate(sent.value):
                    matcher = _matcher(name, number, block)
                    for row, text in enumerate(plain):
                        out += [(row, *match) for match in matcher.matches(text)]
                places = {row: original_places(texts[row]) for row in {m[0] for m in out}}
                found = [(ids[r], i, d, k, places[r][a], places[r][b - 1] + 1 if b else places[r][b]) for r, i, d, k, a, b in out]
                columns = list(zip(*found)) if found else [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

        return rows.mapInArrow(matched, SCHEMA)

    found = _each_pass(items, lambda sofar, sent, name: of_pass(sent, name) if sofar is None else sofar.unionByName(of_pass(sent, name)), documents)
    return documents.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def without_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, same columns, less those that hold an item within its budget."""
    schema, at = documents.schema, documents.columns.index("text")

    def of_pass(sofar: DataFrame | None, sent: Broadcast, name: str) -> DataFrame:
        def clean(batches):
            for batch in W.pieces(batches, at, CHUNK_BYTES):
                plain = [normalised(t) if t else "" for t in batch.column(at).to_pylist()]
                good = [True] * len(plain)
                for number, block in enumerate(sent.value):
                    matcher = _matcher(name, number, block)
                    good = [ok and next(matcher.matches(t), None) is None for ok, t in zip(good, plain)]
                yield batch.filter(pa.array(good, pa.bool_()))

        return (documents if sofar is None else sofar).mapInArrow(clean, schema)

    found = _each_pass(items, of_pass, documents)
    return documents if found is None else found


def _each_pass(items: DataFrame, of_pass: Callable[[DataFrame | None, Broadcast, str], DataFrame], documents: DataFrame) -> DataFrame | None:
    """Results of all passes; what a pass was sent is given up before the next is sent."""
    found, sent = None, None
    for blocks in passes(items):
        if sent is not None:
            found = stored(found)
            sent.destroy()
        sent = documents.sparkSession.sparkContext.broadcast(blocks)
        found = of_pass(found, sent, uuid4().hex)
    return found
