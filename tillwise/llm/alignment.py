"""Cross-tokenizer alignment: pointer jumping.

A text is encoded by a byte-level model (A) and by a merge-type model (B), and every token gets the
bytes it stands for. Each token points to the farthest-right token of the other model that overlaps
it; of an A and a B token that end together the B token is the last and points to itself. Doubling
all pointers at once (pointer of pointer) until none moves takes every token to the last one of its
component. Tokens with one terminal are one group: the shortest stretch at whose end both models
end a token. The A and B token that end a group are linked.

A link's count is the number of links of the whole corpus with its two ids; a link is best if no
other A id has a greater count with its B id.

Both models cut a text at its units (``units``), so that pointers are followed once for each distinct
unit that a worker meets. Documents travel in blocks of about ``BLOCK_BYTES`` of text. A block's
distinct id pairs are counted, the counts are added up over all blocks, and the block asks for the
totals of its own pairs: shuffled are distinct pairs of blocks and packed unit numbers, never tokens.
One pair has at most one row a block; ``PAIR_ROWS`` blocks of them meet in a task, more are salted.

A text whose joined A or B bytes are not those of a space and the text (the merge-type model writes
its own sign for a space as a space), and a null or empty one, has no tokens: counts are 0 and the
digest is ''. Every row gives one row; null and repeated ids are passed through.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.merge_dropout import gather
from tillwise.llm.tables import pack, stored, unpack
from tillwise.llm.units import Known, units_of

#: Bytes of text of a block.
BLOCK_BYTES = 8 << 20
#: Units a worker remembers; when full it starts anew.
CACHE_UNITS = 1_000_000
#: Blocks whose rows of one id pair go to one task.
PAIR_ROWS = 4096

_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, " + ", ".join(f"{name} array<long>" for name in _NUMBERS)
    + ", digests array<string>, doc_units binary, unit_pairs binary, pairs array<long>, counts array<long>"
)
SCHEMA = "doc_id long, " + ", ".join(f"{name} long" for name in _NUMBERS) + ", n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, other bytes for the characters from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class ByteLevel:
    """Ids and bytes of a byte-level model in the tokenizers library's format."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.tokenizer.get_vocab()
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            spelled[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else b""
        self.bytes = spelled

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class MergeType:
    """Ids and bytes of a merge-type model in the sentencepiece library's format, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.model.vocab_size())
        pieces = [self.model.id_to_piece(i) for i in size]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(size, pieces)]
        self.space = self.model.piece_to_id("▁")

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.model.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else [self.space] for u, ids in zip(units, found)]


class Tokens:
    """Tokens of many units side by side."""

    def __init__(self, found: list[list[int]], spelled: tuple[np.ndarray, np.ndarray, np.ndarray]):
        data, begins, sizes = spelled
        self.count = np.fromiter(map(len, found), np.int64, len(found))
        self.ids = np.fromiter((i for ids in found for i in ids), np.int64, int(self.count.sum()))
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.size = sizes[self.ids]
        self.data, at = gather(data, begins[self.ids], self.size)
        self.unit_first = at[self.first]


def _spelled(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(e) for e in entries], np.int64)
    return np.frombuffer(b"".join(entries), np.uint8), np.cumsum(sizes) - sizes, sizes


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The B token at which the pointers of each A and of each B token end.

    Ends (exclusive) ascend and cover the same bytes.
    """
    n = len(ends_b)
    to_a = np.searchsorted(ends_a, ends_b, "left")
    pointer = np.concatenate([np.where(ends_a[to_a] == ends_b, np.arange(n), n + to_a), np.searchsorted(ends_b, ends_a, "left")])
    while True:
        jumped = pointer[pointer]
        if np.array_equal(jumped, pointer):
            return pointer[n:], pointer[:n]
        pointer = jumped


class Aligner:
    """Groups and links of units, and what was learned of them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), MergeType(path_b)
        self.spelled_a, self.spelled_b = _spelled(self.a.bytes), _spelled(self.b.bytes)
        self.name_a = [str(i) for i in range(len(self.a.bytes))]
        self.name_b = [str(i) for i in range(len(self.b.bytes))]
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        #: For each known unit: tokens of A and B, groups, links (-1 tokens: its bytes differ).
        self.numbers = np.zeros((0, 4), np.int64)
        self.pairs, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.groups: list[bytes] = []

    def learn(self, hashes: np.ndarray, units: list[str]) -> None:
        raw = [u.encode() for u in units]
        found_a, found_b = self.a.encode(units), self.b.encode(units)
        a, b = Tokens(found_a, self.spelled_a), Tokens(found_b, self.spelled_b)
        size = np.array([len(r) for r in raw], np.int64)
        same = (np.diff(a.unit_first) == size) & (np.diff(b.unit_first) == size)
        da, db = memoryview(a.data.tobytes()), memoryview(b.data.tobytes())
        for k in np.flatnonzero(same).tolist():
            same[k] = da[a.unit_first[k] : a.unit_first[k + 1]] == raw[k] == db[b.unit_first[k] : b.unit_first[k + 1]]
        in_a, in_b = np.repeat(same, a.count), np.repeat(same, b.count)
        ids_a, ids_b = a.ids[in_a], b.ids[in_b]
        ends_a, ends_b = np.cumsum(a.size[in_a]), np.cumsum(b.size[in_b])
        unit_b = np.repeat(np.arange(len(units)), b.count)[in_b]
        group_a, group_b = terminals(ends_a, ends_b) if len(ends_b) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        last = np.flatnonzero(group_b == np.arange(len(group_b)))
        linked = np.searchsorted(ends_a, ends_b[last])  # the A token that ends with the group
        pairs = (ids_a[linked] << np.int64(32)) | ids_b[last]
        groups = np.bincount(unit_b[last], minlength=len(units))
        numbers = np.stack([np.where(same, a.count, -1), np.where(same, b.count, -1), groups, groups], 1)
        self._write(groups, np.searchsorted(group_a, last, "right"), np.searchsorted(group_b, last, "right"), ids_a, ids_b)
        self.numbers = np.concatenate([self.numbers, numbers])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(groups)])
        self.known.add(hashes)

    def _write(self, groups: np.ndarray, to_a: np.ndarray, to_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        """The text form of each unit's groups."""
        names_a, names_b = [self.name_a[i] for i in ids_a.tolist()], [self.name_b[i] for i in ids_b.tolist()]
        ends_a, ends_b, at, i, j = to_a.tolist(), to_b.tolist(), 0, 0, 0
        for n in groups.tolist():
            parts = []
            for g in range(at, at + n):
                parts.append(f"{','.join(names_a[i : ends_a[g]])}|{','.join(names_b[j : ends_b[g]])}")
                i, j = ends_a[g], ends_b[g]
            at += n
            self.groups.append(";".join(parts).encode())

    def block(self, number: int, doc_ids: pa.Array, texts: pa.Array) -> list[pa.Array]:
        """One row of BLOCK_SCHEMA."""
        units = units_of(texts)
        new = self.known.missing(units.hashes)
        if len(self.known) + new.sum() > CACHE_UNITS:
            self.forget()
            new[:] = True
        if new.any():
            self.learn(units.hashes[new], units.text(np.flatnonzero(new)))
        known = self.known.numbers_of(units.hashes)
        numbers = self.numbers[known]
        of_unit = numbers[units.inverse]
        broken = W.segment_sums((of_unit[:, 0] < 0).astype(np.int64), units.first) > 0
        whole = ~broken & (np.diff(units.first) > 0)
        sums = W.segment_sums(of_unit, units.first)
        sums[~whole] = 0
        of_known, digests = known[units.inverse].tolist(), []
        for ok, a, b in zip(whole.tolist(), units.first[:-1].tolist(), units.first[1:].tolist()):
            digests.append(hashlib.sha256(b";".join([self.groups[k] for k in of_known[a:b]])).hexdigest() if ok else "")
        # Units of the whole documents, ascending within each; how often each unit occurs in them.
        row = np.repeat(np.arange(len(whole)), np.diff(units.first))
        inside = whole[row]
        row, unit = row[inside], units.inverse[inside]
        used = np.bincount(unit, minlength=len(known))
        key = np.sort((row << 32) | unit) & 0xFFFFFFFF
        doc_units = np.concatenate([[len(whole)], np.where(whole, np.diff(units.first), 0), key]).astype(np.uint32)
        links = self.first[known + 1] - self.first[known]
        pair_of_link, _ = gather(self.pairs, self.first[known], links)
        pairs, place = np.unique(pair_of_link, return_inverse=True)
        counts = np.bincount(place, np.repeat(used, links), len(pairs)).astype(np.int64)
        unit_pairs = np.concatenate([[len(known)], links, place]).astype(np.uint32)
        lists = [doc_ids.to_pylist(), *sums.T.tolist()]
        kinds = [pa.list_(pa.int64())] * 5
        out = [pa.array([number], pa.int64()), *(pa.array([x], k) for x, k in zip(lists, kinds)), pa.array([digests], pa.list_(pa.string()))]
        out += [pa.array([pack(x)], pa.binary()) for x in (doc_units, unit_pairs)]
        return out + [pa.array([x], pa.list_(pa.int64())) for x in (pairs, counts)]


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process: what it learned serves all tasks that the process runs."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def aligned_blocks(documents: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """BLOCK_SCHEMA: the documents in blocks, with their groups, units, and the counts of the block's id pairs."""
    names = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]

    def blocks(batches):
        aligner, number = _aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in W.pieces(batches, 1, BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays(aligner.block(number, batch.column(0), batch.column(1)), names)
            number += 1

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(blocks, BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (A id * 2^32 + B id), n and best: its links in the corpus, and whether no A id has more with its B id."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).where("p.counts > 0")
    counts = counts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))  # one row for each A id at most
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_b))


def align(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA for every row."""
    blocks = stored(aligned_blocks(documents, path_a or _path("byte_bpe_50k.json"), path_b or _path("piece_bpe_32k.model"), id_column, text))
    salts = 1 + blocks.count() // PAIR_ROWS
    asked = blocks.select("block", F.explode("pairs").alias("pair")).withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    totals = pair_counts(blocks).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    told = asked.join(totals, ["pair", "salt"]).select(F.col("block").alias("asking"), "pair", "n", "best")
    held = blocks.select("block", "doc_ids", *_NUMBERS, "digests", "doc_units", "unit_pairs", "pairs")
    return held.groupBy("block").cogroup(told.groupBy("asking")).applyInArrow(_summed(), SCHEMA)


def _summed() -> Callable[[pa.Table, pa.Table], pa.Table]:
    def summed(block: pa.Table, told: pa.Table) -> pa.Table:
        row = {name: block.column(name)[0] for name in block.column_names}
        pairs = row["pairs"].values.to_numpy()
        n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        place = np.searchsorted(pairs, told.column("pair").to_numpy())
        n[place], best[place] = told.column("n").to_numpy(), told.column("best").to_numpy().astype(np.int64)
        unit_pairs = unpack(row["unit_pairs"].as_py(), np.uint32).astype(np.int64)
        units = unit_pairs[0]
        first = np.concatenate([[0], np.cumsum(unit_pairs[1 : 1 + units])])
        pair_of_link = unit_pairs[1 + units :]
        of_unit = np.stack([W.segment_sums(best[pair_of_link], first), W.segment_sums(n[pair_of_link], first)], 1)
        doc_units = unpack(row["doc_units"].as_py(), np.uint32).astype(np.int64)
        docs = doc_units[0]
        sums = W.segment_sums(of_unit[doc_units[1 + docs :]], np.concatenate([[0], np.cumsum(doc_units[1 : 1 + docs])]))
        columns = [row["doc_ids"].values, *(row[name].values for name in _NUMBERS), pa.array(sums[:, 0]), pa.array(sums[:, 1]), row["digests"].values]
        return pa.Table.from_arrays(columns, [part.split()[0] for part in SCHEMA.split(", ")])

    return summed
