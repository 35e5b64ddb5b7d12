"""Conversation prefix trie: ternary search trees over range shards.

Turns are named by 128 bits of their place, role and text; texts are hashed where they are read and
never shuffled. Conversations become sequences of turn names, in segments of at most ``SEGMENT``
turns; equal segments behind equal beginnings are one row with their number and least id. The rows
are sorted and dealt out by range. A shard (a block of neighbouring rows) numbers its turns in order
and inserts its sequences into a ternary search tree, the median first and then the medians of both
halves, so that no search is long. An iterative traversal from the leaves up gives each node its
members, least id, children, leaves and saved tokens.

A node whose members may lie in several shards is open: those on the way to a shard's first and last
row, and those above a segment that goes on. Open nodes are merged by name. Their leaves and savings
are summed up the tree by doubling: each round adds the sums of the nodes 2^k levels below, so the
rounds grow with the logarithm of the depth and no shard, group or driver holds the tree.

Rows without a conversation id belong to no conversation and give nothing. A conversation is ordered
by turn (null first), rows of one turn by a hash of role and text; repeated rows are turns of their
own. Null role or text is the empty one. An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.tables import stored

#: Turns of a segment: bounds the rows that hold sequences.
SEGMENT = 512
#: Turns of a shard's tree; a partition is cut into as many shards as it needs.
SHARD_TURNS = 200_000
#: Ids in one piece of a node's list.
LIST_PIECE = 512
WORD = r"[^\x20\x09-\x0D]+"

_NAME = "depth long, k1 long, k2 long"
SHARD_SCHEMA = (
    f"shard long, open boolean, {_NAME}, p1 long, p2 long, parent_open boolean, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long"
)


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, pos (from 1), d1, d2 (128 bits of role and text) and words of every turn; hashed before the shuffle."""
    said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("d1"), F.xxhash64(F.lit("turn"), *reversed(said)).alias("d2"),
        F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"),
    )
    rows = rows.withColumn("family", F.col("conv_id") - F.col("conv_id") % 20).repartition("family")
    order = Window.partitionBy("family", "conv_id").orderBy(F.col("turn").asc_nulls_first(), "d1", "d2")
    return rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """family, conv_id, pos, d1, d2, words of rebuilt conversations; one without turns has a row at pos 0.

    A conversation c begins with the first crc32(c) % 4 turns of c - c % 20 and goes on with its own
    turns behind its first so many.
    """
    head = F.struct("pos", "d1", "d2", "words")
    heads = turns.where((F.col("conv_id") == F.col("family")) & (F.col("pos") <= 3))
    heads = heads.groupBy("family").agg(F.array_sort(F.collect_list(head)).alias("heads"))  # three rows at most
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    rows = turns.join(heads, "family", "left").withColumn("h", h)
    begin = F.when(F.col("h") > 0, F.slice(F.coalesce("heads", F.array().cast(f"array<{_struct()}>")), 1, F.greatest(F.col("h"), F.lit(1)).cast("int")))
    rows = rows.withColumn("begin", F.coalesce(begin, F.array().cast(f"array<{_struct()}>")))
    place = (F.size("begin") + F.col("pos") - F.col("h")).alias("pos")
    own = F.when(F.col("pos") > F.col("h"), F.array(F.struct(place.cast("long").alias("pos"), "d1", "d2", "words")))
    first = F.when(F.col("pos") == 1, F.concat(F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("d1"), F.lit(0).cast("long").alias("d2"), F.lit(0).cast("long").alias("words"))), F.col("begin")))
    none = F.array().cast(f"array<{_struct()}>")
    return rows.select("family", "conv_id", F.inline(F.concat(F.coalesce(first, none), F.coalesce(own, none))))


def _struct() -> str:
    return "struct<pos:bigint,d1:bigint,d2:bigint,words:bigint>"


def segments_of(items: DataFrame, size: int = SEGMENT) -> DataFrame:
    """family, conv_id, segment, turns (array of z1, z2, words), c1, c2 (name of what lies before) and last.

    The name of a beginning is the bitwise sum of the names z of its turns, which know their place.
    Every conversation has a segment 0; it is empty for one without turns.
    """
    named = items.select(
        "family", "conv_id", "pos", "words", F.xxhash64("pos", "d1", "d2").alias("z1"), F.xxhash64("d2", "pos", "d1").alias("z2"),
        F.when(F.col("pos") == 0, 0).otherwise(F.expr(f"(pos - 1) div {size}")).alias("segment"),
    )
    turn = F.when(F.col("pos") > 0, F.struct("pos", "z1", "z2", "words"))
    rows = named.groupBy("family", "conv_id", "segment").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        *(F.bit_xor(F.when(F.col("pos") > 0, F.col(z)).otherwise(0)).alias(f"x{z[1]}") for z in ("z1", "z2")),
    )
    order = Window.partitionBy("family", "conv_id").orderBy("segment")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        "conv_id", "segment", F.transform("turns", lambda t: F.struct(t["z1"], t["z2"], t["words"])).alias("turns"),
        *(F.coalesce(F.bit_xor(x).over(before), F.lit(0).cast("long")).alias(f"c{x[1]}") for x in ("x1", "x2")), "x1", "x2",
        F.lead("segment").over(order).isNull().alias("last"),
    )


class Tree:
    """A ternary search tree over sequences of codes, one node for each code at each place."""

    def __init__(self):
        self.code, self.low, self.high, self.down, self.up = [], [], [], [], []

    def _node(self, code: int, up: int) -> int:
        self.code.append(code)
        self.low.append(-1)
        self.high.append(-1)
        self.down.append(-1)
        self.up.append(up)
        return len(self.code) - 1

    def insert(self, codes: list[int]) -> int:
        """The node of the last code (codes must not be empty)."""
        if not self.code:
            self._node(codes[0], -1)
        at, up, k, last = 0, -1, 0, len(codes) - 1
        while True:
            code, here = codes[k], self.code[at]
            if code == here:
                if k == last:
                    return at
                k, up = k + 1, at
                if self.down[at] < 0:
                    self.down[at] = self._node(codes[k], up)
                at = self.down[at]
                continue
            side = self.low if code < here else self.high
            if side[at] < 0:
                side[at] = self._node(code, up)
            at = side[at]


def medians(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle first, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    for low, high in ranges:
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(low, middle), (middle + 1, high)]


def shard_nodes(shard: int, rows: pa.Table, size: int = SEGMENT) -> pa.RecordBatch:
    """SHARD_SCHEMA for sorted rows (segment, c1, c2, turns, last, n, conv_id) of one shard."""
    segment, c1, c2, n, least = (rows.column(c).to_numpy() for c in ("segment", "c1", "c2", "n", "conv_id"))
    goes_on = ~rows.column("last").to_numpy().astype(bool)
    lists = rows.combine_chunks().column("turns").chunk(0)
    length = lists.value_lengths().to_numpy()
    flat = lists.flatten()
    z1, z2, words = (flat.field(k).to_numpy() for k in range(3))
    first = np.concatenate([[0], np.cumsum(length)])
    # Dictionary: names of turns, and of the beginnings the segments hang on, in order.
    roots, root = np.unique(np.stack([segment, c1, c2], 1), axis=0, return_inverse=True)
    turn_names, turn = np.unique(np.stack([z1, z2], 1), axis=0, return_inverse=True) if len(z1) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    root, turn = root.reshape(-1).tolist(), turn.reshape(-1).tolist()
    tree, ends = Tree(), np.zeros(len(n), np.int64)
    for row in medians(len(n)):
        ends[row] = tree.insert([root[row], *turn[first[row] : first[row + 1]]])
    nodes = len(tree.code)
    code, up = np.array(tree.code), np.array(tree.up)
    word_of_turn = np.zeros(len(turn_names), np.int64)
    word_of_turn[turn] = words
    # Names, depths and the way to the first and last row, from the top down.
    depth, k1, k2, own_words = (np.zeros(nodes, np.int64) for _ in range(4))
    is_root = up < 0
    depth[is_root], k1[is_root], k2[is_root] = roots[code[is_root], 0] * size, roots[code[is_root], 1], roots[code[is_root], 2]
    levels, level = [np.flatnonzero(is_root)], np.full(nodes, -1)
    level[is_root] = 0
    by_up = np.argsort(up, kind="stable")
    begin = np.searchsorted(up[by_up], np.arange(nodes + 1))
    while True:
        above = levels[-1]
        count = begin[above + 1] - begin[above]
        if not count.sum():
            break
        at = np.arange(count.sum()) + np.repeat(begin[above] - (np.cumsum(count) - count), count)
        below = by_up[at]
        top, name = up[below], turn_names[code[below]]
        depth[below], k1[below], k2[below] = depth[top] + 1, k1[top] ^ name[:, 0], k2[top] ^ name[:, 1]
        own_words[below] = word_of_turn[code[below]]
        levels.append(below)
    is_open = is_root & (depth > 0)
    is_open[ends[goes_on]] = True
    is_open[ends[[0, len(n) - 1]]] = True
    members, conv = np.zeros(nodes, np.int64), np.full(nodes, np.iinfo(np.int64).max)
    np.add.at(members, ends, n)
    np.minimum.at(conv, ends, least)
    children, leaves, saved = (np.zeros(nodes, np.int64) for _ in range(3))
    for below in levels[:0:-1]:  # from the leaves up
        top = up[below]
        closed = ~is_open[below]
        np.logical_or.at(is_open, top[~closed], True)
        np.add.at(members, top, members[below])
        np.minimum.at(conv, top, conv[below])
        leaves[below[closed]] = np.maximum(leaves[below[closed]], children[below[closed]] == 0)
        saved[below[closed]] += (members[below[closed]] - 1) * own_words[below[closed]]
        for sums, values in ((children, np.ones(nodes, np.int64)), (leaves, leaves), (saved, saved)):
            np.add.at(sums, top[closed], values[below[closed]])
    is_open[is_root] = True
    # A later segment's root is counted where the segment before it ends.
    again = is_root & (depth > 0)
    top = np.maximum(up, 0)
    known = np.iinfo(np.int64).max != conv
    columns = {
        "shard": np.full(nodes, shard), "open": is_open, "depth": depth, "k1": k1, "k2": k2,
        "p1": pa.array(k1[top], mask=is_root), "p2": pa.array(k2[top], mask=is_root), "parent_open": pa.array(is_open[top], mask=is_root),
        "conv_id": pa.array(conv, mask=again | ~known), "parent_conv_id": pa.array(conv[top], mask=is_root | is_open[top]),
        "n_convs": np.where(again, 0, members), "n_children": children, "n_leaves": leaves, "saved_tokens": saved, "words": own_words,
    }
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def shard_trees(segments: DataFrame, size: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """SHARD_SCHEMA: the nodes of every shard of the distinct segments."""
    key = ["segment", "c1", "c2", "turns"]
    distinct = stored(segments.groupBy(*key, "last").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")))
    # One expression orders the shards: neighbours in it share beginnings.
    sorted_rows = distinct.repartitionByRange(*key).sortWithinPartitions(*key)

    def nodes(batches):
        shard, held, turns = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            size_of = np.cumsum(pa.compute.list_value_length(batch.column("turns")).to_numpy() + 1)
            at = 0
            while at < batch.num_rows:
                room = (size_of[at - 1] if at else 0) + shard_turns - turns
                to = max(at + 1, int(np.searchsorted(size_of, room, "right")))
                held.append(batch.slice(at, to - at))
                turns += int(size_of[to - 1] - (size_of[at - 1] if at else 0))
                at = to
                if turns >= shard_turns or at < batch.num_rows:
                    yield shard_nodes(shard, pa.Table.from_batches(held), size)
                    shard, held, turns = shard + 1, [], 0
        if held:
            yield shard_nodes(shard, pa.Table.from_batches(held), size)

    return sorted_rows.mapInArrow(nodes, SHARD_SCHEMA)


def merged_open(nodes: DataFrame) -> DataFrame:
    """depth, k1, k2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens of the open nodes."""
    name = ["depth", "k1", "k2"]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    rows = stored(nodes.where("open").groupBy(*name).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), *sums))
    above = [F.col("depth") - 1, F.col("p1"), F.col("p2")]
    more = rows.where("p1 IS NOT NULL").groupBy(*(c.alias(k) for c, k in zip(above, name))).agg(F.count("*").alias("open_children"))
    rows = rows.join(more, name, "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0)))
    parents = rows.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    rows = rows.join(parents, ["depth", "p1", "p2"], "left").select(
        *name, (F.col("depth") - 1).alias("up_depth"), F.col("p1").alias("up1"), F.col("p2").alias("up2"), "conv_id", "parent_conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"), (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    rows = stored(rows)
    up = ["up_depth", "up1", "up2"]
    deepest = rows.where("up1 IS NOT NULL").agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        reach = rows.where("up1 IS NOT NULL")
        come = reach.groupBy(*(F.col(u).alias(k) for u, k in zip(up, name))).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = rows.select(*(F.col(k).alias(u) for k, u in zip(name, up)), *(F.col(u).alias(f"next_{u}") for u in up))
        rows = rows.join(come, name, "left").join(further, up, "left").select(
            *name, *(F.col(f"next_{u}").alias(u) for u in up), "conv_id", "parent_conv_id", "n_convs", "n_children",
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )
        rows, step = stored(rows), 2 * step
    return rows.drop(*up)


def ends_of(segments: DataFrame, size: int = SEGMENT, piece: int = LIST_PIECE) -> DataFrame:
    """depth, k1, k2 and ends_sha256 of every node at which conversations end.

    Lists are sorted in pieces and then hashed as a stream, in order of their pieces: a digest of one list
    is made by one task, which holds a batch of pieces at a time.
    """
    ends = segments.where("last").select(
        (F.col("segment") * size + F.size("turns")).alias("depth"), F.col("c1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("c2").bitwiseXOR(F.col("x2")).alias("k2"), "conv_id",
        F.expr(f"conv_id div {piece}").alias("piece"),
    )
    name = ["depth", "k1", "k2"]
    pieces = ends.groupBy(*name, "piece").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    pieces = pieces.repartition(*name).sortWithinPartitions(*name, "piece").select(*name, "ids")

    def digests(batches):
        current, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != current:
                    if current:
                        done.append((*current, digest.hexdigest()))
                    current, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digest_batch(done)
        if current:
            yield _digest_batch([(*current, digest.hexdigest())])

    return pieces.mapInArrow(digests, f"{_NAME}, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["depth", "k1", "k2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, size: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    segments = stored(segments_of(rebuilt(turns_of(conversations)), size))
    nodes = stored(shard_trees(segments, size, shard_turns))
    merged = merged_open(nodes)
    name = ["depth", "k1", "k2"]
    # A closed node under an open one asks for its parent's id, inside its shard: a shard has few rows of any parent.
    # Where a segment ends and the next begins in one shard, only the next one's row has children.
    parents = nodes.where("open AND n_children > 0").select("shard", *name).join(merged.select(*name, "conv_id"), name)
    parents = parents.select("shard", (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("merged_conv_id"))
    closed = nodes.where("NOT open").join(parents, ["shard", "depth", "p1", "p2"], "left")
    columns = ["conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "merged_conv_id")).select(*name, *columns)
    found = closed.unionByName(merged.select(*name, *columns)).join(ends_of(segments, size), name, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
