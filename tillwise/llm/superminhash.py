"""MinHash near-deduplication with SuperMinHash signatures.

* A document's set: hashes of its distinct shingles (``size`` words in a row, A-Z lower-cased).
* Signature: every element visits the registers in an order of its own and offers its step number
  plus a random fraction; a register keeps its least offer. As the offers of one element are a
  permutation, estimates vary less than with independent hashes. Once every register holds less
  than the next step number, later steps cannot matter and the loop stops.
* Banding: documents that agree on a whole band share a bucket.
* Verification: links are confirmed on the full sets, exactly.
* Grouping: union-find inside tasks, then joins, give each document its component.

How groups of any size are handled. Documents with equal sets are one class from the start. Each
class is first checked against one other only, the bucket centre with which it shares most bands;
that joins most of a group of copies. What is left are pairs in a bucket whose classes are still in
different components: buckets are dealt out in blocks of ``BLOCK`` classes, and a group of two
blocks compares signatures in numpy. Classes with a partner in another component and an estimate
near the threshold go on, with their texts, and the group checks those pairs on full sets. Pairs
are never rows. So no pair that shares a band is skipped unless its classes are already in one
component or its estimate is more than ``MARGIN`` below the threshold.

Chances to lose a link: at a threshold of 0.85, 32 bands of 8 rows miss a pair of just that
similarity with 4e-5 (0.9: 2e-8); at 0.8, 42 bands of 6 rows with 3e-6. The margin of 0.1 is over
four standard deviations of the estimate.

Null and empty texts, or those without words, have no set and no links; fewer than ``size`` words
are one shingle. The nodes of the graph are sets, not ids: rows of a repeated id are grouped by what
each of them holds, and rows without an id by their text. A component is named by the least id of its
rows, or by null if none has an id; ``one_of_each`` keeps one row of each component, repeated
rows and null ids included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.tables import stored

REGISTERS = 256
#: Greatest chance that banding misses a pair right at the threshold; it sets the rows of a band.
MISS = 1e-4
#: Estimates this far below the threshold rule a pair out.
MARGIN = 0.1
#: Classes of a bucket that one task compares with as many others.
BLOCK = 256
#: Tasks that the rows of one bucket are spread over when they meet what is known of it.
SALTS = 32
#: Shingles sketched, and bytes of text cut, at a time.
CHUNK = 1 << 16
CHUNK_BYTES = 2 << 20
SEED = 20_170_618


def rows_of_band(percent: int) -> int:
    """Most rows a band may have for MISS to hold at the threshold."""
    missed = lambda rows: (1 - (percent / 100) ** rows) ** (REGISTERS // rows)
    return max((rows for rows in range(1, 17) if missed(rows) <= MISS), default=1)


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and where each begins."""
    words = W.hashed_words(texts, W.BLANK_WORDS, W.ASCII_LOWER)
    n = words.counts()
    out, lengths = [], np.zeros(len(n), np.int64)
    for low, high in W.row_chunks(words.first, CHUNK * 4):
        first = words.first[low : high + 1] - words.first[low]
        h = words.hashes[words.first[low] : words.first[high]]
        window = np.zeros(max(len(h) - size + 1, 0), np.uint64)
        for k in range(size):
            window = W.mix(window + h[k : k + len(window)])
        for row in range(low, high):
            a, b = first[row - low], first[row - low + 1]
            if b - a >= size:
                found = np.unique(window[a : b - size + 1])
            elif b > a:
                found = np.array([b - a], np.uint64)
                for k in range(a, b):
                    found = W.mix(found + h[k : k + 1])
                found = found ^ np.uint64(0x5DEECE66D)
            else:
                continue
            out.append(found)
            lengths[row] = len(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(lengths)])


def sketch(elements: np.ndarray, first: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signature of each set ``elements[first[i]:first[i + 1]]``; rows of floats."""
    out = np.full((len(first) - 1, registers), np.inf)
    for low, high in W.row_chunks(first, CHUNK):
        sets = np.flatnonzero(np.diff(first[low : high + 1]) > 0) + low
        if len(sets):
            out[sets] = _sketch(elements[first[low] : first[high]], np.diff(first[low : high + 1])[sets - low], registers)
    return out


def _sketch(elements: np.ndarray, lengths: np.ndarray, registers: int) -> np.ndarray:
    best = np.full(len(lengths) * registers, np.inf)
    base = np.repeat(np.arange(len(lengths)) * registers, lengths)
    order = np.tile(np.arange(registers, dtype=np.int16), (len(elements), 1))
    live = np.arange(len(lengths))  # sets that may still change
    element = np.arange(len(elements))
    for step in range(registers):
        draw = W.seeded(elements, SEED + step)
        # The next register of each element's permutation: one step of a Fisher-Yates shuffle.
        pick = step + (draw % np.uint64(registers - step)).astype(np.int64)
        register = order[element, pick].astype(np.int64)
        order[element, pick] = order[element, step]
        fraction = (W.mix(draw) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(best, base + register, step + fraction)
        done = best.reshape(-1, registers)[live].max(axis=1) < step + 1
        if done.any():
            if done.all():
                break
            stay = np.zeros(len(lengths), bool)
            stay[live[~done]] = True
            keep = stay[base // registers]
            elements, base, order, live = elements[keep], base[keep], order[keep], live[~done]
            element = np.arange(len(elements))
    return best.reshape(-1, registers)


SKETCH_SCHEMA = "doc_id long, row long, t1 long, n_shingles long, name long, bands array<long>, marks binary"


def _row_key(id_column: str, text: str) -> tuple:
    """Names of a row (its id and text) and of its text, 64 bits each; together they tell rows apart."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return F.xxhash64(F.col(f"`{id_column}`").cast("long"), content), F.xxhash64(F.lit("text"), content)


def named_rows(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, row, t1 of every row."""
    row, t1 = _row_key(id_column, text)
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), row.alias("row"), t1.alias("t1"))


def sketches(documents: DataFrame, size: int, rows_each: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: its id, names of the row and of its text, set size, name of the set, band keys, and a byte of each register."""
    n_bands = REGISTERS // rows_each

    def sketched(batches):
        for batch in W.pieces(batches, 3, CHUNK_BYTES):
            elements, first = shingles(batch.column(3), size)
            n = np.diff(first)
            # Names of sets: from sums over their elements, so they do not depend on order.
            low, high = (W.segment_sums(W.seeded(elements, k).view(np.int64), first).view(np.uint64) for k in (1, 2))
            name = W.mix(W.mix(low + n.astype(np.uint64)) + high).view(np.int64)
            bits = np.ascontiguousarray(sketch(elements, first)).view(np.uint64)
            keys = np.zeros((len(n), n_bands), np.uint64)
            for r in range(rows_each):
                keys = W.mix(keys + bits[:, r : n_bands * rows_each : rows_each])
            keys = W.mix(keys + np.arange(1, n_bands + 1, dtype=np.uint64))
            marks = (W.mix(bits) & np.uint64(255)).astype(np.uint8)
            has = n > 0
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * n_bands)]), pa.int32()), pa.array(keys[has].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n), pa.array(name), bands, pa.array([m.tobytes() for m in marks], pa.binary())], [c.split()[0] for c in SKETCH_SCHEMA.split(", ")])

    rows = named_rows(documents, id_column, text).select("doc_id", "row", "t1", "text")
    return rows.mapInArrow(sketched, SKETCH_SCHEMA)


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The (a, b) pairs with 100 * intersection >= percent * union on their full sets.

    pairs: a, b. texts: name, text of every class that occurs.
    """
    left = texts.select(F.col("name").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("name").alias("b"), F.col("text").alias("text_b"))

    def checked(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                x, fx = shingles(part.column(2), size)
                y, fy = shingles(part.column(3), size)
                keep = []
                for k in range(part.num_rows):
                    keep.append(_linked(x[fx[k] : fx[k + 1]], y[fy[k] : fy[k + 1]], percent))
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(checked, "a long, b long")


def _forest(batches):
    """Union-find over a task's edges: each node that is not a root, with its root."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    tied = [(x, root(x)) for x in parent]
    tied = [(x, r) for x, r in tied if x != r]
    yield pa.RecordBatch.from_arrays([pa.array([t[k] for t in tied], pa.int64()) for k in (0, 1)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of ``edges`` (a, b).

    After union-find inside tasks, rounds of: each node learns its least neighbour; both ends of
    an edge are tied to the lesser of what the two have learned. A hub's neighbours are never
    collected, and the number of rounds grows with the logarithm of the longest chain.
    """
    edges = stored(edges.mapInArrow(_forest, "a long, b long").distinct())
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        of_a = least.select("a", F.col("least").alias("least_a"))
        of_b = least.select(F.col("a").alias("b"), F.col("least").alias("least_b"))
        ties = edges.join(of_a, "a").join(of_b, "b").select(F.explode(F.array("a", "b")).alias("a"), F.least("least_a", "least_b").alias("b"))
        edges = stored(ties.where("a != b").distinct())
        # Done when every node has one tie and none of a tie's targets is tied itself.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("b", F.lit(0), F.lit(1)))
        open_ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out = 1 AND into = 1)")
        if open_ends.isEmpty():
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold, exactly."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= percent * (len(p) + len(q) - both)


BLOCK_KEY = ["bucket", "low", "high"]


def open_members(members: DataFrame, percent: int) -> DataFrame:
    """BLOCK_KEY, name, component, partners: classes that may have a link across components.

    members: bucket, blocks (of its bucket), name, component, bands, marks. A pair of blocks is
    one group, so a bucket of g classes gives g * ceil(g / BLOCK) rows, not g * g. The partners of
    a class are those in its group that are in another component, share no earlier bucket with
    it, and have an estimate near the threshold; best estimates come first.
    """
    placed = members.withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("*", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    least = (percent / 100 - MARGIN) * (1 - 1 / 256) + 1 / 256

    def compare(keys: tuple, rows: pa.Table) -> pa.Table:
        ids, component = rows["name"].to_numpy(), rows["component"].to_numpy()
        bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        marks = np.frombuffer(b"".join(rows["marks"].to_pylist()), np.uint8).reshape(-1, REGISTERS)
        block = rows["block"].to_numpy()
        bucket, low, high = (k.as_py() for k in keys)
        partners: list[list[int]] = [[] for _ in ids]
        involved = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            if low == high:
                others = np.arange(i + 1, len(ids))
            elif block[i] == low:
                others = np.flatnonzero(block == high)
            else:
                continue
            others = others[component[others] != component[i]]
            # The bucket of the first band that both share has the pair; the rest leave it out.
            shared = bands[others] == bands[i]
            others = others[bands[i][shared.argmax(axis=1)] == bucket] if len(others) else others
            estimate = (marks[others] == marks[i]).mean(axis=1)
            others, estimate = others[estimate >= least], estimate[estimate >= least]
            if len(others):
                partners[i] = ids[others[np.argsort(-estimate, kind="stable")]].tolist()
                involved[i] = involved[others] = True
        keep = np.flatnonzero(involved)
        columns = [pa.array([k.as_py()] * len(keep), t) for k, t in zip(keys, (pa.int64(), pa.int32(), pa.int32()))]
        columns += [pa.array(ids[keep]), pa.array(component[keep]), pa.array([partners[i] for i in keep], pa.list_(pa.int64()))]
        return pa.Table.from_arrays(columns, [*BLOCK_KEY, "name", "component", "partners"])

    schema = "bucket long, low int, high int, name long, component long, partners array<long>"
    return dealt.select(*BLOCK_KEY, "block", "name", "component", "bands", "marks").groupBy(*BLOCK_KEY).applyInArrow(compare, schema)


def open_links(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """a, b: confirmed links that tie different components together, from ``open_members``.

    Each group gets its members' texts once and checks its pairs on full sets. A pair whose
    components an earlier link of the group has tied needs no check and no row.
    """

    def confirm(keys: tuple, rows: pa.Table) -> pa.Table:
        sets: list[np.ndarray] = []
        for batch in W.pieces(rows.select(["text"]).to_batches(), 0, CHUNK_BYTES):
            elements, first = shingles(batch.column(0), size)
            sets += [elements[a:b] for a, b in zip(first, first[1:])]
        ids, component = rows["name"].to_pylist(), rows["component"].to_pylist()
        place = {name: k for k, name in enumerate(ids)}
        parent = {c: c for c in component}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a, b = [], []
        for k, partners in enumerate(rows["partners"].to_pylist()):
            for partner in partners:
                x, y = root(component[k]), root(component[place[partner]])
                if x != y and _linked(sets[k], sets[place[partner]], percent):
                    parent[max(x, y)] = min(x, y)
                    a.append(ids[k])
                    b.append(partner)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return members.join(texts, "name").groupBy(*BLOCK_KEY).applyInArrow(confirm, "a long, b long")


def grouped(documents: DataFrame, size: int, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, t1, n_shingles, component (a name; null for an empty set), component_id of every row."""
    rows = named_rows(documents, id_column, text)
    every = stored(sketches(documents, size, rows_of_band(percent), id_column, text))
    # Classes of equal sets, combined before the shuffle; one row of each stands for it.
    classes = stored(every.where("n_shingles > 0").groupBy("name").agg(F.min("row").alias("row"), F.min("doc_id").alias("least_id")))
    marked = every.where("n_shingles > 0").join(classes.select("row"), "row", "left_semi").select("name", "bands", "marks").dropDuplicates(["name"])
    marked = stored(marked)

    keys = marked.select("name", F.explode("bands").alias("bucket"))
    buckets = keys.groupBy("bucket").agg(F.min("name").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    in_buckets = stored(keys.join(buckets.select("bucket", "centre", "n"), "bucket"))
    shared = in_buckets.where("name != centre").groupBy("name", "centre").agg(F.count(F.lit(1)).alias("bands_shared"))
    # Of centres that share as many bands the greater name is taken.
    star = stored(shared.groupBy("name").agg(F.max_by("centre", F.struct("bands_shared", "centre")).alias("centre")).select(F.col("centre").alias("a"), F.col("name").alias("b")))
    standing = classes.join(in_buckets.select("name").distinct(), "name", "left_semi").select("row", "name")
    texts = stored(rows.select("row", "text").join(standing, "row").dropDuplicates(["name"]).select("name", "text"))
    links = stored(verified(star, texts, size, percent))
    first = stored(components(links))

    # Buckets that still hold different components. The rows of one bucket are spread over SALTS
    # tasks; what is known of the bucket goes to each of them.
    label, salt = F.coalesce("component", "name"), F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int").alias("salt")
    members = in_buckets.join(first, in_buckets["name"] == first["node"], "left").select("bucket", salt, "name", label.alias("component"))
    spans = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    unsettled = spans.where("x != y").select("bucket", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = members.join(unsettled, ["bucket", "salt"]).join(marked, "name")
    more = stored(open_links(stored(open_members(members, percent)), texts, size, percent))
    final = components(links.union(more))

    # The least id of each component; its classes, too, are spread over SALTS tasks to meet it.
    tied = stored(classes.join(final, classes["name"] == final["node"]).select("name", salt, "component", "least_id"))
    least = tied.groupBy("component").agg(F.min("least_id").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    tied = tied.join(least, ["component", "salt"]).select("name", "component", "component_id")
    alone = classes.join(tied.select("name"), "name", "left_anti").select("name", F.col("name").alias("component"), F.col("least_id").alias("component_id"))
    return every.select("doc_id", "row", "t1", "n_shingles", "name").join(tied.union(alone), "name", "left").select(
        "doc_id", "row", "t1", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).alias("component"),
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def deduplicate(documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents``."""
    found = grouped(documents, size, percent, id_column, text)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(documents: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, same columns, with one row of each component: that of the least id, null last, and of its least text.

    Of rows that are equal in id and text one stays. Rows without words are linked with nothing and all stay.
    """
    found = stored(grouped(documents, size, percent, id_column, text).where("n_shingles > 0"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "t1", "row")
    standing = found.groupBy("component").agg(F.min(order).alias("one")).select("one.row", "one.t1")
    again = stored(found.groupBy("row", "t1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(standing, ["row", "t1"], "left_semi").select("row", "t1"))
    out = found.select("row", "t1").join(standing, ["row", "t1"], "left_anti").distinct().union(again)
    row, t1 = _row_key(id_column, text)
    same = lambda names: (row == names["row"]) & (t1 == names["t1"])
    kept = documents.join(out, same(out), "left_anti")
    if again.isEmpty():
        return kept
    repeated = documents.join(again, same(again), "left_semi")
    return kept.unionByName(repeated.dropDuplicates([id_column, text]))
