"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

1. Every unit of text (a run of letters, digits or signs) has a fixed sparse random index vector.
   The context vector of a unit is the sum of its neighbours' index vectors over *all* documents,
   one vector for each distinct unit, brought to unit length and stored in a byte a dimension.
2. A document is the mean and spread of its units' context vectors, the mean of its index vectors,
   and the mean agreement of neighbouring index vectors (high in repetitive text).
3. A two-layer numpy network is fitted to at most ``FIT_ROWS`` labelled rows. Its temperature is
   fitted on labelled rows that the network has not seen, so that scores are probabilities.

Vectors grow with the corpus and are never collected or broadcast. Documents travel in blocks of
``BLOCK_BYTES`` of text. A block sends the sums of its distinct units, dealt into buckets by the
unit's hash; a bucket adds up what all blocks sent (64-bit sums) and answers each block with the
vectors of just its units; these meet the block's unit counts, and documents are pooled there. A
unit is one row a block, however frequent it is, and there are as many buckets as partitions.

Null and empty texts have no units: their features are zeros, which the network scores like any
other. Null ids are kept; their held_out is null, as they have no crc32. Without labelled rows of
both classes every score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.tables import held_out, stored

DIM = 32
#: Index vectors have this many entries of +1 or -1.
NONZERO = 2
#: Bytes of text of a block.
BLOCK_BYTES = 16 << 20
#: Bits of a unit's name beside its bucket.
NAME_BYTES = 6
#: At most so many labelled rows train the network and set its temperature.
FIT_ROWS = 20_000
#: Of these, one in so many sets the temperature only.
CALIBRATION_SHARE = 5
HIDDEN = 32
EPOCHS = 60
#: Counts of units pooled at a time.
CHUNK = 1 << 16
N_FEATURES = 3 * DIM + 3
#: Values of a unit vector are stored as whole 31sts: a document averages hundreds of them.
SCALE = 31

SENT_SCHEMA = "block long, bucket int, adds boolean, asks boolean, payload binary"
TOLD_SCHEMA = "block long, bucket int, payload binary"
DOCS_SCHEMA = "block long, doc_ids array<long>, k1 array<long>, k2 array<long>, payload binary"
POOLED_SCHEMA = "doc_id long, k1 long, k2 long, x array<float>"


def _index(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and sign of the k-th entry of each unit's index vector."""
    bits = W.seeded(hashes, 11 + k)
    return (bits % np.uint64(DIM)).astype(np.int64), ((bits >> np.uint64(32)) & np.uint64(1)).astype(np.int64) * 2 - 1


@dataclass
class Block:
    """Units of some texts; the distinct ones by bucket and then by hash."""

    units: W.Words
    names: np.ndarray
    bucket: np.ndarray
    inverse: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, buckets: int) -> Block:
        units = W.hashed_words(texts, W.UNITS)
        names, inverse = np.unique(units.hashes, return_inverse=True)
        bucket = (names % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(units, names[order], bucket[order], place[inverse])

    def contexts(self) -> np.ndarray:
        """The sum of the neighbours' index vectors of each distinct unit."""
        total = np.zeros(len(self.names) * DIM, np.int32)
        rows = self.units.rows()
        next_to = rows[1:] == rows[:-1]
        for k in range(NONZERO):
            at, sign = _index(self.units.hashes, k)
            sign = sign.astype(np.int32)
            np.add.at(total, (self.inverse[:-1] * DIM + at[1:])[next_to], sign[1:][next_to])
            np.add.at(total, (self.inverse[1:] * DIM + at[:-1])[next_to], sign[:-1][next_to])
        return total.reshape(-1, DIM)

    def own_features(self) -> np.ndarray:
        """Mean index vector, agreement of neighbours and length of every text; no other block is needed for these."""
        first, h, rows = self.units.first, self.units.hashes, self.units.rows()
        texts = len(first) - 1
        n = np.maximum(np.diff(first), 1)[:, None].astype(np.float32)
        index = np.zeros(texts * DIM)
        for k in range(NONZERO):
            at, sign = _index(h, k)
            index += np.bincount(rows * DIM + at, sign, texts * DIM)
        index = index.reshape(texts, DIM) / n
        same = np.zeros(len(h), np.float32)
        same[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        repeats = W.segment_sums(same, first) / n[:, 0]
        return np.column_stack([np.abs(index), repeats, np.sqrt((index**2).sum(axis=1)), np.log1p(np.diff(first))]).astype(np.float32)

    def unit_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct units of each text in order, how often each occurs, and where each text's begin."""
        key, counts = np.unique((self.units.rows() << 32) | self.inverse, return_counts=True)
        return key & 0xFFFFFFFF, counts, np.searchsorted(key >> 32, np.arange(len(self.units.first)))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, each as a zstandard frame of its bytes, lowest bytes of all values first."""
    out, compressor = [], zstandard.ZstdCompressor(level=3)
    for values in arrays:
        planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
        frame = compressor.compress(np.ascontiguousarray(planes).tobytes())
        out += [len(frame).to_bytes(8, "little"), frame]
    return b"".join(out)


def _unpacked(payload: bytes, *kinds: str) -> Iterator[np.ndarray]:
    at = 0
    for kind in kinds:
        size = int.from_bytes(payload[at : at + 8], "little")
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[at + 8 : at + 8 + size]), np.uint8)
        yield np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)
        at += 8 + size


def pack_sums(names: np.ndarray, sums: np.ndarray) -> bytes:
    """Sorted names (of one bucket) and their sums: a byte for each, and the few that need more."""
    small = sums.reshape(-1).astype(np.int8)
    wide = np.flatnonzero(small != sums.reshape(-1))
    return _packed((names >> np.uint64(64 - 8 * NAME_BYTES)).astype("<u8"), small, wide.astype("<i8"), sums.reshape(-1)[wide].astype("<i4"))


def unpack_sums(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    names, small, wide, values = _unpacked(payload, "<u8", "i1", "<i8", "<i4")
    sums = small.astype(np.int64)
    sums[wide] = values
    return names, sums.reshape(-1, DIM)


def unit_length(sums: np.ndarray) -> np.ndarray:
    """Context vectors from sums, in whole parts of SCALE."""
    length = np.sqrt((sums.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return np.rint(SCALE * sums / np.maximum(length, 1)).astype(np.int8)


def _blocks(batches) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Numbered blocks of a task; the same rows in the same order give the same numbers."""
    number = TaskContext.get().partitionId() << 32
    for batch in W.pieces(batches, 0, BLOCK_BYTES):
        yield number, batch
        number += 1


def _rows(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """text, doc_id and 128 bits of the text; both passes read these, so that both cut the same blocks."""
    key = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.col(text).alias("text"), F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(key).alias("k1"), F.xxhash64(F.lit("quality"), key).alias("k2"))


def _sent(rows: DataFrame, buckets: int, adds: bool, asks: bool) -> DataFrame:
    """SENT_SCHEMA: of each block and bucket, the units and the sums of their contexts."""

    def sent(batches):
        for number, batch in _blocks(batches):
            block = Block.of(batch.column(0), buckets)
            sums = block.contexts() if adds else np.zeros((len(block.names), DIM), np.int32)
            cuts = np.searchsorted(block.bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[k], cuts[k + 1])
                columns = [[number], [k], [adds], [asks], [pack_sums(block.names[part], sums[part])]]
                kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [p.split()[0] for p in SENT_SCHEMA.split(", ")])

    return rows.mapInArrow(sent, SENT_SCHEMA)


def _told(table: pa.Table) -> pa.Table:
    """Answers of one bucket: the vectors of each asking block's units, from the sums of all that add."""
    payloads = [p.as_py() for p in table.column("payload")]
    adds, asks = table.column("adds").to_pylist(), table.column("asks").to_pylist()
    names = np.unique(np.concatenate([unpack_sums(p)[0] for p in payloads]))
    total = np.zeros((len(names), DIM), np.int64)
    for payload, add in zip(payloads, adds):
        if add:
            own, sums = unpack_sums(payload)
            total[np.searchsorted(names, own)] += sums  # a block names a unit once
    vectors = unit_length(total)
    told = [_packed(vectors[np.searchsorted(names, unpack_sums(p)[0])].reshape(-1)) for p, ask in zip(payloads, asks) if ask]
    keep = table.filter(pa.array(asks, pa.bool_()))
    return pa.Table.from_arrays([keep.column("block"), keep.column("bucket"), pa.array(told, pa.binary())], ["block", "bucket", "payload"])


def _counted(rows: DataFrame, buckets: int) -> DataFrame:
    """DOCS_SCHEMA: of each block, its documents' unit counts and own features."""

    def counted(batches):
        for number, batch in _blocks(batches):
            block = Block.of(batch.column(0), buckets)
            unit, counts, first = block.unit_counts()
            gaps = np.diff(unit, prepend=0)
            gaps[first[:-1][np.diff(first) > 0]] = unit[first[:-1][np.diff(first) > 0]]
            payload = _packed(np.array([len(block.names)], "<i8"), np.diff(first).astype("<i4"), gaps.astype("<u4"), counts.astype("<u4"), block.own_features().reshape(-1))
            lists = [pa.array([batch.column(k).to_pylist()], pa.list_(pa.int64())) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, pa.array([payload], pa.binary())], ["block", "doc_ids", "k1", "k2", "payload"])

    return rows.mapInArrow(counted, DOCS_SCHEMA)


def pool(vectors: np.ndarray, unit: np.ndarray, counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text's units."""
    out = np.zeros((len(first) - 1, 2 * DIM), np.float32)
    for low, high in W.row_chunks(first, CHUNK):
        begin, end = first[low], first[high]
        weight = counts[begin:end, None].astype(np.float32)
        v = vectors[unit[begin:end]].astype(np.float32) / SCALE
        n = np.maximum(W.segment_sums(weight, first[low : high + 1] - begin), 1)
        mean = W.segment_sums(weight * v, first[low : high + 1] - begin) / n
        square = W.segment_sums(weight * v * v, first[low : high + 1] - begin) / n
        out[low:high, :DIM], out[low:high, DIM:] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    return out


def _pooled(docs: pa.Table, told: pa.Table) -> pa.Table:
    """POOLED_SCHEMA of one block's documents from their counts and the answers of all buckets."""
    if len(docs) != 1:
        raise ValueError("the documents changed while they were pooled")
    units, sizes, gaps, counts, own = _unpacked(docs.column("payload")[0].as_py(), "<i8", "<i4", "<u4", "<u4", "<f4")
    told = told.sort_by("bucket")
    answers = [next(_unpacked(p.as_py(), "i1")) for p in told.column("payload")]
    vectors = (np.concatenate(answers) if answers else np.zeros(0, np.int8)).reshape(-1, DIM)
    if len(vectors) != units[0]:
        raise ValueError("the documents changed while they were pooled")
    first = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    sums = np.cumsum(gaps, dtype=np.int64)
    before = np.concatenate([[0], sums])[first[:-1]]
    unit = sums - np.repeat(before, sizes)
    x = np.concatenate([pool(vectors, unit, counts, first), own.reshape(len(sizes), -1)], axis=1)
    lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1), pa.float32()), N_FEATURES).cast(pa.list_(pa.float32()))
    columns = [docs.column(name)[0].values for name in ("doc_ids", "k1", "k2")]
    return pa.Table.from_arrays([*columns, lists], ["doc_id", "k1", "k2", "x"])


def pool_documents(documents: DataFrame, corpus: DataFrame | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """POOLED_SCHEMA for every row, stored: its id, 128 bits of its text, its features.

    Word vectors come from the documents themselves, or from another corpus if one is named.
    """
    buckets = max((documents if corpus is None else corpus).rdd.getNumPartitions(), 8)
    rows = _rows(documents, id_column, text)
    sent = _sent(rows, buckets, corpus is None, True)
    if corpus is not None:
        sent = sent.unionByName(_sent(_rows(corpus, id_column, text), buckets, True, False))
    told = sent.groupBy("bucket").applyInArrow(_told, TOLD_SCHEMA)
    counted = _counted(rows, buckets)
    return stored(counted.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_pooled, POOLED_SCHEMA))


@dataclass
class Network:
    """Standardised features -> tanh layer -> logit, divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least log loss on unseen rows, by a search over a geometric grid."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.25, 8, 101)
    return float(grid[int(np.argmin([_log_loss(logits / t, y) for t in grid]))])


def fit(x: np.ndarray, y: np.ndarray, calibration: np.ndarray, seed: int = 7) -> Network:
    """Adam on mini-batches; ``calibration`` marks the rows kept for the temperature."""
    train = ~calibration if len(np.unique(y[~calibration])) == 2 else np.ones(len(y), bool)
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)) if len(y) else 0.5
    width = x.shape[1]
    net = Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return net
    rng = np.random.default_rng(seed)
    xt, yt = x[train].astype(np.float64), y[train].astype(np.float64)
    net.mean, net.scale = xt.mean(axis=0), np.maximum(xt.std(axis=0), 1e-3)
    xt = (xt - net.mean) / net.scale
    net.w1 = rng.normal(0, width**-0.5, (width, HIDDEN))
    net.w2 = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(yt))
        for at in range(0, len(order), 128):
            xb, yb = xt[order[at : at + 128]], yt[order[at : at + 128]]
            hidden = np.tanh(xb @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -30, 30))) - yb) / len(yb)
            back = np.outer(error, params[2]) * (1 - hidden**2)
            grads = [xb.T @ back + 1e-3 * params[0], back.sum(axis=0), hidden.T @ error + 1e-3 * params[2], np.array([error.sum()])]
            step += 1
            for p, g, mi, vi in zip(params, grads, m, v):
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                p -= 2e-3 * (mi / (1 - 0.9**step)) / (np.sqrt(vi / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    net.temperature = fit_temperature(net.logits(x[~train]), y[~train])
    return net


def fit_quality(pooled: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Network:
    """The network from at most ``rows`` labelled rows that may be learned from, in hash order.

    The ids are chosen from the label table alone; only that bounded list meets the documents.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = pooled.join(F.broadcast(ids), "doc_id").select("doc_id", "k1", "x", "label").toArrow().sort_by([("doc_id", "ascending"), ("k1", "ascending")])
    doc_id, y = sample["doc_id"].to_numpy(), sample["label"].to_numpy()
    x = sample["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES) if len(sample) else np.zeros((0, N_FEATURES))
    return fit(x, y, W.mix(doc_id.astype(np.uint64)) % np.uint64(CALIBRATION_SHARE) == 0)


def _scored(pooled: DataFrame, network: Network) -> DataFrame:
    """doc_id, k1, k2, score."""
    shared = pooled.sparkSession.sparkContext.broadcast(network)

    def scored(batches):
        for batch in batches:
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(shared.value.probabilities(x), pa.float64())], ["doc_id", "k1", "k2", "score"])

    return pooled.mapInArrow(scored, "doc_id long, k1 long, k2 long, score double")


def score_quality(pooled: DataFrame, network: Network, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every pooled row."""
    return _scored(pooled, network).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(documents: DataFrame, pooled: DataFrame, network: Network, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The documents, same columns, whose score reaches the threshold; a row's score depends on its text alone."""
    low = _scored(pooled, network).where(F.col("score") < threshold).select(F.col("k1").alias("low1"), F.col("k2").alias("low2")).distinct()
    key = F.coalesce(documents[text], F.lit(""))
    return documents.join(low, (F.xxhash64(key) == low["low1"]) & (F.xxhash64(F.lit("quality"), key) == low["low2"]), "left_anti")
