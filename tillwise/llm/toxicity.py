"""Toxicity: class-conditional Kneser-Ney models, toxic against ordinary.

One chain of levels, each smoothed by the next through an absolute discount n1 / (n1 + 2 n2) from its
own counts of counts, and each summing to one over the words of the corpus:

* word after word, in a class;
* continuation counts of a word in a class: after how many different words it occurs there;
* continuation counts of its stem (the first ``STEM`` bytes) in a class, for rare inflected forms;
* the shared level, from *all* documents: a stem's share of all distinct pairs of words, and a
  word's share of its stem's. A pair counts once in the corpus, however many documents hold it.
  Rare and unseen expressions end here, where the classes do not differ.

A text's evidence is its log-likelihood under the toxic model less that under the ordinary one,
divided by length: over the whole text and over its most toxic window of 1, 4 and 16 words, since
an insult in a long text is enough. The same is taken without the first level, from continuation
counts alone, which a passage that one toxic text holds hardly moves; there also the 2nd, 3rd, 5th
and 8th most toxic word count, as toxic texts have several. A logistic calibration turns all this
into a probability; it comes from labelled rows outside the counted sample.

Shared shares of words and stems that neither class has counted stand in both likelihoods alike and
fall out of their difference. So only those of counted words and stems are sent to the tasks, though
all distinct pairs are counted for them (``shared_counts``).

Bounds: ``FIT_ROWS`` counted rows a class, in hash order and as long as their texts hold no more than
``FIT_BYTES``, and ``CALIBRATION_ROWS`` calibration rows; labels are learned from nothing else. What
the driver holds and broadcasts depends on these only. Null and empty texts have no words; their
score is that of the calibration at zero evidence. Without both labels every score is the share of
label 1. A null id is scored like any other; its held_out is null, as it has no crc32.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm import words as W
from tillwise.llm.tables import SUM_SCHEMA, block_rows, held_out, pack, shared_folder, tree_sum, unpack

#: Labelled rows counted for each class, in hash order, and the most bytes of text they may hold.
FIT_ROWS = 4_000
FIT_BYTES = 16 << 20
#: Labelled rows of the calibration, in hash order, apart from the counted ones.
CALIBRATION_ROWS = 4_000
CALIBRATION_SHARE = 5
#: Distinct pairs a task holds before it sends them on.
HELD_PAIRS = 4_000_000
#: Bits of a pair's name beside its bucket and its word or stem.
PAIR_BITS = 40
COUNT_BLOCKS = 16
#: Pieces in which the driver fetches the sample's counts.
PIECES = 8
CHUNK = 1 << 18
STEM = 5
WINDOWS = (1, 4, 16)
#: Words of a text, from its most toxic one on (0), whose evidence counts by itself.
RANKS = (1, 2, 4, 7)
#: Constant; mean and windows with and without the pairs of words; ranked words; log length.
N_INPUTS = 1 + 2 * (1 + len(WINDOWS)) + len(RANKS) + 1
#: The context of a text's first word.
START = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Text:
    """Words of a batch, the word before each of them, and their stems."""

    first: np.ndarray
    word: np.ndarray
    before: np.ndarray
    stem: np.ndarray


def read_words(texts: pa.Array) -> Text:
    data, offsets = W.text_bytes(pc.utf8_lower(texts))
    starts, ends = W.spans(data, offsets, W.ALNUM_WORDS)
    first = np.searchsorted(starts, offsets, "left")
    word = W.hash_spans(data, starts, ends)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[first[:-1][np.diff(first) > 0]] = START
    return Text(first, word, before, W.hash_spans(data, starts, np.minimum(ends, starts + STEM)))


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def shared_counts(documents: DataFrame, words: np.ndarray, stems: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (before, word) pairs of all documents: of each listed word, of the other words of each listed stem, and all.

    ``words`` and ``stems`` are sorted hashes. Tasks make their pairs distinct, deal them into buckets by
    the pair's hash (so no word is a hot key) and send each bucket as one payload: the listed word, else
    the listed stem, each pair belongs to, with 40 more bits of its hash. A bucket's payloads are
    made distinct together; there are as many buckets as the documents have partitions.
    """
    tasks = documents.rdd.getNumPartitions()
    buckets, kinds = max(tasks, 8), 1 + len(stems) + len(words)
    cells = -(-kinds // COUNT_BLOCKS) * COUNT_BLOCKS
    listed = documents.sparkSession.sparkContext.broadcast((words, stems))

    def payloads(held: list[np.ndarray]):
        kind, pair = (np.concatenate(c) for c in zip(*held))
        _, once = np.unique(pair, return_index=True)
        kind, pair = kind[once], pair[once]
        bucket = (pair % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket * kinds + kind, kind="stable")  # pairs stay sorted within
        kind, pair, bucket = kind[order], pair[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack_pairs(kind[cuts[k] : cuts[k + 1]], pair[cuts[k] : cuts[k + 1]])], pa.binary())], ["bucket", "payload"])

    def pairs(batches):
        held, size = [], 0
        words, stems = listed.value
        for batch in W.pieces(batches):
            text = read_words(batch.column(0))
            pair, once = np.unique(pair_hash(text.before, text.word), return_index=True)
            stem, word = _find(stems, text.stem[once]), _find(words, text.word[once])
            kind = np.where(word < len(words), 1 + len(stems) + word, np.where(stem < len(stems), 1 + stem, 0))
            held.append((kind, pair))
            size += len(pair)
            if size >= HELD_PAIRS:
                yield from payloads(held)
                held, size = [], 0
        if held:
            yield from payloads(held)

    def counted(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([unpack_pairs(p.as_py()) for p in table.column("payload")]))
        counts = np.bincount((keys >> np.uint64(PAIR_BITS)).astype(np.int64), minlength=cells)
        rows = list(block_rows(table.column("bucket")[0].as_py(), counts.astype(np.int64), COUNT_BLOCKS))
        columns = zip(*rows)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.binary()))], ["part", "block", "payload"])

    sent = documents.select("text").mapInArrow(pairs, "bucket int, payload binary")
    counts = tree_sum(sent.groupBy("bucket").applyInArrow(counted, SUM_SCHEMA), buckets, cells, COUNT_BLOCKS, np.int64)[:kinds]
    listed.unpersist()
    return counts[1 + len(stems) :], counts[1 : 1 + len(stems)], int(counts.sum())


def pack_pairs(kind: np.ndarray, pair: np.ndarray) -> bytes:
    """Pairs sorted by kind: the kinds, how many pairs each has, and the last 40 bits but the bucket's of each pair."""
    kinds, counts = np.unique(kind, return_counts=True)
    head = pack(np.concatenate([np.diff(kinds, prepend=0), counts]).astype(np.uint32))
    bits = (pair >> np.uint64(64 - PAIR_BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : PAIR_BITS // 8]
    return len(head).to_bytes(4, "little") + head + bits.tobytes()


def unpack_pairs(payload: bytes) -> np.ndarray:
    """kind * 2^40 + bits of every pair."""
    size = int.from_bytes(payload[:4], "little")
    kinds, counts = unpack(payload[4 : 4 + size], np.uint32).astype(np.int64).reshape(2, -1)
    bits = np.frombuffer(payload, np.uint8, offset=4 + size).reshape(-1, PAIR_BITS // 8)
    wide = np.zeros((len(bits), 8), np.uint8)
    wide[:, : PAIR_BITS // 8] = bits
    return (np.repeat(np.cumsum(kinds), counts).astype(np.uint64) << np.uint64(PAIR_BITS)) | wide.view("<u8").reshape(-1)


def pair_counts(sample: DataFrame) -> dict[str, np.ndarray]:
    """before, word, stem, toxic, ordinary: how often each pair occurs in the (text, label) sample.

    The counts are stored and fetched in PIECES, so that the driver never holds them twice.
    """

    def partial(batches):
        for batch in W.pieces(batches):
            text = read_words(batch.column(0))
            toxic = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(text.first)) == 1
            _, at, inverse = np.unique(pair_hash(text.before, text.word), return_index=True, return_inverse=True)
            counts = [np.bincount(inverse[own], minlength=len(at)) for own in (toxic, ~toxic)]
            keys = [pa.array(x[at].view(np.int64)) for x in (text.before, text.word, text.stem)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c.astype(np.int32)) for c in counts)], ["before", "word", "stem", "toxic", "ordinary"])

    counts = (
        sample.mapInArrow(partial, "before long, word long, stem long, toxic int, ordinary int")
        .groupBy("before", "word")
        .agg(F.min("stem").alias("stem"), F.sum("toxic").cast("int").alias("toxic"), F.sum("ordinary").cast("int").alias("ordinary"))
    )
    spark, path = sample.sparkSession, shared_folder(sample.sparkSession)
    counts.withColumn("piece", F.pmod("word", F.lit(PIECES))).write.partitionBy("piece").parquet(path)
    found = spark.read.schema("before long, word long, stem long, toxic int, ordinary int, piece int").parquet(path)
    size, at = found.count(), 0
    out = {c: np.empty(size, np.uint64 if c in ("before", "word", "stem") else np.int32) for c in counts.columns}
    for k in range(PIECES):
        piece = found.where(F.col("piece") == k).select(*counts.columns).toArrow()
        for c, values in out.items():
            values[at : at + len(piece)] = piece[c].to_numpy().view(values.dtype)
        at += len(piece)
    return out


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of keys in the list; its length (a last, empty entry) for those that are not there."""
    at = np.searchsorted(sorted_keys, keys)
    at[at < len(sorted_keys)] = np.where(sorted_keys[at[at < len(sorted_keys)]] == keys[at < len(sorted_keys)], at[at < len(sorted_keys)], len(sorted_keys))
    return at


@dataclass
class Lexicon:
    """Sorted hashes of the sample's pairs, words and stems, and the shared shares of the words and stems.

    The last entry of a share is for what the sample does not hold; there it is the same for both
    classes, and 1 stands for it.
    """

    pairs: np.ndarray
    words: np.ndarray
    stems: np.ndarray
    #: Of each word, its stem's place among the stems (their number: none).
    stem_of_word: np.ndarray
    #: A word's share of its stem's distinct pairs, and a stem's share of all.
    word_share: np.ndarray
    stem_share: np.ndarray

    def places(self, text: Text, part: slice) -> tuple[np.ndarray, ...]:
        word, before, stem = text.word[part], text.before[part], text.stem[part]
        return _find(self.pairs, pair_hash(before, word)), _find(self.words, before), _find(self.words, word), _find(self.stems, stem)

    def shared_with(self, documents: DataFrame) -> Lexicon:
        """The lexicon with shares counted over all documents."""
        of_word, others, total = shared_counts(documents, self.words, self.stems)
        known = self.stem_of_word < len(self.stems)
        of_stem = others + np.bincount(self.stem_of_word[known], of_word[known], len(self.stems)).astype(np.int64)
        in_stem = np.where(known, of_word / np.maximum(np.append(of_stem, 0)[self.stem_of_word], 1), 1)
        return replace(self, word_share=np.append(in_stem, 1.0), stem_share=np.append(of_stem / max(total, 1), 1.0))


@dataclass
class ClassModel:
    """Discounted probabilities of one class; the last entry of each array is for the unseen."""

    pair: np.ndarray
    backoff: np.ndarray
    word: np.ndarray
    word_rest: float
    stem: np.ndarray
    stem_rest: float

    def probability(self, pair, before, word, stem, word_share, stem_share) -> np.ndarray:
        """Of words after words, given the shared shares of the words in their stems and of the stems."""
        return self.pair[pair] + self.backoff[before] * self.of_word(word, stem, word_share, stem_share)

    def of_word(self, word, stem, word_share, stem_share) -> np.ndarray:
        """Of words whatever stands before them."""
        return self.word[word] + self.word_rest * (self.stem[stem] + self.stem_rest * stem_share) * word_share


def _discounted(counts: np.ndarray, discount: float) -> tuple[np.ndarray, float]:
    """Shares left after the discount, with an entry for the unseen; the share taken off."""
    total = max(float(counts.sum()), 1.0)
    left = np.append(np.maximum(counts - discount, 0) / total, 0)
    return left.astype(np.float32), 1 - float(left.sum())


def absolute_discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), where nk counts the entries of count k; some share is always left to the rest."""
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return max(once / max(once + 2 * twice, 1), 0.1)


def class_model(n_words: int, n_stems: int, before: np.ndarray, word: np.ndarray, stem: np.ndarray, counts: np.ndarray) -> ClassModel:
    """before, word, stem: places of all pairs' parts in the lexicon, in the order of its pairs."""
    there = counts > 0
    of_pair = absolute_discount(counts)
    context = np.bincount(before, counts, n_words)
    taken = np.bincount(before, np.minimum(counts, np.float32(of_pair)), n_words)
    pair = np.zeros(len(counts) + 1, np.float32)
    np.maximum(counts - np.float32(of_pair), 0, out=pair[:-1])
    pair[:-1] /= np.maximum(context, 1).astype(np.float32)[before]
    backoff = np.append(np.where(context > 0, taken / np.maximum(context, 1), 1), 1).astype(np.float32)
    words, stems = np.bincount(word[there], minlength=n_words), np.bincount(stem[there], minlength=n_stems)
    return ClassModel(pair, backoff, *_discounted(words, absolute_discount(words)), *_discounted(stems, absolute_discount(stems)))


def fit_classes(counted: dict[str, np.ndarray]) -> tuple[Lexicon, tuple[ClassModel, ClassModel]]:
    """Both classes' models from the counts of pairs.

    The greatest arrays of the driver are made here; each is given up as soon as the next is there.
    """
    words = np.unique(np.concatenate([np.unique(counted["before"]), np.unique(counted["word"])]))
    stems = np.unique(counted["stem"])
    stem = np.searchsorted(stems, counted.pop("stem")).astype(np.int32)
    pairs = pair_hash(counted["before"], counted["word"])
    before = np.searchsorted(words, counted.pop("before")).astype(np.int32)
    word = np.searchsorted(words, counted.pop("word")).astype(np.int32)
    order = np.argsort(pairs).astype(np.int32)
    pairs, before, word, stem = pairs[order], before[order], word[order], stem[order]
    stem_of_word = np.full(len(words), len(stems))
    stem_of_word[word] = stem
    both = tuple(class_model(len(words), len(stems), before, word, stem, counted.pop(c)[order]) for c in ("toxic", "ordinary"))
    nothing = np.ones(1)
    return without_idle(Lexicon(pairs, words, stems, stem_of_word, nothing, nothing), both)


def without_idle(lexicon: Lexicon, classes: tuple[ClassModel, ClassModel]) -> tuple[Lexicon, tuple[ClassModel, ClassModel]]:
    """The same models without entries that say what the entry for the unseen says anyway."""
    pairs, words, stems = (np.zeros(len(x), bool) for x in (lexicon.pairs, lexicon.words, lexicon.stems))
    for m in classes:
        pairs |= m.pair[:-1] > 0
        words |= (m.word[:-1] > 0) | (m.backoff[:-1] != 1)
        stems |= m.stem[:-1] > 0
    keep = lambda values, mask: np.append(values[:-1][mask], values[-1])
    small = lambda m: ClassModel(keep(m.pair, pairs), keep(m.backoff, words), keep(m.word, words), m.word_rest, keep(m.stem, stems), m.stem_rest)
    new_place = np.append(np.where(stems, np.cumsum(stems) - 1, stems.sum()), stems.sum())  # of each stem, and of none
    kept = replace(lexicon, pairs=lexicon.pairs[pairs], words=lexicon.words[words], stems=lexicon.stems[stems], stem_of_word=new_place[lexicon.stem_of_word[words]])
    return kept, tuple(map(small, classes))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    #: (toxic, ordinary).
    classes: tuple[ClassModel, ClassModel]
    weights: np.ndarray

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """N_INPUTS of every text."""
        text = read_words(texts)
        out = np.zeros((len(text.first) - 1, N_INPUTS))
        out[:, 0] = 1
        out[:, -1] = np.log(np.maximum(np.diff(text.first), 1))
        for low, high in W.row_chunks(text.first, CHUNK):
            first = text.first[low : high + 1] - text.first[low]
            part = slice(text.first[low], text.first[high])
            places = self.lexicon.places(text, part)
            shared = self.lexicon.word_share[places[2]], self.lexicon.stem_share[places[3]]
            words = [m.of_word(*places[2:], *shared) for m in self.classes]
            whole = [m.pair[places[0]] + m.backoff[places[1]] * w for m, w in zip(self.classes, words)]
            alone = np.log(words[0] / words[1])
            out[low:high, 1:-1] = np.concatenate([_spans(np.log(whole[0] / whole[1]), first), _spans(alone, first), _ranked(alone, first)], axis=1)
        return out

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.weights, -30, 30)))


def _spans(ratio: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ten times the mean of each text's word ratios, and its highest mean over a window of each length."""
    n = np.diff(first)
    sums = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
    total = sums[first[1:]] - sums[first[:-1]]
    out = np.zeros((len(n), 1 + len(WINDOWS)))
    out[:, 0] = 10 * total / np.maximum(n, 1)
    full = np.flatnonzero(n > 0)
    for k, length in enumerate(WINDOWS):
        if len(full):
            left = np.repeat(first[1:], n) - np.arange(len(ratio))  # words from here to the text's end
            window = np.where(left >= length, sums[np.minimum(np.arange(len(ratio)) + length, len(ratio))] - sums[:-1], -np.inf)
            out[full, k + 1] = np.maximum.reduceat(window, first[:-1][full])
        short = n < length
        out[short, k + 1] = total[short]
        out[:, k + 1] /= length
    return out


def _ranked(ratio: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The ratios of each text's words at RANKS; a text with fewer words gives its least, or 0 if that is greater."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    span = float(np.abs(ratio).max(initial=0)) * 2 + 1
    best = ratio[np.argsort(rows * span - ratio)]
    out = np.zeros((len(n), len(RANKS)))
    for k, rank in enumerate(RANKS):
        enough = n > rank
        out[enough, k] = best[first[:-1][enough] + rank]
        few = (n > 0) & ~enough
        out[few, k] = np.minimum(best[first[1:][few] - 1], 0)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.3) -> np.ndarray:
    """Newton steps, halved until the loss falls, for a logistic regression with a small ridge on all but the constant."""
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    weights = np.zeros(x.shape[1])
    weights[0] = np.log(share / (1 - share))
    if len(np.unique(y)) < 2:
        return weights
    ridge = np.full(x.shape[1], penalty)
    ridge[0] = 1e-6
    loss = lambda w: float(np.sum(np.logaddexp(0, x @ w) - y * (x @ w)) + (ridge * w * w).sum() / 2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * weights)
        step = np.clip(step, -5, 5)
        while loss(weights + step) > loss(weights) and np.abs(step).max() >= 1e-8:
            step = step / 2
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _chosen(labels: DataFrame, label: str, counted_rows: int, calibration_rows: int) -> DataFrame:
    """doc_id, label, calibrates: the bounded sample, from the label table alone."""
    order = F.xxhash64("doc_id")
    rows = (
        labels.where(F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .withColumn("calibrates", F.pmod(order, F.lit(CALIBRATION_SHARE)) == 0)
    )
    first = lambda part, n: part.orderBy(order, "doc_id").limit(n)
    return (
        first(rows.where(F.col("calibrates")), calibration_rows)
        .unionByName(first(rows.where(~F.col("calibrates") & (F.col("label") == 1)), counted_rows))
        .unionByName(first(rows.where(~F.col("calibrates") & (F.col("label") == 0)), counted_rows))
    )


def _within(sample: DataFrame, most_bytes: int) -> DataFrame:
    """The sample's rows, of each class as many in hash order as hold no more text than that."""
    so_far = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return sample.withColumn("held", F.sum(size).over(so_far)).where(F.col("held") <= most_bytes).drop("held")


def fit_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> ToxicityModel:
    chosen = F.broadcast(_chosen(labels, label, rows, calibration_rows))
    sample = documents.select("doc_id", "text").join(chosen, "doc_id")
    counted = _within(sample.where(~F.col("calibrates")), FIT_BYTES)
    lexicon, classes = fit_classes(pair_counts(counted.select("text", "label")))
    lexicon = lexicon.shared_with(documents)
    model = ToxicityModel(lexicon, classes, np.zeros(0))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def evidence(batches):
        for batch in W.pieces(batches):
            inputs = sent.value.evidence(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(inputs), pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["inputs", "label", "doc_id"])

    seen = sample.where("calibrates").select("text", "label", "doc_id").mapInArrow(evidence, "inputs array<double>, label int, doc_id long").toArrow().sort_by("doc_id")
    sent.unpersist()
    inputs = np.array(seen["inputs"].to_pylist(), float).reshape(len(seen), N_INPUTS)
    y = seen["label"].to_numpy()
    return ToxicityModel(lexicon, classes, fit_logistic(inputs, y))


def score_toxicity(documents: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in W.pieces(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.probabilities(batch.column(1)), pa.float64())], ["doc_id", "score"])

    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(scored, "doc_id long, score double")
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    )
