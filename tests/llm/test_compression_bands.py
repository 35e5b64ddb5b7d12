import math
import os
import random
import re
import string
from collections import Counter

import pytest
import zstandard

from tests.llm.conftest import ODD_TEXTS, prose
from tillwise.llm import compression_bands as C


SAMPLE = "/root/testdata/sf0.1"
_rng = random.Random(99)
SYLLABLES = [c + v + e for c in ["b", "br", "ch", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "st", "t", "th", "v", "w", ""] for v in "aeiou" for e in ["", "n", "r", "s", "l"]]
VOCABULARY = ["".join(_rng.choices(SYLLABLES, k=_rng.choice([1, 1, 2, 2, 3]))) for _ in range(4000)]


def varied(seed, n):
    """Prose of a vocabulary as large as that of clean texts; ``prose`` has ten syllables and compresses like a list."""
    return " ".join(random.Random(seed).choices(VOCABULARY, [(k + 10) ** -0.9 for k in range(4000)], k=n))


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    found, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if found[w] > 1:
            covered |= {k, k + 1, k + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = ODD_TEXTS + ["a b c a b c", "a b c x a b c", "a a a a", "l\nl\n \nl\n\nm", "q" + "\x85" + "w \x1c e", " ".join(prose(1, 5).split() * 30), prose(2, 300)]


def test_base_counts_equal_brute_force(documents):
    found = C.judge_texts(documents(TEXTS)).orderBy("doc_id").collect()
    for row, text in zip(found, TEXTS):
        n_words, *rest = brute(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n_words, *rest)
        assert row.base_failed == (n_words < 50 or 100 * rest[-1] > 50 * n_words)
        assert not (row.kept and row.base_failed)


def test_verdicts(documents):
    clean = varied(3, 400)
    noise = " ".join(re.findall("...", os.urandom(3000).hex()))
    repeated = " ".join(f"{prose(4, 40)} {k}." for k in range(40))
    half = varied(5, 3000) + "\n" + " ".join(["tick tock"] * 9000)
    kept = [r.kept for r in C.judge_texts(documents([clean, noise, repeated, half, varied(6, 60)])).orderBy("doc_id").collect()]
    assert kept == [True, False, False, False, True]


@pytest.mark.parametrize("alphabet, sizes", [(string.ascii_letters + string.digits + "+/", (260, 500, 1000, 4000, 30_000)), (string.ascii_lowercase, (1300, 2000, 4000, 30_000))])
@pytest.mark.parametrize("group", [4, 5, 8])
def test_random_characters_are_out_of_band(alphabet, sizes, group):
    rng, compressor = random.Random(2), zstandard.ZstdCompressor(level=C.LEVEL)
    for size in sizes:
        text = " ".join("".join(rng.choices(alphabet, k=group)) for _ in range(size // (group + 1)))
        assert not C.compression(text.encode(), compressor)[3], size


def test_bands_and_chunks():
    assert C.chunk_ends(1) == [1]
    assert C.chunk_ends(C.CHUNK_BYTES + 10) == [C.CHUNK_BYTES + 10]
    assert C.chunk_ends(2 * C.CHUNK_BYTES) == [C.CHUNK_BYTES, 2 * C.CHUNK_BYTES]
    low, high = zip(*(C.band(2**k) for k in range(7, 20)))
    assert list(low) == sorted(low, reverse=True) and list(high) == sorted(high, reverse=True)


def test_odd_and_empty(odd_documents, documents):
    assert C.judge_texts(odd_documents).count() == odd_documents.count()
    assert C.judge_texts(documents([])).count() == 0


@pytest.mark.parametrize("text", ["", "\n", "a\nb\na"])
def test_small_texts(text):
    assert C.base_counts(text.encode()) == brute(text)


def brute_verdict(text):
    """Base rules, then limits by a straight line between the two points around the length, chunk by chunk."""
    n_words, _, _, _, n_repeat = brute(text)
    data = (text or "").encode()
    if n_words < 50 or 100 * n_repeat > 50 * n_words:
        return False

    def out(piece):
        ratio, x = len(zstandard.ZstdCompressor(level=C.LEVEL).compress(piece)) / len(piece), math.log2(len(piece))
        for (a, low_a, high_a), (b, low_b, high_b) in zip(C.BANDS, C.BANDS[1:]):
            if a <= x <= b:
                share = (x - a) / (b - a)
                return not low_a + share * (low_b - low_a) <= ratio <= high_a + share * (high_b - high_a)
        return not C.BANDS[-1][1] <= ratio <= C.BANDS[-1][2]

    pieces = [data[k : k + C.CHUNK_BYTES] for k in range(0, len(data), C.CHUNK_BYTES)]
    if len(pieces) > 1 and len(pieces[-1]) < C.CHUNK_BYTES / 2:
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    return not out(data) and sum(map(out, pieces)) <= C.MOST_BAD_CHUNKS * len(pieces)


def test_verdict_equals_brute_force(documents):
    rng = random.Random(3)
    texts = TEXTS + [varied(k, rng.randint(40, 4000)) for k in range(30)] + [prose(k, rng.randint(40, 4000)) for k in range(5)]
    texts += [varied(k, rng.randint(10, 400)) + " " + " ".join(prose(k + 1, 60).split() * rng.randint(1, 9)) for k in range(30)]
    texts += [" ".join("".join(rng.choices("0123456789abcdef", k=8)) for _ in range(rng.randint(60, 2000))) for _ in range(10)]
    found = C.judge_texts(documents(texts)).orderBy("doc_id").collect()
    assert [r.kept for r in found] == [brute_verdict(t) for t in texts]
    assert 10 < sum(r.kept for r in found) < len(texts) - 10


@pytest.mark.parametrize("group", [3, 4, 8, 32])
def test_hexadecimal_noise_is_out_of_band_from_4_kb_on(group):
    rng, compressor = random.Random(4), zstandard.ZstdCompressor(level=C.LEVEL)
    for size in (4200, 8000, 30_000):
        text = " ".join("".join(rng.choices("0123456789abcdef", k=group)) for _ in range(size // (group + 1)))
        assert not C.compression(text.encode(), compressor)[3], size


@pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="sample tables absent")
def test_bands_decide_beyond_the_base_rules(spark):
    """Poor texts that pass the base rules are rejected more often than not, good ones hardly ever."""
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet").select("doc_id", "quality")
    judged = C.judge_texts(spark.read.parquet(f"{SAMPLE}/documents.parquet")).where("NOT base_failed").join(labels, "doc_id")
    share = dict(judged.where("quality IS NOT NULL").selectExpr("quality", "cast(kept AS int) AS kept").groupBy("quality").avg("kept").collect())
    assert share[0] <= 0.5 and share[1] >= 0.99
