import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import words as W


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab \n\té\x0b1!", max_size=30), max_size=8))
def test_words_are_those_of_bytes_split(texts):
    found = W.hashed_words(pa.array(texts, pa.string()))
    words = [(t or "").encode().split() for t in texts]
    assert found.counts().tolist() == [len(w) for w in words]
    names = {}
    for word, h in zip((w for ws in words for w in ws), found.hashes.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_huge_words_and_slices():
    long = "y" * (3 * W.WINDOW + 5)
    array = pa.array(["skip", f"a {long} b", long]).slice(1)
    found = W.hashed_words(array)
    assert found.counts().tolist() == [3, 1]
    assert found.hashes[1] == found.hashes[3]


def test_case_folding_is_ascii_only():
    h = W.hashed_words(pa.array(["ABC abc É é"]), W.BLANK_WORDS, W.ASCII_LOWER).hashes
    assert h[0] == h[1] and h[2] != h[3]


def test_segment_sums_with_empty_segments():
    assert W.segment_sums(np.array([1.0, 2, 4]), np.array([0, 0, 2, 2, 3])).tolist() == [0, 3, 0, 4]
