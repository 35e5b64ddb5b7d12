import public_tokenizers
import pytest
import sentencepiece

from tillwise.llm import prefix_counts

from .conftest import ODD_TEXTS, prose
from .test_alignment import random_texts


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return lambda text: len(model.encode(text or ""))


def test_counts_equal_the_library(documents, library):
    texts = random_texts(1500) + ["a▁b", "▁", "▁ x", "x ▁ y", "<s></s><unk>", "x" * 3000, "ab" * 900, " " * 700, prose(2, 4000)]
    found = {r.doc_id: r for r in prefix_counts.prefix_counts(documents(texts)).collect()}
    for k, text in enumerate(texts):
        assert (found[k].n_tokens, found[k].n_bytes, found[k].n_chars) == (library(text), len(text.encode()), len(text))


def test_every_beginning(documents, library):
    texts = random_texts(120) + ["▁ ▁x", "aaaaaaaaaaaaaaaaaaaaa", "Internationalisation  of\n\nrepresentations", "x" * 90, "=" * 130]
    for row in prefix_counts.prefix_counts(documents(texts)).collect():
        text, counts = texts[row.doc_id], prefix_counts.PrefixCounts(row.counts, row.n_chars)
        want = [library(text[:k]) for k in range(len(text) + 1)]
        assert [counts.tokens(k) for k in range(len(text) + 1)] == want
        for budget in (0, 1, 3, 10, 1000):
            assert counts.longest(budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_wide_growth_is_stored_wide(library):
    """A frame of four bytes a character reads like one of a byte."""
    import numpy as np
    import zstandard

    payload = zstandard.ZstdCompressor().compress(np.array([1, 300, -299], "<i4").tobytes())
    counts = prefix_counts.PrefixCounts(payload, 3)
    assert [counts.tokens(k) for k in range(4)] == [0, 1, 301, 2]


def test_budget_is_read_from_stored_counts(documents, library):
    texts = [prose(1, 900), "short", "", None, "é" * 100]
    found = {r.doc_id: r for r in prefix_counts.token_budget(prefix_counts.prefix_counts(documents(texts)), 50).collect()}
    for k, text in enumerate(texts):
        text = text or ""
        want = max(n for n in range(len(text) + 1) if library(text[:n]) <= 50) if library(text) > 50 else len(text)
        assert (found[k].n_tokens, found[k].over_limit, found[k].fit_chars) == (library(text), library(text) > 50, want)


def test_odd_rows(odd_documents, library):
    found = prefix_counts.token_budget(prefix_counts.prefix_counts(odd_documents)).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=str) == sorted(((r.doc_id, library(r.text)) for r in odd_documents.collect()), key=str)
    assert len(found) == len(ODD_TEXTS) + 2


def test_empty_table(documents):
    assert prefix_counts.token_budget(prefix_counts.prefix_counts(documents([]))).collect() == []
