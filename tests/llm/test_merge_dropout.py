import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_TEXTS, prose
from tillwise.llm import merge_dropout as M

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts, rate, seed=M.SEED):
    ids, first = M.encode_texts(M.pieces_of(PATH), pa.array(texts, pa.string()), np.arange(len(texts)).astype(np.uint64), rate, seed)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_without_dropout_ids_are_the_library_s():
    texts = [t for t in ODD_TEXTS if t is None or "▁" not in t] + ["a  b\n\tc", " lead", "tail ", "漢字 ab"]
    assert encoded(texts, 0.0) == [LIBRARY.encode(t or "") for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab ▁\n漢é\x00the", max_size=40), max_size=5), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_decoding_is_lossless(texts, rate):
    ids = encoded(texts, rate)
    flat = np.array([i for x in ids for i in x], np.int64)
    data, begins = M.decode_ids(M.pieces_of(PATH), flat, np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64))
    assert [data[a:b].tobytes().decode() for a, b in zip(begins, begins[1:])] == texts


def test_dropout_varies_by_seed_and_not_by_run():
    text = [prose(1, 400)]
    one, two = encoded(text, 0.1), encoded(text, 0.1, seed=1)
    assert one == encoded(text, 0.1) and one != two and one != encoded(text, 0.0)
    assert len(encoded(text, 1.0)[0]) == len(text[0]) + 1  # every merge is skipped


def test_each_occurrence_is_segmented_on_its_own():
    """One word many times, in one text and over many: far more segmentations than a fixed few."""
    word = "internationalisation"
    cut = lambda text: {tuple(text[a:b]) for a, b in zip(*_unit_bounds(text))}
    alone = {tuple(ids) for ids in encoded([word] * 2000, 0.1)}
    assert len(alone) > 20 and len(cut(encoded([" ".join([word] * 2000)], 0.1)[0])) > 20


def _unit_bounds(ids):
    """Where the units of a text begin and end: at each piece that begins with the space sign."""
    starts = [k for k, i in enumerate(ids) if LIBRARY.id_to_piece(i).startswith("▁")]
    return starts, starts[1:] + [len(ids)]


def test_rounds_equal_the_agenda(monkeypatch):
    texts = [prose(2, 200), "x" * 200, "ab" * 90]
    side_by_side = encoded(texts, 0.2)
    monkeypatch.setattr(M, "LONG_UNIT", 0)
    assert encoded(texts, 0.2) == side_by_side


def test_spark_round_trip(odd_documents, documents):
    found = M.encode(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in found)
    back = {r.doc_id: r.text for r in M.decode(M.encode(documents(ODD_TEXTS))).collect()}
    assert back == {k: t or "" for k, t in enumerate(ODD_TEXTS)}
    assert M.encode(documents([])).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.text for r in M.decode(rows).collect()} == {""}


@pytest.mark.parametrize("rate", [0.0, 0.3])
def test_long_units_go_through_the_heap(rate):
    text = ["the" * 4000]
    ids = encoded(text, rate)[0]
    assert LIBRARY.decode(ids) == text[0]
