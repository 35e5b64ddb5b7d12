import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tests.llm.conftest import ODD_TEXTS
from tillwise.llm import token_codes as D
from tillwise.llm.tables import shared_folder


def test_segments_give_any_token_back():
    rng = np.random.default_rng(1)
    for top in (200, 256, 70_000, 2**32 - 1):
        ids = rng.integers(0, top, 3000, dtype=np.uint64).astype(np.uint32)
        ids[rng.random(3000) < 0.5] %= 100
        starts = np.array([0, 0, 10, 10, 2500, 3000])
        segment = D.Segment(D.pack_segment([5, None, 7, 7, 9], starts, ids))
        assert segment.doc_ids == [5, None, 7, 7, 9]
        assert np.array_equal(segment.tokens(0, 3000), ids)
        assert np.array_equal(segment.document(3), ids[10:2500])
        assert [segment.token(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
        assert np.array_equal(segment.tokens(513, 1025), ids[513:1025])
    with pytest.raises(IndexError):
        segment.token(3000)


def test_no_tokens():
    segment = D.Segment(D.pack_segment([1], np.array([0, 0]), np.zeros(0, np.uint32)))
    assert len(segment.tokens(0, 0)) == 0 and len(segment.document(0)) == 0


def test_round_trip_equals_the_tokenizer(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT_TOKENS", 500)
    texts = ODD_TEXTS + ["THE  quick's fox\u00a0jumped", "İstanbul ΣΑΣ", "<|endoftext|>", "e\u0301 \u0301x", "hello <|endoftext|> x", "a<|startoftext|>b<|ENDOFTEXT|><|endoftext|"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = D.round_trip(documents(texts[::-1])).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(found, texts[::-1]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_odd_rows_and_an_empty_table(spark, odd_documents, documents):
    found = D.round_trip(odd_documents).orderBy("start").collect()
    assert len(found) == odd_documents.count() and found[0].doc_id is None
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    path = shared_folder(spark)
    D.write_codes(documents([]), path)
    assert D.document_digests(D.read_codes(spark, path)).count() == 0


def test_special_strings_are_read_as_the_library_reads_them():
    encoder = D.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    ids, first = encoder.encode(pa.array(["hello <|endoftext|> x"]))
    assert ids.tolist() == [3306, 49407, 343] and first.tolist() == [0, 3]


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError, match="not those of its words"):
        D.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_rows_of_one_id_are_dealt_out(spark):
    rows = [(None if k % 2 else 5, f"text {k} " + "word " * 50) for k in range(400)] + [(5, "equal rows " * 40)] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = shared_folder(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task
    try:
        D.write_codes(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    segments = D.read_codes(spark, path)
    sizes = [r.n for r in segments.groupBy("part").agg({"n_docs": "sum"}).withColumnRenamed("sum(n_docs)", "n").collect()]
    assert sum(sizes) == 800 and max(sizes) <= 300 and len(sizes) >= 4
    found = D.document_digests(segments).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] * 200 + [5] * 600
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
