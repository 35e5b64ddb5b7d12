"""The registered queries on a small sample: one row for each row of the table, stated columns."""

import os

import pytest

from tillwise.llm.queries import QUERIES
from tillwise.sources.staging import release

SAMPLE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="sample tables absent")

SCORES = {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
COLUMNS = {
    "op1_toxicity": SCORES,
    "op3_compression_bands": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean",
    },
    "op4_merge_dropout": {"doc_id": "bigint", "ids": "array<int>", "n_tokens": "bigint", "lossless": "boolean"},
    "op6_superminhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op8_token_codes": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op9_quality_classifier": SCORES,
    "op11_alignment": {
        "doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint",
        "count_sum": "bigint", "groups_sha256": "string",
    },
    "op13_prefix_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op5_html_layout": {"page_id": "bigint", "text": "string"},
    "op10_link_graph": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_one_row_for_each(spark, name):
    found = QUERIES[name](spark, SAMPLE)
    assert dict(found.dtypes[: len(COLUMNS[name])]) == COLUMNS[name]
    key = found.columns[0]
    table = "pages" if key == "page_id" else "documents"
    want = sorted(r[0] for r in spark.read.parquet(f"{SAMPLE}/{table}.parquet").select(key).collect())
    rows = found.collect()
    assert sorted(r[key] for r in rows) == want
    if name == "op4_merge_dropout":
        assert all(r.lossless for r in rows)
    release(spark)


def test_leaks_name_documents_and_items(spark):
    found = QUERIES["op2_decontamination"](spark, SAMPLE)
    assert dict(found.dtypes) == {"doc_id": "bigint", "item_id": "bigint", "distance": "int", "budget": "int", "start": "bigint", "end": "bigint"}
    assert all(r.distance <= r.budget and r.start < r.end for r in found.collect())
