"""Stages and registration."""

import random

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.conftest import DOCUMENTS, prose, rows_of
from tests.llm.test_superminhash import brute
from tillwise.llm import decontamination, merge_dropout

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, junk, copies, a leak, a secret, and null and empty texts."""
    out = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(4)
    good = [prose(k, rng.randint(60, 150)) for k in range(200)]
    junk = [" ".join(w + "###" for w in prose(1000 + k, 80).split()) for k in range(100)]
    item = prose(5000, 30)
    near = good[0].replace(good[0].split()[10], "other", 1)
    texts = good + junk + [good[1], near, f"{prose(6000, 60)} {item}", f"{prose(6001, 80)} password=hunter22", None, ""]
    spark.createDataFrame(rows_of(texts), DOCUMENTS).write.parquet(f"{out}/documents.parquet")
    labels = [(k, 1, 0) for k in range(200)] + [(200 + k, 0, 0) for k in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, texts


def test_stages_do_what_brute_force_does(spark, folder, tmp_path):
    out, texts = folder
    docs = spark.read.parquet(f"{out}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, out)
        if name != "tokens":
            assert result.columns == COLUMNS
        result.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r.asDict() for r in docs.collect()}
    quality = kept["quality"]
    assert sum(k in quality for k in range(200)) >= 190 and sum(k in quality for k in range(200, 300)) <= 10
    ids = sorted(quality)
    components = brute([quality[k]["text"] for k in ids], 5, 80)
    assert sorted(kept["near_duplicates"]) == [k for place, k in enumerate(ids) if components[place][1] == place]
    assert {300, 301} & set(kept["near_duplicates"]) == set()
    item = prose(5000, 30)
    leaking = {k for k, r in kept["near_duplicates"].items() if list(decontamination.Matcher([decontamination.Item(1, item)]).matches(r["text"] or ""))}
    assert leaking == {302} and set(kept["decontamination"]) == set(kept["near_duplicates"]) - leaking
    assert set(kept["secrets"]) == set(kept["decontamination"])
    assert kept["secrets"][303]["text"].endswith("[assign]") and kept["secrets"][303]["n_chars"] == len(kept["secrets"][303]["text"])
    changed = [k for k, r in kept["secrets"].items() if r != kept["decontamination"][k]]
    assert changed == [303]
    back = {r.doc_id: r.text for r in merge_dropout.decode(docs).collect()}
    assert back == {k: r["text"] or "" for k, r in kept["secrets"].items()}
    ran = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, out).collect()}
    assert ran == {k: r["ids"] for k, r in kept["tokens"].items()}


def test_each_operator_has_one_query():
    names = list(entry_points.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]


def test_empty_documents_run_through(spark, folder, tmp_path):
    out, _ = folder
    empty = str(tmp_path)
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{empty}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{out}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
