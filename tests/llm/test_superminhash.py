import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_TEXTS, prose
from tillwise.llm import superminhash as S
from tillwise.llm.queries import ORACLE_SQL, op6_superminhash

SAMPLE = "/root/testdata/sf0.01"


def sets_of(texts, size):
    out = []
    for text in texts:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    return out


def brute(texts, size, percent):
    sets = sets_of(texts, size)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(len(s), root(k)) for k, s in enumerate(sets)]


def near_copies(seed, n, changes):
    rng = random.Random(seed)
    base = prose(seed, 120).split()
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
        yield " ".join(words)


def drifting(seed, n):
    """Each text is an edited copy of the one before."""
    rng = random.Random(seed)
    words = prose(seed, 100).split()
    for _ in range(n):
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = prose(rng.randrange(10**6), 1)
        yield " ".join(words)


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, documents, monkeypatch, size, percent):
    monkeypatch.setattr(S, "BLOCK", 16)  # so that hot buckets are dealt in many blocks
    texts = ODD_TEXTS + [prose(20, 100)] * 30 + [prose(k, 90) for k in range(30, 60)]
    for seed in (100, 101, 102):
        texts += near_copies(seed, 40, 9)
    for seed in range(200, 240):
        texts += drifting(seed, 5)
    random.Random(1).shuffle(texts)
    found = S.deduplicate(documents(texts), size, percent).orderBy("doc_id").collect()
    want = brute(texts, size, percent)
    assert [(r.n_shingles, r.component_id) for r in found] == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


@pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="sample tables absent")
def test_sample_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SAMPLE}/documents.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op6_superminhash"]).fetchall())
    assert sorted(tuple(r) for r in op6_superminhash(spark, SAMPLE).collect()) == want


def test_signature_is_exact_and_estimates_are_close():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n, shift in ((1000, 100), (40, 4), (1, 0)):
        a, b = np.sort(pool[:n]), np.sort(pool[shift : n + shift])
        signature = S.sketch(np.concatenate([a, b]), np.array([0, n, 2 * n]))
        assert np.isfinite(signature).all()
        true = (n - shift) / (n + shift)
        assert abs((signature[0] == signature[1]).mean() - true) < 0.1
        # Registers hold one value of each integer part order: the plain algorithm without early stop.
        assert np.array_equal(signature[0], slow_signature(a))


def slow_signature(elements):
    best = np.full(S.REGISTERS, np.inf)
    for element in elements:
        order = list(range(S.REGISTERS))
        for step in range(S.REGISTERS):
            draw = S.W.seeded(np.array([element]), S.SEED + step)
            pick = step + int(draw[0] % np.uint64(S.REGISTERS - step))
            order[step], order[pick] = order[pick], order[step]
            best[order[step]] = min(best[order[step]], step + float(S.W.mix(draw)[0] >> np.uint64(11)) * 2.0**-53)
            if step > best.max():
                break
    return best


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 700)] + [(7, 160)]
    random.Random(2).shuffle(edges)
    found = {r.node: r.component for r in S.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert found == {7: 7, **{k: 7 for k in range(100, 161)}, **{k: 500 for k in range(500, 700)}}


def test_miss_bound_sets_the_bands():
    for percent in (60, 80, 85, 90, 95):
        rows = S.rows_of_band(percent)
        assert (1 - (percent / 100) ** rows) ** (S.REGISTERS // rows) <= S.MISS


def test_odd_rows_and_an_empty_table(odd_documents, documents):
    found = S.deduplicate(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert {r.component_id for r in found if r.doc_id in (8, 9)} == {8}
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in found if r.doc_id in (0, 1, 2))
    assert S.deduplicate(documents([])).count() == 0


def test_shingles_ignore_ascii_case_only():
    e, f = S.shingles(pa.array(["A b C", "a B c", "É b c", "é b c"]), 3)
    assert e[0] == e[1] and e[2] != e[3] and f.tolist() == [0, 1, 2, 3, 4]


A, B = prose(70, 40), prose(71, 40)
REPEATED = [(1, A), (1, A), (2, A), (5, A), (5, B), (None, A)]


def _rows(spark, rows):
    """With columns whose names the operator uses."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "t1", "name", "component", "one", "salt"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_repeated_and_null_ids(spark, parts):
    df = _rows(spark, REPEATED).repartition(parts)
    kept = S.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, A), (5, B)])
    found = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in S.deduplicate(df).collect()))
    assert found == [(0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (5, 1, False), (5, 5, True)]


def test_groups_without_any_id(spark):
    near = A.replace(A.split()[3], "other", 1)
    rows = [(None, A), (None, near), (None, B), (None, ""), (None, ""), (None, None), (4, ""), (4, ""), (9, None)]
    df = _rows(spark, rows).repartition(3)
    kept = [(r.doc_id, r.text) for r in S.one_of_each(df, size=3, percent=70).collect()]
    assert len({(None, A), (None, near)} & set(kept)) == 1
    assert sorted((r for r in kept if r[1] not in (A, near)), key=str) == sorted([(None, B), *rows[3:]], key=str)
    assert {(r.component_id, r.kept) for r in S.deduplicate(df, 3, 70).where("doc_id IS NULL").collect()} == {(None, True)}


def test_one_of_each_keeps_the_least_id_of_brute_force(documents):
    texts = [prose(k, 60) for k in range(12)] + list(near_copies(300, 25, 6)) + [prose(2, 60), prose(3, 60)] + list(drifting(301, 6))
    kept = sorted(r.doc_id for r in S.one_of_each(documents(texts).repartition(4)).collect())
    assert kept == [k for k, (_, root) in enumerate(brute(texts, 5, 80)) if k == root]
