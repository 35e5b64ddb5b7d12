import random

import pytest

from tests.llm.conftest import prose
from tillwise.llm import decontamination as P


def distance(pattern, text):
    """Least edit distance of the pattern to a substring, by the textbook table."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
        before = row
    return min(before)


def test_myers_and_pigeonhole_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.5:
            part = list(item)
            for _ in range(rng.randint(0, 7)):
                part[rng.randrange(len(part))] = rng.choice(["", "x", "ab"])
            at = rng.randint(0, len(text))
            text = text[:at] + "".join(part) + text[at:]
        want = distance(item, text)
        assert P.Pattern(item).best(text)[0] == want
        found = list(P.Matcher([P.Item(1, item)]).matches(text))
        assert bool(found) == (want <= P.budget(len(item)))
        for _, d, _, a, b in found:
            assert d == want and distance(item, text[a:b]) == want


def test_pieces_cover_the_item():
    for n in (1, 7, 8, 20, 100, 301):
        item = prose(n, 100)[:n]
        cut = P.pieces(item)
        assert "".join(piece for _, piece in cut) == item and len(cut) == P.budget(n) + 1
        assert all(item[at:].startswith(piece) for at, piece in cut)


def test_leaks_are_found_and_clean_texts_stay(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_CHARACTERS", 400)
    items = [prose(k, 30) for k in range(6)]
    table = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, items[0]), (None, items[1])], "item_id long, text string")
    edited = items[2][:50] + "Z" + items[2][51:90] + items[2][91:]
    texts = ["x  " + items[0].upper().replace(" ", "\n ") + " y", f"{prose(50, 20)} {edited}", prose(51, 200), None, "", items[3][:100]]
    docs = documents(texts)
    found = P.find_leaks(docs, table).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(0, 0, 0), (0, 9, 0), (1, 2, 2)]
    spans = {(r.doc_id, r.item_id): texts[r.doc_id][r.start : r.end] for r in found}
    assert P.normalised(spans[0, 0]) == items[0] and spans[1, 2] == edited
    assert sorted(r.doc_id for r in P.without_leaks(docs, table).collect()) == [2, 3, 4, 5]


def test_odd_rows_and_empty_tables(spark, odd_documents, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert P.find_leaks(odd_documents, none).count() == 0
    assert P.without_leaks(odd_documents, none).count() == odd_documents.count()
    some = spark.createDataFrame([(1, "word"), (2, prose(9, 80))], "item_id long, text string")
    assert sorted((r.doc_id is None, r.item_id) for r in P.find_leaks(odd_documents, some).collect()) == [(False, 1), (False, 1), (True, 2)]
    assert P.find_leaks(documents([]), some).count() == 0


@pytest.mark.parametrize("text", ["  İ a\t\tB ", "abc", "", " \n "])
def test_places_lead_back_to_the_text(text):
    places = P.original_places(text)
    assert len(places) == len(P.normalised(text)) + 1
    for k, c in enumerate(P.normalised(text)):
        assert c == " " or c in text[places[k]].lower()


def test_blocks_of_one_pass_read_the_documents_once(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_CHARACTERS", 400)
    items = spark.createDataFrame([(k, prose(k, 30)) for k in range(24)], "item_id long, text string")
    assert sum(len(blocks) for blocks in P.passes(items)) >= 12
    docs = documents([prose(50, 20) + " " + prose(k, 30) for k in range(24)] + [prose(51, 50)])
    for found in (P.find_leaks(docs, items), P.without_leaks(docs, items)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
    assert sorted((r.doc_id, r.item_id) for r in P.find_leaks(docs, items).collect()) == [(k, k) for k in range(24)]
    assert [r.doc_id for r in P.without_leaks(docs, items).collect()] == [24]


def test_long_item_tables_take_several_passes(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_CHARACTERS", 300)
    monkeypatch.setattr(P, "PASS_CHARACTERS", 900)
    items = spark.createDataFrame([(k, prose(k, 30)) for k in range(12)], "item_id long, text string")
    assert len(list(P.passes(items))) >= 3
    assert all(sum(len(i.text) for b in blocks for i in P.unpacked(b)) <= 900 for blocks in P.passes(items))
    docs = documents([prose(50, 20) + " " + prose(k, 30) for k in range(12)] + [None, prose(51, 50)])
    assert sorted((r.doc_id, r.item_id) for r in P.find_leaks(docs, items).collect()) == [(k, k) for k in range(12)]
    assert sorted(r.doc_id for r in P.without_leaks(docs, items).collect()) == [12, 13]


def test_blocks_survive_packing():
    block = [P.Item(None, "a\"b \u2028"), P.Item(3, "é\ud7ff")]
    assert P.unpacked(P.packed(block)) == block
