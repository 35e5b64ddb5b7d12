import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tillwise.llm import alignment

from .conftest import ODD_TEXTS, prose


def _byte_of() -> dict[str, int]:
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = (b for b in range(256) if b not in own)
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def brute_force(rows):
    """Whole texts through both libraries, byte offsets by adding up, counts in a dictionary."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of, entry = _byte_of(), {i: t for t, i in a_model.get_vocab().items()}
    found, counts = [], Counter()
    for doc_id, text in rows:
        if not text:
            found.append((doc_id, None))
            continue
        whole = (" " + text).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(byte_of[c] for c in entry[i]) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, None))
            continue
        ends_a = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in a_bytes]))}
        ends_b = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in b_bytes]))}
        groups, links, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            to_a, to_b = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, a[i:to_a])) + "|" + ",".join(map(str, b[j:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            i, j = to_a, to_b
        counts.update(links)
        found.append((doc_id, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, one in found:
        if one is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = one
        out.append((doc_id, n_a, n_b, n_groups, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest))
    return out


def aligned(df):
    return sorted(map(tuple, alignment.align(df).collect()), key=str)


def random_texts(n: int):
    rng = random.Random(11)
    pool = list(" ab'\n\t.éß日　  \x00<>0x1ﬁ😀́​﻿  ") + ["ing", "tion", "===", "<|endoftext|>", "I'll", " 12", "\u0085", "  "]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_pointers_end_at_the_last_token_of_the_component():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        ends_a = np.append(np.flatnonzero(rng.random(n) < 0.5), n)
        ends_b = np.append(np.flatnonzero(rng.random(n) < 0.4), n)
        ends_a, ends_b = ends_a[ends_a > 0], ends_b[ends_b > 0]
        of_a, of_b = alignment.terminals(ends_a, ends_b)
        common = np.intersect1d(ends_a, ends_b)
        for ends, found in ((ends_a, of_a), (ends_b, of_b)):
            want = common[np.searchsorted(common, ends)]
            assert ends_b[found].tolist() == want.tolist()


def test_against_brute_force(documents):
    texts = random_texts(600) + ["a▁b", "▁", " ", "  x", "a ", "\n", "x" * 3000, " " * 300, prose(3, 500), prose(3, 500), "<|endoftext|> a"]
    df = documents(texts)
    want = sorted(brute_force([(r.doc_id, r.text) for r in df.collect()]), key=str)
    assert aligned(df) == want
    assert aligned(df.repartition(7)) == want


def test_odd_rows(odd_documents):
    want = sorted(brute_force([(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]), key=str)
    assert aligned(odd_documents) == want
    assert len(want) == len(ODD_TEXTS) + 2


def test_hot_pairs_are_salted(documents, monkeypatch):
    df = documents([prose(4, 80)] * 40).repartition(8)
    want = aligned(df)
    monkeypatch.setattr(alignment, "PAIR_ROWS", 2)  # read on the driver alone
    assert aligned(df) == want


def test_empty_table(documents):
    assert aligned(documents([])) == []
