import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tillwise.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """Every beginning of every rebuilt conversation in a dictionary."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = said.get(c - int(math.fmod(c, 20)), [])[:h] + said[c][h:]
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df, **how):
    found = conversation_trie.prefix_trie(df, **how)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, found.collect()), key=str)


def made_up(n: int, seed: int, most: int = 9):
    """Few different turns, so that beginnings are shared; distinct turn numbers."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        kind = rng.random()
        length = 0 if kind < 0.1 else rng.randint(1, most)
        for turn in range(length):
            text = "hello there" if kind < 0.4 else rng.choice(["", None, "a b  c", "x", "é ü\tz"])
            rows.append((c, turn if turn else rng.choice([0, None]), rng.choice(["user", None, ""]) if kind > 0.6 else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"size": 1, "shard_turns": 40}, {"size": 3, "shard_turns": 1}])
def test_against_brute_force(spark, how):
    rows = made_up(150, 7)
    assert trie(spark.createDataFrame(rows, SCHEMA).repartition(5), **how) == brute_force(rows)


def test_long_and_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (0, 3, 41, 60) for t in range(45 + c % 2)] + [(c, t, "user", "same words") for c in range(100, 160) for t in range(3)]
    rows += [(7, 0, "user", "turn 0")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_force(rows)
    assert trie(df) == want
    assert trie(df, size=4, shard_turns=30) == want


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, None, None, None), (5, 1, "user", "a"), (5, 1, "user", "a"), (25, 0, "", ""), (-3, 0, "user", "minus"), (-3, 1, "user", "x y")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "family", "depth", "k1", "words", "segment", "turns", "shard", "open", "h"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    found = trie(df)
    # As in SQL the remainder of -3 by 20 is -3: its family is 0, which is absent.
    assert found == brute_force(rows)
    roots = [r for r in found if r[1] == 0]
    assert len(roots) == 1 and roots[0][:4] == (-3, 0, None, 3)


def test_turns_of_one_number_are_ordered_alike_everywhere(spark):
    rows = [(c, 0, "user", t) for c in (20, 21, 22) for t in ("b", "a", "c")]
    found = trie(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert [r[3] for r in found] == [3, 3, 3, 3]  # one path of the three


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []


def test_tree_holds_sequences_and_stays_low():
    rng = random.Random(2)
    sequences = sorted({(0, *(rng.randint(0, 500) for _ in range(rng.randint(0, 4)))) for _ in range(3000)})
    tree = conversation_trie.Tree()
    ends = {sequences[k]: tree.insert(list(sequences[k])) for k in conversation_trie.medians(len(sequences))}
    assert sorted(conversation_trie.medians(len(sequences))) == list(range(len(sequences)))
    for sequence, node in ends.items():
        spelled = []
        while node >= 0:
            spelled.append(tree.code[node])
            node = tree.up[node]
        assert tuple(reversed(spelled)) == sequence
    children = np.array([tree.down[0], *tree.low, *tree.high])
    assert len(set(children[children >= 0].tolist())) == (children >= 0).sum()

    def height(node: int) -> int:
        steps, level = 0, [node]
        while level:
            steps, level = steps + 1, [k for at in level for k in (tree.low[at], tree.high[at]) if k >= 0]
        return steps

    # 500 first turns in one tree: about nine levels when balanced.
    assert height(tree.down[0]) <= 14
