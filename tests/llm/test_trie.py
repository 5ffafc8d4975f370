"""The conversation trie against brute force, and tree contraction on trees of every shape."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pulsebar.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, lane string, digest long, node string, words string"


def brute(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", x or ""))
    for turns in conv.values():
        turns.sort()
    rebuilt = {}
    for c, turns in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = [t[2:] for t in conv.get(c - int(math.fmod(c, 20)), [])[:h]] + [t[2:] for t in turns[h:]]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, m in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    out = []
    for k, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k))
        parent = min(nodes[k[:-1]]) if k else None
        out.append((min(m), len(k), parent, len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, tasks=5):
    given = spark.createDataFrame([(*r, "l", 1, "n", "w") for r in rows], SCHEMA).repartition(tasks)
    got = sorted(map(tuple, trie.prefix_trie(given).collect()), key=lambda r: (r[1], r[0]))
    assert got == sorted(brute(rows), key=lambda r: (r[1], r[0]))


@pytest.fixture
def uncoalesced(spark):
    """Small inputs keep several lanes."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_odd_conversations(spark):
    """Ties, repeated rows, nulls, absent and short group heads, negative ids, turnless ones, clashing columns."""
    draw = random.Random(1)
    rows = [(7, 3, "user", "x")] * 5 + [(None, 1, "user", "q"), (60, 0, "user", "\u0001long " * 20000)]
    for c in [*range(90), -7, -40, 500, 2**62]:
        for t in range(draw.choice([0, 1, 2, 3, 5, 30])):
            rows.append((
                c, draw.choice([t, t, t, None, 1]), draw.choice(["user", "assistant", None]),
                draw.choice(["a b", "a", "", None, "c\x0bd e", "é ß x"]),
            ))
    check(spark, rows)
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_swapped_turns_are_other_nodes(spark):
    check(spark, [(c, t, "user", text) for c, texts in enumerate(["abc", "bac", "abc", "cab"]) for t, text in enumerate(texts)])


@pytest.mark.parametrize("turn", ["rising", "null"])
def test_one_conversation_holds_most_rows(spark, uncoalesced, turn):
    """It spreads over the lanes; its tail is one long unary chain."""
    rows = [(21, t if turn == "rising" else None, "user", f"t{t % 50:02}") for t in range(200)]
    rows += [(c, t, "user", f"t{t:02}") for c in range(30) for t in range(3)]
    check(spark, rows)
    _, runs = trie._in_lanes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert runs.where("conv_id = 21").count() > 1


def test_chunks_of_a_list_of_members(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 2)
    check(spark, [(c, 0, "user", "same") for c in range(-30, 70)])


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_subtree_sums(spark, shape):
    draw, n = random.Random(5), 120
    above = {
        "chain": lambda k: k - 1, "star": lambda k: 0, "random": lambda k: draw.randrange(k),
        "caterpillar": lambda k: k - 1 if k % 2 else max(k - 2, 0),
    }[shape]
    parents = [None] + [above(k) for k in range(1, n)]
    weights = [draw.randrange(100) for _ in range(n)]
    want = [[w, 1] for w in weights]
    for k in reversed(range(1, n)):
        for i in (0, 1):
            want[parents[k]][i] += want[k][i]
    rows = [(k, p, w, 1) for k, (p, w) in enumerate(zip(parents, weights))]
    tree = spark.createDataFrame(rows, "node long, parent long, weight long, size long")
    got = {r.node: [r.weight, r["size"]] for r in trie.subtree_sums(tree, ["weight", "size"]).collect()}
    assert got == dict(enumerate(want))
