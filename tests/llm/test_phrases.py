"""Collocations against brute force; compaction of paths and rings."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from pulsebar.llm import phrases

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, lang string, text string, node string, next string, n long, hot string, salt string"


def brute(docs, least=10, best=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        rows = []
        for p, a in candidates.items():
            if len(p) == 2 and longer[p] and 100 * longer[p] >= 50 * a:
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), l, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, k, p, a, l, r, totals[lang], score) for k, (score, a, p, l, r) in enumerate(rows[:best], 1)]
    return sorted(out)


def check(spark, rows, **options):
    given = spark.createDataFrame([(k, lang, text, "n", "x", 1, "h", "s") for k, (lang, text) in enumerate(rows)], SCHEMA)
    got = sorted(map(tuple, phrases.collocations(given.repartition(4), **options).collect()))
    assert got == brute(rows, options.get("least", 10), options.get("best", 2000))
    return got


@pytest.fixture(scope="module")
def rows():
    """Few words, so everything repeats: rings, repeated words, hot pairs with many followers, nulls, odd letters."""
    draw = random.Random(2)
    bits = ["a", "b", "c", "Dd", "É", "é", "la la la la", "x y x y x y", ". ", "\t", "!", "\x0b", "the same long passage of words that never changes"]
    rows = [(draw.choice(["en", "fr", None, "x"]), " ".join(draw.choice(bits) for _ in range(draw.choice([0, 3, 40])))) for _ in range(200)]
    rows += [("ring", "ring ong ring ong ring ong ring ong")] * 12 + [("yy", "q " * 50)] * 3 + [(None, None), ("en", ""), ("", "one two, one two")]
    rows += [("hot", f"p q r{k % 30}") for k in range(600)] + [("long", "w1 w2 w3 " * 30000)]
    return rows


def test_odd_texts(spark, rows):
    found = check(spark, rows)
    assert {"und", "ring", "hot", "long"} <= {r[0] for r in found}
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_portions_and_hot_nodes(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "_BYTES", 400)
    monkeypatch.setattr(phrases, "_WORDS", 37)
    monkeypatch.setattr(phrases, "MOST_HOT", 16)
    rows = [r for r in rows if r[0] != "long"]
    check(spark, rows, best=25)


def test_scores_beyond_64_bits(spark):
    counted = spark.createDataFrame([(10**14, 10**14 + 7, 10**14 + 9), (3, 5, 7)], "a long, l long, r long")
    got = [r.s for r in counted.select(phrases._score(*map(counted.__getitem__, "alr")).alias("s")).collect()]
    assert got == [10**6 * 10**28 // ((10**14 + 7) * (10**14 + 9)), 10**6 * 9 // 35]


def test_paths(spark):
    """A fork, a chain, a loop on one node, and a ring nothing leads into."""
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("d", "f"), ("s", "s"), *[(f"r{k}", f"r{(k + 1) % 9}") for k in range(9)]]
    edges += [(f"k{k}", f"k{k + 1}") for k in range(21)]
    frame = spark.createDataFrame([("en", s, t, t, 10 + k) for k, (s, t) in enumerate(edges)], "lang string, source string, target string, word string, f long")
    paths = [[r.source, *[s.target for s in r.steps]] for r in phrases.compacted(frame).collect()]
    assert sorted((s, t) for p in paths for s, t in zip(p, p[1:])) == sorted(edges)
    assert ["a", "b", "c", "d"] in paths and ["d", "e"] in paths and ["d", "f"] in paths
    assert [f"k{k}" for k in range(22)] in paths
    rings = [p for p in paths if p[0].startswith("r")]
    assert sum(len(p) - 1 for p in rings) == 9
