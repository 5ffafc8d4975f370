"""Nearest neighbours against brute force: recall, exact scores, order, odd rows, copies, both places of the index."""

from __future__ import annotations

import numpy as np
import pytest

from pulsebar.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, label int, v binary, class string, code string, cell long, query long"


def brute(rows, nearest=20):
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:nearest]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def recall(frame, rows):
    """Share of the true neighbours found; ranks, order and scores have to be right in any case."""
    given = {r[0]: np.array(r[1], np.float32).astype(float) for r in rows}
    want, got = brute(rows), {}
    for query, rank, vec_id, score in map(tuple, frame.collect()):
        got.setdefault(query, []).append((rank, vec_id, score))
    assert set(got) == {q for q, w in want.items() if w}
    hit = 0
    for query, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(want[query]) + 1))
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        assert query not in {f[1] for f in found}
        for _, vec_id, score in found:
            assert score == pytest.approx(float(given[vec_id] @ given[query]), abs=1e-12)
        hit += len({f[1] for f in found} & {w[0] for w in want[query]})
    return hit / sum(map(len, want.values()))


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, None if x is None else [None if c is None else float(c) for c in x], 1, b"v", "c", "c", 1, 1) for i, x in rows], SCHEMA
    ).repartition(5)


@pytest.fixture(scope="module")
def clustered():
    """Tight clusters of unequal lengths, and one vector that a fifth of the rows share."""
    draws = np.random.default_rng(1)
    centres = draws.normal(size=(60, 16))
    rows = [(i, (centres[i % 60] * draws.uniform(0.5, 2) + 0.02 * draws.normal(size=16)).astype(np.float32)) for i in range(1500)]
    return rows + [(5000 + i, rows[40][1]) for i in range(300)]


def test_table(spark):
    small = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert recall(queries.op12_nearest(spark, small), rows) >= 0.95


@pytest.mark.parametrize("cells", [True, False])
def test_copies_and_clusters(spark, clustered, cells):
    assert recall(neighbours.nearest_rows(frame(spark, clustered), cells=cells), clustered) >= 0.9


def test_index_and_blocks_find_the_same(spark, clustered, monkeypatch):
    """Several blocks of rows and queries, too; a pair that shares several cells is found once."""
    want = {tuple(r) for r in neighbours.nearest_rows(frame(spark, clustered), cells=False).collect()}
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    for cells in (True, False):
        found = [tuple(r) for r in neighbours.nearest_rows(frame(spark, clustered), cells=cells).collect()]
        assert len(found) == len(set(found)) and set(found) == want


def test_odd_rows(spark, clustered):
    good = clustered[:50] + [(-20, -clustered[1][1])]
    odd = [
        (60, None), (80, [0.0] * 16), (100, [float("nan")] * 16), (120, [None] * 16), (140, [1.0]), (None, clustered[0][1]),
        (160, []), (180, [float("inf")] + [0.0] * 15), good[0], good[3],
    ]
    assert recall(neighbours.nearest_rows(frame(spark, good + odd)), good) >= 0.9
    assert neighbours.nearest_rows(frame(spark, [])).count() == 0
    assert neighbours.nearest_rows(frame(spark, good[:1])).count() == 0
    same = [(k, good[0][1]) for k in (40, 0, 7, 20)]
    found = sorted(tuple(r)[:3] for r in neighbours.nearest_rows(frame(spark, same)).collect())
    assert found == [(0, 1, 7), (0, 2, 20), (0, 3, 40), (20, 1, 0), (20, 2, 7), (20, 3, 40), (40, 1, 0), (40, 2, 7), (40, 3, 20)]


def test_shares_hold_the_radius():
    """Whatever is within the radius is within its share in some substring, and no smaller shares would do."""
    draws = np.random.default_rng(3)
    for radius in range(0, 40):
        reach = neighbours.shares(radius)
        assert sum(s + 1 for s in reach) == radius + 1 or radius >= neighbours.PARTS * neighbours.PART
        for _ in range(50):
            flips = np.bincount(draws.integers(0, neighbours.PARTS, radius), minlength=neighbours.PARTS)
            assert (flips <= reach).any()
    assert neighbours.shared_index_pays(10**9, 10**7, 3) and not neighbours.shared_index_pays(10**5, 10**4, 55)
