from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fabpulse.llm import cover_tree


def brute(rows, k=10):
    known = []
    for vec_id, vector in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            known.append((vec_id, [math.floor(1024 * x) for x in vector]))
    for asked, (query, w) in enumerate(known):
        if query is not None and query % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, v)), i is None, i or 0)
                            for at, (i, v) in enumerate(known) if at != asked)[:k]
            for rank, (score, missing, i) in enumerate(scored, 1):
                yield query, rank, None if missing else i, -score


def searched(llm, rows, **how):
    df = llm.createDataFrame([(i, v, 1) for i, v in rows],
                             "vec_id long, embedding array<float>, score int")
    vectors = cover_tree.integer_vectors(df)
    found = cover_tree.top_k(vectors, F.col("vec_id") % 100 == 0, **how)
    return sorted(map(tuple, found.collect()), key=repr)


def f32(vector):
    return [float(np.float32(x)) for x in vector]


@pytest.mark.parametrize("how", [{}, {"block": 150, "group": 4}])
def test_equals_brute_force(llm, how):
    random = np.random.default_rng(3)
    centres = random.standard_normal((6, 12))
    rows = [(i, f32(centres[i % 6] + random.standard_normal(12) * random.choice([0.01, 0.5])))
            for i in range(1_200)]
    rows += [(2_000 + i, f32(centres[0])) for i in range(500)]  # one vector many times
    assert searched(llm, rows, **how) == sorted(brute(rows), key=repr)


def test_hard_rows(llm):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, 9.0]), (100, [1.0]), (200, []), (1, [3.0, -1.0, 2.0]),
            (2, None), (3, [None, 1.0]), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (None, [1.0, 1.0]),
            (300, [0.0, 0.0]), (6, [-4.0, 0.25])]
    assert searched(llm, rows) == sorted(brute(rows), key=repr)


def test_large_components_stay_exact(llm):
    rows = [(i, [2.0**20 + i % 3 * 0.25, 1.0 + i % 7]) for i in range(300)]
    rows = [(i, f32(v)) for i, v in rows]
    assert searched(llm, rows, k=4) == sorted(brute(rows, 4), key=repr)


def test_one_row_and_none(llm):
    assert searched(llm, [(0, [1.0])]) == []
    assert searched(llm, [(1, [1.0]), (2, [1.0])]) == []
    df = llm.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.top_k(cover_tree.integer_vectors(df), F.col("vec_id") % 100 == 0).count() == 0


def test_rows_of_one_id_are_candidates(llm):
    rows = [(1, [1.0, 0.0]), (1, [5.0, 0.0]), (2, [2.0, 0.0]), (100, [1.0, 0.0])]
    assert searched(llm, rows) == [(100, 1, 1, 5_242_880), (100, 2, 2, 2_097_152), (100, 3, 1, 1_048_576)]
    again = [(100, [1.0, 0.0])] * 3 + rows + [(None, [1.0, 0.0])] * 2 + [(7, [0.5, 3.0])] * 20
    assert searched(llm, again, block=8) == sorted(brute(again), key=repr)


def test_equals_sql(llm, tmp_path):
    random = np.random.default_rng(9)
    rows = [(int(i), f32(random.standard_normal(4).round(1))) for i in random.integers(0, 700, 900)]
    rows += [(None, [1.0] * 4), (800, None), (900, [1.0, None, 2.0, 0.0]), (901, [math.nan] * 4), (902, [math.inf] * 4)]
    path = str(tmp_path / "e.parquet")
    llm.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{path}/*.parquet'")
    assert sorted(con.sql(cover_tree.ORACLE).fetchall(), key=repr) == searched(llm, rows, block=200)


def test_queries_go_to_blocks_they_can_answer_from():
    random = np.random.default_rng(4)
    sample = random.integers(-50, 50, (40, 3))
    found = cover_tree.floors(np.arange(3), sample[:3], np.arange(40), sample, 5)
    for at in range(3):
        others = np.delete(sample, at, axis=0) @ sample[at]
        assert found[at] == np.sort(others)[-5]
    assert cover_tree.floors(np.arange(3), sample[:3], np.arange(5), sample[:5], 5) is None


def clusters(n, spread=20, width=8):
    random = np.random.default_rng(1)
    centres = random.standard_normal((20, width)) * 1_000
    return np.floor(np.repeat(centres, n // 20, axis=0)
                    + random.standard_normal((n, width)) * spread).astype(np.int64)


@pytest.mark.parametrize("points", [
    np.random.default_rng(0).standard_normal((900, 2)), clusters(2_000),
    np.random.default_rng(0).standard_normal((900, 40)), np.ones((300, 3))])
def test_covering_and_separation(points):
    tree = cover_tree.CoverTree(points)
    nodes = [tree.root]
    for node in nodes:
        own = points[tree.order[node.low:node.high]]
        assert np.sqrt(((own - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            assert [c.low for c in node.children] == [node.low, *(c.high for c in node.children[:-1])]
            assert node.children[-1].high == node.high
            assert len(node.children) <= cover_tree.FANOUT
            assert all(c.radius <= node.radius / 2 for c in node.children)
            assert (node.children[0].centre == node.centre).all()
            gaps = np.sqrt(((node.centres[:, None] - node.centres[None]) ** 2).sum(axis=2))
            assert gaps[~np.eye(len(gaps), dtype=bool)].min() > node.radius / 2
        nodes += node.children
    assert sorted(tree.order) == list(range(len(points)))
    assert len(nodes) > 5 or points.shape[1] in (40, 3)


def test_pruning_skips_pairs(monkeypatch):
    vectors = clusters(4_000)
    compared = []
    plain = cover_tree.Search._compare
    monkeypatch.setattr(cover_tree.Search, "_compare", lambda self, a, b: (
        compared.append((a.high - a.low) * (b.high - b.low)), plain(self, a, b)))
    rows = np.arange(4_000)
    cover_tree.Search(rows[::10], vectors[::10], rows, vectors, 5)
    assert sum(compared) < 400 * 4_000 / 5
