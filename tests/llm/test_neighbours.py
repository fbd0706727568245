import numpy as np
import pytest
from pyspark.sql import functions as F

from arrivo.llm import ann_tree

SPEC = "vec_id long, embedding array<float>, rank string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x") for i, v in rows], SPEC)


def brute(rows, is_query, keep=5):
    """All pairs in double precision; ties to the smaller id."""
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            known.setdefault((i, tuple(np.float32(v).tolist())), None)
    out = {}
    for i, v in known:
        if is_query(i):
            q = np.array(v, np.float64)
            near = sorted((-float(ann_tree.exact_cosine(q, np.array([w], np.float64))[0]), j) for j, w in known if j != i)
            out[i] = [(j, -s) for s, j in near[:keep]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_spread_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(3000)]
    got = found(ann_tree.neighbours(table(spark, rows), F.col("id") % 50 == 0))
    want = brute(rows, lambda i: i % 50 == 0)
    assert set(got) == set(want)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {q: dict(want[q]) for q in want}
    assert all(s == exact[q][j] for q in got for j, s in got[q] if j in exact[q])


def test_clusters_and_copies_are_exact(spark):
    """Far apart clusters, one vector with a third of all rows, and scaled copies that tie."""
    rng = np.random.default_rng(1)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.1).tolist()) for i in range(400)]
    rows += [(i, [1.0] * 8) for i in range(400, 600)] + [(i, [2.0] * 8) for i in range(600, 620)]
    got = found(ann_tree.neighbours(table(spark, rows), F.col("id") % 50 == 0, recall=1.0))
    want = brute(rows, lambda i: i % 50 == 0)
    assert got == want
    assert [j for j, _ in got[500]] == [400, 401, 402, 403, 404]


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]), (100, [None, 1.0]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (None, [1.0, 2.0]), (250, [1.0, 2.0, 3.0])]
    got = found(ann_tree.neighbours(table(spark, rows), F.col("id") % 50 == 0))
    root = pytest.approx(2**-0.5)
    assert got == {0: [(3, root), (50, 0.0)], 50: [(3, root), (0, 0.0)]}


def test_empty_and_no_queries(spark):
    assert ann_tree.neighbours(table(spark, []), F.col("id") % 50 == 0).count() == 0
    assert ann_tree.neighbours(table(spark, [(1, [1.0]), (2, [1.0])]), F.col("id") % 50 == 0).count() == 0


def test_best_first_visits_every_leaf_once():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(600, 6))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    tree = ann_tree.grow(unit, 600, branches=4, leaf_rows=40)
    assert tree.leaves > 4
    assert sorted(tree.best_first(unit[0])) == list(range(tree.leaves))
    own = tree.leaf_of(unit)
    assert np.mean([next(tree.best_first(u)) == leaf for u, leaf in zip(unit, own)]) > 0.9


def test_blocks_give_the_same(spark, monkeypatch):
    """Leaves dealt out in many blocks of rows and queries find what one block finds."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    one = found(ann_tree.neighbours(table(spark, rows), F.col("id") % 5 == 0))
    monkeypatch.setattr(ann_tree, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann_tree, "BLOCK_QUERIES", 8)
    assert found(ann_tree.neighbours(table(spark, rows), F.col("id") % 5 == 0)) == one
