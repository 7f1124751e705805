"""Nearest neighbours: recall against brute force, ties, odd vectors."""

import math

import numpy as np
import pytest

from tablebridge.llm import ann
from tablebridge.llm.common import map_arrow

SMALL = ann.Settings(degree=8, trees=4, leaf=32, sample=6, beam=40, expand=20)


def brute(rows, asked, k):
    out = {}
    for q, v in rows:
        if q in asked:
            d = sorted((math.sqrt(sum((float(np.float32(a)) - float(np.float32(b))) ** 2 for a, b in zip(v, w, strict=True))), i) for i, w in rows if i != q)
            out[q] = d[:k]
    return out


def test_recall(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(1500, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "id % 50 = 0", 10).collect()
    want = brute(rows, set(range(0, 1500, 50)), 10)
    assert len(got) == 300
    hits = sum((g.score, g.vec_id) in [(d, i) for d, i in want[g.query_id]] or any(i == g.vec_id for _, i in want[g.query_id]) for g in got)
    assert hits / 300 >= 0.9
    for g in got:
        exact = np.sqrt(((x[g.query_id].astype(float) - x[g.vec_id].astype(float)) ** 2).sum())
        assert abs(exact - g.score) < 1e-12 and 1 <= g.rank <= 10 and g.vec_id != g.query_id


@pytest.mark.parametrize("scale", [1e-60, 1.0, 1e60])
def test_any_magnitude(spark, scale):
    r = np.random.default_rng(2)
    x = r.normal(size=(60, 8)) * scale
    got = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), "id in (0, 7, 30)", 3, SMALL).collect()
    for q in (0, 7, 30):
        d = sorted((np.sqrt(((x[q] - x[j]) ** 2).sum()), j) for j in range(60) if j != q)[:3]
        assert [g.vec_id for g in sorted(got, key=lambda g: g.rank) if g.query_id == q] == [j for _, j in d]


def test_iterations_end_when_lists_settle(spark, monkeypatch):
    """From bad beginnings (one ordering, small blocks) NN-descent itself makes the lists good."""
    r = np.random.default_rng(3)
    x = r.normal(size=(800, 8)).astype(np.float32)
    coded = ann._coded(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"))
    true = [set(np.argsort(((x - v) ** 2).sum(axis=1))[1:9].tolist()) for v in x]
    share = lambda graph: np.mean([len(true[g.id] & set(g.near[:8])) / 8 for g in graph.collect()])
    recalls = [share(ann.build_graph(coded, ann.Settings(degree=16, trees=1, leaf=16, spare_bits=1, sample=8, iterations=n))) for n in (0, 2, 30)]
    assert recalls[0] < 0.3 < recalls[1] < recalls[2] and recalls[2] > 0.95


def test_rounds_have_few_shuffles_and_python_steps(spark, monkeypatch):
    """Each is a task for every partition, however few its rows: 211 on the check tool's hot table."""
    r = np.random.default_rng(5)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(r.normal(size=(300, 8)))], "vec_id long, embedding array<double>")
    plans, cut = [], ann.cut
    monkeypatch.setattr(ann, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    assert ann.nearest(rows, "id % 50 = 0", 5, SMALL).count() == 30
    shape = lambda plan: (plan.count("MapInArrow"), plan.count("Join"), plan.count("Repartition"))
    iterations = [p for p in plans if "reach" in p]
    rounds = [p for p in plans if "query" in p and "near" in p and "ids" in p and "Union" in p]
    assert iterations and {shape(p) for p in iterations} == {(3, 1, 2)}
    assert rounds and {shape(p) for p in rounds} == {(1, 2, 1)}
    assert len(plans) == 5 + len(iterations) + len(rounds)  # one more for each round would be one that looks whether it ended


def test_workers_pass_imports_by_in_collections(spark):
    def frozen(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([gc.get_freeze_count()], pa.int64())], names=["n"])

    assert all(x.n > 1000 for x in map_arrow(spark.range(8, numPartitions=2), frozen, "n long").collect())


def test_ties_and_groups_of_equal_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100 + i, [0.0, 1.0]) for i in range(3)] + [(200, [1.0, 1.0]), (200, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnsRenamed({}).selectExpr("*", "1 as id", "2 as score", "3 as v")
    got = ann.nearest(df, "id in (0, 5, 101, 200)", 10, SMALL).collect()
    want = brute([*rows[:-1]], {0, 5, 101, 200}, 10)
    assert {(g.query_id, g.rank): (g.score, g.vec_id) for g in got} == {(q, k + 1): d for q, ds in want.items() for k, d in enumerate(ds)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (7, [None, 1.0]), (None, [1.0, 2.0]), (8, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, "true", 10, SMALL).collect()
    assert {(g.query_id, g.rank): g.vec_id for g in got} == {(0, 1): 1, (0, 2): 8, (1, 1): 0, (1, 2): 8, (8, 1): 1, (8, 2): 0}
    assert ann.nearest(df.where("false"), "true", 10, SMALL).count() == 0
    assert ann.nearest(df.where("vec_id = 0"), "true", 10, SMALL).count() == 0


def test_lists_merge():
    b = ann._lists(np.array([1, 1, 1, 2]), np.array([5, 4, 5, 9]), np.array([0.5, 0.5, 0.5, 1.0]), np.array([False, False, True, False]), 2)
    assert b.to_pydict() == {"id": [1, 2], "near": [[4, 5], [9]], "far": [[0.5, 0.5], [1.0]], "old": [[False, True], [False]]}
