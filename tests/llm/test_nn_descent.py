import math
import random

from pyspark.sql import functions as F

from rideflow.llm import nn_descent as nn
from tests.llm import brute


def _run(spark, rows, every=1, **more):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found: dict = {}
    for r in nn.nearest_neighbours(frame, F.col("vec_id") % every == 0, **more).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in found.items()}


def _float(x):
    import numpy as np

    return float(np.float32(x))


def test_recall_against_brute_force(spark):
    rnd = random.Random(6)
    centres = [[rnd.gauss(0, 1) for _ in range(24)] for _ in range(12)]
    rows = [(i, [_float(c + rnd.gauss(0, 0.5)) for c in rnd.choice(centres)]) for i in range(1500)]
    got = _run(spark, rows, every=10)
    want = brute.nearest(dict(rows), [i for i, _ in rows if i % 10 == 0], 10)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda x: (x[1], x[0]))
        for v, s in found:
            assert math.isclose(s, math.dist(dict(rows)[q], dict(rows)[v]), rel_tol=1e-12)


def test_one_vector_in_very_many_rows(spark):
    rnd = random.Random(7)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000 + i, [_float(rnd.random()) for _ in range(3)]) for i in range(100)]
    got = _run(spark, rows, every=100)
    assert [v for v, _ in got[200]] == list(range(10)) and {s for _, s in got[200]} == {0.0}
    assert [v for v, _ in got[0]] == list(range(1, 11))
    want = brute.nearest(dict(rows), [1000], 10)
    assert [v for v, _ in got[1000]] == [v for v, _ in want[1000]]


def test_vectors_beyond_half_precision(spark):
    for size in (1e6, 1e25, 1e-12):
        rnd = random.Random(8)
        rows = [(i, [_float(size * rnd.gauss(0, 1)) for _ in range(8)]) for i in range(400)]
        got = _run(spark, rows, every=20)
        want = brute.nearest(dict(rows), [i for i, _ in rows if i % 20 == 0], 10)
        assert sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) >= 0.95 * 10 * len(want)


def test_links_of_a_search_are_bounded(spark):
    rnd = random.Random(9)
    # One node in the middle of a shell: it is in nearly every list.
    rows = [(0, [0.01] * 16)]
    for i in range(1, 600):
        x = [rnd.gauss(0, 1) for _ in range(16)]
        rows.append((i, [_float(c / math.hypot(*x)) for c in x]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    nodes = nn.materialize(nn.distinct_nodes(nn.usable_vectors(frame), 10))
    graph = nn.materialize(nn.neighbour_graph(nodes, k=10))
    held = graph.mapInArrow(nn._edges, nn._EDGES).filter("turned AND owner = 0").count()
    links = [r["from"] for r in nn.search_links(graph, degree=10).collect()]
    assert held > 60 and set(links) == set(range(600))
    assert max(links.count(n) for n in range(600)) <= 20


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-0.0, 1.0]), (8, [-0.0, 1.0]), (9, [])]
    got = _run(spark, rows)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {0: [1, 8], 1: [8, 0], 8: [1, 0]}
    assert _run(spark, []) == {} and _run(spark, [(1, [1.0])]) == {} and _run(spark, [(1, None)]) == {}
