import random

import numpy as np
from pyspark.sql import functions as F

from mercaflow.llm import neighbours
from mercaflow.llm.neighbours import nearest


def test_neighbours_of_small_tables_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(4)]) for i in range(400)]
    rows += [(i, [1.0, 1.0, 2.0, 0.5]) for i in range(400, 460)]
    odd = [(500, None), (501, [0.0] * 4), (502, [1.0, None, 1.0, 1.0]), (503, [float("nan")] * 4), (600, [1.0, 2.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame([*rows, *odd, rows[0]], "vec_id long, embedding array<float>")
    got = nearest(df, df.filter("vec_id % 100 = 0"), k=10).collect()
    good = {i: np.array(v) for i, v in rows if any(v)}
    hit = asked = 0
    for q in (i for i in good if i % 100 == 0):
        away = sorted((float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 11))
        hit += sum(abs(s - d) < 1e-9 and i == j for (_, s, i), (d, j) in zip(own, away))
        asked += 10
    assert hit / asked >= 0.9
    assert {r.query_id for r in got} == {i for i in good if i % 100 == 0}


def test_no_vectors_no_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, df).collect() == []


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    got = nearest(df, df.filter("vec_id = 0")).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]


def test_rounds_go_on_until_the_graph_settles(spark, monkeypatch):
    # A poor start, from which two rounds lead to few of the neighbours.
    monkeypatch.setattr(neighbours, "TREES", 2)
    monkeypatch.setattr(neighbours, "CELL", 6)
    vectors = np.random.default_rng(6).standard_normal((1500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    nodes = df.select(F.col("vec_id").alias("node"), "embedding")
    hit = 0
    for row in neighbours.build_graph(nodes).collect():
        away = np.square(vectors - vectors[row.node]).sum(axis=1)
        away[row.node] = np.inf
        hit += len({e.id for e in row.entries[:10]} & set(np.argsort(away)[:10].tolist()))
    assert hit >= 0.9 * 10 * len(vectors)
