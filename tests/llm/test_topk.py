"""Top-k search in integers of any size, against plain Python integers."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from lineforge.llm import topk

SCHEMA = "vec_id long, embedding array<double>, v int, row long, qb int, cb int, score long, rank int"


def program(vectors, k):
    """(query_id, rank, vec_id, score): rows that share an id each ask and are ranked for themselves."""
    used = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors if all(abs(64 * x) < 2**63 for x in v)]
    out = []
    for q, v in used:
        if q % 20 == 0:
            found = [(i, sum(a * b for a, b in zip(v, w, strict=False))) for i, w in used if i != q]
            found = sorted((-max(-(2**63), min(2**63 - 1, s)), i) for i, s in found)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, vectors, **settings):
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4, 5, 6) for i, v in vectors], SCHEMA).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, topk.SearchSettings(**settings))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


def test_scores_beyond_2_to_53(spark):
    """The two vectors that doubles cannot tell apart, and random ones around them."""
    draw = np.random.default_rng(3)
    vectors = [(0, [2.0**22 + 1 / 64, 1 / 64]), (1, [2.0**22 + 1 / 64, 1 / 64]), (2, [2.0**22 + 1 / 64, 0.0])]
    vectors += [(i, [float(x) for x in draw.integers(-(2**40), 2**40, 4) / 64]) for i in range(3, 90)]
    vectors += [(i, [float(x) for x in draw.integers(-9, 9, 4) / 64]) for i in range(90, 200)]
    got = run(spark, vectors, k=6, query_block=3, candidate_block=40, dimensions=2)
    assert got == program(vectors, 6)
    exact = (2**28 + 1) ** 2
    assert {s for q, _, i, s in got if q == 0 and i in (1, 2)} <= {exact + 1, exact}


def test_components_and_scores_out_of_range(spark):
    vectors = [(0, [1e307, 1.0]), (1, [1.0, 1.0]), (20, [1e15, 1e15]), (21, [1e16, -1.0]), (22, [-1e16, 1.0]), (23, [1e15, 2.0]), (24, [2.0**57, 1.0]), (25, [2.0, 3.0])]
    got = run(spark, vectors, k=10)
    assert got == program(vectors, 10)
    assert {q for q, *_ in got} == {20} and {0, 24}.isdisjoint(i for _, _, i, _ in got)
    assert {s for _, _, i, s in got if i in (21, 23)} == {2**63 - 1} and {s for _, _, i, s in got if i == 22} == {-(2**63)}


def test_repeated_ids_and_ties(spark):
    vectors = [(20, [1.0, 0.0]), (20, [0.5, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (5, [1.0, 9.0]), (3, [0.0, 1.0]), (9, [])]
    got = run(spark, vectors, k=4)
    want = program([(i, v + [0.0] * (2 - len(v))) for i, v in vectors], 4)
    assert got == want
