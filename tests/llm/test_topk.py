from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from talentsift.llm import topk


def brute(rows, k=10, factor=1024):
    clean = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.add((i, tuple(math.floor(factor * x) for x in v)))
    out = set()
    for q in {i for i, _ in clean if i % 100 == 0}:
        best = {}
        for i, qv in clean:
            if i == q:
                for j, v in clean:
                    if j != q and len(v) == len(qv):
                        best[j] = max(best.get(j, -(1 << 70)), sum(a * b for a, b in zip(qv, v, strict=True)))
        for rank, (score, j) in enumerate(sorted((-s, j) for j, s in best.items())[:k], 1):
            out.add((q, rank, j, -score))
    return out


def run(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as block", "2 as score", "3 as x")
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return {tuple(r) for r in found.collect()}


def test_ties_repeats_nulls_and_mixed_lengths_match_brute_force(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # one vector many times
    rows += [(100, rows[100][1]), (200, [1.0] * 8), (1300, [0.0] * 8), (1400, [-0.5] * 8)]
    rows += [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(2100, [1.0, 2.0]), (2101, [3.0, 4.0]), (2200, []), (2201, [])]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == {(0, 1, 1, 2048 * 1024)}
    assert run(spark, [(0, [1.0])]) == set()
    assert run(spark, []) == set()


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [3e9, 1.0]), (1, [2e3, 5.0]), (2, [2e3, 5.001])]
    assert run(spark, rows) == brute(rows)


def test_a_search_stops_before_the_lists_end():
    import numpy as np

    rows = np.zeros((4000, 4), np.int64)
    rows[:, 0] = np.arange(4000)
    lists = topk.SortedLists(np.arange(4000), rows)
    seen = []
    original = np.unique
    try:
        topk.np.unique = lambda x: seen.append(len(x)) or original(x)
        assert lists.search(-1, np.array([5, 0, 0, 0]), 3, 16) == [(19995, 3999), (19990, 3998), (19985, 3997)]
    finally:
        topk.np.unique = original
    assert sum(seen) < 100


def test_an_id_of_many_high_vectors_takes_one_place(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += [(7, [v * (3 + k / 10) for v in rows[100][1]]) for k in range(11)]
    rows += [(8, [v * (2 + k / 10) for v in rows[200][1]]) for k in range(11)]
    found = run(spark, rows)
    assert found == brute(rows)
    assert {q: sum(x[0] == q for x in found) for q in (0, 100, 200)} == {0: 10, 100: 10, 200: 10}
