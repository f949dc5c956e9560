from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from talentsift.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, x string, dots int"


def vectors(seed, n, size=4, spread=3.0):
    random_ = random.Random(seed)
    return [(i, [round(random_.gauss((i % 3) * 2 - 2, spread) * 64) / 64 for _ in range(size)]) for i in range(n)]


def plain(rows, size, clusters, rounds, scale=256, seed=2):
    """The contract read aloud, in whole numbers of any size."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) and abs(x * scale) < centroids.LARGEST for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    named = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None]
    middle = [x for _, x in sorted(named)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        groups = [[] for _ in middle]
        for _, x in kept:
            groups[nearest(x)[1]].append(x)
        middle = [[sum(column) // len(g) for column in zip(*g, strict=True)] if g else c for g, c in zip(groups, middle, strict=True)]
    return sorted((str(i), *nearest(x)) for i, x in kept) if middle else [], middle


def run(spark, rows, size, clusters, rounds):
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)
    assigned, final = centroids.centroid_clusters(frame, size=size, clusters=clusters, rounds=rounds)
    return assigned, final


@pytest.mark.parametrize(("clusters", "rounds"), [(1, 2), (5, 0), (7, 4), (60, 3)])
def test_clusters_equal_the_plain_procedure(spark, clusters, rounds):
    rows = vectors(clusters, 200)
    assigned, final = run(spark, rows, 4, clusters, rounds)
    found = sorted((str(r["vec_id"]), r["distance"], r["cluster"]) for r in assigned.collect())
    assert (found, final) == plain(rows, 4, clusters, rounds)


def test_kept_products_are_exact(spark):
    assigned, final = run(spark, vectors(1, 150), 4, 6, 4)
    for row in assigned.collect():
        assert row["dots"] == [int(np.dot(row["x"], c)) for c in final]


def test_odd_vectors_ties_and_repeats(spark):
    good = vectors(2, 40)
    odd = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 1.0, 1.0]), (104, [float("nan"), 0.0, 0.0, 0.0]), (105, [float("inf"), 0.0, 0.0, 0.0])]
    odd += [(106, [1e30, 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (None, None)]
    rows = [*good, *odd, *good[:5], *good[:5], (3, [9.0, 9.0, 9.0, 9.0])]
    assigned, final = run(spark, rows, 4, 50, 3)
    found = sorted((str(r["vec_id"]), r["distance"], r["cluster"]) for r in assigned.collect())
    assert (found, final) == plain(rows, 4, 50, 3)


def test_large_components_stay_exact(spark):
    random_ = random.Random(3)
    rows = [(i, [random_.choice([-1, 1]) * random_.randint(1, 1 << 26) / 256 for _ in range(4)]) for i in range(60)]
    assigned, final = run(spark, rows, 4, 5, 3)
    found = sorted((str(r["vec_id"]), r["distance"], r["cluster"]) for r in assigned.collect())
    assert (found, final) == plain(rows, 4, 5, 3)


def test_inertia_and_digests(spark):
    rows = vectors(4, 80)
    assigned, final = run(spark, rows, 4, 6, 2)
    found = centroids.with_inertia(assigned, final).collect()
    total = sum(r["distance"] for r in found)
    for r in found:
        assert r["inertia"] == total and r["cluster_inertia"] == sum(x["distance"] for x in found if x["cluster"] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, final[r["cluster"]])).encode()).hexdigest()


def test_tables_without_vectors(spark):
    for rows in ([], [(1, None)], [(None, [1.0, 1.0, 1.0, 1.0])]):
        assigned, final = run(spark, rows, 4, 3, 2)
        assert final == [] and centroids.with_inertia(assigned, final).collect() == []
