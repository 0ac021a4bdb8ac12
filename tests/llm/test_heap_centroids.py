"""Heap-ordered clustering against plain Lloyd rounds in whole numbers."""

import random

import pytest

from ctspark.llm import heap_centroids as hc

SCHEMA = "vec_id long, vec array<long>, id string, cluster string, data string, moved int"


def lloyd(vectors, centroids, rounds):
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for v in vectors]
        for c in range(len(centroids)):
            mine = [v for v, o in zip(vectors, own, strict=True) if o == c]
            if mine:
                centroids = [*centroids[:c], [sum(col) // len(mine) for col in zip(*mine, strict=True)], *centroids[c + 1 :]]
    return [nearest(v) for v in vectors], centroids


def run(spark, rows, starts, dims, rounds=5, block=16):
    df = spark.createDataFrame([(i, v, "x", "y", "z", 1) for i, v in rows], SCHEMA).repartition(3)
    first = spark.createDataFrame([(i, c) for i, c in enumerate(starts)], "n long, vec array<long>").orderBy("n")
    return hc.cluster(df, first, dims, rounds, block=block)


def points(n, dims, spread, seed=1):
    rng = random.Random(seed)
    middles = [[rng.randint(-spread, spread) for _ in range(dims)] for _ in range(6)]
    return [[a + rng.randint(-spread // 6 - 1, spread // 6 + 1) for a in rng.choice(middles)] for _ in range(n)]


@pytest.mark.parametrize(("n", "k", "dims", "spread"), [(200, 12, 3, 4), (300, 8, 5, 300), (150, 40, 2, 2), (80, 1, 3, 50), (60, 7, 4, 90_000_000)])
def test_against_plain_rounds(spark, n, k, dims, spread):
    vectors = points(n, dims, spread)
    starts = vectors[:k]
    found = run(spark, list(enumerate(vectors)), starts, dims)
    expected, centroids = lloyd(vectors, starts, 5)
    assert found.centroids == centroids
    assert [(r["id"], r["distance"], r["cluster"]) for r in found.rows.orderBy("id").collect()] == [(i, d, c) for i, (d, c) in enumerate(expected)]


def test_settled_vectors_stay_in_their_heaps(spark):
    rng = random.Random(2)
    vectors = [[1000 * c + rng.randint(-9, 9), rng.randint(-9, 9)] for c in range(8) for _ in range(40)]
    found = run(spark, list(enumerate(vectors)), [vectors[40 * c] for c in range(8)], 2)
    assert found.scanned[0] == 320
    assert sum(found.scanned[1:]) == 0


def test_rows_that_take_no_part_and_repeats(spark):
    vectors = points(50, 2, 20)
    rows = [*enumerate(vectors), (None, [5, 5]), (3, vectors[3]), (3, vectors[3]), (90, None), (91, []), (92, [1]), (93, [1, None]), (94, [1, 2, 3])]
    found = run(spark, rows, vectors[:4], 2)
    used = [*vectors, [5, 5], vectors[3], vectors[3]]
    expected, centroids = lloyd(used, vectors[:4], 5)
    assert found.centroids == centroids
    ids = [*range(50), None, 3, 3]
    assert sorted(((r["id"], r["distance"], r["cluster"]) for r in found.rows.collect()), key=str) == sorted(((i, d, c) for i, (d, c) in zip(ids, expected, strict=True)), key=str)


def test_equal_centroids_and_empty_ones(spark):
    vectors = [[1, 1]] * 30 + [[9, 9]] * 3
    found = run(spark, list(enumerate(vectors)), [[1, 1], [1, 1], [500, 500]], 2)
    expected, centroids = lloyd(vectors, [[1, 1], [1, 1], [500, 500]], 5)
    assert found.centroids == centroids and centroids[1:] == [[1, 1], [500, 500]]
    assert {r["cluster"] for r in found.rows.collect()} == {c for _, c in expected}


def test_no_vectors(spark):
    assert run(spark, [], [], 4).rows.collect() == []
    assert run(spark, [], [[1, 2, 3, 4]], 4).rows.collect() == []


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1 << 27, 0])], [[0, 0]], 2)
