import math
import random
from hashlib import sha256

import numpy as np
import pytest

from lexatlas.llm import clustering
from lexatlas.llm.clustering import ball_tree, centroid_clusters


def brute(rows, k, rounds, dim, scale=256):
    v = [(i, [math.floor(scale * z) if abs(z) < 2**53 else int(z) * scale for z in x]) for i, x in rows if x is not None and len(x) == dim and all(z is not None and math.isfinite(z) for z in x)]
    c = [x for _, x in sorted((sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in v if i is not None)[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda x: min((far(x, y), j) for j, y in enumerate(c))
    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in v]
        c = [[sum(col) // own.count(j) for col in zip(*(x for o, (_, x) in zip(own, v, strict=True) if o == j), strict=True)] if j in own else y for j, y in enumerate(c)]
    last = [(i, *nearest(x)) for i, x in v]
    inertia = [sum(d for _, d, j in last if j == n) for n in range(len(c))]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(((i, j, fits(d), fits(inertia[j]), fits(sum(inertia)), sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in last), key=str)


def odd_rows(rng, n, dim, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [z + rng.gauss(0, spread) for z in centres[i % 5]]) for i in range(n)]
    rows += [(901, None), (902, [1.0] * (dim - 1) + [None]), (903, [math.nan] * dim), (904, []), (905, [math.inf] + [0.0] * (dim - 1)), (906, [1.0] * (dim + 1)), (None, [0.5] * dim)]
    return rows + [(1000 + i, [0.25] * dim) for i in range(40)] + [(7, [-3.0] * dim)] * 3


SCHEMA = "vec_id long, embedding array<double>, cluster int, `a.b` string"


def tuples(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


@pytest.mark.parametrize(("spread", "block", "leaf", "k"), [(0.01, 8192, 8, 6), (1.0, 50, 4, 12), (0.1, 64, 1, 30)])
def test_clusters_equal_brute_force(spark, spread, block, leaf, k):
    rows = odd_rows(random.Random(k), 300, 4, spread)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    counter = spark.sparkContext.accumulator(0)
    assert tuples(centroid_clusters(df, k, 3, dim=4, block=block, leaf=leaf, counter=counter)) == brute(rows, k, 3, 4)


def test_most_distances_are_not_taken(spark):
    """In the plane a leaf lies near few of 40 centroids, and balls far inside a cluster are assigned whole."""
    rng = random.Random(1)
    rows = [(i, [rng.random() * 10, rng.random() * 10]) for i in range(4000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    counter = spark.sparkContext.accumulator(0)
    got = centroid_clusters(df, 40, 3, dim=2, leaf=16, counter=counter)
    assert tuples(got) == brute(rows, 40, 3, 2)
    assert counter.value < 4000 * 40 * 4 / 6  # three rounds and the sums of the last assignment


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([1.0, 1e3, 1e7, 1e18, 1e300]) * rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)] + [(100 + i, [rng.random()] * 3) for i in range(60)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert tuples(centroid_clusters(df, 9, 3, dim=3)) == brute(rows, 9, 3, 3)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 1, "x")], SCHEMA)
    assert [r["cluster"] for r in centroid_clusters(df, 40, dim=2).collect()] == [0, 0]
    assert centroid_clusters(df.where("false"), dim=2).collect() == []
    assert centroid_clusters(df, dim=3).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_trees_hold_their_vectors():
    m = np.random.default_rng(0).integers(-500, 500, (700, 5)).astype(np.int32)
    m[:100] = 3
    order, nodes = ball_tree(m, 10)
    assert sorted(order) == list(range(700))
    for k, node in enumerate(nodes):
        x = m[order[node["start"] : node["start"] + node["count"]]].astype(float)
        assert (x.sum(0) == node["sum"]).all() and (x * x).sum() == node["square"]
        assert np.sqrt(((x - x.mean(0)) ** 2).sum(1)).max() <= node["radius"]
        if node["right"]:
            left, right = nodes[k + 1], nodes[node["right"]]
            assert left["start"] == node["start"] and right["start"] == left["start"] + left["count"] and left["count"] + right["count"] == node["count"]
        else:
            assert node["count"] <= 10 or not (x - x[0]).any()


def test_the_bounds_leave_ties_to_the_smaller_number():
    c = clustering.Centroids([[0, 0], [4, 0], [0, 0], [4, 0]])
    m = np.array([[2, 0], [2, 5], [1, 0], [3, 0]], np.int32)
    order, nodes = ball_tree(m, 1)
    owner = {}
    c.meet(nodes, m[order], lambda node, k: owner.update({tuple(m[order[node["start"]]].tolist()): k}), lambda start, who, far: owner.update({tuple(m[order[start + j]].tolist()): int(k) for j, k in enumerate(who)}))
    assert owner == {(2, 0): 0, (2, 5): 0, (1, 0): 0, (3, 0): 1}
