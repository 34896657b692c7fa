"""Centroid clustering by ball-tree filtering.

Vectors become integers, floor(scale * x) of each component. Where they are read they are packed into blocks, and each block is a metric
tree: a ball holds all vectors of its subtree and knows their count, their integer sum, the sum of their squares and a radius around
their mean. Trees are laid down once; no vector is shuffled, so no frequent vector or source makes a large task.

A round sends the centroids, k vectors, to all trees. A ball keeps the centroids that may be nearest to one of its vectors: by the triangle
inequality those not farther from its mean than the nearest one and two radii. With one left the whole ball is that centroid's, by its sums; else
its children are asked, and in a leaf the exact integer distances to those left decide, ties to the smaller number. Blocks leave counts and
sums, which meet in groups; new centroids are the floors of the exact means. Empty clusters keep their centroid. Equal centroids are
asked once, for the smaller number.

Arithmetic: bounds have room for rounding, all that decides is exact. Vectors with a component of EXACT or more go in blocks without a
tree, in integers of any size, and so do distances to centroids that large.

Edge cases: vectors that are null, of another dimension, or hold null or non-finite components take no part. First centroids are the
vectors of smallest hash of salt and id, ties by the vector; those with a null id are none. With fewer than k vectors there are as
many centroids; without any, no rows. Rows that repeat are vectors of their own, a null id stays null. A distance or inertia
beyond 64 bits is null. Other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm.common import name, ready_python, staged, table
from lexatlas.llm.folding import summed

CLUSTERS, ROUNDS, DIM, SCALE, SALT = 40, 5, 64, 256.0, "2"
#: Vectors of a block, and of a leaf.
BLOCK, LEAF = 8192, 64
#: Components below this have exact products in doubles, up to 512 dimensions.
EXACT = 1 << 21
LONG = 1 << 63
TREES = "ids array<long>, wide boolean, vectors binary, nodes binary"


def node_type(dim: int) -> np.dtype:
    """right: the number of the right child, the left one is the next; 0 in a leaf."""
    return np.dtype([("start", "<i4"), ("count", "<i4"), ("right", "<i4"), ("radius", "<f8"), ("square", "<i8"), ("sum", "<i8", (dim,))])


def ball_tree(m: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of a block of integer vectors: a node holds the vectors at start .. start + count of that order."""
    order, nodes = np.arange(len(m)), []
    todo = [(0, len(m), -1)]
    while todo:
        start, end, parent = todo.pop()
        x = m[order[start:end]].astype(float)
        total = x.sum(0)
        away = ((x - total / len(x)) ** 2).sum(1)
        radius = math.sqrt(away.max()) * (1 + 1e-9) + 1e-9
        if parent >= 0:
            nodes[parent][2] = len(nodes)
        me = len(nodes)
        nodes.append([start, end - start, 0, radius, int((x * x).sum()), total.astype(np.int64)])
        a = x[away.argmax()]
        to_a = ((x - a) ** 2).sum(1)
        if end - start <= leaf or not to_a.any():  # few, or all the same
            continue
        left = to_a < ((x - x[to_a.argmax()]) ** 2).sum(1)
        order[start:end] = np.concatenate([order[start:end][left], order[start:end][~left]])
        cut = start + int(left.sum())
        todo += [(cut, end, me), (start, cut, -1)]
    return order, np.array([tuple(x) for x in nodes], node_type(m.shape[1]))


def integers(rows: list[list[float]], scale: float) -> list[list[int]]:
    """floor(scale * x), exactly; scale is a power of two."""
    return [[math.floor(scale * x) if abs(x) < 1 << 53 else int(x) * int(scale) for x in r] for r in rows]


def _trees(dim: int, scale: float, block: int, leaf: int):
    def record(ids: list, m: np.ndarray) -> list:
        order, nodes = ball_tree(m, leaf)
        return [[ids[k] for k in order], False, np.ascontiguousarray(m[order], "<i4").tobytes(), nodes.tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids: list = []
        held: list[np.ndarray] = []

        def packed(rows: list) -> pa.RecordBatch:
            kinds = [pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["ids", "wide", "vectors", "nodes"])

        for b in batches:
            x = np.asarray(b.column(1).flatten(), float).reshape(-1, dim)
            ids = b.column(0).to_pylist()
            wide = (np.abs(x) >= EXACT / scale).any(1)
            if wide.any():
                at = np.flatnonzero(wide)
                text = ";".join(",".join(map(str, v)) for v in integers(x[at].tolist(), scale))
                yield packed([[[ids[k] for k in at], True, text.encode(), b""]])
            small = np.flatnonzero(~wide)
            held_ids += [ids[k] for k in small]
            held.append(np.floor(scale * x[small]).astype(np.int32))
            if len(held_ids) >= block:
                m = np.concatenate(held)
                whole = len(held_ids) // block * block
                for k in range(0, whole, block):
                    yield packed([record(held_ids[k : k + block], m[k : k + block])])
                held_ids, held = held_ids[whole:], [m[whole:]]
        if held_ids:
            yield packed([record(held_ids, np.concatenate(held))])

    return run


class Centroids:
    """k integer vectors, and what of a block is nearest to each. products: exact distances taken."""

    def __init__(self, vectors: list[list[int]]):
        self.vectors, self.products = vectors, 0
        self.exact = np.array(vectors, object)
        most = 1 << 500  # farther away than any bound needs
        self.floats = np.array([[float(max(-most, min(most, x))) for x in v] for v in vectors])
        self.narrow = all(abs(x) < EXACT for v in vectors for x in v)
        self.distinct = np.array([v not in vectors[:k] for k, v in enumerate(vectors)])

    def exactly(self, x: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(numbers, squared distances) of the nearest centroids among those; x: rows of integers."""
        self.products += len(x) * len(among)
        if self.narrow and x.dtype != object:
            c, x = self.floats[among], x.astype(float)
            d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
            best = d.argmin(1)
            return among[best], d[np.arange(len(x)), best].astype(np.int64).tolist()
        x = x.astype(object)
        d = np.stack([((x - self.exact[c]) ** 2).sum(1) for c in among], 1)
        best = np.array([min(range(len(among)), key=row.__getitem__) for row in d], np.int64)
        return among[best], [row[b] for row, b in zip(d, best, strict=True)]

    def meet(self, nodes: np.ndarray, x: np.ndarray, ball, points) -> None:
        """Goes down a block's tree. ball(node, centroid): the whole ball is the centroid's; points(start, centroids, distances): a leaf's."""
        at = np.zeros(1, np.int64)
        may = self.distinct[None, :]
        while len(at):
            node = nodes[at]
            centre = node["sum"] / node["count"][:, None]
            # distances of means in plain differences: their rounding is far below the room
            d = np.sqrt(np.stack([((centre - c) ** 2).sum(1) for c in self.floats], 1))
            d[~may] = np.inf
            near = d.min(1)
            may = may & (d <= (near + 2 * node["radius"])[:, None] * (1 + 1e-9) + 1e-6)
            alone = may.sum(1) == 1
            for k in np.flatnonzero(alone):
                ball(node[k], int(may[k].argmax()))
            for k in np.flatnonzero(~alone & (node["right"] == 0)):
                start, end = node["start"][k], node["start"][k] + node["count"][k]
                points(int(start), *self.exactly(x[start:end], np.flatnonzero(may[k])))
            down = ~alone & (node["right"] > 0)
            at, may = np.concatenate([at[down] + 1, node["right"][down].astype(np.int64)]), np.concatenate([may[down], may[down]])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[list, np.ndarray, np.ndarray | None]]:
    """ids, vectors, nodes of each block; no nodes where vectors are integers of any size."""
    for b in batches:
        for r in b.to_pylist():
            if r["wide"]:
                yield r["ids"], np.array([[int(x) for x in v.split(b",")] for v in r["vectors"].split(b";")], object).reshape(-1, dim), None
            else:
                yield r["ids"], np.frombuffer(r["vectors"], "<i4").reshape(-1, dim), np.frombuffer(r["nodes"], node_type(dim))


def _totals(shared, dim: int, counter):
    """Counts, sums of squares and sums of each centroid's vectors, as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> bytes:
        c = Centroids(shared.value)
        out = np.zeros((len(c.vectors), dim + 2), object)
        for _, x, nodes in _blocks(batches, dim):
            here = np.zeros(out.shape, np.int64 if nodes is not None else object)

            def ball(node, k, here=here) -> None:
                here[k, 0] += node["count"]
                here[k, 1] += node["square"]
                here[k, 2:] += node["sum"]

            def points(start, owner, _, here=here, x=x) -> None:
                part = x[start : start + len(owner)].astype(here.dtype)
                np.add.at(here, owner, np.column_stack([np.ones(len(owner), here.dtype), (part * part).sum(1), part]))

            if nodes is None:
                points(0, *c.exactly(x, np.flatnonzero(c.distinct)))
            else:
                c.meet(nodes, x, ball, points)
            out = out + here.astype(object)
        if counter is not None:
            counter.add(c.products)
        return ",".join(map(str, out.ravel())).encode()

    return run


def _add(values: list[bytes]) -> bytes:
    return b",".join(str(sum(map(int, column))).encode() for column in zip(*(v.split(b",") for v in values), strict=True))


def _assigned(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Centroids(shared.value)
        for ids, x, nodes in _blocks(batches, dim):
            owner, distance = np.zeros(len(ids), np.int32), np.zeros(len(ids), object)

            def points(start, numbers, far, owner=owner, distance=distance) -> None:
                owner[start : start + len(numbers)], distance[start : start + len(numbers)] = numbers, far

            def ball(node, k, x=x, points=points) -> None:
                start, end = node["start"], node["start"] + node["count"]
                points(int(start), *c.exactly(x[start:end], np.array([k])))

            if nodes is None:
                points(0, *c.exactly(x, np.flatnonzero(c.distinct)))
            else:
                c.meet(nodes, x, ball, points)
            far = [int(d) if d < LONG else None for d in distance]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(owner, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def vector_trees(rows: DataFrame, *, id_col: str, vector_col: str, dim: int, scale: float, block: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(kept rows: id, v; their trees, laid down)."""
    ready_python(rows.sparkSession)
    v = F.col(name(vector_col)).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select(F.col(name(id_col)).cast("long").alias("id"), F.when(v.isNotNull() & (F.size(v) == dim) & ~bad, v).alias("v")).where("v is not null")
    return kept, staged(kept.mapInArrow(_trees(dim, scale, block, leaf), TREES), "ball-trees")


def centroid_clusters(
    rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, *, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: float = SCALE, salt: str = SALT, block: int = BLOCK, leaf: int = LEAF, counter=None
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector. counter: an accumulator for the number
    of exact distances in the rounds."""
    spark = rows.sparkSession
    kept, trees = vector_trees(rows, id_col=id_col, vector_col=vector_col, dim=dim, scale=scale, block=block, leaf=leaf)
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = kept.where("id is not null").select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()  # k rows
    centroids = integers([r["v"] for r in first], scale)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")

    def totals() -> list[tuple[int, int, list[int]]]:
        shared = spark.sparkContext.broadcast(centroids)
        flat = list(map(int, summed(trees, _totals(shared, dim, counter), _add).split(b",")))
        parts = [flat[j : j + dim + 2] for j in range(0, len(flat), dim + 2)]
        return [(p[0], p[1], p[2:]) for p in parts]

    for _ in range(rounds):
        centroids = [[x // n for x in total] if n else c for c, (n, _, total) in zip(centroids, totals(), strict=True)]
    # the squared distances of a cluster add up to squares - 2 centroid * sum + count * centroid^2
    inertia = [s - 2 * sum(a * b for a, b in zip(c, total, strict=True)) + n * sum(a * a for a in c) for c, (n, s, total) in zip(centroids, totals(), strict=True)]
    fits = lambda x: x if x < LONG else None
    told = [(j, fits(i), fits(sum(inertia)), sha256(",".join(map(str, c)).encode()).hexdigest()) for j, (c, i) in enumerate(zip(centroids, inertia, strict=True))]
    known = F.broadcast(spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # k rows
    found = trees.mapInArrow(_assigned(spark.sparkContext.broadcast(centroids), dim), "vec_id long, cluster int, distance long")
    return found.join(known, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_sql() -> str:
    """The rounds one after the other, by all distances."""
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS p, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, e) - 1)::INT AS c, e FROM (SELECT sha256('2:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 40)
)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT p, vec_id, e, b.c, b.d FROM (
    SELECT v.p, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, min({{'d': list_sum(list_transform(list_zip(v.e, c0.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c0.c}}) AS b
    FROM v, c{r} c0 GROUP BY v.p)
)""")
        if r < ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT c, list(q ORDER BY j) AS e FROM (
    SELECT c, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS q FROM (
      SELECT c, j, sum(e[j]) AS s, count(*) AS n FROM (SELECT c, e, unnest(range(1, 65)) AS j FROM a{r}) GROUP BY c, j)) GROUP BY c
), c{r + 1} AS MATERIALIZED (SELECT c0.c, coalesce(m.e, c0.e) AS e FROM c{r} c0 LEFT JOIN m{r} m ON m.c = c0.c)""")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.c = a.c
"""


OP13_SQL = op13_sql()
