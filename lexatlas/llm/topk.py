"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets, a quarter octave of their norm each, and packed into blocks of a bucket, sorted by
norm. Queries are packed too. Every query first meets the blocks of the longest vectors, HEAD_ROWS rows and more, which bounds its
k-th score from below. A task then takes a group of query blocks and a group of row blocks, the longest vectors first, and raises the
bounds as it goes. Bound / (query norm * the block's longest norm) is the query's local cosine threshold in a block: above 1 the block
is skipped for it; groups that no query can use are dropped before they are shipped. Below COORDINATE only the rows that are long
enough for the bound are multiplied (length pruning); from there on the query's largest coordinates are multiplied first and
Cauchy-Schwarz bounds the rest, so that few rows are multiplied whole (coordinate pruning). What is left is verified by its whole
integer product, and k rows at most per query leave a task.

The queries are a stated set against all rows in blocks; the pairs of blocks grow with queries times rows, as exact search must. A row
block is shipped once for QUERY_GROUP query blocks.

Edge cases: vectors that are null, or hold null or non-finite components, take no part. Of vectors of different dimension the
shorter one counts as filled up with zeros. A row with the query's own id is no candidate. Rows that repeat an id are candidates
of their own; a query row that repeats has a result of its own. A null id is no query, and comes last among ties. Components and
products beyond 64 bits count as the largest or smallest number of 64 bits. Empty tables give empty results. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.llm.common import name, ready_python, staged, table

BLOCK, QUERY_BLOCK = 4096, 2048
#: Blocks that a task holds at most, of queries and of rows. At 1,024 dimensions each takes 128 MB.
QUERY_GROUP, ROW_GROUP = 16, 8
#: Rows of the longest vectors that give the first bounds: the leading blocks that hold so many.
HEAD_ROWS = 4096
#: Queries that are multiplied together, sorted by how many rows are long enough for them.
TOGETHER = 256
#: Query blocks are joined with the groups of rows that they need in so many parts.
SALTS = 32
#: Local cosine threshold from which the coordinates prune, and how many of them.
COORDINATE, FOCUS = 0.6, 12
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min
PACKED = "block long, bucket int, dim int, longest double, ids binary, vectors binary"


def scaled(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    x = lambda v: v.cast("double")
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(x(v)) | (F.abs(x(v)) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda v: F.floor(x(v) * F.lit(scale)).cast("long")))


def _pack(t: pa.Table) -> pa.Table:
    ids = t.column("id").to_pandas(integer_object_nulls=True)
    ids = np.array([NO_ID if x is None else x for x in ids], np.int64)
    rows = t.column("v").to_pylist()
    dim = max(map(len, rows), default=0)
    m = np.zeros((len(rows), dim), np.int64)
    for i, r in enumerate(rows):
        m[i, : len(r)] = r
    norms = np.sqrt((m.astype(float) ** 2).sum(1))
    order = np.lexsort((ids, -norms))
    small = m.size == 0 or np.abs(m).max() < 2**31
    data = np.ascontiguousarray(m[order].astype("<i4" if small else "<i8"))
    head = [t.column("block")[0].as_py(), t.column("bucket")[0].as_py(), dim, float(norms.max(initial=0.0))]
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("dim", pa.int32()), ("longest", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary())])
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip([*head, ids[order].tobytes(), data.tobytes()], schema, strict=True)], schema=schema)


def pack(rows: DataFrame, size: int, tag: str) -> DataFrame:
    """rows (id, v) -> blocks of about `size` vectors of one norm bucket. Blocks are dealt by position, so no id makes a large one."""
    # positions are taken where rows are read, so that a task that runs again deals them alike
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = rows.withColumn("bucket", F.when(norm2 > 0, F.floor(2 * F.log2(norm2))).otherwise(-1).cast("int"))
    counts = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    counts = counts.withColumn("first", F.sum("blocks").over(W.partitionBy(F.lit(0)).orderBy("bucket")) - F.col("blocks"))
    rows = rows.join(staged(counts.coalesce(1), f"{tag}-buckets"), "bucket")
    rows = rows.withColumn("block", F.col("first") + F.pmod(F.xxhash64("at"), F.col("blocks")))
    return staged(rows.select("block", "bucket", "id", "v").groupBy("block").applyInArrow(_pack, PACKED), tag)


def _matrix(vectors: bytes, ids: bytes, dim: int, to: int) -> np.ndarray:
    n = len(ids) // 8
    m = np.frombuffer(vectors, f"<i{len(vectors) // max(1, n * dim)}" if n * dim else "<i4").reshape(n, dim)
    return np.pad(m, ((0, 0), (0, to - dim))) if to > dim else m


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: by doubles while they are exact, else by integers; beyond 64 bits by integers of any size, then cut to the range."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if most < 2**53:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    if most >= 2**63:
        return np.clip(q.astype(object) @ c.astype(object).T, LOWEST + 1, NO_ID).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _bounds(k: int):
    """Lower bounds of each query's k-th score from the blocks in `heads`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                dim = max(r.dim, *(h["dim"] for h in r.heads))
                q, ids = _matrix(r.vectors, r.ids, r.dim, dim), np.frombuffer(r.ids, np.int64)
                s = np.concatenate([_products(q, _matrix(h["vectors"], h["ids"], h["dim"], dim)) for h in r.heads], 1)
                c_ids = np.concatenate([np.frombuffer(h["ids"], np.int64) for h in r.heads])
                s[(ids[:, None] == c_ids) & (c_ids != NO_ID)] = LOWEST
                low = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(q), LOWEST)
                norm = np.sqrt((q.astype(float) ** 2).sum(1))
                least = np.where(low <= 0, 0.0, low / np.maximum(norm, 1e-300)).min(initial=np.inf)
                out.append((r.block, low.astype("<i8").tobytes(), float(least)))
            yield pd.DataFrame(out, columns=["block", "low", "least"])

    return run


def _highest(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's rows the k of highest score, ties to the smaller id; by query, then rank."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    new = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(new, np.arange(len(query)), 0))
    return query[rank < k], ids[rank < k], score[rank < k]


class Search:
    """A block of queries with their bounds and the best rows seen so far. products: whole products made."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, low: np.ndarray, k: int):
        self.q, self.ids, self.low, self.k, self.products = q, ids, low.copy(), k, 0
        self.q2 = q.astype(float) ** 2
        self.norm = np.sqrt(self.q2.sum(1))
        self.best = (np.zeros(0, np.int64),) * 3

    def meet(self, c: np.ndarray, c_ids: np.ndarray) -> None:
        """Rows of one block, by falling norm."""
        c2 = c.astype(float) ** 2
        c_norm = np.sqrt(c2.sum(1))
        longest = c_norm.max(initial=0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(self.low <= 0, 0.0, self.low / (self.norm * longest))
            reach = np.where(self.low <= 0, -np.inf, self.low / self.norm * (1 - 1e-9))
        found = [self._by_length(np.flatnonzero(local < COORDINATE), reach, c, c_norm)]
        found += [self._by_coordinates(i, c, c2, c_norm) for i in np.flatnonzero((local >= COORDINATE) & (local <= 1 + 1e-9))]
        at, row, score = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = (self.ids[at] != c_ids[row]) | (c_ids[row] == NO_ID)
        self.best = _highest(*(np.concatenate(x) for x in zip(self.best, (at[keep], c_ids[row][keep], score[keep]), strict=True)), self.k)
        # a query with k rows has the last one's score as its bound
        full = np.flatnonzero(np.bincount(self.best[0], minlength=len(self.q)) == self.k)
        last = np.searchsorted(self.best[0], full, "right") - 1
        self.low[full] = np.maximum(self.low[full], self.best[2][last])

    def _by_length(self, queries: np.ndarray, reach: np.ndarray, c: np.ndarray, c_norm: np.ndarray) -> tuple:
        out = [(np.zeros(0, np.int64),) * 3]
        n = np.searchsorted(-c_norm, -reach[queries], "right")
        order = np.argsort(n)
        for k in range(0, len(order), TOGETHER):
            part = order[k : k + TOGETHER]
            here = queries[part]
            s = _products(self.q[here], c[: n[part[-1]]])
            self.products += s.size
            at, row = np.nonzero(s >= self.low[here, None])
            out.append((here[at], row, s[at, row]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _by_coordinates(self, i: int, c: np.ndarray, c2: np.ndarray, c_norm: np.ndarray) -> tuple:
        focus = np.argsort(-self.q2[i])[:FOCUS]
        part = c[:, focus].astype(float) @ self.q[i, focus].astype(float)
        rest = np.sqrt(np.maximum(0, self.q2[i].sum() - self.q2[i, focus].sum()) * np.maximum(0, c_norm**2 - c2[:, focus].sum(1)))
        row = np.flatnonzero((part + rest) * (1 + 1e-9) + 1e-6 >= self.low[i])
        s = _products(self.q[i : i + 1], c[row])[0]
        self.products += len(row)
        row, s = row[s >= self.low[i]], s[s >= self.low[i]]
        return np.full(len(row), i), row, s


def _search(k: int, counter):
    """A group of query blocks against a group of row blocks."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query": pd.array([], "int64"), "query_id": pd.array([], "int64"), "vec_id": pd.array([], "Int64"), "score": pd.array([], "int64")})]
        dim = max([0, *rows["dim"], *queries["dim"]])
        blocks = [(_matrix(r.vectors, r.ids, r.dim, dim), np.frombuffer(r.ids, np.int64)) for r in rows.sort_values(["longest", "block"], ascending=[False, True]).itertuples(index=False)]
        for r in queries.sort_values("block").itertuples(index=False):
            s = Search(_matrix(r.vectors, r.ids, r.dim, dim), np.frombuffer(r.ids, np.int64), np.frombuffer(r.low, "<i8"), k)
            for c, c_ids in blocks:
                s.meet(c, c_ids)
            if counter is not None:
                counter.add(s.products)
            at, ids, score = s.best
            known = pd.array(ids, dtype="Int64")
            known[ids == NO_ID] = pd.NA
            out.append(pd.DataFrame({"query": (r.block << 20) + at, "query_id": s.ids[at], "vec_id": known, "score": score}))
        return pd.concat(out[1:] or out, ignore_index=True)

    return run


def top_products(queries: DataFrame, rows: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, counter=None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer products with the rows, ties to the smaller id. counter: an
    accumulator for the number of whole products."""
    spark = rows.sparkSession
    ready_python(spark)

    def ints(d: DataFrame) -> DataFrame:
        return d.select(F.col(name(id_col)).cast("long").alias("id"), scaled(F.col(name(vector_col)), scale).alias("v")).where("v is not null")

    c = pack(ints(rows), BLOCK, "topk-rows")
    q = pack(ints(queries), QUERY_BLOCK, "topk-queries")
    n_q, n_c = (d.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0] for d in (q, c))
    # the blocks of the longest vectors, until they hold enough rows: at most those and a block more
    enough = max(HEAD_ROWS, k + 1)
    order = c.select("block", "longest", (F.length("ids") / 8).alias("n")).orderBy(F.desc("longest"), "block").limit(enough)
    before = F.sum("n").over(W.orderBy(F.desc("longest"), "block").rowsBetween(W.unboundedPreceding, -1))
    first = order.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < enough).select("block")
    heads = c.join(F.broadcast(first), "block").agg(F.collect_list(F.struct("dim", "ids", "vectors")).alias("heads")).where(F.size("heads") > 0)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_q, 1) - 1).cast("long"))).alias("block")
    low = q.select("block", "dim", "ids", "vectors").join(heads.select(each, "heads"), "block").mapInPandas(_bounds(k), "block long, low binary, least double")
    low = staged(low, "topk-bounds")

    # groups of blocks: as many tasks as keep the cores busy, else as large as a task may hold
    q_groups = max(1, -(-n_q // QUERY_GROUP))
    size = max(1, min(ROW_GROUP, n_c * q_groups // (4 * spark.sparkContext.defaultParallelism)))
    c_groups = max(1, -(-n_c // size))
    c = c.withColumn("cg", F.floor(F.col("block") / size))
    q = q.select("block", "dim", "ids", "vectors").join(low, "block").withColumn("qg", F.floor(F.col("block") / QUERY_GROUP))
    least = low.groupBy(F.floor(F.col("block") / QUERY_GROUP).alias("qg")).agg(F.min("least").alias("least"))
    meet = c.groupBy("cg").agg(F.max("longest").alias("longest")).select("cg", "longest", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_groups - 1).cast("long"))).alias("qg"))
    meet = staged(meet.join(least, "qg").where(F.col("longest") * (1 + 1e-9) >= F.col("least")).select("qg", "cg"), "topk-pairs")
    left = c.select("cg", "block", "longest", "dim", "ids", "vectors").join(meet, "cg")
    salts = min(SALTS, c_groups)
    spread = q.select("qg", "block", "dim", "ids", "vectors", "low", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    right = spread.join(meet.withColumn("salt", F.pmod("cg", F.lit(salts))), ["qg", "salt"])
    found = left.groupBy("qg", "cg").cogroup(right.groupBy("qg", "cg")).applyInPandas(_search(k, counter), "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_products(vectors.where("vec_id % 20 = 0"), vectors, 20)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 20
"""
