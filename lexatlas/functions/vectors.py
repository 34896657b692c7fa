"""Vectors: cosine similarity as a column, and blocks of vectors for products of many with many."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexatlas.scratch import laid_in, scratch_path

#: Vectors in a block, bytes of the vectors in a group at most, and tasks that pairs of groups are dealt to at most.
BLOCK, GROUP, TASKS = 2048, 1 << 25, 10_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """0 where a vector has no length; null where one is null."""
    n = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(n == 0, 0.0).otherwise(dot(a, b) / n)


def cosine_to(vector: list[float], a: Column) -> Column:
    """Cosine similarity to one vector, whose norm is taken once."""
    v = F.array(*[F.lit(float(x)) for x in vector])
    return cosine(v, a, F.lit(math.sqrt(sum(float(x) ** 2 for x in vector))))


def usable(a: Column) -> Column:
    """Whether a vector takes part in searches: not null or empty, all components finite numbers."""
    bad = F.exists(a, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(a.isNotNull() & (F.size(a) > 0) & ~bad, F.lit(False))


def blocks(rows: DataFrame, vector: str, size: int = BLOCK) -> tuple[DataFrame, dict[int, int]]:
    """rows packed into blocks of one dimension: dim, slot, an array of each other column, data (the vectors one after another, as
    floats if they are floats, else as doubles); and how many slots each dimension has. Rows whose vector isn't usable are left out. Rows are dealt by where they are read, so that no
    frequent key makes a large block and a task that runs again deals them alike."""
    keys = [c for c in rows.columns if c != vector]
    some = rows.where(usable(F.col(vector))).withColumn("__at", F.monotonically_increasing_id()).withColumn("dim", F.size(vector))
    slots = {r["dim"]: -(-r["n"] // size) for r in some.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a few dimensions
    single = rows.schema[vector].dataType.simpleString() == "array<float>"
    item = F.struct(*keys, F.col(vector).cast("array<float>" if single else "array<double>").alias("__v"))
    packed = some.select("dim", F.pmod(F.xxhash64("__at"), _of(slots)).alias("slot"), item.alias("item")).groupBy("dim", "slot").agg(F.collect_list("item").alias("items"))
    column = lambda k: F.transform("items", lambda x: x[k])
    return packed.select("dim", "slot", *[column(k).alias(k) for k in keys], F.flatten(column("__v")).alias("data")), slots


def _of(slots: dict[int, int]) -> Column:
    pairs = [F.lit(x).cast("long") for kv in slots.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.col("dim").cast("long")) if pairs else F.lit(1).cast("long")


def meet(left: tuple[DataFrame, dict[int, int]], right: tuple[DataFrame, dict[int, int]], run, schema: str, group: int = GROUP) -> DataFrame:
    """run(left blocks, right blocks) -> rows, for each group of left blocks with each group of right blocks of the same dimension. Both sides
    are laid down once, a folder for each group, and a task reads the two groups of its pair there, of `group` bytes at most: nothing is shuffled for
    each group of the other side. Groups are smaller only where there would be fewer pairs of them than cores."""
    spark = left[0].sparkSession
    common = sorted(d for d in left[1] if d in right[1])
    size = {d: grouped(d, left[1][d], right[1][d], spark.sparkContext.defaultParallelism, group) for d in common}

    def lay(side: DataFrame) -> str:
        folder = scratch_path(spark, "groups")
        here = side.where(F.col("dim").isin(*common)) if common else side.where("false")
        here.withColumns({"__dim": F.col("dim"), "__group": F.floor(F.col("slot") / _of(size))}).write.partitionBy("__dim", "__group").option("compression", "zstd").parquet(folder)
        return folder

    folders = lay(left[0]), lay(right[0])
    shape = [(d, -(-left[1][d] // size[d]), -(-right[1][d] // size[d])) for d in common]
    ends = list(accumulate(m * n for _, m, n in shape))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in b["id"].tolist():
                i = next(i for i, end in enumerate(ends) if at < end)
                dim, m, n = shape[i]
                pair = divmod(at - (ends[i] - m * n), n)
                a, c = (laid_in(f"{folder}/__dim={dim}/__group={g}") for folder, g in zip(folders, pair, strict=True))
                if a and c:
                    yield run(pa.concat_tables(a).to_pandas(), pa.concat_tables(c).to_pandas())

    total = ends[-1] if ends else 0
    return spark.range(0, total, 1, max(1, min(total, TASKS))).mapInPandas(pairs, schema)


def grouped(dim: int, left: int, right: int, cores: int, group: int = GROUP) -> int:
    """Blocks in a group: as many as `group` bytes hold of single vectors, but fewer if that leaves cores without a pair of groups."""
    most = max(1, group // (BLOCK * dim * 4))
    return max(1, min(most, math.isqrt(left * right // cores)))


def unit_rows(data: np.ndarray, dim: int) -> np.ndarray:
    """A block's vectors as rows of length 1; those of no length stay zero."""
    m = np.asarray(data, float).reshape(-1, dim)
    size = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)
