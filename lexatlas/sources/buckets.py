"""Stored tables in buckets by the hash of a key: an upsert rewrites the buckets that its rows fall in and leaves the files of others.

A table is a folder with `data`, whose files never change, and `manifest`, a stored table (see sinks) that names the folder of each bucket.
A new manifest becomes current by one rename, which fails if another writer was first; so a reader sees all of an upsert or nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexatlas.functions.numbering import first_rows
from lexatlas.scratch import staged
from lexatlas.sources.sinks import current, delete, overwrite

BUCKET = "__bucket"
MANIFEST = "bucket int, folder string"


def _folders(spark: SparkSession, manifest: str | None) -> dict[int, str | None]:
    """The folder of each bucket, null for one without rows: a row for each bucket of the table."""
    return {r["bucket"]: r["folder"] for r in spark.read.schema(MANIFEST).parquet(manifest).collect()} if manifest else {}


def version(spark: SparkSession, path: str) -> int:
    """The number of a table's current version, 0 if there is none; for upsert's `base`."""
    return current(spark, f"{path}/manifest")[0]


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, schema: T.StructType, folders: list[str | None]) -> DataFrame:
    there = [f"{path}/data/{f}" for f in folders if f]
    return spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of now, or an empty one if there is none."""
    return _read(spark, path, schema, list(_folders(spark, current(spark, f"{path}/manifest")[1]).values()))


def upsert_buckets(changes: DataFrame, path: str, key: str, *, buckets: int = 64, base: int | None = None) -> list[int]:
    """Insert the rows of changes, each in place of the row with its key; the buckets that were written. A key comes once in changes; null is
    one as well. changes may read the table.

    buckets counts when the table is made and stays. base: the version that changes were made from (see version). If another writer
    has replaced it meanwhile nothing changes and an OSError is raised. Files of the version before stay for those that still read it.
    """
    spark = changes.sparkSession
    number, manifest = current(spark, f"{path}/manifest")
    known = _folders(spark, manifest)
    old = _folders(spark, current(spark, f"{path}/manifest", before=number)[1]) if number > 1 else {}
    base, count = number if base is None else base, len(known) or buckets
    rows = staged(changes.withColumn(BUCKET, bucket_of(key, count)), "changes")
    touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # `count` numbers at most
    name, now = uuid.uuid4().hex, {b: known.get(b) for b in range(count)}
    if touched:
        there = _read(spark, path, changes.schema, [now[b] for b in touched])
        every = there.withColumn("__new", F.lit(0)).unionByName(rows.drop(BUCKET).withColumn("__new", F.lit(1)))
        merged = first_rows(every, [key], [-F.col("__new")]).drop("__new").withColumn(BUCKET, bucket_of(key, count))
        merged.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{path}/data/{name}")
    new = now | {b: f"{name}/{BUCKET}={b}" for b in touched}
    try:
        overwrite(spark.createDataFrame(list(new.items()), MANIFEST).coalesce(1), f"{path}/manifest", base)
    except OSError:
        delete(spark, f"{path}/data/{name}")
        raise
    for folder in set(old.values()) - set(now.values()) - set(new.values()) - {None}:
        delete(spark, f"{path}/data/{folder}")
    return touched
