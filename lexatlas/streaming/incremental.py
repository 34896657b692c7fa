"""Incremental builds as a stream: each micro-batch of segments becomes one increment of the concept base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexatlas.operators.concepts import build_base, increment_rows, upsert
from lexatlas.schemas import ALIASES, CONCEPTS
from lexatlas.scratch import staged
from lexatlas.sources.buckets import read_buckets, upsert_buckets, version
from lexatlas.sources.readers import read_table
from lexatlas.sources.sinks import current, overwrite


def increment(spark: SparkSession, segments: DataFrame, folder: str, embed=None) -> None:
    """One increment. Repeating it changes nothing, so a batch that runs again after a failure does no harm."""
    at = {name: current(spark, f"{folder}/{name}")[0] for name in ("concepts", "aliases")}
    concepts, aliases = read_table(spark, f"{folder}/concepts", CONCEPTS), read_table(spark, f"{folder}/aliases", ALIASES)
    concepts, aliases = build_base(segments, concepts, aliases, embed)
    # both results read both tables, so they are laid down before either is replaced
    concepts.write.mode("overwrite").parquet(f"{folder}/_next/concepts")
    aliases.write.mode("overwrite").parquet(f"{folder}/_next/aliases")
    overwrite(spark.read.schema(ALIASES).parquet(f"{folder}/_next/aliases"), f"{folder}/aliases", at["aliases"])
    overwrite(spark.read.schema(CONCEPTS).parquet(f"{folder}/_next/concepts"), f"{folder}/concepts", at["concepts"])


def increment_buckets(spark: SparkSession, segments: DataFrame, folder: str, embed=None, buckets: int = 64) -> dict[str, list[int]]:
    """One increment of a base kept in buckets: only the buckets of new rows are written; which, for each table. Aliases go first: a run that
    broke off between the two gives the same numbers to the same concepts when it is repeated."""
    tables = {"concepts": CONCEPTS, "aliases": ALIASES}
    at = {name: version(spark, f"{folder}/{name}") for name in tables}
    added, own, found = increment_rows(segments, *[read_buckets(spark, f"{folder}/{name}", schema) for name, schema in tables.items()], embed)
    added = staged(added, "added")
    changed = {"aliases": (upsert(own, found, key="alias"), "alias"), "concepts": (added, "concept_id")}
    return {name: upsert_buckets(rows, f"{folder}/{name}", key, buckets=buckets, base=at[name]) for name, (rows, key) in changed.items()}


def follow(segments: DataFrame, folder: str, checkpoint: str, embed=None, buckets: int | None = None, **trigger) -> StreamingQuery:
    """Run increments from a stream of segments (with `ordinal`); with `buckets` the base is kept in so many of them."""
    spark = segments.sparkSession

    def batch(df: DataFrame, _: int) -> None:
        if buckets:
            increment_buckets(spark, df, folder, embed, buckets)
        else:
            increment(spark, df, folder, embed)

    return segments.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
