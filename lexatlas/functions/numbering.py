"""Dense numbers 1..n in a total order without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.scratch import staged

#: monotonically_increasing_id() counts rows in these low bits, partitions above them.
ROW_BITS = 33


def dense_numbers(df: DataFrame, to: str, *order: Column | str) -> DataFrame:
    """df with the column `to`: the row's place, from 1, in the order of `order`, whose values are distinct.

    Rows are dealt by sampled ranges of the order, sorted in their partition and laid down with their places in it; partitions are
    counted, and only the counts, one for each partition, meet in one task.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = staged(placed, "numbered")
    part = F.shiftright("__at", ROW_BITS)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = F.broadcast(counts.select("__part", before.alias("__before")))  # a row for each partition
    return placed.join(counts, part == F.col("__part")).withColumn(to, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1).drop("__at", "__part", "__before")


def first_rows(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key: the first in order. Aggregation combines on the map side, so a frequent key is no burden."""
    values = [c for c in df.columns if c not in key]
    least = F.min_by(F.struct(*values), F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]))
    return df.groupBy(*key).agg(least.alias("__first")).select(*key, "__first.*").select(*df.columns)
