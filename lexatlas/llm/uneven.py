"""Joins of rows with a table of one row per key, where a few keys may hold a large part of all rows.

A key with more than HOT_ROWS rows and more than one part in HOT_PARTS of all rows is dealt to several tasks: its rows get one of
`salts` numbers, and its row of the other table is repeated once for each. No task then gets more rows of one key than that
bound. There are HOT_PARTS such keys at most and twice as many repeats, so the list of hot keys is small enough to broadcast
whatever the input is.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexatlas.llm.common import columns, name, own, staged

HOT_ROWS, HOT_PARTS = 1 << 16, 10_000
#: Rows are first counted in so many buckets of keys, which combine where they are read; only full buckets are counted by key.
BUCKETS = 1 << 16


def key_hash(key: list[str]) -> Column:
    return F.xxhash64(*columns(key))


def hot_of(counted: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """counted (h, n: rows of the key of that hash) -> h, salts of the keys that are to be dealt; None if there are none."""
    r = counted.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    bound = max(hot_rows, (r["rows"] or 0) // HOT_PARTS)
    if (r["most"] or 0) <= bound:
        return None
    return staged(counted.where(F.col("n") > bound).groupBy("h").agg(F.max(F.ceil(F.col("n") / bound)).cast("long").alias("salts")), "hot-keys")


def hot_keys(rows: DataFrame, key: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """h, salts of the keys of rows that are to be dealt; None if there are none."""
    h = rows.select(key_hash(key).alias("h")).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    buckets = h.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    r = buckets.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    bound = max(hot_rows, (r["rows"] or 0) // HOT_PARTS)
    if (r["most"] or 0) <= bound:
        return None
    full = F.broadcast(buckets.where(F.col("n") > bound).select("bucket"))  # BUCKETS rows at most
    counts = h.join(full, "bucket").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bound)
    return staged(counts.select("h", F.ceil(F.col("n") / bound).cast("long").alias("salts")), "hot-keys")


def join_dealt(rows: DataFrame, keyed: DataFrame, on: dict[str, str], hot: DataFrame | None, how: str = "inner", by: list[str] | None = None) -> DataFrame:
    """rows joined (inner or left) with keyed, null-safe. on: columns of rows and, other names, of keyed, of the same types. by: columns
    in which rows of one key differ; without it rows are dealt by where they are read, and must come from a stored table."""
    same = reduce(and_, (F.col(name(a)).eqNullSafe(F.col(name(b))) for a, b in on.items()))
    if hot is None:
        return rows.join(keyed, same, how)
    x = max(own(rows), own(keyed), key=len)
    hot = F.broadcast(hot.select(F.col("h").alias(f"{x}h"), F.col("salts").alias(f"{x}salts")))
    place = F.xxhash64(*columns(by)) if by else F.monotonically_increasing_id()
    dealt = rows.withColumns({f"{x}place": place, f"{x}key": key_hash(list(on))}).join(hot, F.col(f"{x}key") == F.col(f"{x}h"), "left")
    dealt = dealt.withColumn(f"{x}salt", F.coalesce(F.pmod(f"{x}place", f"{x}salts"), F.lit(0))).drop(f"{x}place", f"{x}key", f"{x}h", f"{x}salts")
    spread = keyed.withColumn(f"{x}key", key_hash(list(on.values()))).join(hot, F.col(f"{x}key") == F.col(f"{x}h"), "left")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(f"{x}salts"), F.lit(1)) - 1)
    spread = spread.withColumn(f"{x}part", F.explode(parts)).drop(f"{x}key", f"{x}h", f"{x}salts")
    return dealt.join(spread, same & (F.col(f"{x}salt") == F.col(f"{x}part")), how).drop(f"{x}salt", f"{x}part")
