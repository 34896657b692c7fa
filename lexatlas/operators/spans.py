"""Resolving spans that are rows: for texts whose matches are more than a task should hold.

`annotate` resolves the matches of a text where the text is. Here spans and skipped regions are tables (id, start, end), dealt by ranges
of (id, offset), so that one text's rows lie in any number of partitions: which regions reach into a range, and the islands of
overlapping spans, are prefix scans (see scans). Only an island, a run of spans without a gap, is resolved by one task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexatlas.functions.scans import CARRY, Scan, ranged_scan
from lexatlas.scratch import staged
from lexatlas.workers import ready_python


class _Reach:
    """The furthest end of a run's regions."""

    def __init__(self):
        self.end = None

    def step(self, end: int | None) -> tuple:
        if end is not None and (self.end is None or end > self.end):
            self.end = end
        return (self.end,)

    def close(self) -> dict:
        return {"end": self.end}


def _further(a: dict, b: dict) -> dict:
    return {"end": max((x["end"] for x in (a, b) if x["end"] is not None), default=None)}


COVERED = Scan(("__end",), "__reach long", "end long", _Reach, _Reach.step, _Reach.close, _further)


def outside(spans: DataFrame, regions: DataFrame, offset: str, *, id_col: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """The rows of spans whose `offset`, an expression of start and end, lies in no region of the same id. regions: id, start, end (exclusive),
    in any order, also overlapping. Regions come before the offsets where they start; the furthest end so far tells whether one is covered."""
    kept = [c for c in spans.columns if c != id_col]
    points = spans.select(id_col, F.expr(offset).cast("long").alias("__from"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__end"), F.struct(*kept).alias("__row"))
    begins = regions.where("start < end").select(id_col, F.col("start").cast("long").alias("__from"), F.lit(0).alias("__kind"), F.col("end").cast("long").alias("__end"), F.lit(None).cast(points.schema["__row"].dataType).alias("__row"))
    reached = ranged_scan(points.unionByName(begins), [id_col], ["__from", "__kind"], COVERED, partitions)
    to = F.greatest(F.col("__reach"), F.col(f"{CARRY}.end"))
    return reached.where((F.col("__kind") == 1) & (to.isNull() | (to <= F.col("__from")))).select(id_col, "__row.*").select(*spans.columns)


class _Islands:
    """The island that is open at the end of a run: where it begins and how far it reaches."""

    def __init__(self):
        self.begin, self.end = None, None

    def step(self, start: int, end: int) -> tuple:
        if self.end is None or start >= self.end:
            self.begin, self.end = start, end
        else:
            self.end = max(self.end, end)
        return (self.begin,)

    def close(self) -> dict:
        return {"begin": self.begin, "end": self.end}


def _bridged(a: dict, b: dict) -> dict:
    return dict(b) if b["begin"] >= a["end"] else {"begin": a["begin"], "end": max(a["end"], b["end"])}


ISLANDS = Scan(("start", "end"), "__begin long", "begin long, end long", _Islands, _Islands.step, _Islands.close, _bridged)


def islands(spans: DataFrame, *, id_col: str = "doc_id", to: str = "island", partitions: int | None = None) -> DataFrame:
    """spans with the column `to`, where the island of each begins: spans of one id whose union has no gap. Spans that only touch are apart."""
    cut = ranged_scan(spans, [id_col], ["start", "end"], ISLANDS, partitions)
    joined = F.col("__begin") < F.col(f"{CARRY}.end")  # an island that begins below the reach of earlier partitions is one with theirs
    return cut.withColumn(to, F.when(joined, F.col(f"{CARRY}.begin")).otherwise(F.col("__begin"))).drop("__begin", CARRY)


def longest_first(spans: list[tuple[int, int]]) -> list[int]:
    """Places of the spans that stay: the longest first, then by start, what overlaps none that stays."""
    kept: list[tuple[int, int]] = []
    out = []
    for i in sorted(range(len(spans)), key=lambda i: (spans[i][0] - spans[i][1], spans[i][0])):
        a, b = spans[i]
        k = bisect_left(kept, (a, b))
        if (k == len(kept) or b <= kept[k][0]) and (k == 0 or kept[k - 1][1] <= a):
            kept.insert(k, (a, b))
            out.append(i)
    return out


def _resolved(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for starts, ends in batches:
        yield pd.Series([longest_first(list(zip(s, e, strict=True))) for s, e in zip(starts, ends, strict=True)], dtype=object)


def resolve(spans: DataFrame, regions: DataFrame, *, id_col: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """id, start, end of the spans that stay: those of which neither end lies in a region, and of overlapping ones the longest, then the first.

    Empty spans and those with a null in id, start or end take no part; equal ones count once. An island of one span stays as it is; larger
    ones are resolved each by one task, which holds two numbers a span.
    """
    ready_python(spans.sparkSession)
    # laid down: ranges are sampled before rows are dealt, so what a scan reads is read twice, and both scans read the regions
    whole = staged(spans.where(F.col(id_col).isNotNull() & (F.col("start") < F.col("end"))).select(id_col, "start", "end").distinct(), "spans")
    regions = staged(regions.select(id_col, "start", "end"), "regions")
    free = outside(whole, regions, "start", id_col=id_col, partitions=partitions)
    free = outside(free, regions, "end - 1", id_col=id_col, partitions=partitions)
    each = islands(free, id_col=id_col, partitions=partitions).groupBy(id_col, "island").agg(F.collect_list(F.struct("start", "end")).alias("s"))
    alone = each.where(F.size("s") == 1).select(id_col, F.get("s", F.lit(0)).alias("m"))
    kept = F.pandas_udf(_resolved, "array<int>")(F.col("s.start"), F.col("s.end"))
    several = each.where(F.size("s") > 1).select(id_col, F.explode(F.transform(kept, lambda i: F.get("s", i))).alias("m"))
    return alone.unionByName(several).select(id_col, "m.start", "m.end")
