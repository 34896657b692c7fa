"""Prefix scans: a fold over the rows of a key in order, however many rows a key has.

A window over a key puts all its rows in one task. Here rows are dealt by sampled ranges of (key, order), so that a hot key lies in many
partitions. Each partition folds its rows as if nothing came before and lays them down, and after them a summary of its last key. Only the
summaries, one for each partition, meet in one task, which tells each partition what its first key brings along; that is joined
to the rows of this key, and the caller finishes them by column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lexatlas.scratch import staged
from lexatlas.workers import ready_python

#: Summaries of more characters than this are joined without a broadcast.
CARRIED = 1 << 25
PART, WHOLE, SUMMARY, CARRY = "__scan_part", "__scan_whole", "__scan_summary", "__scan_carry"


@dataclass(frozen=True)
class Scan:
    """A fold whose state after a run of rows can be told by a small summary.

    start() is the state before any row; step(state, *reads) changes it and returns the row's `outputs`, as far as the run alone tells them;
    close(state) is the run's summary, a dict; after(before, run) the summary of a run behind another: associative, a new dict.
    """

    reads: tuple[str, ...]
    outputs: str
    summary: str
    start: Callable[[], object]
    step: Callable[..., tuple]
    close: Callable[[object], dict]
    after: Callable[[dict, dict], dict]


def ranged_scan(df: DataFrame, key: list[str], order: list[Column | str], scan: Scan, partitions: int | None = None) -> DataFrame:
    """df with the outputs of the scan and CARRY: the summary of the key's rows in earlier partitions, null where there are none.

    Rows that are equal in key and order stay in one partition, in any order among themselves. A null in the key is a key like others.
    """
    ready_python(df.sparkSession)
    ranges = [*key, *order]
    dealt = df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    outputs, summary = T.StructType.fromDDL(scan.outputs), T.StructType.fromDDL(scan.summary)
    own = [T.StructField(PART, T.IntegerType()), T.StructField(WHOLE, T.BooleanType()), T.StructField(SUMMARY, summary)]
    fields = [*[T.StructField(f.name, f.dataType) for f in df.schema], *outputs, *own]
    tails = [to_arrow_type(f.dataType) for f in [*outputs, *own]]
    columns, names = df.columns, [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        state, now, runs, last = None, None, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = zip(*[b.column(c).to_pylist() for c in key], strict=True) if key else [()] * b.num_rows
            got = []
            for k, values in zip(keys, zip(*[b.column(c).to_pylist() for c in scan.reads], strict=True) if scan.reads else [()] * b.num_rows, strict=True):
                if not runs or k != now:
                    state, now, runs = scan.start(), k, runs + 1
                got.append(scan.step(state, *values))
            made = [pa.array(c, t) for c, t in zip([*zip(*got, strict=True), [part] * len(got)], tails, strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns, *made, *[pa.nulls(len(got), t) for t in tails[-2:]]], names)
            last = b.slice(b.num_rows - 1)
        if last is not None:
            end = [last.column(c) if c in key else pa.nulls(1, last.column(c).type) for c in columns]
            end += [pa.nulls(1, t) for t in tails[:-3]] + [pa.array([v], t) for v, t in zip([part, runs == 1, scan.close(state)], tails[-3:], strict=True)]
            yield pa.RecordBatch.from_arrays(end, names)

    laid = staged(dealt.sortWithinPartitions(*ranges).mapInArrow(run, T.StructType(fields)), "scanned")
    carried = _carried(laid.where(f"{WHOLE} is not null"), key, scan, summary)
    rows = laid.where(f"{WHOLE} is null").drop(WHOLE, SUMMARY)
    size = carried.agg(F.coalesce(F.sum(F.length(F.to_json(CARRY))), F.lit(0))).first()[0]
    known = F.broadcast(carried) if size <= CARRIED else carried
    same = rows[PART] == known["__p"]
    for i, c in enumerate(key):
        same &= rows[c].eqNullSafe(known[f"__k{i}"])
    return rows.join(known, same, "left").select(*df.columns, *outputs.names, CARRY)


def _carried(ends: DataFrame, key: list[str], scan: Scan, summary: T.StructType) -> DataFrame:
    """For each partition but the first: the last key before it, and what all its rows so far come to. One row a partition, in one task."""
    own = [T.StructField(f"__k{i}", ends.schema[c].dataType) for i, c in enumerate(key)]
    schema = T.StructType([T.StructField("__p", T.IntegerType()), *own, T.StructField(CARRY, summary)])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                k = tuple(r[c] for c in key)
                if before is not None:
                    out.append({"__p": r[PART], **{f"__k{i}": v for i, v in enumerate(now)}, CARRY: before})
                before = scan.after(before, r[SUMMARY]) if r[WHOLE] and before is not None and k == now else r[SUMMARY]
                now = k
            yield pa.RecordBatch.from_pylist(out, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema]))

    one = ends.select(*key, PART, WHOLE, SUMMARY).repartition(1).sortWithinPartitions(PART)
    return staged(one.mapInArrow(sweep, schema), "carried")


def _counted(state: list[int]) -> tuple[int]:
    state[0] += 1
    return (state[0],)


#: Places within a key, from 1.
PLACES = Scan((), "__place long", "n long", lambda: [0], _counted, lambda s: {"n": s[0]}, lambda a, b: {"n": a["n"] + b["n"]})


def places(df: DataFrame, to: str, key: list[str], order: list[Column | str], partitions: int | None = None) -> DataFrame:
    """df with the column `to`: the row's place (long) among those of its key, from 1, in order. Ties come in any order."""
    at = F.col("__place") + F.coalesce(F.col(f"{CARRY}.n"), F.lit(0))
    return ranged_scan(df, key, order, PLACES, partitions).withColumn(to, at).drop("__place", CARRY)
