"""Sums of a few numbers over all rows: each task leaves one value, values meet in groups, groups on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups in which the tasks' values meet, one step after the other: the driver gets as many values as the last step has groups.
GROUPS = (1024, 32)


def summed(rows: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], bytes], add: Callable[[list[bytes]], bytes]) -> bytes:
    """add() of the values that each() leaves for every partition of rows. Values come in the order of partitions, so reruns agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([each(batches)], pa.binary())], ["value"])

    def group(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [part["part"].min()], "value": [add([bytes(v) for v in part.sort_values("part")["value"]])]})

    values = rows.mapInArrow(run, "value binary").select(F.spark_partition_id().alias("part"), "value")
    for groups in GROUPS:
        values = values.groupBy(F.pmod("part", F.lit(groups))).applyInPandas(group, "part int, value binary")
    return add([bytes(r["value"]) for r in sorted(values.collect(), key=lambda r: r["part"])])
