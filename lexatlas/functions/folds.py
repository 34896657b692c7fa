"""Folds over arrays that collect an element for each item, in time proportional to the items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Chunk in which folds collect their output; appending costs a copy of what is appended to.
CHUNK = 256


def gather(items: Column, state: dict[str, Column], step: Callable[[Column, Column], tuple[dict[str, Column], Column]], of: str) -> Column:
    """Fold items with a state of scalars; step(state, item) -> (new state, element). The array of elements, of type `of`, in order."""

    def merge(s: Column, e: Column) -> Column:
        new, out = step(s, e)
        full = F.size(s["part"]) >= CHUNK
        return F.struct(
            *[new[k].alias(k) for k in state],
            F.when(full, F.array(out)).otherwise(F.array_append(s["part"], out)).alias("part"),
            F.when(full, F.array_append(s["whole"], s["part"])).otherwise(s["whole"]).alias("whole"),
        )

    start = F.struct(*[v.alias(k) for k, v in state.items()], F.array().cast(f"array<{of}>").alias("part"), F.array().cast(f"array<array<{of}>>").alias("whole"))
    return F.aggregate(items, start, merge, lambda s: F.flatten(F.array_append(s["whole"], s["part"])))
