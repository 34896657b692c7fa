"""Helpers shared by the training-data operators: tables, names of columns, Unicode, hashed numbers."""

from __future__ import annotations

import re
import unicodedata
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.scratch import release, scratch_dir, scratch_path, staged  # noqa: F401  the operators take these from here
from lexatlas.workers import ready_python  # noqa: F401

#: Words are runs of anything but the ASCII white space of the contracts.
WORD = r"[^\x20\x09-\x0D]+"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read with Spark's own reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own(df: DataFrame) -> str:
    """A prefix that no column of df begins with, for columns of an operator's own."""
    prefix = "__lx_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def columns(names) -> list[Column]:
    """Columns by their whole names, dots included."""
    return [F.col(name(c)) for c in names]


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once; for use inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def unassigned():
    """A test for code points that Python's own Unicode tables leave unassigned: newer tables may call some of them letters."""
    none = (c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
    runs = [[c for _, c in g] for _, g in groupby(enumerate(none), lambda x: x[1] - x[0])]
    exact = re.compile("[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "]").search
    # most texts keep to blocks that are full, which is quickly told
    other = re.compile("[^\u0000-\u0377\u0390-\u03a1\u03a3-\u052f\u2010-\u2064\u20a0-\u20c0\u2100-\u218b\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fff\uac00-\ud7a3]").search
    return lambda text: other(text) and exact(text)


def unit(*cols: Column) -> Column:
    """A reproducible uniform number in [0, 1) from the hash of cols."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))
