"""Sources: text and JSON files, folders, SQLite tables. Files are read by Spark, so any file system it knows will do."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexatlas.functions.numbering import dense_numbers
from lexatlas.schemas import SEGMENT
from lexatlas.sources.sinks import current
from lexatlas.workers import ready_python


def read_texts(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """path, name, text: a row for each whole file. Spark's file sources pass over empty files, which hold nothing for any step here."""
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = SEGMENT) -> DataFrame:
    """The records of JSON files that hold one array, with ordinal, the record's place from 1 in all files, in order of their paths. Broken
    files give no rows; see broken_json for them."""
    items = F.from_json("text", T.ArrayType(schema), {"mode": "PERMISSIVE"})
    each = read_texts(spark, path).select("path", F.posexplode(items).alias("at", "r")).select("path", "at", "r.*")
    return dense_numbers(each, "ordinal", "path", "at").select("ordinal", *[F.col(f"`{f.name}`") for f in schema])


def broken_json(spark: SparkSession, path: str, schema: T.StructType = SEGMENT) -> DataFrame:
    """path, raw: files that don't parse."""
    return read_texts(spark, path).where(F.from_json("text", T.ArrayType(schema)).isNull()).select("path", F.col("text").alias("raw"))


def manifest(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """A small table of (path, section) for a batch."""
    return spark.createDataFrame(pairs, "path string, section string")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version of a stored table, or an empty one if there is none yet. Nothing is moved or mended."""
    folder = current(spark, path)[1]
    return spark.read.schema(schema).parquet(folder) if folder else spark.createDataFrame([], schema)


class _Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SQLiteSource(DataSource):
    """spark.read.format("sqlite").option("path", file).option("table", name): the file must be on a path that all workers see.
    The table is read in ranges of its rowid, `numPartitions` of them."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _columns(self) -> list[tuple[str, str]]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            return [(r[1], r[2].upper()) for r in db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})")]

    def schema(self) -> T.StructType:
        kinds = {"INTEGER": T.LongType(), "REAL": T.DoubleType(), "BLOB": T.BinaryType()}
        return T.StructType([T.StructField(n, kinds.get(t.split("(")[0], T.StringType())) for n, t in self._columns()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SQLiteReader(dict(self.options), schema)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _SQLiteReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.n, self.names = options["path"], options["table"], int(options.get("numpartitions", options.get("numPartitions", 1))), schema.fieldNames()

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f"SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM {_quoted(self.table)}").fetchone()
        step = max(1, -(-(high - low + 1) // self.n))
        return [_Rows(k, k + step) for k in range(low, max(high, low) + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        columns = ", ".join(map(_quoted, self.names))
        db = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)
        yield from db.execute(f"SELECT {columns} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", (partition.low, partition.high))
        db.close()


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 1) -> DataFrame:
    ready_python(spark)
    spark.dataSource.register(SQLiteSource)
    return spark.read.format("sqlite").option("path", path).option("table", table).option("numPartitions", partitions).load()


def float_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """df with a column of native float32 bytes as array<float>."""
    @F.pandas_udf("array<float>")
    def vectors(b: pd.Series) -> pd.Series:
        return b.map(lambda x: None if x is None else np.frombuffer(x, "<f4").tolist())

    return df.withColumn(column, vectors(F.col(column)))
