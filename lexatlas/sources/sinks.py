"""Sinks: stored tables with upserts, JSON arrays, text files, SQLite files."""

from __future__ import annotations

import os
import re
import sqlite3
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.workers import ready_python


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _version(number: int) -> str:
    return f"v{number:010d}"


def delete(spark: SparkSession, path: str) -> None:
    fs, make = _files(spark, path)
    fs.delete(make(path), True)


def current(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, str | None]:
    """(number, folder) of a stored table's current version, the highest (below `before`); number 0 for a plain folder of Parquet files, and
    for none."""
    fs, make = _files(spark, path)
    if not fs.exists(make(path)):
        return 0, None
    names = [s.getPath().getName() for s in fs.listStatus(make(path)) if s.isDirectory()]
    numbers = [int(n[1:]) for n in names if re.fullmatch(r"v\d{10}", n)]
    last = max((n for n in numbers if before is None or n < before), default=0)
    if last:
        return last, f"{path.rstrip('/')}/{_version(last)}"
    plain = any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(make(path)))
    return 0, path if plain else None


def overwrite(df: DataFrame, path: str, base: int | None = None) -> None:
    """Replace a stored table. df may read it. A version is a folder that never changes: the new one is written under a hidden name and becomes
    the current one by one rename to the next number, which fails if there is such a version. Readers move nothing and
    always find a whole version; a process that ends before the rename leaves the table as it was.

    base: the number of the version that df was made from (see current); the one that is current at the call if not given. If another
    writer has replaced it meanwhile nothing changes and an OSError is raised. The version before stays for those that still read it.
    """
    spark, folder = df.sparkSession, path.rstrip("/")
    base = current(spark, path)[0] if base is None else base
    new = f"{folder}/_{uuid.uuid4().hex}"
    fs, make = _files(spark, path)
    df.write.parquet(new)
    try:
        _commit(spark, new, f"{folder}/{_version(base + 1)}")
    except Exception as e:
        fs.delete(make(new), True)
        raise OSError(f"{path} was replaced by another writer or can't be moved to; it is unchanged") from e
    for status in fs.listStatus(make(path)):
        name = status.getPath().getName()
        if re.fullmatch(r"v\d{10}", name) and int(name[1:]) < base:
            fs.delete(status.getPath(), True)


def _commit(spark: SparkSession, made: str, target: str) -> None:
    """Rename a folder; fails if the target exists, whatever is in it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    make = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(make(target).getFileSystem(conf).makeQualified(make(target)).toUri(), conf)
    if context.util().exists(make(target)):
        raise FileExistsError(target)
    context.rename(make(made), make(target), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))


def json_array(df: DataFrame, order: str, by: str | None = None) -> DataFrame:
    """value: the rows of df as a JSON array in order; one row, or one row for each value of `by`. For exports of a document's rows."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*[c for c in df.columns if c not in (order, by)]).alias("r"))))
    value = F.to_json(F.transform(rows, lambda x: x["r"]), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")
    return df.groupBy(by).agg(value) if by else df.agg(value)


def write_texts(files: DataFrame, folder: str) -> None:
    """Write rows (path, content) as files below a folder that all workers see, a path or a URI of a file system that pyarrow opens,
    each under a name of its own first. Of equal paths any one may win; a null content is empty."""

    def put(rows) -> None:
        import posixpath

        from pyarrow import fs as pafs

        if "://" in folder or folder.startswith("file:"):
            fs, root = pafs.FileSystem.from_uri(folder)
        else:
            fs, root = pafs.LocalFileSystem(), posixpath.abspath(folder)
        root = root.rstrip("/")
        for r in rows:
            to = posixpath.normpath(posixpath.join(root, r["path"]))
            if not to.startswith(f"{root}/"):
                raise ValueError(f"a path leaves the folder: {r['path']}")
            fs.create_dir(posixpath.dirname(to), recursive=True)
            part = f"{to}.{uuid.uuid4().hex}"
            with fs.open_output_stream(part) as f:
                f.write((r["content"] or "").encode("utf-8"))
            fs.move(part, to)

    files.select("path", "content").foreachPartition(put)


def write_sqlite(df: DataFrame, path: str, table: str) -> int:
    """Write df as a table of a new SQLite file, from one task that streams its rows, as such a file has one writer: for exports. Vectors
    become native float32 bytes, lists and structs JSON. The file is replaced when it is whole; how many rows it has."""
    ready_python(df.sparkSession)
    kinds = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "binary": "BLOB", "array<float>": "BLOB"}
    types = [f.dataType.simpleString() for f in df.schema]
    flat = df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if t.startswith(("array<", "struct<", "map<")) and t != "array<float>" else F.col(f"`{f.name}`") for f, t in zip(df.schema, types, strict=True)])
    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    columns = ", ".join(f"{quoted(f.name)} {kinds.get(t, 'TEXT')}" for f, t in zip(df.schema, types, strict=True))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = f"{path}.{uuid.uuid4().hex}", 0
        db = sqlite3.connect(part)
        db.execute(f"CREATE TABLE {quoted(table)} ({columns})")
        for b in batches:
            values = [[None if x is None else np.array(x, "<f4").tobytes() for x in c.to_pylist()] if t == "array<float>" else c.to_pylist() for c, t in zip(b.columns, types, strict=True)]
            db.executemany(f"INSERT INTO {quoted(table)} VALUES ({', '.join('?' * len(types))})", zip(*values, strict=True))
            n += b.num_rows
        db.commit()
        db.close()
        os.replace(part, path)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return flat.coalesce(1).mapInArrow(put, "n long").first()["n"]


def metadata_upsert(existing: DataFrame, values: dict[str, str]) -> DataFrame:
    """A key/value table with these values set."""
    new = existing.sparkSession.createDataFrame(list(values.items()), "key string, value string")
    return existing.join(new.select("key"), "key", "left_anti").unionByName(new)
