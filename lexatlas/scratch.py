"""Tables laid down in the folder that driver and executors share, to cut lineage so that a lost executor costs no earlier work."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in a local session without it, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = own = tempfile.mkdtemp(prefix="lexatlas-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"file://{_own_dirs[sc.applicationId]}"


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark)}/lexatlas/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete the tables that this application has staged; results that still read them must have been written before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/lexatlas/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def laid_in(folder: str) -> list[pa.Table]:
    """What Parquet files lie in a folder of scratch_path(), for a task that reads it; none if there is no such folder."""
    fs, path = pafs.FileSystem.from_uri(folder)
    out = []
    for file in sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")):
        with fs.open_input_file(file) as f:
            out.append(pq.ParquetFile(f).read())
    return out
