"""What Python operators need on the workers: the package itself, and bounded Arrow batches."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Bound of an Arrow batch sent to a Python worker, in rows and bytes, so that very long texts don't pile up.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16777216"}

_shipped: set[str] = set()


def ready_python(spark: SparkSession) -> None:
    """Bound this session's Arrow batches, and ship the package to workers that can't import it yet."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    package, app = Path(__file__).resolve().parent, spark.sparkContext.applicationId
    if app not in _shipped and str(package.parent) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        to = tempfile.mkdtemp(prefix="lexatlas-")
        atexit.register(shutil.rmtree, to, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{to}/lexatlas", "zip", package.parent, package.name))
    _shipped.add(app)
