"""Getting this package to Python workers that were not started with it on their path, and rows to them in small batches."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Bytes of a batch of rows for Python where the session says nothing else: a batch is held several times over, in the JVM,
#: on the way and in the worker, so that Spark's 64 MB would be most of an executor's memory beside the heap.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors that were not started with it on their path."""
    if spark.conf.get(BATCH_SETTING, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[1])
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == root:
        return
    if getattr(spark.sparkContext, "_saltmarsh_shipped", False):
        return
    target = Path(tempfile.mkdtemp()) / "saltmarsh.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in Path(root, "saltmarsh").rglob("*.py"):
            z.write(p, p.relative_to(root))
    path = list(sys.path)
    spark.sparkContext.addPyFile(str(target))
    sys.path[:] = path  # the driver keeps its own copy
    spark.sparkContext._saltmarsh_shipped = True
