"""The folder that all executors share, and tables in it that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Tables that this driver has written and not deleted, oldest first.
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """From spark.checkpoint.dir. Only where one machine is the whole cluster may that be unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(context, "_saltmarsh_shared"):
        context._saltmarsh_shared = f"file://{tempfile.mkdtemp(prefix='saltmarsh-')}"
    return context._saltmarsh_shared


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to enough tasks for all cores, where much work follows: a well packed file has few splits, however many rows it holds."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/saltmarsh/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _MADE.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def tables_made() -> set[str]:
    """The tables of stored() that are still there."""
    return set(_MADE)


def release(spark: SparkSession, tables: Iterable[DataFrame | str]) -> None:
    """Delete tables of stored() that nothing reads any more."""
    for t in tables:
        path = t if isinstance(t, str) else t.stored_at
        if path in _MADE:
            _MADE.remove(path)
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)
