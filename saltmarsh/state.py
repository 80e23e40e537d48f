"""Versioned state tables: a version is a directory, made by renaming one that was written whole; a lost race is an error.

Renaming never replaces a version that is there, so of two writers that read the same version one succeeds. On stores
without an atomic rename (object stores) a lock outside is needed, as for any table of plain files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions there are, in order."""
    fs, place = _store(spark, path)
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted(int(n.removeprefix("v")) for n in names if n.startswith("v") and n[1:].isdigit())


def load(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, int]:
    """(rows of the last version, its number); no rows and 0 before there is one."""
    found = versions(spark, path)
    if not found:
        return spark.createDataFrame([], schema), 0
    return spark.read.schema(schema).parquet(f"{path}/v{found[-1]:010d}"), found[-1]


def save(df: DataFrame, path: str, seen: int) -> int:
    """Write the version after the one that was read, whole or not at all; an error if another has come between."""
    spark, target = df.sparkSession, f"{path}/v{seen + 1:010d}"
    if versions(spark, path)[-1:] != [seen] * bool(seen):
        raise RuntimeError(f"version {seen} is not the last any more")
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    df.write.parquet(draft)
    fs, final = _store(spark, target)
    # a reservation that only one writer can make, then the rename
    lock = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_reserved-{seen + 1:010d}")
    try:
        fs.create(lock, False).close()
    except Exception as e:
        fs.delete(_store(spark, draft)[1], True)
        raise RuntimeError(f"version {seen + 1} was written meanwhile") from e
    if fs.exists(final) or not fs.rename(_store(spark, draft)[1], final):
        raise RuntimeError(f"version {seen + 1} was written meanwhile")
    return seen + 1
