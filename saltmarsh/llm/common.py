"""Shared plumbing of the training-data operators: table access, shared storage, worker state, Arrow maps."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import release, shared_dir, stored, tables_made
from ..shipping import ship_package

__all__ = ["BROADCAST_ROWS", "arrow_types", "bounded_broadcast", "lean", "map_rows", "private", "release", "shared_dir", "ship_package", "stored", "table", "tables_made", "vocabulary", "worker_state"]

#: Rows that a broadcast side may have at most; beyond it the callers shuffle instead.
BROADCAST_ROWS = 200_000
#: What a Python worker keeps between tasks: one entry at most.
_STATE: dict[object, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark only (the path may be in a store that Python cannot open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    """Bytes of a public vocabulary file; read on the driver and broadcast, so executors need no copy."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def _trim() -> None:
    """Give freed memory back: workers outlive stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def worker_state(key: object, make: Callable[[], object]) -> object:
    """What this Python worker keeps under key between tasks. It keeps one thing: another stage's state goes first."""
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            _trim()
        _STATE[key] = make()
    return _STATE[key]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A map over batches that needs no state of other stages and leaves no freed memory behind in its worker."""

    def lightly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _STATE:
            _STATE.clear()
            _trim()
        yield from run(batches)
        _trim()

    return lightly


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is known to have few rows, else df as it is (Spark then shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def map_rows(df: DataFrame, columns: list[str], schema: str, fn: Callable[[list[list]], dict[str, list]]) -> DataFrame:
    """mapInArrow over the chosen columns: fn takes the columns of a batch as Python lists, returns output columns."""
    ship_package(df.sparkSession)
    names = [f.name for f in _fields(df.sparkSession, schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn([c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays([out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], type=types[n]) for n in names], names=names)

    types = arrow_types(df.sparkSession, schema)
    return df.select(*columns).mapInArrow(run, schema)


def _fields(spark: SparkSession, schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fields


def arrow_types(spark: SparkSession, schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return {f.name: to_arrow_type(f.dataType) for f in _fields(spark, schema)}
