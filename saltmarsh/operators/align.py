"""Alignment of two tables: by position, by the n-th row of a key, and checks that sets agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_position(left: DataFrame, right: DataFrame, position: str = "_pos") -> DataFrame:
    """Row i with row i; different row counts are an error."""
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"{n} rows against {m} rows of evidence")
    return left.join(right, position)


def numbered(df: DataFrame, key: list[str], order: list[str], name: str = "_nth") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def bag_align(left: DataFrame, right: DataFrame, key: list[str], left_order: list[str], right_order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(aligned, leftovers): the n-th row of a key with the n-th row of that key; leftovers name their side."""
    a, b = numbered(left, key, left_order), numbered(right, key, right_order)
    on = [*key, "_nth"]
    rest = a.join(b.select(on), on, "left_anti").select(*on).withColumn("side", F.lit("left")).unionByName(b.join(a.select(on), on, "left_anti").select(*on).withColumn("side", F.lit("right")))
    return a.join(b, on), rest


def append(existing: DataFrame, *more: DataFrame) -> DataFrame:
    """Bag union by name; columns that one side lacks are null."""
    out = existing
    for df in more:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def tagged(parts: dict[str, DataFrame], tag: str = "entity") -> DataFrame:
    """Union of several tables with the name of each."""
    return append(*[df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


#: Sources whose offsets are broadcast when rows are numbered over all of them; more of them meet their rows by a shuffle.
FEW_SOURCES = 10_000


def running_totals(sizes: DataFrame, order: list[Column], n: str, name: str, parts: int = 512, rows: int | None = None) -> DataFrame:
    """sizes (of so many rows, if known) with the sum of ``n`` over the rows before each, in an order that tells all rows apart.

    Rows are dealt to ranges by bounds from a sample of about ``parts`` rows, which also are all that one task ever sorts
    of the ranges' totals; no task sorts the table.
    """
    keyed = sizes.withColumn("_rt_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    every = max(1, (keyed.count() if rows is None else rows) // parts)
    sample = keyed.where(F.pmod(F.xxhash64("_rt_key"), F.lit(every)) == 0).agg(F.array_sort(F.collect_list("_rt_key")).alias("_rt_bounds"))
    ranged = keyed.join(F.broadcast(sample)).withColumn("_rt_part", F.size(F.filter("_rt_bounds", lambda b: b < F.col("_rt_key")))).drop("_rt_bounds")
    totals = ranged.groupBy(F.col("_rt_part").alias("_rt_p")).agg(F.sum(n).alias("_rt_sum"))
    earlier = totals.withColumn("_rt_base", F.coalesce(F.sum("_rt_sum").over(Window.orderBy("_rt_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_rt_sum")
    inside = F.coalesce(F.sum(n).over(Window.partitionBy("_rt_part").orderBy("_rt_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn(name, inside).join(F.broadcast(earlier), F.col("_rt_part") == F.col("_rt_p")).withColumn(name, F.col(name) + F.col("_rt_base")).drop("_rt_key", "_rt_part", "_rt_p", "_rt_base")


def rebased(df: DataFrame, path: str, row: str, name: str = "row_number") -> DataFrame:
    """Rows numbered from 2 over all sources in order of folded path and own row, without one task sorting them all.

    Sources are counted first; a row's number is its rank in its source plus the rows of the sources before it.
    """
    sizes = df.groupBy(F.col(path).alias("_rb_path")).agg(F.count("*").alias("_rb_n"))
    sources = sizes.count()
    offsets = running_totals(sizes, [F.lower("_rb_path"), F.col("_rb_path")], "_rb_n", "_rb_before", rows=sources).drop("_rb_n").hint("broadcast" if sources <= FEW_SOURCES else "merge")
    ranked = df.withColumn("_rb_rank", F.row_number().over(Window.partitionBy(path).orderBy(row)))
    return ranked.join(offsets, F.col(path).eqNullSafe(F.col("_rb_path"))).withColumn(name, (F.col("_rb_rank") + F.col("_rb_before") + 1).cast("long")).drop("_rb_rank", "_rb_path", "_rb_before")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose parent is missing (a null key, too)."""
    return child.join(parent.select(F.col(parent_key).alias("_pk")).distinct(), F.col(key) == F.col("_pk"), "left_anti")


def must_be_empty(df: DataFrame, what: str) -> None:
    if not df.isEmpty():
        raise ValueError(what)
