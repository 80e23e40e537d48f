"""What shows only in large tables: sides that a driver may not collect, groups that pair up, files that fill a worker."""

import random
import tracemalloc

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_queries import rows

from saltmarsh.operators import align, blocks, cards, prices
from saltmarsh.plans import catalogue, flows  # noqa: F401  (registers its queries)
from saltmarsh.sources import tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def large_keys(spark, tmp_path_factory):
    """A few parts on either side of the millionth."""
    folder = str(tmp_path_factory.mktemp("large"))
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey <= 24")
    first = part.withColumn("p_partkey", F.col("p_partkey") + 100_000)
    more = part.withColumn("p_partkey", F.col("p_partkey") + 1_000_000)
    first.unionByName(more).coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.read.parquet(f"{SF}/region.parquet").write.parquet(f"{folder}/region.parquet")
    return folder


def test_many_sources_stay_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(align, "FEW_SOURCES", 2)
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), (None, 1)], "f string, n int")
    out = align.rebased(df, "f", "n")
    assert "SortMergeJoin" in plan_of(out)
    assert sorted((r.f or "", r.n, r.row_number) for r in out.collect()) == [("", 1, 2), ("a", 1, 3), ("a", 2, 4), ("b", 1, 5)]
    assert "Broadcast" not in plan_of(cards.nothing_found(df.select(F.col("f").alias("source_file")), df.select(F.col("f").alias("source_file"))))


@pytest.mark.parametrize("name", ["batch_products", "batch_variants", "batch_files"])
def test_batch_beyond_a_million_parts(spark, large_keys, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{large_keys}/part.parquet/*.parquet'")
    df = catalogue.QUERIES[name](spark, large_keys)
    want = con.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())


def test_sizes_are_counted_before_they_meet(spark):
    said = ["5 g", "5 grs", "5", "5 ml", "7 g", "sin", None]
    draw = random.Random(1)
    variants = [(f"p{draw.randrange(4)}", f"v{i}", draw.choice(said)) for i in range(14)] + [("p9", "only", None)]
    rows = [(i, f"p{i % 6}" if i % 7 else "p9", draw.choice(said)) for i in range(60)]
    v = spark.createDataFrame(variants, "sku_producto string, sku_variante string, presentation string")
    p = spark.createDataFrame(rows, "price_id int, target string, raw_name string")
    got = prices.match_presentations(p, v)
    plan = plan_of(got)
    assert "Window" not in plan and plan.count("Join") == 2  # a product's variants by number, and by size

    def size(x):
        return tuple([*(x or "").replace("grs", "g").split(), ""][:2]) if x and x[0].isdigit() else None

    for r in got.collect():
        mine = [(s, size(x)) for q, s, x in variants if q == r.target]
        own = size(rows[r.price_id][2])
        hits = [s for s, x in mine if own and x and x[0] == own[0] and (x[1] == own[1] or "" in (x[1], own[1]))]
        want = mine[0][0] if len(mine) == 1 else hits[0] if len(hits) == 1 else None
        assert r.sku_variante == want
        reason = prices.RETAINED if not mine else None if want else prices.AMBIGUOUS if own is None else prices.NOT_FOUND
        assert r.reason == reason


def test_records_are_read_as_they_come():
    raw = ("a;b;c\n" + "1;x\u00f3;" + "y" * 90 + "\n").encode() + b"1;x;z\n" * 300_000
    tracemalloc.start()
    n = sum(1 for _ in tables.delimited_records(pa.py_buffer(raw)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 300_002 and peak < 8e6  # before: the text and all records, over 60 MB


def test_words_stay_with_their_lines(spark):
    for name in ("ocr_line_aggregate",):
        assert "Exchange" not in plan_of(catalogue.QUERIES[name](spark, SF))
    words = spark.createDataFrame([(1, 1, "b", 3.0, 1.0, 4.0, 2.0, -1.0), (1, 0, "a", 0.0, 1.5, 2.0, 3.0, 50.0), (2, 0, "c", 0.0, 0.0, 1.0, 1.0, -1.0)], "k int, word_no int, text string, x0 double, y0 double, x1 double, y1 double, conf double")
    assert sorted(map(tuple, blocks.ocr_lines(words, ["k"]).collect())) == [(1, "a b", 0.0, 1.0, 4.0, 3.0, 0.5), (2, "c", 0.0, 0.0, 1.0, 1.0, None)]


@pytest.mark.parametrize("name", ["title_case", "description_format", "card_variants"])
def test_python_work_is_dealt_to_all_cores(spark, name):
    assert catalogue.QUERIES[name](spark, SF).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["attribute_pairs", "attributes_parse"])
def test_attributes_are_dealt_before_they_are_parsed(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    assert df.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert plan_of(df).rindex("Exchange") > plan_of(df).index("map_from_arrays")  # parents come first in a plan's text
