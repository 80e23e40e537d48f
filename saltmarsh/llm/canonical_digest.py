"""Canonical exact digests: Unicode normalisation, case and white-space folding, then a 128-bit xxhash.

Texts fall into buckets of equal digest. Inside a bucket the canonical bytes themselves are compared: where two differ
(a collision), every member's fingerprint is the digest followed by a SHA-256 of its canonical bytes, so equal
fingerprints mean equal canonical texts without exception.

Scale: digests are map-side. For the byte comparison only buckets of two or more rows matter; each task folds its own
copies first and sends one canonical text a bucket, so a hot text costs one row a task and never meets in one place.

Defined cases: null text is empty; repeated rows are kept; null ids are kept; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, ship_package, stored


def canonical(text: str | None) -> str:
    """NFKC, case folded (and composed again, which folding can undo), runs of white space as one space, none at the ends."""
    if not text:
        return ""
    if text.isascii():
        return " ".join(text.lower().split())
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(canonical_text: str) -> str:
    return xxhash.xxh3_128_hexdigest(canonical_text.encode())


def bucket_collisions(docs: DataFrame, digest_fn: Callable[[str], str] = digest, text: str = "text") -> DataFrame:
    """Digests whose buckets hold canonical texts that differ in bytes."""
    ship_package(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([digest_fn(canonical(t)) for t in batch.column(0).to_pylist()], pa.string())], names=["digest"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str], None] = {}
            for t in batch.column(0).to_pylist():
                c = canonical(t)
                seen[digest_fn(c), c] = None
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in seen], pa.string()), pa.array([c for _, c in seen], pa.string())], names=["digest", "body"])

    column = docs.select(text)
    shared = stored(column.mapInArrow(digests, "digest string").groupBy("digest").count().where("count > 1").select("digest"), "digest-buckets")
    bodies = column.mapInArrow(texts, "digest string, body string").join(bounded_broadcast(shared), "digest")
    return bodies.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high")).where("low < high").select("digest")


def next_ids(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, next_id, next_rows): the following distinct id in ascending order, the first after the last, and its rows.

    Ids are range-partitioned and sorted; a partition's last id takes the first of the next one, from one row a partition.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(F.count("*").alias("n"))
    ranged = stored(ids.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id()), "digest-ids")
    firsts = ranged.groupBy("part").agg(F.min(F.struct("doc_id", "n")).alias("first"))
    whole = Window.orderBy("part")  # one row a partition
    after = firsts.select(F.col("part").alias("_part"), F.coalesce(F.lead("first").over(whole), F.first("first").over(whole)).alias("after"))
    inside = Window.partitionBy("part").orderBy("doc_id")
    pair = F.lead(F.struct("doc_id", "n")).over(inside)
    joined = ranged.withColumn("pair", pair).join(F.broadcast(after), F.col("part") == F.col("_part"))
    chosen = F.coalesce("pair", "after")
    return joined.select("doc_id", chosen["doc_id"].alias("next_id"), chosen["n"].alias("next_rows"))


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_ROW = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, digest string, edited_digest string"


def _pair_row(text: str, following: str, digest_fn: Callable[[str], str]) -> tuple:
    other = edited(text, following)
    a, b, c = canonical(text), canonical(other), canonical(following)
    da, db = digest_fn(a), digest_fn(b)
    return len(text), sha256(other.encode()).hexdigest(), f"{da}-{sha256(a.encode()).hexdigest()}", f"{db}-{sha256(b.encode()).hexdigest()}", float(a == b), float(a == c), da, db


def fingerprint_documents(docs: DataFrame, digest_fn: Callable[[str], str] = digest) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness (1 for equal canonical texts, else 0).

    The next document by id usually follows in the same file: rows are paired with what follows them while they are read,
    and checked against the true order of ids. Only rows that this misses (file and split ends, unordered tables, repeated
    ids) are joined with the next document's text. A repeated id's text, as a next document, is its smallest; a null id
    counts as following the last document.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    columns = [c.split()[0] for c in _ROW.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.string(), pa.string()]

    def batch_of(ids: list, nexts: list, made: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*made)) or [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nexts, pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["doc_id", "seen_next", *columns])

    def in_file_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            if held is not None:
                ids.insert(0, held[0])
                texts.insert(0, held[1])
            if ids:
                yield batch_of(ids[:-1], ids[1:], [_pair_row(a, b, digest_fn) for a, b in zip(texts, texts[1:])])
                held = ids[-1], texts[-1]
        if held is not None:
            yield batch_of([held[0]], [None], [_pair_row(held[1], "", digest_fn)])

    def joined_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, nexts, following = (batch.column(i).to_pylist() for i in range(4))
            yield batch_of(ids, nexts, [_pair_row(a, b, digest_fn) for a, b in zip(texts, following)])

    schema = f"doc_id long, seen_next long, {_ROW}"
    order = stored(next_ids(docs), "digest-order")
    read = stored(rows.mapInArrow(in_file_order, schema), "digest-rows")
    checked = read.join(order.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    right = (F.col("seen_next") == F.col("next_id")) & (F.col("next_rows") == 1)
    kept = checked.where(right).select("doc_id", *columns)
    missed = stored(checked.where(~F.coalesce(right, F.lit(False)) & F.col("doc_id").isNotNull()).select("doc_id", "next_id").distinct(), "digest-missed")
    wanted = missed.select("next_id").distinct()
    following = rows.join(bounded_broadcast(wanted), F.col("doc_id") == F.col("next_id"), "left_semi").groupBy("doc_id").agg(F.min("text").alias("following"))
    own = rows.join(bounded_broadcast(missed), "doc_id").join(following.withColumnRenamed("doc_id", "next_id"), "next_id")
    again = own.select("doc_id", "text", "next_id", "following").mapInArrow(joined_pairs, schema).select("doc_id", *columns)
    result = kept.join(bounded_broadcast(missed.select("doc_id")), "doc_id", "left_anti").unionByName(again)
    result = result.unionByName(_null_ids(rows, order, joined_pairs, schema, columns))
    collided = stored(bucket_collisions(rows, digest_fn), "digest-collided")
    out = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    if collided.isEmpty():  # as ever with 128 bits: the digest alone is the fingerprint
        return result.withColumn("fingerprint", F.col("digest")).withColumn("edited_fingerprint", F.col("edited_digest")).select(*out)
    for fp, d in (("fingerprint", "digest"), ("edited_fingerprint", "edited_digest")):
        mark = collided.select(F.col("digest").alias("_d"), F.lit(True).alias("_hit"))
        result = result.join(mark, F.col(d) == F.col("_d"), "left").withColumn(fp, F.when(F.col("_hit"), F.col(fp)).otherwise(F.col(d))).drop("_d", "_hit")
    return result.select(*out)


def _null_ids(rows: DataFrame, order: DataFrame, fn, schema: str, columns: list[str]) -> DataFrame:
    """Rows without an id, paired with the first document."""
    lowest = order.agg(F.min("doc_id").alias("low"))
    first = rows.join(F.broadcast(lowest), F.col("doc_id") == F.col("low")).agg(F.min("text").alias("following"))
    alone = rows.where(F.col("doc_id").isNull()).withColumn("_one", F.lit(1))
    paired = alone.join(F.broadcast(first.withColumn("_one", F.lit(1))), "_one", "left")
    return paired.select("doc_id", "text", F.lit(None).cast("long").alias("next_id"), F.coalesce("following", F.lit("")).alias("following")).mapInArrow(fn, schema).select("doc_id", *columns)
