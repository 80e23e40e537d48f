"""Token counts by a map-side two-tier lookup.

Tier one is a compact table of the corpus's frequent pre-tokens and their lengths in ids, broadcast
to every worker; tier two is each worker's own cache, filled by encoding what tier one misses.
No pre-token is shuffled: each task reads its documents into one bounded summary, a single row, and whole summaries are
merged by a tree.

Units are the vocabulary's pre-tokens, and whole words where a text holds something that only the library splits (see
``word_bpe``).

Defined cases: null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows are
counted each; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, release, ship_package, stored, vocabulary
from .word_bpe import MAX_CACHED, LengthCache, WordEncoder, worker_cache

#: Entries of the broadcast table and of a summary, and summaries that are merged at once: all fixed, whatever the corpus.
TABLE_WORDS = 65_536
SUMMARY_WORDS = 16_384
FAN_IN = 32


def summary(counts: Counter, most: int) -> bytes:
    """The most frequent units and their counts as one value; ties go to the smaller one."""
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most]
    return "\n".join(f"{n} {w}" for w, n in top).encode()


def merged(summaries: Iterable[bytes]) -> Counter:
    """Counts over several summaries."""
    total: Counter = Counter()
    for s in summaries:
        for line in s.decode().split("\n") if s else ():
            n, _, w = line.partition(" ")
            total[w] += int(n)
    return total


def frequent_units(docs: DataFrame, vocabulary_json: bytes, text: str = "text", table_words: int = TABLE_WORDS, summary_words: int = SUMMARY_WORDS, fan_in: int = FAN_IN) -> list[str]:
    """The most frequent units over all documents, from bounded heavy-hitter summaries merged by a tree.

    A task counts each batch apart and keeps units that occur at least twice in a batch; it holds at most four times
    ``summary_words`` entries at any time.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_json)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        units = worker_cache(LengthCache, shared.value).encoder.units
        for batch in batches:
            column = batch.column(0)
            for at in range(0, len(column), 256):
                part: Counter = Counter()
                for t in column.slice(at, 256).to_pylist():
                    if t:
                        part.update(units(t))
                for w, n in part.items():
                    if n > 1 and len(w) <= MAX_CACHED and "\n" not in w:
                        total[w] += n
                if len(total) > 4 * summary_words:
                    total = Counter(dict(total.most_common(2 * summary_words)))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([summary(total, summary_words)], pa.binary())], names=["body"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = merged(b for batch in batches for b in batch.column(0).to_pylist())
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([summary(total, summary_words)], pa.binary())], names=["body"])

    spark, level = docs.sparkSession, stored(docs.select(F.col(text)).mapInArrow(summarise, "body binary"), "token-summaries")
    while (n := level.count()) > fan_in:
        below, level = level, stored(level.repartition(-(-n // fan_in)).mapInArrow(lean(merge), "body binary"), "token-summaries")
        release(spark, [below])
    total = merged(r.body for r in level.collect())  # at most fan_in summaries
    release(spark, [level])
    return [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:table_words]]


def length_table(units: list[str], vocabulary_json: bytes) -> tuple[bytes, bytes]:
    """Units and their lengths, packed: newline-joined UTF-8 and one byte a length (no frequent unit needs more than 255 ids)."""
    encoder = WordEncoder(vocabulary_json)
    kept = [(u, n) for u, n in ((u, len(encoder.unit(u))) for u in units) if n < 256]
    return "\n".join(w for w, _ in kept).encode(), bytes(n for _, n in kept)


def count_tokens(docs: DataFrame, vocabulary_json: bytes | None = None, limit: int = 2048, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document; equals the library's encoding without added tokens."""
    spark = docs.sparkSession
    vocabulary_json = vocabulary_json or vocabulary("word_bpe_49k.json")
    shared = spark.sparkContext.broadcast((vocabulary_json, *length_table(frequent_units(docs, vocabulary_json, text), vocabulary_json)))
    key = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, table, lengths = shared.value
        fixed = dict(zip(table.decode().split("\n"), lengths)) if lengths else {}
        cache = worker_cache(LengthCache, vocab, fixed, key)
        for batch in batches:
            n = pa.array([cache.count(t) if t else 0 for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), n], names=["doc_id", "n_bytes", "n_tokens"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), body.alias("text"), F.octet_length(body).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
