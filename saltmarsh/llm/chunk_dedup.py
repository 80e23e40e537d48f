"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last sixteen bytes cuts texts where its top bits are zero, between a least and a greatest
size, so equal passages are cut alike wherever they stand. The smallest document that holds a chunk's digest keeps it; in
every other document it is a repeat (what a document repeats of itself stays). Repeats that follow one another make a
run, and runs of at least ``MIN_WORDS`` words are passages to remove: single chunks shared by chance stay. A passage that
is one short word over and over has no cuts of its own, so copies of it may be cut at different places and then stay.

Digests have 96 bits, so that among 10 ** 13 chunks no two unlike ones are expected to share one; bytes are not compared.

Scale: chunk rows are shuffled once by digest, sorted and read as a stream, so that a task holds one row of the digest at
hand however many documents share it. Every few megabytes of text keep one document's occurrences of a digest for that shuffle;
those in other documents are known repeats already and travel under a key of their own row, so a digest that a third of
all documents share costs one document's rows every few megabytes. Repeats alone are then gathered by document, again as a stream of
which a task holds one document's.

Defined cases: null text is empty; a row without id takes no part and stays whole; rows that repeat an id with the same
text are one document, and both stay; empty tables give no rows; very long texts are cut like others; other columns of
the input are kept by ``remove_repeats``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, lean, private, ship_package, stored

#: Chunk sizes in bytes: at least, at most; one place in 2 ** CUT_BITS is a cut.
LEAST, MOST, CUT_BITS = 16, 128, 3
#: A run of repeats of at least so many words is removed; the ends of a repeated passage lose up to a chunk each.
MIN_WORDS = 36
#: Bytes of text whose chunks are folded at once.
HELD_BYTES = 6 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
GEAR = np.random.default_rng(20240501).integers(0, 1 << 16, 256).astype(np.uint16)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at each byte: the sum of the table's values of the last 16 bytes, each shifted by its age."""
    h = GEAR[raw]
    for age in (1, 2, 4, 8):
        older = h[:-age] << np.uint16(age)
        h = h.copy()
        h[age:] += older
    return h


def cuts(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes."""
    out: list[int] = []
    start, n = 0, len(raw)
    if not n:
        return out
    for c in (np.flatnonzero(gear_hashes(raw) >> np.uint16(16 - CUT_BITS) == 0) + 1).tolist():
        while c - start > MOST:
            start += MOST
            out.append(start)
        if c - start >= LEAST:
            out.append(c)
            start = c
    while n - start > MOST:
        start += MOST
        out.append(start)
    if n > start:
        out.append(n)
    return out


def chunk_text(text: str) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(digests, ends, words): a digest is two numbers, of 64 and 32 bits; words is the number of words that begin in each chunk."""
    body = text.encode()
    raw = np.frombuffer(body, np.uint8)
    ends = cuts(raw)
    if not ends:
        return np.empty((0, 2), np.int64), [], np.empty(0, np.int64)
    space = _SPACE[raw]
    begins = np.cumsum(~space & np.r_[True, space[:-1]])
    words = np.diff(np.r_[0, begins[np.array(ends) - 1]])
    digest = xxhash.xxh3_128_digest
    made = np.frombuffer(b"".join([digest(body[a:b]) for a, b in zip([0, *ends], ends)]), np.int64).reshape(-1, 2).copy()
    made[:, 1] >>= 32
    return made, ends, words


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """(doc_id, spans, words): runs of repeated chunks, as array of struct(begin, end) in bytes, and their words in all.

    Only documents that have such runs.
    """
    ship_package(docs.sparkSession)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            for i in range(batch.num_rows):
                d, t = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                digests, ends, words = chunk_text(t)
                if ends:
                    parts.append((digests[:, 0], digests[:, 1], np.full(len(ends), d, np.int64), np.array([0, *ends[:-1]], np.int64), np.array(ends, np.int64), words.astype(np.int32)))
                    size += ends[-1]
                if size > HELD_BYTES:
                    yield folded(parts)
                    parts, size = [], 0
            if parts:
                yield folded(parts)

    def folded(parts: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((columns[3], columns[2], columns[1], columns[0]))
        key, more, doc, begin, end, words = (c[order] for c in columns)
        repeat = _repeats(key, more, doc)[0]
        mixed = (doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + begin.view(np.uint64)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.where(repeat, mixed, key)), pa.array(more.astype(np.int32)), pa.array(doc), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(words), pa.array(repeat)], names=["key", "more", "doc_id", "begin", "end", "words", "repeat"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # digest and first document of the last row
        for batch in batches:
            known = batch.column(6).to_numpy(zero_copy_only=False).copy()
            at = np.flatnonzero(~known)
            if len(at):
                known[at], before = _repeats(*(batch.column(i).to_numpy()[at] for i in range(3)), before)
            yield batch.filter(pa.array(known)).select([2, 3, 4, 5])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last document so far
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            rows = [np.concatenate(c) for c in zip(held, rows)] if held else rows
            if batch.num_rows:
                last = np.searchsorted(rows[0], rows[0][-1])
                held = [c[last:] for c in rows]
                if last:
                    yield joined(*(c[:last] for c in rows))
        if held:
            yield joined(*held)

    def joined(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
        head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (begin[1:] > end[:-1])])
        total = np.add.reduceat(words, head)
        last = np.r_[head[1:], len(doc)] - 1
        kept = total >= min_words
        doc, begin, end, total = doc[head][kept], begin[head][kept], end[last][kept], total[kept]
        at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.empty(0, int)
        spans = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], names=["begin", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[at, len(doc)].astype(np.int32)), spans)
        return pa.RecordBatch.from_arrays([pa.array(doc[at]), lists, pa.array(np.add.reduceat(total, at) if len(at) else total, pa.int64())], names=["doc_id", "spans", "words"])

    rows = docs.where(F.col("doc_id").isNotNull() & F.col(text).isNotNull()).select(F.col("doc_id").cast("long"), F.col(text))
    chunks = rows.mapInArrow(lean(chunked), "key long, more int, doc_id long, begin int, end int, words int, repeat boolean")
    repeats = chunks.repartition("key").sortWithinPartitions("key", "more", "doc_id").mapInArrow(lean(marked), "doc_id long, begin int, end int, words int")
    return repeats.repartition("doc_id").sortWithinPartitions("doc_id", "begin", "end").mapInArrow(lean(runs), "doc_id long, spans array<struct<begin:int,end:int>>, words long")


def _repeats(key: np.ndarray, more: np.ndarray, doc: np.ndarray, before: tuple[int, int, int] | None = None) -> tuple[np.ndarray, tuple[int, int, int] | None]:
    """Of rows sorted by (key, more, doc): which are in another document than the first of their digest, and what to go on from.

    before is the digest and its first document where the rows before these end.
    """
    if not len(key):
        return np.empty(0, bool), before
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (more[1:] != more[:-1])])
    owner = doc[first]
    if before is not None and before[:2] == (key[0], more[0]):
        owner[0] = before[2]
    return doc != np.repeat(owner, np.diff(np.r_[first, len(key)])), (int(key[-1]), int(more[-1]), int(owner[-1]))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """text without byte spans, each narrowed to whole words."""
    body = text.encode()
    out, at = [], 0
    for begin, end in spans:
        while 0 < begin < end and not _SPACE[body[begin - 1]]:
            begin += 1
        while begin < end < len(body) and not _SPACE[body[end - 1]]:
            end -= 1
        if end > begin:
            out.append(body[at:begin])
            at = end
    out.append(body[at:])
    return b"".join(out).decode()


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """docs with repeated passages cut out of all but the first document that holds them; n_chars follows where there is such a column."""
    key, held, hit = private(docs, "_id", "_spans", "_cut")
    found = stored(repeated_runs(docs, min_words, text), "chunk-runs").select(F.col("doc_id").alias(key), F.col("spans").alias(held))
    # few spans in all are broadcast, so that the texts stay where they are; more of them meet the texts in one shuffle
    few = found.select(F.explode(held)).limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    columns = docs.columns
    joined = docs.join(F.broadcast(found) if few else found, F.col("doc_id") == F.col(key), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            spans = batch.column(len(columns))
            if spans.null_count < len(spans):
                texts = batch.column(at).to_pylist()
                for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    if texts[i] is not None:
                        texts[i] = without_spans(texts[i], [(s["begin"], s["end"]) for s in spans[i].as_py()])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch.select([*range(len(columns)), len(columns) + 1])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {hit} boolean"
    done = joined.select(*columns, held, F.col(held).isNotNull().alias(hit)).mapInArrow(lean(cut), schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.when(F.col(hit), F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done.select(*columns)


def chunk_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every document with its size, the words and bytes in repeated runs, and those runs as begin:end in bytes."""
    found = stored(repeated_runs(docs, min_words), "chunk-runs").select(F.col("doc_id").alias("_id"), "spans", "words")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    joined = sized.join(found, F.col("doc_id") == F.col("_id"), "left")
    said = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["begin"].cast("string"), s["end"].cast("string"))), ",")
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return joined.select("doc_id", "n_bytes", F.coalesce("words", F.lit(0).cast("long")).alias("repeated_words"), F.coalesce(size, F.lit(0).cast("long")).alias("repeated_bytes"), F.coalesce(said, F.lit("")).alias("spans"))
