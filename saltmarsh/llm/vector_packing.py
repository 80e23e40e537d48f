"""Best-fit packing of token sequences under several capacities at once.

A piece is a vector (tokens, one document, attention cost = tokens squared). A bin has a capacity in
each dimension. Pieces are placed in falling order of length; among the open bins that hold a piece
under every constraint, the one with the least weighted norm of what remains takes it (``norm``), or
the one whose residual has the greatest weighted dot product with the piece (``dot``).

Scale: documents are tokenised map-side; only (id, piece, start, length, crc) rows are shuffled, dealt
out evenly (round robin, so neither long documents nor repeated ids make a hot partition) to shards of
about ``shard_docs`` documents, each packed alone. A shard leaves at most a few bins unfilled.

Defined cases: null text is empty, and so one piece holding only the end id; repeated rows are packed
each, apart; null ids stay null; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ship_package, vocabulary
from .word_bpe import IdCache, worker_cache

SHARD_DOCS = 24_000
#: Weights of the three dimensions in the residual norm and the dot product.
WEIGHTS = (1.0, 0.02, 0.05)


class VectorBestFit:
    """Assigns vectors to bins; capacities and weights hold one number a dimension."""

    def __init__(self, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm"):
        if rule not in ("norm", "dot"):
            raise ValueError(rule)
        self.capacity, self.weights, self.rule = capacity.astype(float), weights.astype(float), rule

    def pack(self, items: np.ndarray) -> np.ndarray:
        """The bin of each item, in the order given; an item that exceeds a capacity on its own is an error."""
        scaled = items / self.capacity
        if (scaled > 1).any():
            raise ValueError("an item exceeds the capacity of an empty bin")
        smallest = np.minimum.accumulate(scaled[::-1], axis=0)[::-1]  # of the items still to come
        out = np.empty(len(items), np.int64)
        residual, name, used, made = np.empty((64, items.shape[1])), np.empty(64, np.int64), 0, 0
        eps = 1e-12
        for i, v in enumerate(scaled):
            if i % 256 == 0 and used:  # bins too full for anything to come are closed
                keep = (residual[:used] + eps >= smallest[i]).all(axis=1)
                n = int(keep.sum())
                residual[:n], name[:n] = residual[:used][keep], name[:used][keep]
                used = n
            left = residual[:used] - v
            fits = np.flatnonzero((left >= -eps).all(axis=1))
            if len(fits):
                if self.rule == "norm":
                    at = fits[np.argmin((left[fits] ** 2) @ self.weights)]
                else:
                    at = fits[np.argmax(residual[fits] @ (self.weights * v))]
                residual[at] = left[at]
            else:
                if used == len(residual):
                    residual, name = np.concatenate([residual, np.empty_like(residual)]), np.concatenate([name, np.empty_like(name)])
                at, used = used, used + 1
                residual[at], name[at], made = 1.0 - v, made, made + 1
            out[i] = name[at]
        return out


def tokenize_pieces(docs: DataFrame, vocabulary_json: bytes, size: int, end_id: int = 0, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each document, its end id, cut every ``size`` ids: one row a piece."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_json)
    end, step = int(end_id).to_bytes(4, "little"), 4 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(IdCache, shared.value)
        for batch in batches:
            rows: list[tuple] = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (cache.encode(t) if t else b"") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_column).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, size: int = 2048, max_docs: int | None = None, max_attention: int | None = None, rule: str = "norm", weights: tuple = WEIGHTS, shard_docs: int = SHARD_DOCS, vocabulary_json: bytes | None = None) -> DataFrame:
    """Pieces of all documents with the sequence each goes to and its place there.

    size, max_docs and max_attention are the capacities of a sequence in tokens, pieces and summed squared lengths;
    without the latter two, they are what any ``size`` tokens can need. max_attention must be at least size squared.
    """
    vocabulary_json = vocabulary_json or vocabulary("word_bpe_49k.json")
    capacity = np.array([size, max_docs or size, max_attention or size * size])
    n_docs = docs.count()  # from the files' own row counts
    shards = max(1, -(-n_docs // shard_docs))
    pieces = tokenize_pieces(docs, vocabulary_json, size)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, held, made = TaskContext.get().partitionId() << 40, [], 0

        def out(rows: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(base + sequence), pa.array(offset)], names=names)

        for batch in batches:
            full = np.asarray(batch.column(3)) == size
            if full.any():  # a full piece is a sequence; only the last piece of a document is held
                whole = batch.filter(pa.array(full))
                yield out(whole, np.arange(made, made + whole.num_rows), np.zeros(whole.num_rows, np.int64))
                made += whole.num_rows
            held.append(batch.filter(pa.array(~full)))
        rows = pa.Table.from_batches(held).combine_chunks() if held else None
        if rows is None or not rows.num_rows:
            return
        length = rows["length"].to_numpy()
        order = np.lexsort((rows["ids_crc32"].to_numpy(), rows["piece"].to_numpy(), rows["doc_id"].fill_null(-1).to_numpy(), -length))
        rows, length = rows.take(pa.array(order)), length[order]
        bins = VectorBestFit(capacity, np.array(weights), rule).pack(np.stack([length, np.ones_like(length), length * length], axis=1))
        by_bin = np.argsort(bins, kind="stable")
        before = np.cumsum(length[by_bin]) - length[by_bin]
        first = np.r_[True, bins[by_bin][1:] != bins[by_bin][:-1]]
        offset = np.empty_like(length)
        offset[by_bin] = before - np.maximum.accumulate(np.where(first, before, 0))
        for batch_rows, at in ((rows.slice(i, 20_000), i) for i in range(0, rows.num_rows, 20_000)):
            n = batch_rows.num_rows
            yield out(batch_rows.combine_chunks().to_batches()[0], made + bins[at : at + n], offset[at : at + n])

    return pieces.repartition(shards).mapInArrow(lean(pack), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
