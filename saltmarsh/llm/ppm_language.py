"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ``order`` bytes is counted on a bounded sample of labelled texts and
frozen. The cost of a byte is exact: -log2 of its probability in the longest context that has seen it, plus, for each
longer context that is known but has not, -log2 of that context's escape probability (method C: distinct successors
over all occurrences plus distinct). Below order 0 every byte costs 8 bits. A text's language is the one with the
shortest code for all its bytes.

The trees are flattened to tables: for each length the byte strings seen in any language, with the cost of the last
byte and the escape cost after the string, one column a language. Texts are scored by vectorised hash look-ups.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0; equal code lengths go to the
smaller name; repeated rows are scored each; an empty table gives no rows; without any labelled text every text is
``und``; other columns of the input are not read. A NUL byte is taken for the mark before a text's first byte.
"""

from __future__ import annotations

import copy
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, worker_state

ORDER = 4
#: Bounds of the training sample, a language: texts, their bytes in all, and the bytes of one text.
MAX_TEXTS, MAX_BYTES, MAX_TEXT_BYTES = 500, 1_200_000, 100_000
UNKNOWN = "und"
#: A limit is learned from so many held-out texts at least; least bits a byte it allows; bits a short text may cost more.
LIMIT_TEXTS, LEAST_RATE, SLACK_BITS, RATE_BYTES = 50, 10.0, 64.0, 64
_LETTER = regex.compile(r"\p{L}")
_WINDOW = 1 << 18


class HashTable:
    """Positions of int64 keys by open addressing; look-ups are vectorised."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        todo = np.arange(len(keys))
        at = self._home(keys)
        while len(todo):
            free = todo[self.slots[at[todo]] < 0]
            self.slots[at[free]] = free
            self.keys[at[free]] = keys[free]
            todo = todo[self.slots[at[todo]] != todo]
            at[todo] = (at[todo] + 1) & (len(self.slots) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is absent."""
        at = self._home(keys)
        got = self.slots[at]
        wrong = np.flatnonzero((self.keys[at] != keys) & (got >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            got[wrong] = self.slots[at[wrong]]
            wrong = wrong[(self.keys[at[wrong]] != keys[wrong]) & (got[wrong] >= 0)]
        return got


def _grams(buffer: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n bytes that end at each position (positions before n - 1 see zeros)."""
    key = np.zeros(len(buffer), np.int64)
    for back in range(n):
        key[back:] |= buffer[: len(buffer) - back].astype(np.int64) << (8 * back)
    return key


class PpmModel:
    """Frozen context trees of several languages."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.order, self.languages = order, sorted(texts)
        self.limit: tuple[float, float] | None = None  # bits a byte, and bits besides, that a text of these languages may cost
        n_lang = len(self.languages)
        if not n_lang:  # predict() then never looks further
            self.keys, self.cost, self.contexts, self.escape = [], [], [], []
            return
        counts: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for lang in self.languages:
            pad = b"\0" * order
            raw = b"".join(pad + t.encode() for t in texts[lang])
            buffer = np.frombuffer(raw, np.uint8)
            real = np.ones(len(buffer), bool)
            at = 0
            for t in texts[lang]:
                real[at : at + order] = False
                at += order + len(t.encode())
            counts.append([np.unique(_grams(buffer, n)[real], return_counts=True) for n in range(1, order + 2)])
        self.keys = [np.unique(np.concatenate([counts[li][n][0] for li in range(n_lang)])) for n in range(order + 1)]
        self.cost: list[np.ndarray] = []  # by length of the string: its last byte's cost after the rest, a column a language
        self.contexts: list[np.ndarray] = []  # by length: the strings that some byte follows
        self.escape: list[np.ndarray] = []  # and what escaping from them costs, 0 where a language does not know them
        for n in range(order + 1):
            keys = self.keys[n]
            cost = np.empty((len(keys), n_lang), np.float32)
            context = keys >> 8 if n else np.zeros(len(keys), np.int64)
            lower = self.cost[n - 1][np.searchsorted(self.keys[n - 1], keys & ((1 << (8 * n)) - 1))] if n else np.full((len(keys), n_lang), 8.0)
            known = np.unique(context)
            escape = np.zeros((len(known), n_lang))
            for li in range(n_lang):
                k, c = counts[li][n]
                own, inverse = np.unique(k >> 8 if n else np.zeros(len(k), np.int64), return_inverse=True)
                total, distinct = np.bincount(inverse, weights=c), np.bincount(inverse)
                escape[np.searchsorted(known, own), li] = -np.log2(distinct / (total + distinct))
                cost[:, li] = lower[:, li] + escape[np.searchsorted(known, context), li]
                cost[np.searchsorted(keys, k), li] = -np.log2(c / (total + distinct)[inverse])
            self.cost.append(cost)
            self.contexts.append(known)
            self.escape.append(escape.astype(np.float32))

    def prepare(self) -> PpmModel:
        """Build the look-up tables (not sent over the network)."""
        if not hasattr(self, "tables"):
            self.tables = [HashTable(k) for k in self.keys]
            self.context_tables = [HashTable(k) for k in self.contexts]
        return self

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("tables", "context_tables")}

    def code_lengths(self, raws: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        self.prepare()
        total = np.zeros((len(raws), len(self.languages)))
        pad = b"\0" * self.order
        buffer = np.frombuffer(b"".join(pad + r for r in raws), np.uint8)
        lengths = np.array([len(r) for r in raws])
        starts = np.cumsum(lengths + self.order) - lengths  # of each text's own bytes
        for begin in range(0, len(buffer), _WINDOW):
            end, lead = min(len(buffer), begin + _WINDOW), min(begin, self.order)
            part = buffer[begin - lead : end]
            first, last = np.searchsorted(starts + lengths, begin, "right"), np.searchsorted(starts, end, "left")
            here = np.arange(first, last)
            a, b = np.maximum(starts[here], begin) - begin + lead, np.minimum(starts[here] + lengths[here], end) - begin + lead
            here, a, b = here[b > a], a[b > a], b[b > a]
            if not len(here):
                continue
            real = np.zeros(len(part), bool)
            for x, y in zip(a, b):
                real[x:y] = True
            at = np.flatnonzero(real)
            cost = self._costs(part, at)
            n = b - a
            total[here] += np.add.reduceat(cost, np.cumsum(n) - n, axis=0)
        return total

    def _costs(self, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        longest = _grams(part, self.order + 1)
        keys = longest[at]
        found = self.tables[self.order].find(keys)
        cost = self.cost[self.order][found].astype(np.float64)
        missing = np.flatnonzero(found < 0)
        cost[missing] = 0.0
        for n in range(self.order, -1, -1):
            if not len(missing):
                break
            # the context of n bytes has not been followed by this byte anywhere: escape from it where it is known
            context = (keys[missing] >> 8) & ((1 << (8 * n)) - 1)
            known = self.context_tables[n].find(context)
            cost[missing] += np.where((known >= 0)[:, None], self.escape[n][known], 0.0)
            if n == 0:
                cost[missing] += 8.0
                break
            found = self.tables[n - 1].find(keys[missing] & ((1 << (8 * n)) - 1))
            hit = found >= 0
            cost[missing[hit]] += self.cost[n - 1][found[hit]]
            missing = missing[~hit]
        return cost

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its probability by code length, each text."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        todo = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.languages else []
        if todo:
            bits = self.code_lengths([texts[i].encode() for i in todo])
            best = bits.argmin(axis=1)
            p = 1 / np.exp2(np.clip(bits.min(axis=1)[:, None] - bits, -1000, 0)).sum(axis=1)
            for i, b, x, cost in zip(todo, best, p, bits.min(axis=1)):
                if self.limit is None or cost <= self.limit[0] * len(texts[i].encode()) + self.limit[1]:
                    langs[i], scores[i] = self.languages[b], float(x)
        return langs, scores


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def training_sample(docs: DataFrame, max_texts: int = MAX_TEXTS, max_bytes: int = MAX_BYTES, max_text_bytes: int = MAX_TEXT_BYTES, held: bool = False) -> dict[str, list[str]]:
    """Distinct whole labelled texts outside the held-out third (or, if ``held``, inside it), a bounded number of each language, chosen by their hash.

    Copies are folded before anything is collected, so that a hot text counts once; texts of over ``max_text_bytes`` are
    not learnt from.
    """
    hashed = F.xxhash64("text")
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (held_out(F.col("doc_id")) == F.lit(held))).where(F.octet_length("text").between(1, max_text_bytes)).select("lang", "text", hashed.alias("h"))
    sizes = {r.lang: max(1, r.n) for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, 1.5 * max_texts / n))])
    picked = rows.where(F.pmod("h", F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003).groupBy("lang", "h").agg(F.first("text").alias("text"))
    # places in the order of hashes and bytes before them are counted where the rows are, so no more than the bounds is collected
    by_hash = Window.partitionBy("lang").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    placed = picked.withColumn("n", F.count("*").over(by_hash)).withColumn("size", F.sum(F.octet_length("text")).over(by_hash))
    out: dict[str, list[str]] = {}
    for r in sorted(placed.where((F.col("n") <= max_texts) & (F.col("size") <= max_bytes)).collect(), key=lambda r: (r.lang, r.h)):
        out.setdefault(r.lang, []).append(r.text)
    return out


def train(docs: DataFrame, order: int = ORDER, **bounds: int) -> PpmModel:
    return PpmModel(training_sample(docs, **bounds), order)


def train_with_limit(docs: DataFrame, order: int = ORDER, **bounds: int) -> PpmModel:
    """A model that takes a text for unknown if its best language explains it worse than any held-out labelled text.

    No limit is below ``LEAST_RATE`` bits a byte (8 need no model) plus ``SLACK_BITS``; with few held-out texts
    there is none.
    """
    model = train(docs, order, **bounds)
    seen = [t.encode() for texts in training_sample(docs, held=True, **bounds).values() for t in texts if _LETTER.search(t)]
    if model.languages and len(seen) >= LIMIT_TEXTS:
        bits, size = model.code_lengths(seen).min(axis=1), np.array([len(t) for t in seen])
        rate = max(LEAST_RATE, float((bits / size)[size >= RATE_BYTES].max(initial=0)))
        model.limit = (rate, max(SLACK_BITS, float((bits - rate * size).max())))
        del model.tables, model.context_tables
    return model


def predict_languages(docs: DataFrame, model: PpmModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns with the language and its score, as columns of these names, of every whole text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], F.col(text).alias("_text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = worker_state(("ppm", key), lambda: copy.copy(shared.value).prepare())
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                langs, scores = ready.predict(part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    out = rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], F.col("lang_pred").alias(names[0]), F.col("score").alias(names[1]))


def evaluate(predicted: DataFrame, lang: str = "lang") -> float:
    """Share of right predictions among rows that have a label."""
    r = predicted.where(F.col(lang).isNotNull()).agg(F.avg((F.col("lang_pred") == F.col(lang)).cast("double")).alias("a")).first()
    return math.nan if r.a is None else r.a
