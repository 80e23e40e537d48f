"""SimHash fingerprints, and links between near ones with pivot distance tables.

A fingerprint x has a table of Hamming distances to reference fingerprints. By the triangle inequality a pair whose
distances to any reference differ by more than r is discarded; the survivors are compared bit by bit.

What meets at all is decided by banding, said plainly: distances to random references spread too little to index
anything (a window of 3 around a distance keeps 46 % of random pairs of 64 bits). References of a single bit e show that bit,
d(x, 0) + 1 - d(x, e) being 2 or 0, so bands are groups of such references, and their equal coordinates are join keys.

``link_fingerprints`` (64 bits, r = 3) is exact: six bands, of which at least three must agree, so twenty choices. A
bucket yields links of a spanning forest only, never all its pairs. A bucket of many members is split again by the bits
that vary in it, in r + 1 groups of which one must agree, until the parts are small or one tree.

``near_duplicates`` serves similarity of word shingles: wide fingerprints of distinct shingles, whose distance measures
the angle between the sets, find the candidates, and the sets themselves decide. Fingerprints meet by keys of randomly
chosen bits: as many keys as find a pair of the stated similarity with the stated probability. Key length follows the
logarithm of the number of fingerprints, and the number of keys follows the key length, so buckets stay small and the
probability stays the same at any size.

Scale: equal fingerprints are folded before anything is compared. Partitions follow the number of rows. Keys that very many
fingerprints share are found on a sample of one fingerprint in 64; their members are dealt to slots, and each pair of
slots meets in a task of its own, so no task holds more than two slots. Links and labels stay in tables.

Defined cases: null text is empty; an empty text's fingerprint is zero and links like any other; a row without id has a
fingerprint, no links and a null component; rows of one id belong together; an empty table gives no rows; other columns
of the input are not read, and ``deduplicate`` keeps them, whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, lean, private, release, ship_package, stored
from .components import components

SEED = 42
GROUPS, AGREEING = 6, 3
#: References besides the groups, used to discard pairs.
FURTHER = 8
#: Members of a bucket that others meet in the first of two rounds, least first; the second compares all that is left (near_duplicates).
CENTERS = 16
#: Buckets of more members are split by further bits before they are compared (link_fingerprints).
DENSE = 256
#: Members of a slot of a hot key: of 64-bit fingerprints, of wide ones in the second round.
SLOT, WIDE_SLOT = 65_536, 8_192
#: One fingerprint in so many is looked at to find hot keys; rows of keys that a task takes.
SAMPLED, TASK_ROWS, WIDE_ROWS = 64, 1_000_000, 200_000
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_BLOCK = 1 << 15
#: Hashes of a cluster's shingle sets that one place holds (twice, where two slots of a cluster meet): 16 MB.
GROUP_HASHES = 2_000_000


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included; fewer words are one shingle, none give nothing.

    Words are what bytes.split() yields: runs without the six ASCII white-space bytes. Only A-Z are lower-cased.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    one = xxhash.xxh64_intdigest
    shingles = [b" ".join(words)] if len(words) < size else map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.array([one(s, SEED) for s in shingles], np.uint64)


def distinct_hashes(text: str, size: int) -> np.ndarray:
    """The set of the text's shingle hashes, in order."""
    return np.unique(shingle_hashes(text, size))


def simhash(hashes: np.ndarray, bits: int = 64) -> np.ndarray:
    """The fingerprint as uint64 words, lowest bits first: a bit is 1 if over half of the hashes have it.

    Bits beyond the first 64 come from the hashes mixed again.
    """
    ones = np.zeros(bits, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        h = hashes[at : at + _BLOCK]
        for word in range(bits // 64):
            x = h
            if word:
                x = h + np.uint64(word * _MIX[0] & 0xFFFFFFFFFFFFFFFF)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
                x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
                x = x ^ (x >> np.uint64(31))
            ones[64 * word : 64 * word + 64] += np.unpackbits(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, shingle: int, bits: int = 64, text: str = "text", distinct: bool = False) -> DataFrame:
    """(doc_id, fp, size): fp is a long of 64 bits, or binary where there are more; size is the number of shingles, of distinct ones if asked for."""
    ship_package(docs.sparkSession)
    hashes = distinct_hashes if distinct else shingle_hashes
    kind = pa.int64() if bits == 64 else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes = [], []
            for t in batch.column(1).to_pylist():
                found = hashes(t or "", shingle)
                fp = simhash(found, bits)
                fps.append(int(fp.view(np.int64)[0]) if bits == 64 else fp.tobytes())
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, kind), pa.array(sizes, pa.int32())], names=["doc_id", "fp", "size"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(lean(run), f"doc_id long, fp {'long' if bits == 64 else 'binary'}, size int")


def references(n: int, words: int = 1) -> np.ndarray:
    """Fixed pseudo-random reference fingerprints."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, (n, words), dtype=np.uint64, endpoint=False)


def distances(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """The pivot distance table: a row a fingerprint, a column a reference."""
    return np.stack([np.bitwise_count(fps ^ r).sum(axis=1) for r in refs], axis=1).astype(np.int16)


def group_keys(fps: np.ndarray) -> np.ndarray:
    """Keys of 64-bit fingerprints, a column a choice of agreeing bands: the choice and the fingerprint's bits there."""
    edges = np.linspace(0, 64, GROUPS + 1).astype(int)
    masks = [sum(1 << i for i in range(a, b)) for a, b in itertools.pairwise(edges)]
    chosen = [sum(masks[g] for g in c) for c in itertools.combinations(range(GROUPS), AGREEING)]
    keys = []
    for i, m in enumerate(chosen):
        x = (fps & np.uint64(m)) + np.uint64((i + 1) * _MIX[0] & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX[1])
        keys.append(x ^ (x >> np.uint64(29)))  # one-to-one, so that equal keys of a choice mean equal bits
    return np.stack(keys, axis=1)


class _Forest:
    """Union of positions by their least root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.root[at]
        while ((up := self.root[r]) != r).any():
            r = up
        self.root[at] = r
        return r

    def join(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Places in (a, b) of pairs that joined two trees."""
        made, root = [], self.root
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
            while root[i] != i:
                i = root[i]
            while root[j] != j:
                j = root[j]
            if i != j:
                root[max(i, j)] = min(i, j)
                made.append(k)
        return made


def runs_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins in sorted keys, and its length."""
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return head, np.diff(np.r_[head, len(key)])


def dense_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions (a, b) of a spanning forest of near pairs among many distinct 64-bit fingerprints."""
    table, forest, made = distances(fps[:, None], references(FURTHER)), _Forest(len(fps)), []
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        roots = forest.roots(at)
        if (roots == roots[0]).all():
            continue
        varying = int(np.bitwise_or.reduce(fps[at] ^ fps[at[0]]))
        bits = [i for i in range(64) if varying >> i & 1]
        if len(at) > DENSE and len(bits) > radius:
            for part in np.array_split(np.array(bits), radius + 1):
                key = fps[at] & np.uint64(sum(1 << int(i) for i in part))
                order = np.argsort(key, kind="stable")
                head, size = runs_of(key[order])
                todo += [at[order[h : h + n]] for h, n in zip(head.tolist(), size.tolist()) if n > 1]
            continue
        for i in range(len(at) - 1):
            later = at[i + 1 :]
            later = later[forest.roots(later) != forest.roots(at[i : i + 1])]
            later = later[np.abs(table[later] - table[at[i]]).max(axis=1, initial=0) <= radius]
            later = later[np.bitwise_count(fps[later] ^ fps[at[i]]) <= radius]
            one = np.full(len(later), at[i])
            made += [(int(at[i]), int(later[k])) for k in forest.join(one, later)]
    return made


def bucket_links(key: np.ndarray, fps: np.ndarray, node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest among near fingerprints of equal key."""
    order = np.argsort(key, kind="stable")
    key, fps, node = key[order], fps[order], node[order]
    head, size = runs_of(key)
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for h, n in zip(head[size > DENSE].tolist(), size[size > DENSE].tolist()):
        if links := dense_links(fps[h : h + n], radius):
            out_a.append(node[h : h + n][[x for x, _ in links]])
            out_b.append(node[h : h + n][[y for _, y in links]])
    small = np.repeat((size > 1) & (size <= DENSE), size)
    key, fps, node = key[small], fps[small], node[small]
    table, forest = distances(fps[:, None], references(FURTHER)), _Forest(len(key))
    left, step = np.arange(len(key)), 0
    while len(left):
        step += 1
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
        a = left[forest.roots(left) != forest.roots(left + step)]
        b = a + step
        near = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= radius
        a, b = a[near], b[near]
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        a, b = a[near], b[near]
        if len(a):
            made = forest.join(a, b)
            out_a.append(node[a[made]])
            out_b.append(node[b[made]])
    return np.concatenate(out_a), np.concatenate(out_b)


def hot_keys(rows: DataFrame, members: int) -> DataFrame | None:
    """(hot, slots) for the keys of rows (key, node, ...) that more than some members share, as far as a sample of nodes tells."""
    sample = rows.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0)
    slots = F.ceil(F.col("n") * SAMPLED / members).cast("int")
    found = stored(sample.groupBy(F.col("key").alias("hot")).agg(F.count("*").alias("n")).where(F.col("n") * SAMPLED > members).select("hot", slots.alias("slots")), "simhash-hot")
    return None if found.isEmpty() else found


def placed(rows: DataFrame, hot: DataFrame | None, pairs: bool) -> DataFrame:
    """rows (key, node, ...) with their place: 0, and for hot keys a slot (from 1), or each pair of slots that the row's own is in."""
    if hot is None:
        return rows.withColumn("place", F.lit(0).cast("long"))
    slots = F.col("slots").cast("long")
    own = F.pmod(F.xxhash64("node", F.lit(1)), slots)
    place = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), slots - 1), lambda j: F.least(own, j) * slots + F.greatest(own, j))) if pairs else own + 1
    met = rows.join(bounded_broadcast(hot), F.col("key") == F.col("hot"), "left")
    cold = met.where("slots is null").select(*rows.columns, F.lit(0).cast("long").alias("place"))
    return cold.unionByName(met.where("slots is not null").select(*rows.columns, place.alias("place")))


def dealt(rows: DataFrame, n: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """About n rows (key, place, ...) dealt by both to as many tasks as that takes."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(parts, -(-n // task_rows)), "key", "place")


def one_key(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Both in one value: places other than 0 are rare."""
    if place.any():
        return np.unique(np.stack([key, place], axis=1), axis=0, return_inverse=True)[1].ravel()
    return key


def _whole(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """A partition's columns as arrays."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    return [np.concatenate(c) for c in zip(*parts)]


def link_fingerprints(nodes: DataFrame, radius: int = 3, slot: int = SLOT) -> DataFrame:
    """Links (a, b) that join all nodes (node, fp: distinct longs) within ``radius`` bits, directly or over others."""
    if radius > GROUPS - AGREEING:
        raise ValueError("more bits need more groups")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(1).to_numpy().view(np.uint64)
            keys = group_keys(fps)
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(1).to_numpy(), n)), pa.array(np.repeat(batch.column(0).to_numpy(), n))], names=["key", "fp", "node"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns := _whole(batches):
            key, fp, node, place = columns
            a, b = bucket_links(one_key(key, place), fp.view(np.uint64), node, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    n = nodes.count()
    keys = nodes.select("node", "fp").mapInArrow(lean(keyed), "key long, fp long, node long")
    hot = hot_keys(keys, slot) if n > slot else None  # fewer nodes cannot fill a slot
    return dealt(placed(keys, hot, pairs=True), n * math.comb(GROUPS, AGREEING)).mapInArrow(lean(linked), "a long, b long")


def _assign(fps: DataFrame, folded: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) from documents' fingerprints, one node a fingerprint, and links between nodes."""
    links = stored(links, "simhash-links")
    groups = folded.withColumn("component_id", F.col("node"))
    if not links.isEmpty():
        label = components(links).withColumnRenamed("node", "_node")
        groups = stored(folded.join(label, F.col("node") == F.col("_node"), "left").select("fp", F.coalesce("component", "node").alias("component_id")), "simhash-groups")
    groups = groups.select(F.col("fp").alias("_fp"), "component_id")
    joined = fps.join(groups, F.col("fp") == F.col("_fp"), "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def _folded(fps: DataFrame) -> DataFrame:
    """One node a distinct fingerprint: its least document, and the most shingles of any."""
    return stored(fps.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node"), F.max("size").alias("size")), "simhash-nodes")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): links of at most ``radius`` bits between 64-bit fingerprints, all of them."""
    fps = stored(fingerprints(docs, shingle, 64, text).drop("size"), "simhash")
    folded = _folded(fps.withColumn("size", F.lit(0)))
    return _assign(fps, folded, link_fingerprints(folded, radius))


def angle(similarity: float) -> float:
    """Expected share of differing bits between the fingerprints of two like-sized sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def joining_pairs(key: np.ndarray, label: np.ndarray, fps: np.ndarray, radius: int, loose: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a, b) of equal key and at most ``radius`` bits between them (``loose`` in the first 64) that join all labels which such pairs join.

    All pairs of a key whose labels are not joined yet are compared; a pair that joins nothing new is not told. Rows are
    sorted by key; fps has a row of words each.
    """
    if not len(key):
        return
    head, size = runs_of(key)
    mixed = np.minimum.reduceat(label, head) != np.maximum.reduceat(label, head)
    label = np.unique(label, return_inverse=True)[1].ravel()
    forest = _Forest(int(label.max()) + 1)
    left, step = np.flatnonzero(np.repeat(mixed, size)), 0
    while len(left):
        step += 1
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
        for part in np.array_split(left, max(1, len(left) // 500_000)):
            a = part[forest.roots(label[part]) != forest.roots(label[part + step])]
            a = a[np.bitwise_count(fps[a, 0] ^ fps[a + step, 0]) <= loose]
            a = a[np.bitwise_count(fps[a] ^ fps[a + step]).sum(axis=1) <= radius]
            if len(a):
                a = a[forest.join(label[a], label[a + step])]
                yield a, a + step


def alike_links(members: DataFrame, docs: DataFrame, shingle: int, similarity: float, radius: int, bits: int, text: str = "text", hashes: int = GROUP_HASHES) -> DataFrame:
    """Links (a, b) that join the members of each cluster whose sets of distinct shingles are alike: Jaccard ``similarity`` or more.

    members: (node, cluster, fp, size). All pairs of a cluster within ``radius`` bits that links have not joined yet are
    compared by their sets, in the place where the cluster's texts are; no pair is ever a row. A cluster whose sets hold more
    than ``hashes`` hashes in all is dealt to slots, and each pair of slots meets in a task of its own.
    """
    ship_package(docs.sparkSession)
    words = bits // 64
    sizes = members.groupBy(F.col("cluster").alias("_c")).agg(F.ceil(F.sum(F.col("size") + 1) / hashes).alias("slots"), F.count("*").alias("_n")).where("_n > 1")
    slots = F.col("slots")
    own = F.pmod(F.xxhash64("node", F.lit(2)), slots)
    places = F.transform(F.sequence(F.lit(0).cast("long"), slots - 1), lambda j: F.least(own, j) * slots + F.greatest(own, j))
    put = members.join(sizes, F.col("cluster") == F.col("_c")).select("node", "cluster", "fp", own.alias("own"), places.alias("places"))
    put = stored(put, "simhash-members")
    bodies = docs.select(F.col("doc_id").cast("long").alias("_d"), F.coalesce(text, F.lit("")).alias("body"))
    rows = bodies.join(bounded_broadcast(put), F.col("_d") == F.col("node")).select("cluster", F.explode("places").alias("place"), "own", "node", "fp", "body")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []  # one cluster's place at a time
        for batch in batches:
            for cluster, place, own_, node, fp, body in zip(*(c.to_pylist() for c in batch.columns)):
                if (cluster, place) != now:
                    if len(held) > 1:
                        yield links(held)
                    now, held = (cluster, place), []
                held.append((node, own_, fp, distinct_hashes(body, shingle)))
        if len(held) > 1:
            yield links(held)

    def alike(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both > 0 and both >= similarity * (len(x) + len(y) - both) - 1e-9

    def links(held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda h: h[0])
        node, own_ = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
        fps = np.frombuffer(b"".join(h[2] for h in held), np.uint64).reshape(-1, words)
        size, sets = np.array([len(h[3]) for h in held]), [h[3] for h in held]
        across = len(set(own_.tolist())) > 1  # pairs of one slot meet where it is alone
        forest, made = _Forest(len(held)), []
        for i in range(len(held) - 1):
            j = np.arange(i + 1, len(held))
            if across:
                j = j[own_[j] != own_[i]]
            j = j[(node[j] != node[i]) & (np.minimum(size[j], size[i]) >= similarity * np.maximum(size[j], size[i]) - 1e-9)]
            j = j[forest.roots(j) != forest.roots(np.array([i]))]
            j = j[np.bitwise_count(fps[j] ^ fps[i]).sum(axis=1) <= radius]
            for k in j.tolist():
                if forest.roots(np.array([k]))[0] != forest.roots(np.array([i]))[0] and alike(sets[i], sets[k]):
                    forest.join(np.array([i]), np.array([k]))
                    made.append((i, k))
        return pa.RecordBatch.from_arrays([pa.array([node[m[x]] for m in made], pa.int64()) for x in range(2)], names=["a", "b"])

    return rows.repartition("cluster", "place").sortWithinPartitions("cluster", "place").mapInArrow(lean(linked), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, bits: int = 512, recall: float = 0.98, text: str = "text", slot: int = WIDE_SLOT) -> DataFrame:
    """(doc_id, fp, component_id): links between documents whose sets of distinct shingles are alike, Jaccard ``similarity`` or more.

    A pair at exactly that similarity meets in some bucket with probability ``recall``, whatever the number of documents.
    Clusters are made of all pairs that meet and are within a radius, the expected distance of all bits plus 3 standard
    errors: a first, quick round compares each member with the ``CENTERS`` least ones of its bucket up to the first that is
    near by 64 bits and with the one before it; a second compares in full all members of a bucket that are not of one
    cluster yet. Both tell what joins clusters only, so their rows follow the members, never the pairs. Inside a cluster the
    sets of shingles decide, so no link is below ``similarity``. Groups are made of chains of links: two members of one need
    not be alike.
    """
    fps = stored(fingerprints(docs, shingle, bits, text, distinct=True), "simhash-wide")
    folded = _folded(fps)
    n, words = max(1, folded.count()), bits // 64
    p = angle(similarity)
    radius = math.floor(bits * p + 3 * math.sqrt(bits * p * (1 - p)))
    loose = math.ceil(64 * p + 4 * math.sqrt(64 * p * (1 - p)))
    key_bits = min(40, max(16, math.ceil(math.log2(n)) + 2))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - p) ** key_bits))
    rng = np.random.default_rng(SEED)
    chosen = [rng.choice(bits, key_bits, replace=False) for _ in range(tables)]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.int64(1) << np.arange(key_bits, dtype=np.int64)
        for batch in batches:
            node, raw = batch.column(0).to_numpy(), b"".join(batch.column(1).to_pylist())
            one = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, bits // 8), axis=1, bitorder="little")
            head = np.frombuffer(raw, np.int64).reshape(-1, words)[:, 0]
            for t, at in enumerate(chosen):
                key = one[:, at].astype(np.int64) @ weights + (np.int64(t + 1) << 41)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(head)], names=["key", "node", "head"])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (columns := _whole(batches)):
            return
        key, node, head, place = columns
        key = one_key(key, place)
        order = np.lexsort((node, key))
        key, node, head = key[order], node[order], head[order].view(np.uint64)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        start = np.repeat(start, np.diff(np.r_[start, len(key)]))
        size = np.bincount(start, minlength=len(key))[start]
        pairs = []

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            ok = np.bitwise_count(head[a] ^ head[b]) <= loose
            pairs.append(np.stack([node[a[ok]], node[b[ok]], size[b[ok]] == 2], axis=1))
            return ok

        at = np.flatnonzero(start != np.arange(len(key)))
        for c in range(CENTERS):
            at = at[start[at] + c < at]
            at = at[~near(start[at] + c, at)]
        near(at - 1, at)
        found = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2] == 1)], names=["key", "a", "b", "alone"])
        more = (size > 2) | (place[order] > 0)
        yield pa.RecordBatch.from_arrays([pa.array(columns[0][order][more]), pa.array(node[more]), pa.nulls(int(more.sum()), pa.int64()), pa.nulls(int(more.sum()), pa.bool_())], names=["key", "a", "b", "alone"])

    def wide(column: pa.Array) -> np.ndarray:
        column = column.cast(pa.binary(bits // 8))
        return np.frombuffer(column.buffers()[1], np.uint64)[column.offset * words :][: len(column) * words].reshape(-1, words)

    def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [([c.to_numpy() for c in (b.column(0), b.column(1), b.column(2), b.column(4))], wide(b.column(3))) for b in batches if b.num_rows]
        if not parts:
            return
        key, node, label, place = (np.concatenate(c) for c in zip(*[p[0] for p in parts]))
        key, fps = one_key(key, place), np.concatenate([p[1] for p in parts])
        order = np.argsort(key, kind="stable")
        key, node, label, fps = key[order], node[order], label[order], fps[order]
        for a, b in joining_pairs(key, label, fps, radius, loose):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b]))], names=["a", "b"])

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = references(FURTHER, words)
        for batch in batches:
            x, y = wide(batch.column(2)), wide(batch.column(3))
            near = np.abs(distances(x, refs) - distances(y, refs)).max(axis=1, initial=0) <= radius
            near &= np.bitwise_count(x ^ y).sum(axis=1) <= radius
            kept = batch.filter(pa.array(near))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), kept.column(4)], names=["a", "b", "alone"])

    spark = docs.sparkSession
    keys = folded.select("node", "fp").mapInArrow(lean(keyed), "key long, node long, head long")
    hot = hot_keys(keys, slot) if n > slot else None  # fewer nodes cannot fill a slot
    met = stored(dealt(placed(keys, hot, pairs=False), n * tables).mapInArrow(lean(candidates), "key long, a long, b long, alone boolean"), "simhash-met")
    pairs = stored(met.where("key is null").groupBy("a", "b").agg(F.max("alone").alias("alone")), "simhash-candidates")
    side = folded.select(F.col("node").alias("_n"), F.col("fp").alias("_fp"))
    both = pairs.join(side.withColumnRenamed("_fp", "fp_a"), F.col("a") == F.col("_n")).drop("_n").join(side.withColumnRenamed("_fp", "fp_b"), F.col("b") == F.col("_n")).select("a", "b", "fp_a", "fp_b", "alone")
    checked = stored(both.mapInArrow(lean(verified), "a long, b long, alone boolean"), "simhash-checked")
    # of members that meet in larger buckets one link each is enough here: what it leaves apart, the second round joins
    near = stored(checked.where("alone").select("a", "b").unionByName(checked.where("not alone").groupBy("b").agg(F.min("a").alias("a")).select("a", "b")), "simhash-near")
    release(spark, [pairs])
    first = components(near)
    rest = met.where("key is not null").join(_labelled(side, first), F.col("a") == F.col("_n")).select("key", F.col("a").alias("node"), "label", "_fp")
    left = met.where("key is not null").count()
    later = stored(dealt(placed(rest, hot, pairs=True), left, WIDE_ROWS).mapInArrow(lean(remaining), "a long, b long"), "simhash-later")
    release(spark, [met, first])
    clusters = components(near.unionByName(later))
    members = folded.join(clusters.withColumnRenamed("node", "_m"), F.col("node") == F.col("_m")).select("node", F.col("component").alias("cluster"), "fp", "size")
    links = stored(alike_links(members, docs, shingle, similarity, radius, bits, text), "simhash-alike")
    release(spark, [near, later, clusters])
    return _assign(fps, folded, links)


def _labelled(side: DataFrame, found: DataFrame) -> DataFrame:
    """side (_n, _fp) with the component of each node as label; a node that is in none is its own."""
    label = found.select(F.col("node").alias("_l"), "component")
    return side.join(label, F.col("_n") == F.col("_l"), "left").select("_n", F.coalesce("component", "_n").alias("label"), "_fp")


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """docs without near duplicates: of each group the least id stays, with all columns; rows without id stay.

    A group is held together by links, so a text that goes is like some member of its group, and need not be like the one
    that stays.
    """
    groups = near_duplicates(docs, **settings)
    (name,) = private(docs, "_gone")
    gone = stored(groups.where("component_id <> doc_id").select("doc_id").distinct().toDF(name), "simhash-gone")
    return docs.join(bounded_broadcast(gone), F.col("doc_id") == F.col(name), "left_anti")
