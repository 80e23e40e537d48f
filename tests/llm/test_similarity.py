import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from saltmarsh.llm import chunk_dedup as ck
from saltmarsh.llm import pruned_graph as pg
from saltmarsh.llm import simhash_pivots as sh
from saltmarsh.llm.components import components


def vocabulary(n=400, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def corpus(seed=2):
    """Texts with copies, near copies and shared passages."""
    rng, words = random.Random(seed), vocabulary()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 300))) for _ in range(150)]
    texts += texts[:10]
    for t in texts[20:40]:
        w = t.split()
        for _ in range(max(1, len(w) // 100)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [f"{texts[i]} {passage} {texts[i + 1]}" for i in range(60, 64)]
    return [*texts, "", None, "\u00a0", "One Two", "one two", "UN\u00c9 \x0b x\x85y"]


def frame(spark, texts):
    return spark.createDataFrame([(3 * i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")], "doc_id long, text string, fp string")


def brute_simhash(texts):
    fps = []
    for t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = [" ".join(w[j : j + 3]) for j in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        fps.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return fps, [find(i) for i in range(len(fps))]


def test_simhash_links(spark):
    texts = corpus()
    fps, root = brute_simhash(texts)
    got = {r.doc_id: r for r in sh.simhash_components(frame(spark, texts)).collect()}
    for i, fp in enumerate(fps):
        assert got[3 * i].fp & (2**64 - 1) == fp and got[3 * i].component_id == 3 * root[i]
    assert got[None].component_id is None
    assert sh.simhash_components(frame(spark, texts).limit(0)).count() == 0


def test_dense_bucket_yields_a_forest():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(64)]))
    a, b = sh.bucket_links(np.zeros(len(fps), np.int64), fps, np.arange(len(fps)), 3)
    root = {i: i for i in range(len(fps))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        assert int(fps[x] ^ fps[y]).bit_count() <= 3 and find(x) != find(y)
        root[find(x)] = find(y)
    assert len({find(i) for i in root}) == 40


def components_of(n, a, b):
    root = list(range(n))
    for x, y in zip(a, b):
        x, y = root[x], root[y]
        root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_a_crowded_bucket_is_split_without_loss():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 64, dtype=np.uint64)
    low = rng.integers(0, 1 << 22, 1500, dtype=np.uint64)
    fps = np.unique(np.r_[base ^ low, base ^ low[:300] ^ (np.uint64(1) << np.uint64(30))])
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    i, j = np.nonzero(np.triu(near, 1))
    links = sh.dense_links(fps, 3)
    assert all(near[x, y] for x, y in links)
    want = components_of(len(fps), i.tolist(), j.tolist())
    assert 2 < len(set(want)) < len(fps) and components_of(len(fps), *zip(*links)) == want


def test_hot_keys_are_dealt_to_slots(spark):
    """With slots of a few members, links are those of whole buckets."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 64, dtype=np.uint64)
    fps = np.unique(base ^ rng.integers(0, 1 << 12, 900, dtype=np.uint64)).view(np.int64).tolist()
    nodes = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "node long, fp long")
    keys = nodes.selectExpr("1L as key", "node")
    assert sh.hot_keys(keys, 50).first().slots > 3
    spread = sh.placed(keys, sh.hot_keys(keys, 50), pairs=True).groupBy("place").agg({"node": "collect_set"}).collect()
    met = {(x, y) for r in spread for x in r[1] for y in r[1]}
    assert len(met) == len(fps) ** 2 and max(len(r[1]) for r in spread) < len(fps) / 2
    whole, split = ({(r.node, r.component) for r in components(sh.link_fingerprints(nodes, 3, slot)).collect()} for slot in (10**6, 100))
    assert whole == split and len(whole) > 500
    rows = list(enumerate(template(400, 40)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in sh.near_duplicates(docs, slot=64).collect()}
    assert sum(got[400 + k] == got[k * 7919 % 400] for k in range(40)) >= 39


@pytest.mark.parametrize("shared", [0, 200, 300])
def test_pairs_beside_a_shared_template(spark, shared):
    """400 texts of one template, each with 100 words of its own: 200 pairs alike to 0.8 or more are found, and none below 0.7 linked."""
    rng = random.Random(shared)
    frame_, texts = [f"t{i}" for i in range(shared)], []
    for d in range(200):
        own = [f"o{d}x{i}" for i in range(100)]
        other = list(own)
        other[rng.randrange(100)] = "changed"
        texts += [" ".join(frame_ + own), " ".join(frame_ + other)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.component_id for r in sh.near_duplicates(docs).orderBy("doc_id").collect()]
    assert all(jaccard(texts[2 * d], texts[2 * d + 1]) >= 0.8 for d in range(200))
    unlike = jaccard(texts[0], texts[2])
    found = sum(got[2 * d] == got[2 * d + 1] for d in range(200))
    assert unlike < 0.7 + 0.1 * (shared == 300) and found >= 190
    assert len(set(got)) >= 200  # texts of two pairs are never linked


def test_group_keys_miss_no_pair():
    rng = random.Random(5)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << b
        k = sh.group_keys(np.array([x, y], np.uint64))
        assert (k[0] == k[1]).any()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (9, 9)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[100] == got[70] == got[50] == 50


def test_near_duplicates_reach_similar_texts(spark):
    texts = corpus()
    got = {r.doc_id: r.component_id for r in sh.near_duplicates(frame(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))})
    found = wrong = 0
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i]) > 20 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for i, j in alike:
        found += got[3 * i] == got[3 * j]
    for i in range(len(texts)):
        for j in range(i):
            wrong += got[3 * i] == got[3 * j] and len(sets[i]) > 20 and len(sets[i] & sets[j]) < 0.5 * len(sets[i] | sets[j])
    assert len(alike) > 10 and found >= 0.95 * len(alike) and not wrong
    kept = sh.deduplicate(frame(spark, texts))
    assert kept.columns == ["doc_id", "text", "fp"] and kept.where("doc_id is null").count() == 1
    assert {r.doc_id for r in kept.collect()} - {None} == {d for d, c in got.items() if d is not None and d == c}


def template(n, copies):
    """n texts of one template, alike up to 0.7, then copies of some of them with one word changed."""
    rng, rows = random.Random(7), []
    for d in range(n):
        w = [f"w{i}" for i in range(120)]
        for i in rng.sample(range(20), 4):
            w[i * 6] = f"d{d}x{i}"
        rows.append(w)
    for k in range(copies):
        w = list(rows[k * 7919 % n])
        w[rng.randrange(120)] = f"c{k}"
        rows.append(w)
    return [" ".join(w) for w in rows]


def test_copies_within_a_template_meet_their_originals(spark):
    rows = [(i, t) for i, t in enumerate(template(1500, 150))]
    got = {r.doc_id: r.component_id for r in sh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[1500 + k] == got[k * 7919 % 1500] for k in range(150)) >= 148


def jaccard(x, y, size=5):
    x, y = (set(sh.shingle_hashes(t or "", size).tolist()) for t in (x, y))
    return len(x & y) / len(x | y) if x | y else 0.0


def test_unlike_texts_of_a_template_stay(spark):
    texts = template(600, 60)
    kept = {r.doc_id for r in sh.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept >= set(range(600)) and len(kept) <= 602
    assert max(jaccard(texts[i], texts[j]) for i in range(100) for j in range(i)) < 0.8


@pytest.mark.parametrize("hashes", [10**6, 900])
def test_links_are_of_alike_sets(spark, hashes):
    texts = corpus() + template(20, 20)
    ids = [i for i, t in enumerate(texts) if t and t.strip()]
    docs = spark.createDataFrame([(i, texts[i]) for i in ids], "doc_id long, text string")
    members = sh.fingerprints(docs, 5, 512, distinct=True).selectExpr("doc_id as node", "0L as cluster", "fp", "size")
    got = {(r.a, r.b) for r in sh.alike_links(members, docs, 5, 0.8, 512, 512, hashes=hashes).collect()}
    alike = {(i, j) for i in ids for j in ids if i < j and jaccard(texts[i], texts[j]) >= 0.8}
    assert got <= alike and 30 < len(got) < len(alike) + 1
    root = {i: i for i in ids}
    for i, j in sorted(got):
        root = {k: root[i] if r == root[j] else r for k, r in root.items()}
    assert all(root[i] == root[j] for i, j in alike)


def test_one_shingle_over_and_over_hides_no_difference(spark):
    rng, words = random.Random(9), vocabulary()
    texts = [" ".join(["so"] * 300 + [rng.choice(words) for _ in range(80)]) for _ in range(6)]
    assert sh.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 6


def test_a_bucket_is_compared_in_full():
    rng = np.random.default_rng(6)
    fps = rng.integers(0, 1 << 64, (300, 8), dtype=np.uint64)
    fps[200:] = fps[100:200] ^ np.uint64(1)
    key, label = np.repeat([1, 2], [150, 150]), np.arange(300)
    key[100:] = 2
    label[250:] = label[150:200]
    found = [(int(x), int(y)) for a, b in sh.joining_pairs(key, label, fps, 8, 1) for x, y in zip(a, b)]
    assert sorted(found) == [(i, i + 100) for i in range(100, 150)]
    assert not list(sh.joining_pairs(key[:0], label[:0], fps[:0], 8, 1))
    same = np.repeat(fps[:1], 40, axis=0)  # all pairs are near: a tree is told
    assert sum(len(a) for a, _ in sh.joining_pairs(np.zeros(40, int), np.arange(40), same, 8, 8)) == 39


def test_gear_hash_is_the_recurrence():
    raw = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    h = 0
    for i, b in enumerate(raw.tolist()):
        h = ((h << 1) + int(ck.GEAR[b])) % 65536
        assert h == int(ck.gear_hashes(raw)[i])


def test_cuts_shift_with_insertions():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 122, 5000).astype(np.uint8)
    a, b = set(ck.cuts(raw)), {c - 7 for c in ck.cuts(np.r_[raw[:100], rng.integers(97, 122, 7).astype(np.uint8), raw[100:]])}
    assert len(a & b) > 0.9 * len(a)
    ends = [0, *ck.cuts(raw)]
    assert ends[-1] == 5000 and max(np.diff(ends)) <= ck.MOST and min(np.diff(ends)[:-1]) >= ck.LEAST
    assert ck.cuts(raw[:0]) == [] and ck.cuts(raw[:3]) == [3]


def brute_runs(rows):
    where = defaultdict(set)
    for d, t in rows:
        digests, ends, words = ck.chunk_text(t or "")
        for k, a, b, w in zip(map(bytes, digests), [0, *ends], ends, words.tolist()):
            where[k].add((d, a, b, w))
    again = defaultdict(list)
    for places in where.values():
        keeper = min(places)[0]
        for d, a, b, w in places:
            if d != keeper:
                again[d].append((a, b, w))
    out = {}
    for d, spans in again.items():
        runs = []
        for a, b, w in sorted(spans):
            if runs and a <= runs[-1][1]:
                runs[-1] = (runs[-1][0], b, runs[-1][2] + w)
            else:
                runs.append((a, b, w))
        if runs := [r for r in runs if r[2] >= ck.MIN_WORDS]:
            out[d] = (",".join(f"{a}:{b}" for a, b, _ in runs), sum(r[2] for r in runs))
    return out


def test_repeated_runs(spark):
    texts = corpus()
    df = frame(spark, texts)
    got = {r.doc_id: (r.spans, r.repeated_words) for r in ck.chunk_report(df.repartition(3)).collect() if r.spans}
    assert got == brute_runs([(3 * i, t) for i, t in enumerate(texts)]) and len(got) > 10
    done = {r.doc_id: r.text for r in ck.remove_repeats(df).collect()}
    for i, t in enumerate(texts):
        assert (3 * i in got) or done[3 * i] == t
    shared = texts.index(None) - 4  # the passage's first holder keeps it
    sizes = [len((done[3 * (shared - 1 + k)] or "").split()) for k in range(4)]
    whole = [len(texts[shared - 1 + k].split()) for k in range(4)]
    assert all(w - s >= 40 for s, w in list(zip(sizes, whole))[1:])
    assert done[None] == "no id" and ck.remove_repeats(df.limit(0)).count() == 0
    assert ck.without_spans("uno dos tres", [(2, 9)]) == "uno tres"


def vectors(spark, x, ids=None):
    rows = [(int(i), [float(v) for v in r], 1) for i, r in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def brute_nearest(x, ids, k=20):
    out = {}
    for q, i in zip(x, ids):
        if i % 20 == 0:
            s = (x * q).sum(axis=1)
            out[i] = [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
    return out


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, scaled):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 24))[rng.integers(0, 30, 3000)] + 0.6 * rng.normal(size=(3000, 24))
    x = (x * rng.uniform(0.5, 2, (3000, 1)) if scaled else x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(float)
    want = brute_nearest(x, np.arange(3000))
    got = defaultdict(list)
    for r in pg.nearest_neighbours(vectors(spark, x), shard=1000).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in w}) for q, w in want.items())
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == 20 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        for v, s in found:
            assert s == pytest.approx(float(x[v] @ x[q]), abs=1e-12)


def test_groups_of_shards_find_the_same(spark):
    rng = np.random.default_rng(6)
    rows = pg.usable(vectors(spark, rng.normal(size=(900, 8))), "vec_id", "embedding").unionByName(pg.usable(vectors(spark, rng.normal(size=(40, 8))), "vec_id", "embedding"))
    index, shards = pg.build_index(rows, 60)
    queries = rows.where("vec_id % 20 = 0")
    one, all_ = ({tuple(r) for r in pg.search_index(index, shards, queries, 7, group_bytes=n).collect()} for n in (1, 1 << 30))
    assert shards == 16 and one == all_ and len(one) == 45 * 7


def test_ties_and_odd_vectors(spark):
    x = np.array([[1.0, 0], [1, 0], [1, 0], [0, 1], [-1, 0]])
    rows = [(i * 10, [float(v) for v in r], 1) for i, r in enumerate(x)]
    odd = [(100, None, 1), (120, [0.0, 0.0], 1), (140, [float("nan"), 1.0], 1), (160, [None, 1.0], 1), (180, [1.0], 1), (None, [1.0, 1.0], 1), (40, [-1.0, 0.0], 1), (200, [], 1), (220, [float("inf"), 1.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in pg.nearest_neighbours(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert dict(got) == {0: [(1, 10, 1.0), (2, 20, 1.0), (3, 30, 0.0), (4, 40, -1.0)], 20: [(1, 0, 1.0), (2, 10, 1.0), (3, 30, 0.0), (4, 40, -1.0)], 40: [(1, 30, 0.0), (2, 0, -1.0), (3, 10, -1.0), (4, 20, -1.0)]}
    assert pg.nearest_neighbours(df.limit(0)).count() == 0
    assert pg.nearest_neighbours(vectors(spark, np.ones((3000, 3)))).where("rank = 1 and query_id > 0 and vec_id <> 0").count() == 0


def test_stages_beside_clashing_names(spark):
    text = " ".join(vocabulary(120))
    names = ["_gone", "_id", "_spans", "_cut", "_fp", "_n", "key", "node", "spans", "words", "begin", "place"]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, text, len(text), *names), (2, text + " tail", len(text) + 5, *names), (3, None, None, *[None] * len(names)), (None, text, 9, *names)]
    df = spark.createDataFrame(rows, schema)
    kept = {r.doc_id: r for r in sh.deduplicate(df).collect()}
    assert set(kept) == {1, 3, None} and tuple(kept[1])[3:] == tuple(names)
    cut = {r.doc_id: r for r in ck.remove_repeats(df).collect()}
    assert cut[1].text == text and len(cut[2].text) < 60 and cut[2].n_chars == len(cut[2].text) and tuple(cut[2])[3:] == tuple(names)
    assert cut[3].text is None and cut[None].text == text
