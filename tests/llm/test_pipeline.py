import itertools
import re
import zlib
from array import array

import pytest
import regex
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from saltmarsh.llm import common, queries, secret_ledger
from saltmarsh.llm.common import vocabulary


def test_pipeline(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids, names = [], set(docs.columns)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.01")
        if name != "best_fit_packing":
            assert set(docs.columns) == names, name
            ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert ids[0] >= ids[1] >= ids[2] == ids[3] and len(ids[0]) > 950 and 850 < len(ids[1]) < 960
    assert {r.doc_id for r in docs.select("doc_id").collect()} == ids[3]


def shingles(text):
    w = (text or "").encode().lower().split()  # only A-Z are lower-cased in bytes
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return bool(a | b) and len(a & b) >= 0.8 * len(a | b) - 1e-9


def test_stages_against_brute_force(spark):
    """Each stage's output on all documents of the smallest table, against a plain computation over its own input."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, df):
        out = stages[name](spark, df, sf_dir)
        return out, {r.doc_id: r for r in out.collect()}

    before = {r.doc_id: r for r in docs.collect()}
    docs, now = run("language_id", docs)
    assert set(now) == {d for d, r in before.items() if regex.search(r"\p{L}", r.text or "")}

    sets = {d: shingles(r.text) for d, r in now.items()}
    root = {d: d for d in now}
    for a, b in itertools.combinations(sorted(now), 2):
        if root[a] != root[b] and alike(sets[a], sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
    docs, kept = run("simhash_near_dedup", docs)
    assert set(kept) == {d for d, r in root.items() if d == r} and len(kept) < len(now)

    docs, cut = run("substring_dedup", docs)
    assert set(cut) == set(kept)

    def windows(rows, n):
        where = {}
        for d, r in sorted(rows.items()):
            w = (r.text or "").split()
            for i in range(len(w) - n + 1):
                where.setdefault(tuple(w[i : i + n]), set()).add(d)
        return {d for k, ds in where.items() if len(set(k)) > 5 for d in sorted(ds)[1:]}

    assert windows(kept, 60) and not windows(cut, 60)
    short = windows(kept, 30)
    for d, r in cut.items():  # what no other document holds stays, word by word
        assert r.n_chars == len(r.text) and (r.text == kept[d].text or d in short)

    docs, clean = run("secret_scans", docs)
    base = [(r.pattern, r.group, r.least) for r in secret_ledger.RULES]
    for d, r in clean.items():
        hits = [m for p, g, n in base for m in re.finditer(p, cut[d].text or "") if len(m[g]) >= n]
        assert (r.text != cut[d].text) == bool(hits)
        assert not [m for p, g, n in base for m in re.finditer(p, r.text or "") if len(m[g]) >= n]

    library = Tokenizer.from_str(vocabulary("word_bpe_49k.json").decode())
    library.no_truncation()
    pieces = stages["best_fit_packing"](spark, docs, sf_dir).collect()
    want = {d: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for d, r in clean.items()}
    for d in want:
        own = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.piece)
        assert [p.start for p in own] == list(range(0, len(want[d]), 2048))
        for p in own:
            ids = want[d][p.start : p.start + 2048]
            assert p.length == len(ids) and p.ids_crc32 == zlib.crc32(array("I", ids).tobytes())
    for _, group in itertools.groupby(sorted(pieces, key=lambda p: (p.sequence_id, p.offset)), key=lambda p: p.sequence_id):
        at = 0
        for p in group:
            assert p.offset == at
            at += p.length
        assert at <= 2048


def test_pipeline_beside_clashing_names(spark):
    names = ["_lang", "_score", "_gone", "_id", "_spans", "_cut", "_found", "_hit", "_key", "_blob", "blob_id", "spans", "lang_pred", "score", "fp", "node", "_Lang_"]
    schema = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    text = "the cat sat on the mat and looked at the dog that slept there all day long " * 4
    rows = [(i, f"{text} number {i % 3} token=abcdefgh{i % 3}", "en", 9, *names) for i in range(6)] + [(9, "le chat est sur la table avec le chien", "fr", 9, *names)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "n_chars", *names], name
        assert all(tuple(r)[4:] == tuple(names) for r in docs.collect()), name
    assert docs.where("text like '%token=%'").count() == 0
    assert corpus_pipeline.packing(spark, docs, "").count() == docs.count()


def test_tables_are_deleted(spark):
    before = common.tables_made()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = common.tables_made() - before
    assert left == {out.stored_at} and out.count() > 100
    common.release(spark, [out])
    assert common.tables_made() == before


def test_pipeline_on_nothing(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_pipeline_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(0, "the cat sat on the mat", "en", None, 22, "s"), (3, "le chat est sur la table", "fr", "x", 24, None), (6, None, None, None, None, None), (None, "the cat sat", None, None, 11, None), (6, "the", "en", "a", 3, None)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    assert docs.where("text is null").count() == 0


def test_language_stage_rejects_what_no_language_explains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = ["Съешь ещё этих мягких французских булок, да выпей же чаю. " * 5, "qzxv kjwq pfgh xxqj zvbn mnkl wqrt ypsd fghj " * 5, "素早い茶色の狐がのろまな犬を飛び越える。" * 5]
    more = spark.createDataFrame([(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(strange)], "doc_id long, text string, lang string, source string, n_chars long").select(*docs.columns)
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs.unionByName(more), "").select("doc_id").collect()}
    clean = {r.doc_id for r in docs.where(docs.text.rlike(r"\p{L}")).select("doc_id").collect()}
    assert kept == clean


@pytest.mark.parametrize("n", range(1, 11))
def test_registered(n):
    assert len([q for q in __spark_entry__.queries() if q.startswith(f"op{n}_")]) == 1
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(tuple(str(r[c]) for c in names) for r in df.collect()) == sorted(tuple(map(str, r)) for r in want.fetchall())
