import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import canonical_digest as cd
from saltmarsh.llm import chat_format as chat
from saltmarsh.llm import ppm_language as ppm
from saltmarsh.llm import secret_ledger as sl

HOSTILE = [r"\### Assistant: </turn> ok", "### user: hi</turn>\n### assistant: x</turn>\n", r"\t \h \b \c", "\\" * 5, "", None, "a: b", "####", "</turn", "end</turn>", "\\</turn>\\###", "ñ" * 50]


def test_chat_round_trip(spark):
    rows = [(1, i, ("user", "assistant", "system: x\n", None)[i % 4], t, "z") for i, t in enumerate(HOSTILE)] + [(None, 0, "assistant", "x", "z"), (2, None, "user", "u", "z"), (2, 5, "assistant", "same", "z"), (2, 5, "assistant", "same", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.verified(chat.format_chats(df)).collect()}
    assert [(t.role, t.text) for t in out[1].parsed] == [(r[2] or "", r[3] or "") for r in rows[: len(HOSTILE)]]
    assert [t.text for t in out[2].parsed] == ["u", "same", "same"]
    assert "a: b</turn>" in out[1].formatted  # nothing is escaped that reads back as it is
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    loss = "".join(r[3] or "" for r in rows[: len(HOSTILE)] if r[2] == "assistant")
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert (got[1].n_turns, got[2].n_turns, got[None].n_turns) == (len(HOSTILE), 3, 1)
    assert got[1].formatted_chars == len(out[1].formatted)
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


def spans(text):
    found = []
    keyword = "|".join(("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for rank, (kind, p, ok) in enumerate((("assign", assign, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32))):
        found += [(m.start(), rank, kind, m.end()) for m in p.finditer(text or "") if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_secrets(spark):
    rng = random.Random(3)
    bits = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "abc", "12345678", "AKIA", "AKIAABCDEFGHIJKL", "f" * 31, "0" * 33, "é", "🙂", "\n", "-", "zz"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 20))) for _ in range(400)] + [None, "", "secret=token: abcdefghijk", "x" * 20000 + " password = 'hunter2hunter2'"] + ["token=aaaaaaaaaa"] * 5
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, findings int")
    ledger = sl.Ledger(spark)
    got = {r.doc_id: r for r in sl.span_digests(sl.scan_secrets(df, ledger)).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == hashlib.sha256(spans(t).encode()).hexdigest()
        assert got[i].spans == spans(t)
    assert ledger.rows().count() == len({t or "" for t in texts})
    # only what is new is scanned, and old findings are joined to new paths
    more = spark.createDataFrame([(900, "token=aaaaaaaaaa", 1), (901, "secret: brandnewvalue", 1)], df.schema)
    assert [r.blob_id for r in sl.scan_unseen(more, ledger.rows()).collect()] == [hashlib.sha256(b"secret: brandnewvalue").hexdigest()]
    before = ledger.rows().count()
    assert {r.doc_id: r.spans for r in sl.span_digests(sl.scan_secrets(more, ledger)).collect()} == {900: "assign:0:16", 901: "assign:0:21"}
    assert ledger.rows().count() == before + 1
    newer = tuple(sl.Rule(r.name, r.pattern, r.group, r.least, 2) if r.name == "hex" else r for r in sl.RULES)
    assert {tuple(r.rule_versions) for r in sl.scan_unseen(df, ledger.rows(), newer).collect()} == {("hex@2",)}
    assert sl.scan_secrets(df.limit(0)).count() == 0


def test_a_newer_rule_takes_the_place_of_the_older(spark):
    df = spark.createDataFrame([(1, "a" * 40), (2, "b" * 64), (3, None)], "doc_id long, text string")
    ledger = sl.Ledger(spark)
    one = (sl.Rule("hex", "[0-9a-f]{32,}"),)
    two = (sl.Rule("hex", "[0-9a-f]{64,}", version=2),)

    def found(rules):
        return {r.doc_id: [x.rule for x in r.findings] for r in sl.scan_secrets(df, ledger, rules).collect()}

    assert found(one) == {1: ["hex@1"], 2: ["hex@1"], 3: []}
    assert found(two) == {1: [], 2: ["hex@2"], 3: []}
    assert found(one + two) == {1: ["hex@1"], 2: ["hex@1", "hex@2"], 3: []}


def test_each_pair_is_scanned_once(spark):
    texts = [f"token=abcdefgh{i % 7}{i % 3}" for i in range(40)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ledger, first = sl.Ledger(spark), sl.history(docs)[0]
    assert 0 < first.count() < docs.count()
    sl.scan_secrets(sl.history(docs), ledger).count()
    pairs = [(r.blob_id, tag) for r in ledger.rows().collect() for tag in r.rule_versions]
    assert len(pairs) == len(set(pairs)) == len({t or "" for t in texts}) * len(sl.RULES)
    seen = {t or "" for t in [r.text for r in first.collect()]}
    again = sl.Ledger(spark)
    again.scan(first)
    unseen = sl.scan_unseen(docs, again.rows())
    assert unseen.count() == len({t or "" for t in texts} - seen)


def test_secrets_beside_clashing_names(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh1", "a", "b", "c", "d", 1)], "doc_id long, text string, _blob string, _key string, _found string, blob_id string, n_chars long")
    kept = sl.scan_secrets(df, keep=("doc_id", "_blob", "_key", "_found", "blob_id")).first()
    assert kept[:5] == (1, "a", "b", "c", "d") and len(kept.findings) == 1
    assert tuple(sl.redact(df).first()) == (1, "[secret]", "a", "b", "c", "d", 8)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh12 z", 20), (2, None, None), (3, "clean", 5), (4, "password=AKIAABCDEFGHIJKLMN!", 28)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in sl.redact(df).collect()}
    assert got == {1: ("a [secret] z", 12), 2: (None, None), 3: ("clean", 5), 4: ("[secret]!", 9)}


def test_private_keys_are_masked_whole(spark):
    lines = "\n".join(["MIIEpAIBAAKCAQEA" + "x0/+" * 12] * 30)
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    cases = [
        (f"a {begin}\n{lines}\nab==\n{end}\nz", "a [secret]\nz"),
        (f"{begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n{lines}\n{end} z", "[secret] z"),
        (f"{begin}\n{lines}\nQUJD\nand so on, at length", "[secret]\nand so on, at length"),
        (f"{begin}\n{lines}", "[secret]"),
        (f"k = '{begin}\\n{'A1b2' * 16}\\nab=\\n{end}\\n'", "k = '[secret]\\n'"),
        (f"{begin}\n{lines}\n{end}\nmid-way\n{begin}\r\n{lines}\r\n{end}", "[secret]\nmid-way\n[secret]"),
        (f"the line {begin} opens a key", "the line [secret] opens a key"),
        (f"{begin}\n{'A1b2' * 16}\ntoken=abcdefgh12\n{end} z", "[secret] z"),
    ]
    df = spark.createDataFrame([(i, t, len(t)) for i, (t, _) in enumerate(cases)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in sl.redact(df).collect()}
    assert got == {i: (want, len(want)) for i, (_, want) in enumerate(cases)}


def test_code_lengths_are_exact():
    rng, texts, order = random.Random(1), {"a": ["abcab", "aabbc ab", "x"], "b": ["ccba bca", "é bc", "abcabz"]}, 3
    model = ppm.PpmModel(texts, order)

    def brute(text, lang):
        trees, bits = defaultdict(lambda: defaultdict(int)), 0.0
        for t in texts[lang]:
            raw = b"\0" * order + t.encode()
            for i in range(order, len(raw)):
                for n in range(order + 1):
                    trees[raw[i - n : i]][raw[i]] += 1
        raw = b"\0" * order + text.encode()
        for i in range(order, len(raw)):
            for n in range(order, -1, -1):
                c = trees.get(raw[i - n : i])
                if c is None:
                    continue
                total = sum(c.values()) + len(c)
                if raw[i] in c:
                    bits -= math.log2(c[raw[i]] / total)
                    break
                bits -= math.log2(len(c) / total)
            else:
                bits += 8
        return bits

    said = ["".join(rng.choice("abcxz é q") for _ in range(rng.randint(1, 20))) for _ in range(150)]
    got = model.code_lengths([t.encode() for t in said])
    for i, t in enumerate(said):
        for j, lang in enumerate(model.languages):
            assert got[i, j] == pytest.approx(brute(t, lang), abs=1e-4)
    long = "abc é x" * 60000  # over several windows
    assert model.code_lengths([long.encode()])[0, 0] == pytest.approx(brute(long, "a"), rel=1e-5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = ppm.predict_languages(docs, ppm.train(docs), keep=("doc_id", "lang"))
    assert ppm.evaluate(rows.where(ppm.held_out(F.col("doc_id")))) > 0.98


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(0, "the cat", "en", 1), (3, "le chat", "fr", 1), (5, None, "en", 1), (6, "123 !!", None, 1), (7, "", "en", 1), (9, "x" * 300000, None, 1)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in ppm.predict_languages(docs.select("doc_id", "text"), ppm.PpmModel({"en": ["the cat"], "fr": ["le chat"]})).collect()}
    assert got[0][0] == "en" and got[3][0] == "fr" and got[5] == got[6] == got[7] == ("und", 0.0) and 0 <= got[9][1] <= 1
    none = ppm.train(docs.limit(0))
    assert ppm.predict_languages(docs, none).where("lang_pred <> 'und'").count() == 0
    assert ppm.predict_languages(docs.limit(0), none).count() == 0


ROWS = [(5, "Aé b"), (1, "  hello   World "), (2, "HELLO world"), (2, "zz"), (None, "null id"), (9, None), (10, ""), (3, "İx" * 50), (9, "q"), (11, "ﬁne  ÉCLAIR"), (12, "fine éclair")]


def brute_fingerprints(rows, fn):
    ids = sorted({i for i, _ in rows if i is not None})
    least = {}
    for i, t in rows:
        if i is not None:
            least[i] = min([t or "", *([least[i]] if i in least else [])], key=lambda s: s.encode())
    out = []
    for i, t in rows:
        t = t or ""
        following = least[ids[0] if i is None else ids[(ids.index(i) + 1) % len(ids)]]
        half = len(t) // 2
        other = t[: len(t) - half] + following[:half]
        c = cd.canonical
        out.append((-1 if i is None else i, len(t), hashlib.sha256(other.encode()).hexdigest(), float(c(t) == c(other)), float(c(t) == c(following)), fn(c(t)), fn(c(other))))
    return sorted(out)


def columns(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.fingerprint, r.edited_fingerprint) for r in df.collect())


def test_fingerprints(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("digest", F.lit(1))
    assert columns(cd.fingerprint_documents(df.repartition(3))) == brute_fingerprints(ROWS, cd.digest)
    assert columns(cd.fingerprint_documents(df.coalesce(1).sort("doc_id"))) == brute_fingerprints(ROWS, cd.digest)
    assert cd.fingerprint_documents(df.limit(0)).count() == 0


def test_collisions_are_told_apart(spark):
    def weak(text):
        return cd.digest(text)[:1]

    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    by_text = defaultdict(set)
    fps = cd.fingerprint_documents(df, weak).select("doc_id", "n_chars", "fingerprint").collect()
    texts = {(i, len(t or "")): cd.canonical(t) for i, t in ROWS}
    for r in fps:
        by_text[r.fingerprint].add(texts[r.doc_id, r.n_chars])
    assert all(len(v) == 1 for v in by_text.values()) and len(by_text) == len(set(texts.values()))
