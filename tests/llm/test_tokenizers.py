import hashlib
import random
import zlib
from array import array

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Tokenizer

from saltmarsh.llm import sentencepiece_codec as sp
from saltmarsh.llm.common import vocabulary
from saltmarsh.llm.token_counts import count_tokens
from saltmarsh.llm.vector_packing import VectorBestFit, pack_documents
from saltmarsh.llm.word_bpe import IdCache, LengthCache, WordEncoder

WORDS = vocabulary("word_bpe_49k.json")
PIECES = vocabulary("piece_bpe_32k.model")
TEXTS = ["", None, "Hello, world! it's 12 o'clock", "a" * 5000, "<|endoftext|> x<|endoftext|>y", "Über die Brücke — ça va?", "日本 語\x1cn\x85o\n\n", "word " * 3000, "<s></s> ▁▁ \x00", "same", "same"]


def soup(seed, n, plain=False):
    rng = random.Random(seed)
    pool = list("aB'sé ÀßΣς́İı\x1c\x85  \u200b日7½\n\t_-.Ⅷ!🙂▁<>/") + ["'ll", "<|endoftext|>", "the", "  ", "�"]
    if plain:  # what is split without the library
        pool = list("aBcÑ'sé ÀßÿØ7\n\t\v\f\r_-.!<>/|\"§"[:-1]) + ["'ll", "'re", "'T", "''", "the", "ing", "  "]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


def test_word_ids_equal_the_library():
    encoder, library = WordEncoder(WORDS), Tokenizer.from_str(WORDS.decode())
    ids, lengths = IdCache(encoder, {}, 20_000), LengthCache(encoder, {"the": 1}, 20_000)
    for t in soup(1, 1500) + soup(3, 1500, plain=True) + [t or "" for t in TEXTS]:
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.encode(t) == array("I", want).tobytes()
        assert lengths.count(t) == len(want)


def test_counts(spark):
    library = Tokenizer.from_str(WORDS.decode())
    got = {r.doc_id: r for r in count_tokens(frame(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)
    assert count_tokens(frame(spark, [])).count() == 0


@pytest.mark.parametrize("by_library", [True, False])
def test_pieces_equal_the_library(by_library):
    codec, library = sp.Codec(PIECES, 20_000, by_library), sentencepiece.SentencePieceProcessor(model_proto=PIECES)
    texts = soup(2, 1500) + [t or "" for t in TEXTS] + ["a" * 3000 + " " * 400 + "é" * 99]
    for at in range(0, len(texts), 100):
        codec.warm([codec.segmented(t)[0] for t in texts[at : at + 100]])
        for t in texts[at : at + 100]:
            ids, spans = codec.encode_spans(t)
            assert ids == codec.encode(t) == library.encode(t)
            assert codec.decode(ids) == library.decode(ids)
            assert spans == [(p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]


@pytest.mark.parametrize("by_library", [True, False])
def test_spans_of_unknown_characters(by_library):
    proto = pb.ModelProto()
    proto.ParseFromString(PIECES)
    proto.trainer_spec.byte_fallback = False
    for p in proto.pieces:
        if p.type == sp.BYTE:
            p.type = sp.UNUSED
    model = proto.SerializeToString()
    codec, library = sp.Codec(model, by_library=by_library), sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["a🙂b 日本語 ꙮꙮ x", "\x01 é\x02", "🙂"] + soup(6, 300)
    codec.warm([codec.segmented(t)[0] for t in texts])
    for t in texts:
        want = [(p.id, p.begin, p.end) for p in library.encode(t, return_type="proto").pieces]
        ids, spans = codec.encode_spans(t)
        merged = []  # the library joins unknown neighbours
        for i, (a, b) in zip(ids, spans):
            if merged and i == codec.unknown == merged[-1][0]:
                merged[-1] = (i, merged[-1][1], b)
            else:
                merged.append((i, a, b))
        assert merged == want


def test_decoding_any_ids():
    codec, library, rng = sp.Codec(PIECES), sentencepiece.SentencePieceProcessor(model_proto=PIECES), random.Random(4)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 258), 29871, rng.randint(259, 31999)]) for _ in range(6)]
        assert codec.decode(ids) == library.decode(ids)


def test_compiled_character_map():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    own, rng = sp.Normalizer(proto.normalizer_spec), random.Random(5)
    for _ in range(1500):
        t = "".join(rng.choice("ab  ﬁ①Å Åカ゛ガ\u3000\n\tｶﾞé☃½\u200b") for _ in range(rng.randint(0, 12)))
        out, source = own.normalize(t)
        assert out.decode() == library.normalize(t)
        assert len(source) == len(out) + 1 and list(source) == sorted(source) and source[-1] <= len(t.encode())
    out, source = own.normalize("xﬁ y")  # the ligature's two letters come from its three bytes
    at = out.index(b"fi")
    assert source[at : at + 3].tolist() == [1, 1, 4]


def test_encoded_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=PIECES)
    got = {r.doc_id: r for r in sp.encode_documents(frame(spark, TEXTS)).collect()}
    short = {r.doc_id: r for r in sp.digest_documents(frame(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "")
        assert got[i].ids == ids and got[i].decoded == library.decode(ids)
        assert short[i].n_tokens == len(ids)
        assert short[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert short[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        proto = library.encode(t or "", return_type="proto").pieces
        assert [(s.begin, s.end) for s in got[i].spans] == [(p.begin, p.end) for p in proto]
        assert list(zip(short[i].bounds, short[i].bounds[1:])) == [(p.begin, p.end) for p in proto]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_vector_best_fit_holds_every_constraint(rule):
    import numpy as np

    rng = np.random.default_rng(1)
    length = np.sort(rng.integers(1, 80, 800))[::-1]
    items = np.stack([length, np.ones_like(length), length**2], axis=1)
    capacity, weights = np.array([100, 4, 7000]), np.array([1.0, 0.1, 0.1])
    bins = VectorBestFit(capacity, weights, rule).pack(items)
    for d in range(3):
        assert np.bincount(bins, items[:, d]).max() <= capacity[d]
    # the plain rule: every open bin is looked at for every item
    left, plain = [], []
    for v in items / capacity:
        fits = [i for i, r in enumerate(left) if (r - v >= -1e-12).all()]
        if fits:
            best = min(fits, key=lambda i: (float((((left[i] - v) ** 2) * weights).sum()), i)) if rule == "norm" else max(fits, key=lambda i: (float((left[i] * v * weights).sum()), -i))
            left[best] = left[best] - v
        else:
            left.append(1.0 - v)
            best = len(left) - 1
        plain.append(best)
    assert len(set(bins.tolist())) <= 1.01 * len(left)
    with pytest.raises(ValueError):
        VectorBestFit(capacity, weights).pack(np.array([[101, 1, 1]]))


@pytest.mark.parametrize("options", [{}, {"size": 64, "max_docs": 3, "shard_docs": 4}])
def test_packing(spark, options):
    library, size = Tokenizer.from_str(WORDS.decode()), options.get("size", 2048)
    rows = pack_documents(frame(spark, TEXTS), **options).collect()
    pieces = {}
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            pieces[i, k] = (at, len(part), zlib.crc32(array("I", part).tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == pieces and len(rows) == len(pieces)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append(r)
    for b in bins.values():
        b.sort(key=lambda r: r.offset)
        assert [r.offset for r in b] == [sum(x.length for x in b[:i]) for i in range(len(b))]
        assert sum(r.length for r in b) <= size and len(b) <= options.get("max_docs", size)
    assert pack_documents(frame(spark, []), **options).count() == 0
