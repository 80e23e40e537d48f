import pytest

from saltmarsh import shared
from saltmarsh.llm import common
from saltmarsh.llm.word_bpe import CACHE_BYTES, IdCache, WordEncoder


def test_private_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_Gone int, _gone_ int, b int")
    assert common.private(df, "_gone", "_gone", "_free") == ["_gone__", "_gone___", "_free"]


def test_a_worker_keeps_one_state():
    made = []
    one = common.worker_state("a", lambda: made.append("a") or object())
    assert common.worker_state("a", lambda: made.append("a")) is one
    common.worker_state("b", lambda: made.append("b") or object())
    assert list(common._STATE) == ["b"] and made == ["a", "b"]
    list(common.lean(lambda batches: batches)(iter([])))
    assert not common._STATE


def test_caches_stay_within_their_bytes():
    encoder = WordEncoder(common.vocabulary("word_bpe_49k.json"))
    cache = IdCache(encoder, {}, 100_000)
    for i in range(3000):
        cache.encode(f"word{i}x and q{'abcdefgh'[i % 8] * (i % 50)}")
        assert cache.bytes <= 50_000 and len(cache) + len(cache.old) < 700
    assert CACHE_BYTES <= 128 << 20


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared.shared_dir(Session())
    Context.master = "local[2]"
    assert shared.shared_dir(Session()).startswith("file:///")
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
