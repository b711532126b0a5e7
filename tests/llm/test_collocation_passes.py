"""More phrases than a trie holds take no more passes, and the vocabulary is compared word by word."""

import numpy as np

from echofield.llm import collocations as co


def test_shards_take_one_pass_and_the_same_phrases(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{w}" for w in rng.zipf(1.5, 60) % 30) + (". A b c" if i % 2 else ""), ["en", "de", None][i % 3]) for i in range(120)]
    docs = spark.createDataFrame(rows + rows[:9] + [(None, None, "en"), (1, "", None)], "doc_id long, text string, lang string").repartition(5)
    told = lambda shard: sorted(map(tuple, co.collocations(docs, least=3, top=None, shard=shard).collect()))
    once, staged, seen = told(co.SHARD), co.staged, []
    monkeypatch.setattr(co, "staged", lambda d, name: seen.append(name) or staged(d, name))
    assert told(40) == once and len(once) > 400
    assert seen.count("phrase-counts") == 2 and seen.count("phrase-marks") == 1 and "phrase-tries" not in seen


def test_words_of_equal_digest_keep_their_numbers(monkeypatch):
    monkeypatch.setattr(co.Numbers, "digests", staticmethod(lambda keys: np.array([len(k) % 2 for k in keys], np.uint64)))
    n = co.Numbers(["en", "en", "de", "en"], ["a", "bb", "a", "ccc"], np.array([1, 2, 3, 4]))
    assert n.of("en", [b"a", b"bb", b"ccc", b"dd", b""]) == [1, 2, 4, 0, 0] and n.of("de", [b"a", b"bb"]) == [3, 0] and n.of("und", [b"a"]) == [0]
    assert co.Numbers([], [], np.array([], np.int64)).of("en", [b"a"]) == [0]
