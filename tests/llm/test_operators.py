"""Every operator on a small table of awkward rows and on an empty one, against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import llm_data as data
from echofield.llm import bpe, bwt, cotraining, exact_dedup, language, lsh_forest, maxent, mixing, token_cache, topk
from echofield.llm.common import ARROW_BYTES, ARROW_LIMIT, staged

ROWS = data.rows()


@pytest.fixture(scope="module")
def docs(spark):
    return staged(data.frame(spark).repartition(3), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return data.frame(spark, [])


def same(got, want):
    assert Counter(map(str, got)) == Counter(map(str, want))


def test_exact_dedup(docs, empty):
    groups = defaultdict(list)
    for r in ROWS:
        groups[re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "")].append(r)
    want = []
    for g in groups.values():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        want += [(r[0], best, len(g), r[0] == best) for r in g]
    same([tuple(r) for r in exact_dedup.exact_dedup(docs).collect()], want)
    same([tuple(r) for r in exact_dedup.exact_dedup(docs, table_bits=6 + 1).collect()], want)
    assert exact_dedup.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("threshold", [85, 60])
def test_near_dedup(docs, empty, threshold):
    want = [(r[0], n, c, r[0] == c) for r, (n, c) in zip(ROWS, data.near_components(ROWS, threshold))]
    same([tuple(r) for r in lsh_forest.near_dedup(docs, threshold=threshold).collect()], want)
    assert lsh_forest.near_dedup(empty).count() == 0


def test_near_dedup_of_a_large_family(spark):
    """Hundreds of near copies of one text and as many texts with a common passage: the right links and no others."""
    base, passage = data.text(1, 300).split(), data.text(2, 60)
    rows = [(i, " ".join(base[: i % 290] + [f"w{i}"] + base[i % 290 + 1 :])) for i in range(300)]
    rows += [(1000 + i, data.text(5000 + i, 200) + " " + passage) for i in range(300)]
    got = {r.doc_id: r.component_id for r in lsh_forest.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)).collect()}
    want = {r[0]: c for r, (_, c) in zip(rows, data.near_components(rows))}
    assert got == want


@pytest.mark.parametrize("block", [4096, 64])
def test_near_dedup_of_a_base_and_its_versions(spark, monkeypatch, block):
    """Versions are linked to their base only, which has more of them than its neighbours in all trees."""
    monkeypatch.setattr(lsh_forest, "HOT_BLOCK", block)
    base = data.text(1, 404)
    rows = [(0, base), *[(i, base + " " + " ".join(f"v{i}x{k}" for k in range(50))) for i in range(1, 601)]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_dedup(frame).collect()}
    sets = [set(lsh_forest.shingles(t).tolist()) for _, t in rows]
    linked = lambda s, t: 100 * len(s & t) >= 85 * len(s | t)
    assert all(linked(sets[0], s) for s in sets) and not any(linked(sets[i], sets[i + 1]) for i in range(1, 600))
    assert set(got.values()) == {0} and len(got) == 601


@pytest.mark.parametrize("hot", [2_000, 1])
def test_repeated_passages(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(bwt, "HOT_STRINGS", hot)
    monkeypatch.setattr(bwt, "BATCH_BYTES", 4_000)
    want = [(r[0], len((r[1] or "").encode()), s, rest) for r, (s, rest) in zip(ROWS, data.covered([r[1] for r in ROWS], 200))]
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.rest)) for r in bwt.repeated_passages(docs).collect()]
    same(got, want)
    assert bwt.repeated_passages(empty).count() == 0


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(bwt, "BLOCK_BYTES", 1000)
    b = np.frombuffer((data.text(3, 900) + "zz " * 700).encode(), np.uint8)
    covered = np.zeros(len(b) - 199, int)
    for s, n, m, own in bwt.text_runs(b):
        for p, k in zip(s, n):
            covered[p : p + k] += 1
    assert (covered == 1).all()
    monkeypatch.setattr(lsh_forest, "BLOCK_BYTES", 64)
    t = data.text(4, 300) + "\n" + "y" * 200
    pieces = lsh_forest.word_hashes(t)
    monkeypatch.setattr(lsh_forest, "BLOCK_BYTES", 1 << 20)
    assert (pieces == lsh_forest.word_hashes(t)).all() and len(pieces) == len(t.split())


def test_bpe_round_trip(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    want = []
    for r in ROWS:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, tok.decode(ids, skip_special_tokens=False)))
    coded = bpe.round_trip(docs, path)
    same([tuple(r) for r in coded.collect()], want)
    same([tuple(r) for r in bpe.decode(bpe.encode(docs, path), path).collect()], [(i, t) for i, _, t in want])
    assert bpe.round_trip(empty, path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, docs, empty, name):
    from echofield.sources.tables import shared_folder

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    want = [(r[0], len((r[1] or "").encode()), count(r[1] or "")) for r in ROWS]
    cache = shared_folder(spark, "test-cache")
    same([tuple(r) for r in token_counts(docs, path, cache)], want)
    kept = spark.read.parquet(cache)
    # Rows that repeat an id and a text are the only contents that may be encoded twice.
    stored = kept.count()
    assert kept.select("content").distinct().count() == len({r[1] or "" for r in ROWS}) and stored <= len({*ROWS}) + 2
    # A second run adds only what is new.
    more = docs.unionByName(docs.limit(1).withColumn("text", F.lit("entirely new words")))
    assert len(token_counts(more, path, cache)) == len(ROWS) + 1 and spark.read.parquet(cache).count() == stored + 1
    assert token_counts(empty, path, shared_folder(spark, "test-cache")) == []


def token_counts(docs, path, cache):
    return token_cache.token_counts(docs, path, cache).collect()


def test_inner_cuts():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t = data.text(8, 500) + "  two  blanks\n\nand lines " * 40
    parts = list(token_cache.inner_cuts(t, 50))
    assert "".join(parts) == t and len(parts) > 20
    assert sum(len(tok.encode(p).ids) for p in parts) == len(tok.encode(t).ids)


def test_mixing(docs, empty):
    got = mixing.mix(docs, keep=("source",)).collect()
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(data.lowered(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    assert len(got) == len(ROWS)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(math.isclose(r.target, target[s], rel_tol=1e-9) and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max((r.size for r in mine), default=0) / 2 + 1
    assert all(r.taken == r["size"] * r.copies and 0 <= r.copies <= 2 for r in got)
    same(got, mixing.mix(docs.repartition(7), keep=("source",)).collect())
    assert mixing.mix(empty).count() == 0


def test_language(docs, empty):
    got = language.identify(docs, F.lit(True)).collect()
    assert len(got) == len(ROWS)
    told = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(told[i].lang_pred == ("en" if i % 3 else "fr") for i in range(24))
    assert [told[i].lang_pred for i in (200, 201, 202, 203)] == ["und"] * 4 and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert {r.lang_pred for r in language.identify(docs, F.col("lang") == "en").collect()} == {"und", "en"}
    assert language.identify(empty, F.lit(True)).count() == 0


def test_codewords():
    for n in (2, 3, 4, 6, 12, 40):
        m = language.codewords(n)
        apart = [(m[i] != m[j]).sum() for i in range(n) for j in range(i)]
        assert m.shape[0] == n and min(apart) >= m.shape[1] / 4 and (np.abs(m.sum(0)) < n).all()


def test_gram_counts_over_blocks(monkeypatch):
    t = data.text(6, 200, "fr")
    whole = language.gram_counts(t)
    n = len(t.lower().encode())
    assert whole.sum() == 3 * n - 3


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(24)] + [(5, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    model = cotraining.train(docs, labels)
    got = cotraining.score(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.kept == (r.score >= 0.5) for r in got)
    none = cotraining.train(docs, labels.limit(0))
    assert {r.score for r in cotraining.score(docs, none).collect()} == {0.5}
    assert cotraining.train(empty, labels) is None and cotraining.score(empty, model).count() == 0
    one = cotraining.train(docs, labels.filter("doc_id = 3"))
    assert cotraining.score(docs, one).count() == len(ROWS)


def test_views_help_each_other():
    """A view that is right about the pool teaches the other, which has too few labels of its own."""
    r = np.random.default_rng(1)
    y = r.integers(0, 2, 3000).astype(float)
    a, b = np.column_stack([y + r.normal(0, 0.2, 3000)]), np.hstack([(y + r.normal(0, 0.8, 3000))[:, None], r.normal(0, 1, (3000, 60))])
    few = np.arange(60)
    hold = few % 4 == 0
    alone = cotraining.fit(a[few], b[few], y[few], hold, a[:0], b[:0], 1)
    both = cotraining.fit(a[few], b[few], y[few], hold, a[100:], b[100:])
    right = lambda m: ((m.meta.odds(b[100:]) > 0) == (y[100:] > 0)).mean()
    assert right(both) > right(alone) + 0.05 and sum(x for x, _ in both.handed) > 0


def test_lm_score(docs, empty):
    learn = F.coalesce(F.col("doc_id"), F.lit(0)) % 5 != 2
    model, counts = maxent.train(docs.filter(learn), key=F.col("doc_id"))
    got = maxent.score(docs, model, counts, keep=("n_chars",)).collect()
    c = Counter()
    for r in ROWS:
        if (r[0] or 0) % 5 != 2:
            c.update([*data.lowered(r[1]), None])
    n, v = sum(c.values()), len(c)
    want = []
    for r in ROWS:
        w = [*data.lowered(r[1]), None]
        want.append((str(r[0]), r[4], len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 5)))
    same([(str(r.doc_id), r.n_chars, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got], want)
    assert all(r.score < 0 for r in got)
    model, counts = maxent.train(empty)
    assert maxent.score(docs, model, counts).count() == len(ROWS) and maxent.score(empty, model, counts).count() == 0


def test_lm_probabilities_add_up(docs):
    model, counts = maxent.train(docs, key=F.col("doc_id"))
    f = maxent.features(*maxent.tokens([r[1] for r in ROWS[:3]]))[5:8]
    for row in f:
        words = np.arange(model.used)
        p = 10 ** maxent.log_prob(model, np.repeat(row[None], model.used + 1, 0), np.append(words, -1))
        assert math.isclose(p.sum(), 1, rel_tol=1e-4)


def test_topk_with_whole_documents_as_queries(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 260))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:6])] + [(None, texts[7]), (3, texts[8])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    index = staged(topk.build_index(docs), "test-index")
    queries = spark.createDataFrame([(i, t) for i, t in rows if i is None or i % 5 == 0] + [(1000, "w1 w2 w2 w3"), (1001, "none " + " ".join(words))], "query_id bigint, text string")
    found = [Counter(topk.terms(t)) for _, t in rows]
    df, mean = Counter(w for x in found for w in x), sum(sum(x.values()) for x in found) / len(rows)
    want = []
    for q, t in queries.collect():
        best = []
        for (i, _), tf in zip(rows, found):
            size = sum(tf.values())
            s = sum(k * math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w, k in Counter(topk.terms(t)).items() if tf[w])
            if s:
                best.append((-round(s, 6), i is None, i or 0, i))
        want += [(q, n + 1, b[3], -b[0]) for n, b in enumerate(sorted(best, key=lambda b: b[:3])[:7])]
    assert max(len(set(topk.terms(t))) for _, t in rows) > topk.LONG_QUERY
    same([tuple(r) for r in topk.search(index, queries, 7).select("query_id", "rank", "id", "score").collect()], want)


def test_topk_sends_the_postings_of_a_shard_seldom():
    # documents as queries: 12,800 of 256,000; blocks of 256 sent every shard's postings fifty times
    assert topk._query_blocks(12_800, 32, 6) == 2 and topk._query_blocks(128_000, 320, 12) == 16
    assert topk._query_blocks(2_564, 1, 6) == 11 and topk._query_blocks(0, 0, 6) == 1


def test_whole_postings_are_as_cursors_find():
    rng = np.random.default_rng(4)
    size = rng.integers(50, 90, 400).astype(np.int32)
    kept, cursors = [], []
    for w in rng.random(80):
        at = np.flatnonzero(rng.random(400) < 0.3).astype(np.int32)
        tf = rng.integers(1, 5, len(at)).astype(np.int32)
        kept.append((w, at, topk._impact(1.0, tf, size[at], float(size.mean()))))
        starts, _ = topk._blocks(np.array([0, len(at)]))
        last = at[np.append(starts[1:], len(at)) - 1]
        parts = (at, tf, last, np.maximum.reduceat(tf, starts), np.minimum.reduceat(size[at], starts))
        cursors.append(topk._Cursor({c: x.astype(np.int32).tobytes() for c, x in zip(topk.PARTS, parts)}, w, size, float(size.mean())))
    assert topk.whole_postings(kept, 400, 10) == topk.block_max_wand(cursors, 10)
    one = np.array([3, 5, 9], np.int32)
    assert topk.whole_postings([(1.0, one, np.array([0.5, 0.5, 0.5]))], 12, 2) == [(0.5, 3), (0.5, 5)]


def test_topk(spark, docs, empty):
    queries = spark.createDataFrame([(1, data.text(4, 34)), (2, "ofthe thing"), (3, None), (4, "absentword"), (None, "ab")], "query_id bigint, text string")
    index = staged(topk.build_index(docs), "test-index")
    got = [(r.query_id, r["rank"], r.id, r.score) for r in topk.search(index, queries, 5).collect()]
    found = [topk.terms(r[1]) for r in ROWS]
    n, mean = len(ROWS), sum(map(len, found)) / len(ROWS)
    want = []
    for q in queries.collect():
        times, best = Counter(topk.terms(q.text)), []
        for r, words in zip(ROWS, found):
            tf, s = Counter(words), 0.0
            for w, k in times.items():
                if tf[w]:
                    df = sum(w in x for x in map(set, found))
                    s += k * math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(words) / mean))
            if s:
                best.append((-round(s, 6), r[0] is None, r[0] or 0, r[0]))
        want += [(q.query_id, i + 1, b[3], -b[0]) for i, b in enumerate(sorted(best, key=lambda b: b[:3])[:5])]
    same(got, want)
    assert topk.search(staged(topk.build_index(empty), "test-index"), queries).count() == 0
    assert topk.search(index, queries.limit(0)).count() == 0


def test_wand_skips_and_stays_exact():
    r = np.random.default_rng(2)
    size = r.integers(20, 200, 5000).astype(np.int32)
    cursors, scores = [], np.zeros(5000)

    def row(at, tf):
        starts, _ = topk._blocks(np.array([0, len(at)]))
        ends = np.append(starts[1:], len(at)) - 1
        parts = at, tf, at[ends], np.maximum.reduceat(tf, starts), np.minimum.reduceat(size[at], starts)
        return {c: x.astype(np.int32).tobytes() for c, x in zip(topk.PARTS, parts)}

    for df in (4000, 1500, 300, 40, 5):
        at = np.sort(r.choice(5000, df, replace=False)).astype(np.int32)
        tf = r.integers(1, 9, df).astype(np.int32)
        w = math.log(1 + 5000 / df)
        cursors.append(topk._Cursor(row(at, tf), w, size, float(size.mean())))
        scores[at] += topk._impact(w, tf, size[at], float(size.mean()))
    want = sorted(((-round(float(s), 6), i) for i, s in enumerate(scores) if s), key=lambda x: x)[:10]
    assert [(-s, d) for s, d in topk.block_max_wand(cursors, 10)] == want


def test_counts_by_hand():
    assert bpe.byte_alphabet()[32] == "Ġ" and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_near_dedup_of_a_common_token(spark, monkeypatch):
    """Thousands of classes that share their rarest shingles: groups larger than a block meet block by block, all of them ask."""
    monkeypatch.setattr(lsh_forest, "HOT_BLOCK", 16)
    monkeypatch.setattr(lsh_forest, "REACH", 1)
    line = " ".join(f"l{i}" for i in range(60))
    rows = [(i, f"{line} " + " ".join(f"v{i // 2}x{k}" for k in range(12)) + f" e{i}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_dedup(frame).collect()}
    assert got == {r[0]: c for r, (_, c) in zip(rows, data.near_components(rows))}


def test_sketches_bound_intersections():
    """No pair over the threshold is ruled out, and most pairs of other texts are."""
    rng = np.random.default_rng(4)
    for n in (3, 40, 700, 40_000):
        s = rng.integers(0, 2**63, n).astype(np.uint64)
        t = np.concatenate([s[: n - n // 10], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
        a, b = (np.frombuffer(lsh_forest.sketch(x), np.uint8).astype(int) for x in (s, t))
        a[a == 255], b[b == 255] = n, n
        assert np.minimum(a, b).sum() >= n - n // 10


def test_lm_weights_do_not_depend_on_worker_reuse(spark):
    """Each task starts from the round's weights, whichever worker it runs in and whatever that worker ran before."""
    docs = spark.createDataFrame([(i, data.text(i, 60)) for i in range(400)], "doc_id bigint, text string").repartition(24, "doc_id")
    docs = staged(docs, "test-docs")
    first, second = (maxent.train(d, key=F.col("doc_id"))[0] for d in (docs, docs))
    assert (first.to_class == second.to_class).all() and (first.to_word == second.to_word).all()
    # The changes of tasks that start from the same weights are averages: as small as one task's.
    whole = maxent.train(docs.coalesce(1), key=F.col("doc_id"))[0]
    assert np.abs(first.to_class).sum() <= 1.5 * np.abs(whole.to_class).sum()


def test_lm_sums_and_words_are_those_of_the_full_lookups():
    rng = np.random.default_rng(8)
    weights = rng.normal(size=(50, 7)).astype(np.float32)
    rows = rng.integers(0, 50, (400, 4))
    assert (maxent._sums(weights, rows) == weights[rows].sum(1)).all()
    known = np.sort(rng.choice(1 << 40, 300, replace=False)).astype(np.uint64)
    word = np.full(300, -1)
    word[rng.choice(300, 20, replace=False)] = np.arange(20)
    none = np.zeros(0)
    for k, w in ((known, word), (known, np.full(300, -1)), (known[:0], word[:0])):
        m = maxent.Model(k, none, w, 1, 1, 1, 1, 1, none, none, 20)
        h = np.concatenate([known, known + np.uint64(1)])
        assert (m.words_of(h) == m.look(h)[1]).all()


def test_only_shingles_that_sets_share_meet_their_groups(spark, monkeypatch):
    met, real = [], lsh_forest.with_group

    def with_group(rows, *how):
        met.append(rows.count())
        return real(rows, *how)

    monkeypatch.setattr(lsh_forest, "with_group", with_group)
    rng = np.random.default_rng(3)
    one = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) for _ in range(40)]
    sets = [*one, np.sort(np.append(one[0][1:], np.uint64(7)))]
    rows = [(lsh_forest.digest(s), s.tobytes(), True) for s in sets]
    roots = spark.createDataFrame([(rows[5][0], rows[5][0])], "node binary, root binary")
    found = lsh_forest.finishing(spark.createDataFrame(rows, "_cls binary, _set binary, _cut boolean"), roots, 85).collect()
    assert [{bytes(r._a), bytes(r._b)} for r in found] == [{rows[0][0], rows[40][0]}]
    assert met[0] <= 70


def test_pipeline_stages_send_long_texts_in_short_batches(spark):
    before = spark.conf.get(ARROW_LIMIT)
    docs = spark.range(1500).coalesce(1).selectExpr("id AS doc_id", "repeat('ab c ', 4000) AS text", "'en' AS lang", "'s' AS source")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    try:
        corpus_pipeline.encode_tokens(spark, docs, "")
        assert docs.select("text").mapInArrow(sizes, "n bigint").agg(F.max("n")).first()[0] <= 2 * ARROW_BYTES
    finally:
        spark.conf.set(ARROW_LIMIT, before)


def test_language_sends_a_kept_text_once(spark):
    docs = spark.createDataFrame([(1, "one two", "en"), (2, None, None)], "doc_id int, text string, lang string")
    told = language.predict(docs, language.train(docs), keep=("text", "lang"))
    assert [(r.doc_id, r.text, r.lang) for r in told.orderBy("doc_id").collect()] == [(1, "one two", "en"), (2, None, None)]
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "_keep0" not in plan.split("MapInArrow")[-1].split("\n", 1)[1]
