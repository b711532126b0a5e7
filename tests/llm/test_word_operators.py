"""Decontamination, collocations and periodic runs against plain Python on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import llm_data as data
from echofield.llm import collocations, contamination, periodic, queries
from echofield.llm.common import staged

ROWS = data.rows()


@pytest.fixture(scope="module")
def docs(spark):
    return staged(data.frame(spark).repartition(3), "test-docs")


@pytest.fixture(scope="module")
def empty(spark):
    return data.frame(spark, [])


def same(got, want):
    assert Counter(map(str, got)) == Counter(map(str, want))


# Decontamination


def leak_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def leaks(docs, items, size=10):
    wins = defaultdict(set)
    for i, t in items:
        w = leak_words(t)
        for j in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[j : j + size])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, who = leak_words(t), set(), set()
        for width in {len(k) for k in wins}:
            for j in range(len(w) - width + 1):
                if tuple(w[j : j + width]) in wins:
                    hit |= set(range(j, j + width))
                    who |= wins[tuple(w[j : j + width])]
        out.append((i, len(w), len(hit), sorted(who)))
    return out


ITEMS = [
    (1, data.text(3, 33, "fr")), (2, data.text(5, 35)[40:160]), (3, data.text(77, 30_000)[5000:5300]), (3, "ab AB ab!"), (4, "a"), (5, "ab " * 14),
    (6, None), (7, ""), (8, " ?! "), (None, data.text(2, 32)), (9, "nowhere " * 12), (10, data.text(5, 35)[40:160]), (11, "ΣΑΣ x y"), (12, data.text(8, 38) + " nowhere else"),
]


@pytest.mark.parametrize("window,shingle", [(10, 4), (3, 2), (1, 1)])
def test_contaminated(spark, docs, empty, window, shingle):
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id bigint, text string, _w string, t int")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination.contaminated(docs, items, window=window, shingle=shingle).collect()]
    same(got, leaks([r[:2] for r in ROWS], ITEMS, window))
    assert sum(g[2] > 0 for g in got) > 5
    if window == 10:
        assert contamination.contaminated(empty, items).count() == 0
        assert {r.n_hit for r in contamination.contaminated(docs, items.limit(0)).collect()} == {0}


def test_contaminated_spans_and_kept_columns(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(1, f"x y {passage} z {passage}", "a"), (2, passage, "b"), (3, passage[3:], "c")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, items string")
    got = contamination.contaminated(d, spark.createDataFrame([(1, passage)], "item_id bigint, text string"), keep=("text",)).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in got} == {1: [(2, 14), (15, 27)], 2: [(0, 12)], 3: [(0, 11)]}
    assert {r.text for r in got} == {r[1] for r in rows}


def test_passage_of_many_items_and_documents(spark):
    """A third of all items share a passage that a third of all documents hold."""
    shared = data.text(1, 30)
    items = [(i, shared if i % 3 == 0 else data.text(900 + i, 12)) for i in range(90)]
    docs = [(i, data.text(2000 + i, 20) + " " + (shared if i % 3 == 0 else "") + data.text(3000 + i, 9)) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = contamination.contaminated(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    same([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], leaks(docs, items))


def test_no_python_workers_in_decontamination(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    plan = contamination.contaminated(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Collocations


def phrases(rows, least=10, cover=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        good = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        part = {q for p, a in good.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in good and 100 * a >= cover * good[q]}
        scored = []
        for p, a in good.items():
            if p not in part:
                s, _, l, r = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


@pytest.mark.parametrize("least,shard,top,part", [(10, 1 << 20, 2000, 15), (2, 150, 2000, 8), (3, 1 << 20, 7, 15)])
def test_collocations(docs, empty, monkeypatch, least, shard, top, part):
    monkeypatch.setattr(collocations, "PART_BITS", part)
    monkeypatch.setattr(collocations, "VOCABULARY", 256 if part == 8 else 1 << 19)
    want = phrases([(r[1], r[2]) for r in ROWS], least, top=top)
    same([tuple(r) for r in collocations.collocations(docs, least=least, top=top, shard=shard).collect()], want)
    assert len(want) > 10
    if least == 10:
        assert collocations.collocations(empty).count() == 0
        assert collocations.collocations(docs.filter("doc_id = 201")).count() == 0


def test_collocations_with_shared_buckets(docs, monkeypatch):
    """Buckets only let more candidates through; the tries count."""
    monkeypatch.setattr(collocations, "BUCKET_BITS", 3)
    same([tuple(r) for r in collocations.collocations(docs, least=5).collect()], phrases([(r[1], r[2]) for r in ROWS], 5))


def test_collocations_of_counts_past_64_bits(spark):
    """10^6 a^2 goes past 64 bits for three million occurrences of one pair."""
    rows = [(" ".join(["a b"] * 250_000), "en")] * 13
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(4)).collect()
    a, r = 13 * 250_000, 13 * 249_999
    assert (got[0].phrase, got[0].a, got[0].l, got[0].r, got[0].score) == ("a b a", r, a, a, 10**6 * r * r // (a * a))


@pytest.mark.parametrize("size,n,words", [(2, 3000, 40), (3, 40_000, 3000), (2, 30_000, 1 << 24), (2, 1, 5), (3, 0, 5)])
def test_double_array(size, n, words):
    rng = np.random.default_rng(n)
    draw = lambda k: np.minimum(rng.zipf(1.3, (k, size)), words).astype(np.int32)
    x = np.unique(draw(n), axis=0)
    trie, slot = collocations.build(x)
    at, s = trie.advance(collocations.as_bytes(x))
    assert (at == np.arange(len(x))).all() and (s == slot).all() and len(set(slot.tolist())) == len(x)
    y, have = draw(5000), set(map(tuple, x.tolist()))
    assert set(trie.advance(collocations.as_bytes(y))[0].tolist()) == {i for i, p in enumerate(y.tolist()) if tuple(p) in have}
    assert len(trie.owner) <= 8 * len(x) + 1024


# Periodic runs


def all_runs(w, repeats=4, least=6):
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, repeats * q):
                s = w[i : i + n]
                if next(k for k in range(1, n + 1) if s[k:] == s[: n - k]) == q:
                    out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def without(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def awkward_sequences():
    r = random.Random(3)
    for _ in range(300):
        n, k = r.randint(0, 120), r.choice([1, 2, 3, 10])
        w = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.6 and n:
            a, q = r.randrange(n), r.randint(1, 20)
            w = w[:a] + [w[min(n - 1, a + (i - a) % q)] for i in range(a, n)]
        if r.random() < 0.3:
            w = w + [r.randrange(2) for _ in range(r.randint(1, 9))] * r.randint(3, 8) + w
        yield w


def test_runs_of_number_sequences():
    seqs = list(awkward_sequences())
    assert periodic.runs([np.array(s, np.int64) for s in seqs]) == [all_runs(s) for s in seqs]


def test_runs_of_long_sequences():
    rng = np.random.default_rng(1)
    assert periodic.runs([np.zeros(30_000, np.int64)]) == [[(0, 30_000, 1)]]
    x = np.concatenate([rng.integers(0, 9000, 777), np.tile(rng.integers(0, 9000, 2500), 5)[:-7], rng.integers(9000, 9999, 50)])
    assert periodic.runs([x]) == [[(777, 12_493, 2500)]]


def test_transform_is_a_cyclic_convolution():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, periodic.P, (2, 16)).astype(object)
    f = periodic.transform(np.array([a], np.uint64)) * periodic.transform(np.array([b], np.uint64)) % np.uint64(periodic.P)
    want = [sum(a[i] * b[(k - i) % 16] for i in range(16)) * 16 % periodic.P for k in range(16)]
    assert periodic.back(f)[0].tolist() == want


def test_zero_sums_modulo_the_prime_are_checked(monkeypatch):
    """With every sum taken for zero the seeds are wrong and the extension still tells."""
    monkeypatch.setattr(periodic, "occurrences", lambda seq, block: np.ones((max(0, len(seq) // block - 2), block), bool))
    w = [1, 2, 3, 4, 5, 6, 7, 8, 9, 1, 3, 2] * 2
    assert periodic.runs([np.array(w, np.int64)]) == [[]]


def test_periodic_runs(docs, empty):
    want = []
    for r in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        found = all_runs(w) if len(w) < 1000 else periodic.runs([np.unique(w, return_inverse=True)[1]])[0]
        want.append((r[0], len(w), found, without(w, found)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()]
    same(got, want)
    assert any(g[2] for g in got) and periodic.periodic_runs(empty).count() == 0


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def test_periodic_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: planted(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    some = 0
    for r in queries.QUERIES["op13_periodic_runs"](spark, sf).collect():
        w = rows[r.doc_id]
        found = all_runs(w) if len(w) < 1500 else periodic.runs([np.unique(w, return_inverse=True)[1]])[0]
        best = min(((-n, s, q) for s, n, q in found), default=None)
        want = (len(found), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4))
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found)) and r.collapsed_sha256 == sha(without(w, found))
        some += len(found)
    assert some > 10


def test_planted_periods(spark, docs):
    got = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in queries.with_planted_periods(docs).collect()]
    same(got, [(r[0], planted(r[0], r[1])) for r in ROWS])
