"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

* Counts of all training tokens (64-bit hashes) come from one pass; each task adds up its own first.
* The ``WORDS - 1`` most frequent tokens and the end are words of the model, in ``CLASSES`` classes of even size by
  frequency; one more class stands for all other tokens. P(token) = P(class | context) * P(word | class, context), and
  inside the last class the smoothed share of the token among the others, so the probabilities of all tokens and one unseen
  kind add up to one.
* The context's features are hashed into ``ROWS`` rows of weights: previous token, previous two, and the skips over one
  and two tokens, beside a bias that starts at the unigram shares.
* Training: in each round every task takes the weights, goes once through its share of that round's documents in
  mini-batches (AdaGrad), and returns the change; Spark averages the changes by parts of the weights.
* Scoring: batches of sparse feature rows in numpy. Counts of frequent tokens (more than one in ``FREQUENT`` of all, so
  at most ``FREQUENT`` of them) go with the tasks; those of the others meet their documents in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import slices, staged
from echofield.llm.lsh_forest import _mixed, batch_hashes

WORDS, CLASSES = 512, 16
ROWS = 2048
FREQUENT = 1 << 20
ROUNDS = 2
BATCH = 16_384
RATE = 1.0
SKIPS = ((1,), (1, 2), (2,), (3,))
END = np.uint64(0x1F3D5B79A2C4E6F1)
PART = 1 << 15
#: Distinct tokens that a task adds up before it hands them on.
HELD = 2_000_000


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of whole texts with A-Z in lower case, each text followed by the end, and where texts start."""
    words, n = batch_hashes(texts)
    words[words == END] ^= np.uint64(1)
    out = np.full(len(words) + len(n), END)
    ends = np.cumsum(n + 1) - 1
    out[np.delete(np.arange(len(out)), ends)] = words
    return out, ends - n


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def count_tokens(docs: DataFrame, text: str) -> DataFrame:
    """``_h`` and ``_c`` of every distinct token."""

    def run(batches):
        held_h, held_c, n = [], [], 0

        def added():
            h, at = np.unique(np.concatenate(held_h), return_inverse=True)
            return h, np.bincount(at, np.concatenate(held_c)).astype(np.int64)

        for batch in slices(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            h, c = np.unique(tokens(texts)[0], return_counts=True)
            held_h.append(h)
            held_c.append(c)
            n += len(h)
            if n > HELD:
                h, c = added()
                if len(h) > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(c)], ["_h", "_c"])
                    held_h, held_c, n = [], [], 0
                else:
                    held_h, held_c, n = [h], [c], len(h)
        if n:
            h, c = added()
            yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(c)], ["_h", "_c"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, "_h bigint, _c bigint").groupBy("_h").agg(F.sum("_c").alias("_c"))


@dataclass
class Model:
    """Sorted frequent tokens with counts and word numbers (-1: not a word of the model), and the weights."""

    known: np.ndarray
    counts: np.ndarray
    word: np.ndarray
    n: int
    v: int
    other_n: int
    other_v: int
    width: int
    to_class: np.ndarray
    to_word: np.ndarray
    used: int

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens among the frequent ones, -1 for the others, and word numbers."""
        at = np.searchsorted(self.known, h)
        at[at == len(self.known)] = 0
        hit = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        at = np.where(hit, at, -1)
        return at, np.where(hit, self.word[at], -1) if len(self.known) else at


    def words_of(self, h: np.ndarray) -> np.ndarray:
        """Word numbers alone: the words of the model are far fewer than the frequent tokens."""
        own = np.flatnonzero(self.word >= 0)
        words, number = self.known[own], self.word[own]
        if not len(words):
            return np.full(len(h), -1)
        at = np.searchsorted(words, h)
        at[at == len(words)] = 0
        return np.where(words[at] == h, number[at], -1)


def features(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """tokens x skips rows of weights; row 0, the bias of all, is left out. Contexts do not cross ``starts`` of documents."""
    n = len(h)
    inside = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    out = np.zeros((n, len(SKIPS)), np.int32)
    for k, skip in enumerate(SKIPS):
        x = np.full(n, k + 1, np.uint64)
        for d in skip:
            before = np.zeros(n, np.uint64)
            before[d:] = h[:-d] if d < n else 0
            before[inside < d] = 0
            x = _mixed(x * np.uint64(0x9E3779B97F4A7C15) + before)
        out[:, k] = 1 + (x >> np.uint64(32)) % np.uint64(ROWS - 1)
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def _sums(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each line of ``rows`` the sum of its rows of weights, one column of ``rows`` after the other."""
    out = weights.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += weights.take(rows[:, k], axis=0)
    return out


def _word_part(m: Model, f: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Softmax over the words of each row's class."""
    w = m.to_word.reshape(ROWS * CLASSES, m.width)
    x = _sums(w, f * CLASSES + c[:, None]) + w.take(c, axis=0)
    if m.used < CLASSES * m.width:
        x[c[:, None] * m.width + np.arange(m.width) >= m.used] = -np.inf
    return _softmax(x)


def _summed(keys: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of (rows x features), and the sums of the gradients of the rows that have them."""
    flat = keys.ravel().astype(np.uint16) if ROWS * CLASSES <= 1 << 16 else keys.ravel()
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    return flat[first].astype(np.int64), np.add.reduceat(g.take(order // keys.shape[1], axis=0), first, axis=0)


def log_prob(m: Model, f: np.ndarray, word: np.ndarray) -> np.ndarray:
    """log10 of P(word | context), or of P(last class | context) for word -1."""
    c = np.where(word >= 0, word // m.width, CLASSES)
    p = _softmax(_sums(m.to_class, f) + m.to_class[0])[np.arange(len(f)), c].astype(np.float64)
    i = np.flatnonzero(word >= 0)
    if len(i):
        q = _word_part(m, f[i], c[i])
        p[i] *= q[np.arange(len(i)), word[i] % m.width]
    return np.log10(np.maximum(p.astype(np.float64), 1e-30))


def descend(m: Model, batches, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """AdaGrad over mini-batches of (features, words); changes ``m`` in place and returns the changes."""
    first = m.to_class.copy(), m.to_word.copy()
    by_class, by_word = m.to_class, m.to_word.reshape(ROWS * CLASSES, m.width)
    seen_c, seen_w = np.full_like(by_class, 1e-3), np.full_like(by_word, 1e-3)

    def step(weights: np.ndarray, seen: np.ndarray, keys: np.ndarray, g: np.ndarray, bias: tuple[np.ndarray, np.ndarray]) -> None:
        at, grad = _summed(keys, g)
        at, grad = np.append(bias[0], at), np.concatenate([bias[1], grad])
        grad /= np.sqrt(len(g))
        seen[at] += grad * grad
        weights[at] -= rate / 4 * grad / np.sqrt(seen[at])

    for f, word in batches:
        c = np.where(word >= 0, word // m.width, CLASSES)
        g = _softmax(_sums(by_class, f) + by_class[0])
        g[np.arange(len(f)), c] -= 1
        step(by_class, seen_c, f, g, (np.zeros(1, np.int64), g.sum(0, keepdims=True)))
        i = np.flatnonzero(word >= 0)
        if len(i):
            q = _word_part(m, f[i], c[i])
            q[np.arange(len(i)), word[i] % m.width] -= 1
            step(by_word, seen_w, f[i] * CLASSES + c[i][:, None], q, _summed(c[i][:, None], q))
    return m.to_class - first[0], m.to_word - first[1]


def train(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, key: Column | None = None) -> tuple[Model, DataFrame]:
    """The model, and the table of all token counts. Every row is in the counts and in one round of the training."""
    spark = docs.sparkSession
    counts = staged(count_tokens(docs, text), "lm-counts")
    n, v = counts.agg(F.sum("_c"), F.count(F.lit(1))).first()
    n, v = n or 0, v or 0
    # At most FREQUENT tokens can be above this count.
    top = counts.filter(F.col("_c") * FREQUENT > n).toArrow()
    h, c = top.column("_h").to_numpy().view(np.uint64), top.column("_c").to_numpy()
    by = np.argsort(h)
    h, c = h[by], c[by]
    best = [i for i in np.lexsort((h, -c)) if h[i] != END][: WORDS - 1]
    best = np.array(sorted([*best, *np.flatnonzero(h == END)], key=lambda i: (-c[i], h[i])), int)
    word = np.full(len(h), -1)
    word[best] = np.arange(len(best))
    width = max(1, -(-len(best) // CLASSES))
    share = np.zeros(CLASSES * width)
    share[: len(best)] = c[best] + 1
    other = n - int(c[best].sum())
    by_class = np.append(share.reshape(CLASSES, width).sum(1), other + 1)
    to_class, to_word = np.zeros((ROWS, CLASSES + 1), np.float32), np.zeros((ROWS, CLASSES * width), np.float32)
    to_class[0] = np.log(np.maximum(by_class, 1e-3) / by_class.sum())
    to_word[0] = np.log(np.maximum(share, 1e-3) / max(1.0, share.sum()))
    m = Model(h, c, word, n, v, other, v - len(best), width, to_class, to_word, len(best))
    if not n:
        return m, counts

    rows = docs.select(F.col(text).alias("_text"), (F.pmod(F.xxhash64(F.coalesce(key.cast("string") if key is not None else F.col(text), F.lit(""))), F.lit(rounds))).alias("_round"))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(m)

        def work(batches):
            # The worker keeps the broadcast object for its next task, so that each task trains a model of its own.
            mine = replace(shared.value, to_class=shared.value.to_class.copy(), to_word=shared.value.to_word.copy())

            def minis():
                for batch in slices(batches, "_text"):
                    h, starts = tokens(batch.column("_text").to_pylist())
                    f = features(h, starts)
                    word = mine.words_of(h)
                    # A step takes tokens from all over the batch, so that it is not one language or source.
                    order = np.random.default_rng(len(h)).permutation(len(h))
                    for at in range(0, len(h), BATCH):
                        i = order[at : at + BATCH]
                        yield f[i], word[i]

            held = list_first(minis())
            if held is None:
                return
            a, b = descend(mine, held)
            change = np.concatenate([a.ravel(), b.ravel()])
            parts = range(0, len(change), PART)
            yield pa.RecordBatch.from_arrays([pa.array([p // PART for p in parts], pa.int32()), pa.array([change[p : p + PART].tobytes() for p in parts], pa.binary())], ["_part", "_change"])

        changes = staged(rows.filter(F.col("_round") == k).select("_text").mapInArrow(work, "_part int, _change binary"), "lm-changes")

        mean = changes.groupBy("_part").applyInArrow(_mean_change, "_part int, _change binary").toArrow().to_pylist()
        total = np.zeros(m.to_class.size + m.to_word.size, np.float32)
        for r in mean:
            x = np.frombuffer(r["_change"], np.float32)
            total[r["_part"] * PART : r["_part"] * PART + len(x)] = x
        m.to_class = m.to_class + total[: m.to_class.size].reshape(m.to_class.shape)
        m.to_word = m.to_word + total[m.to_class.size :].reshape(m.to_word.shape)
    return m, counts


def list_first(items):
    """The iterator with its first item in front, or None if it has none."""
    for first in items:
        def again():
            yield first
            yield from items

        return again()
    return None


def _mean_change(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams the changes of one part, so that memory does not follow the number of tasks."""
    total, n = None, 0
    for batch in batches:
        for x in batch.column("_change").to_pylist():
            x = np.frombuffer(x, np.float32)
            total = x.astype(np.float64) if total is None else total + x
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())], ["_part", "_change"])


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, and ``keep``.

    ``score`` is the model's log10 probability of the whole text and its end, ``base_score`` that of single tokens with
    one added to every count, ``n_known`` the tokens that occur in training. A null text is an empty one: its end
    alone. Without training rows N and V are 0. Repeated rows, null ids and clashing names of other columns do not
    matter; an empty table gives an empty result. Tokens are told apart by 64-bit hashes.
    """
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    d = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"), *[F.col(c).alias(n) for c, n in zip(keep, names[1:])])
    schema = T.StructType([d.schema[n] for n in names] + [
        T.StructField("n_tokens", T.LongType()), T.StructField("_seen", T.LongType()), T.StructField("_sum", T.DoubleType()),
        T.StructField("_score", T.DoubleType()), T.StructField("_rest", T.LongType()), T.StructField("_rare", T.ArrayType(T.LongType())),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        log_c = np.log10(m.counts + 1.0)
        for batch in slices(batches, "_text", 4 << 20):
            h, starts = tokens(batch.column("_text").to_pylist())
            at, word = m.look(h)
            f = features(h, starts)
            p = np.concatenate([log_prob(m, f[i : i + BATCH], word[i : i + BATCH]) for i in range(0, len(h), BATCH)])
            hit = at >= 0
            known = np.where(hit, log_c[at], 0.0) if len(log_c) else np.zeros(len(h))
            other = word < 0
            # Counts of other tokens that are frequent are here; those of rare ones come by the join.
            p += np.where(other, known, 0.0)
            add = lambda x: np.add.reduceat(x, starts)
            sizes = np.diff(np.append(starts, len(h)))
            offsets = np.concatenate([[0], np.cumsum(sizes - add(hit.astype(np.int64)))]).astype(np.int32)
            columns = [
                pa.array(sizes), pa.array(add(hit.astype(np.int64))), pa.array(add(known)), pa.array(add(p)),
                pa.array(add(other.astype(np.int64))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(h[~hit]))),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], [*names, "n_tokens", "_seen", "_sum", "_score", "_rest", "_rare"])

    rows = d.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows, "lm-rows")
    rare = rows.select("_row", F.explode("_rare").alias("_h"))
    found = rare.join(counts, "_h").groupBy("_row").agg(F.sum(F.log10(F.col("_c") + 1)).alias("_more"), F.count(F.lit(1)).alias("_n"))
    out = rows.drop("_rare").join(found, "_row", "left")
    more = F.coalesce("_more", F.lit(0.0))
    base = F.log10(F.lit(float(model.n + model.v + 1)))
    other = F.log10(F.lit(float(model.other_n + model.other_v + 1)))
    return out.select(
        F.col("_id").alias(id_col), "n_tokens", (F.col("_seen") + F.coalesce("_n", F.lit(0))).alias("n_known"), F.lit(model.n).cast("bigint").alias("train_tokens"),
        (F.col("_sum") + more - F.col("n_tokens") * base).alias("base_score"), (F.col("_score") + more - F.col("_rest") * other).alias("score"),
        *[F.col(n).alias(c) for c, n in zip(keep, names[1:])],
    )
