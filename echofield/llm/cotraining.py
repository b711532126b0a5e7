"""Quality classifier by co-training over two views of a document.

One view is the text (shape statistics and hashed character bigrams), the other what is known about the page (source,
language, length). Each has its own logistic regression. In each round both score a pool of unlabelled documents, and
each hands its most confident pseudo-labels to the other; documents handed over leave the pool. At the end both
views are calibrated on labelled rows that no fit has seen, a small regression over both log odds combines them, and
all documents are scored where they are.

Only the fit is bounded: ``FIT_ROWS`` labelled rows and ``POOL_ROWS`` unlabelled ones at most, chosen by a hash
of the id. Scoring covers every row and the whole text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import slices

FIT_ROWS = 12_000
POOL_ROWS = 12_000
ROUNDS = 4
#: Most of the pool that one view hands over in a round, and the least calibrated confidence.
HAND_OVER = 0.1
CONFIDENT = 0.9
GRAMS = 128
HOLD = 4
BLOCK_CHARS = 1 << 18
RIDGE = 1.0

SPACE = np.array([b in (9, 10, 11, 12, 13, 32) for b in range(256)])
DIGIT = np.array([48 <= b <= 57 for b in range(256)])
UPPER = np.array([65 <= b <= 90 for b in range(256)])
LOWER = np.array([97 <= b <= 122 for b in range(256)])
HIGH = np.array([b >= 128 for b in range(256)])
MARK = ~(SPACE | DIGIT | UPPER | LOWER | HIGH) & (np.arange(256) > 32)
GROUP = np.select([SPACE, DIGIT, UPPER, LOWER, HIGH, MARK], [0, 1, 2, 3, 4, 5], 6).astype(np.int64)
SHAPE = 49
TEXT_DIM = SHAPE + 9 + 32 + GRAMS
SOURCES, LANGS, LENGTHS = 64, 16, 24
META_DIM = SOURCES + LANGS + LENGTHS


def text_view(text: str | None) -> np.ndarray:
    """Features of the whole text; those of a null text are those of an empty one."""
    out = np.zeros(TEXT_DIM)
    shape, marks, grams = np.zeros(SHAPE), np.zeros(32), np.zeros(GRAMS)
    words, distinct, lines, repeats, n = 0, set(), 0, 0, 0
    last = ""
    for at in range(0, len(text or ""), BLOCK_CHARS):
        part = text[at : at + BLOCK_CHARS]
        b = np.frombuffer(part.encode("utf-8", "replace"), np.uint8)
        g = GROUP[b]
        n += len(b)
        shape += np.bincount(g[:-1] * 7 + g[1:], minlength=SHAPE)
        m = b[MARK[b]]
        marks += np.bincount(m & 31, minlength=32)
        code = b[:-1].astype(np.uint32) * np.uint32(2654435761) ^ b[1:].astype(np.uint32) * np.uint32(2246822519)
        grams += np.bincount((code >> np.uint32(8)) % np.uint32(GRAMS), minlength=GRAMS)
        pieces = part.split()
        words += len(pieces)
        # A set of hashes bounded by its own modulus: the count of distinct words saturates, it does not grow without limit.
        distinct.update(hash_word(p) for p in set(pieces))
        repeats += sum(a == c for a, c in zip([last, *pieces], pieces))
        last = pieces[-1] if pieces else last
        lines += part.count("\n")
    total = max(1, n)
    out[:SHAPE] = shape / total
    out[SHAPE : SHAPE + 9] = [
        np.log1p(n) / 10, np.log1p(words) / 10, len(distinct) / max(1, words), repeats / max(1, words), lines / max(1, words),
        n / max(1, words) / 20, marks.sum() / total, float(words == 0), float(repeats > words / 4),
    ]
    out[SHAPE + 9 : SHAPE + 41] = marks / total
    out[SHAPE + 41 :] = grams / total
    return np.sqrt(out)


def hash_word(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & 0xFFFFF


def meta_view(source: str | None, lang: str | None, length: int) -> np.ndarray:
    """One-hot source, language and length class; null has its own place by its name."""
    out = np.zeros(META_DIM)
    out[zlib.crc32(b"n" if source is None else b"s" + source.encode("utf-8", "replace")) % SOURCES] = 1
    out[SOURCES + zlib.crc32(b"n" if lang is None else b"s" + lang.encode("utf-8", "replace")) % LANGS] = 1
    out[SOURCES + LANGS + min(LENGTHS - 1, int(np.log2(length + 1)))] = 1
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> Logistic:
        """Newton steps on the ridge-penalised likelihood; one class only gives its smoothed log odds."""
        mean, scale = x.mean(0), x.std(0)
        scale[scale < 1e-9] = 1.0
        z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
        w = np.zeros(z.shape[1])
        w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-3
        loss = lambda v: np.logaddexp(0, z @ v).sum() - y @ (z @ v) + (penalty * v * v).sum() / 2
        now = loss(w)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (y - p) - penalty * w
            step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty), grad)
            while (then := loss(w + step)) > now and np.abs(step).max() > 1e-9:
                step = step / 2
            w, now = w + step, min(then, now)
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:], -30, 30)


@dataclass
class Model:
    text: Logistic
    meta: Logistic
    both: Logistic
    handed: list[tuple[int, int]]

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Combined, text and page probabilities."""
        t, m = self.text.odds(a), self.meta.odds(b)
        both = self.both.odds(np.column_stack([t, m]))
        return 1 / (1 + np.exp(-np.column_stack([both, t, m])))


def fit(a: np.ndarray, b: np.ndarray, y: np.ndarray, hold: np.ndarray, pool_a: np.ndarray, pool_b: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Co-training: rows of ``y`` where ``hold`` is false teach, the others calibrate."""
    ta, tb, ya, yb = a[~hold], b[~hold], y[~hold], y[~hold]
    free, handed = np.ones(len(pool_a), bool), []
    for _ in range(rounds):
        views = Logistic.fit(ta, ya), Logistic.fit(tb, yb)
        given = []
        for view, held, pool in ((views[0], a[hold], pool_a), (views[1], b[hold], pool_b)):
            rule = Logistic.fit(view.odds(held)[:, None], y[hold])
            p = 1 / (1 + np.exp(-rule.odds(view.odds(pool)[:, None]))) if len(pool) else np.empty(0)
            sure = np.where(free, np.abs(p - 0.5), -1)
            best = np.argsort(-sure, kind="stable")[: int(HAND_OVER * len(pool))]
            best = best[sure[best] >= CONFIDENT - 0.5]
            given.append((best, (p[best] > 0.5).astype(float)))
        (from_a, label_a), (from_b, label_b) = given
        handed.append((len(from_a), len(from_b)))
        tb, yb = np.vstack([tb, pool_b[from_a]]), np.concatenate([yb, label_a])
        ta, ya = np.vstack([ta, pool_a[from_b]]), np.concatenate([ya, label_b])
        free[from_a] = free[from_b] = False
        if not len(from_a) + len(from_b):
            break
    text, meta = Logistic.fit(ta, ya), Logistic.fit(tb, yb)
    both = Logistic.fit(np.column_stack([text.odds(a[hold]), meta.odds(b[hold])]), y[hold])
    return Model(text, meta, both, handed)


def _share(rows: DataFrame, most: int, key: str, salt: str) -> DataFrame:
    """About nine tenths of ``most`` rows at most by a hash of the key, and never more than ``most``."""
    n = rows.count()
    h = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30))
    return rows.filter(h <= int(min(1.0, 0.9 * most / max(1, n)) * (1 << 30))).limit(most)


def _views(rows: DataFrame, extra: list[str]) -> DataFrame:
    """Both feature arrays of each row, beside the columns in ``extra``."""
    kinds = T.StructType([*[rows.schema[c] for c in extra], T.StructField("_a", T.BinaryType()), T.StructField("_b", T.BinaryType())])

    def run(batches):
        for batch in slices(batches, "_text"):
            texts, sources, langs = (batch.column(c).to_pylist() for c in ("_text", "_source", "_lang"))
            a = pa.array([text_view(t).tobytes() for t in texts], pa.binary())
            b = pa.array([meta_view(s, g, len(t or "")).tobytes() for t, s, g in zip(texts, sources, langs)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in extra], a, b], [*extra, "_a", "_b"])

    return rows.mapInArrow(run, kinds)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(-1, width)


def _base(docs: DataFrame, text: str, id_col: str, source: str, lang: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.col(source).cast("string").alias("_source"), F.col(lang).cast("string").alias("_lang"))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id_col: str = "doc_id", source: str = "source", lang: str = "lang",
    fit_rows: int = FIT_ROWS, pool_rows: int = POOL_ROWS, rounds: int = ROUNDS,
) -> Model | None:
    """Fit on a bounded sample. Labels that are null or contradict each other for an id are left out; without any there is no model."""
    l = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id is not null and _y is not null")
    l = l.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).filter("_y = _z").drop("_z")
    chosen = _share(l, fit_rows, "_id", "fit")
    base = _base(docs, text, id_col, source, lang)
    taught = base.join(F.broadcast(chosen), "_id").limit(fit_rows)
    taught = _views(taught.withColumn("_hold", F.pmod(F.xxhash64("_id", F.lit("hold")), F.lit(HOLD)) == 0), ["_y", "_hold"]).toArrow()
    if not taught.num_rows:
        return None
    pool = _views(_share(base, pool_rows, "_id", "pool").withColumn("_y", F.lit(0)), ["_y"]).toArrow()
    y = (taught.column("_y").to_numpy() > 0).astype(float)
    hold = taught.column("_hold").to_numpy()
    if hold.all() or not hold.any():
        hold = np.arange(len(y)) % HOLD == 0 if len(y) > 1 else np.ones(1, bool)
    a, b = _matrix(taught.column("_a"), TEXT_DIM), _matrix(taught.column("_b"), META_DIM)
    if hold.all():
        a, b, y, hold = np.vstack([a, a]), np.vstack([b, b]), np.concatenate([y, y]), np.array([False, True])
    return fit(a, b, y, hold, _matrix(pool.column("_a"), TEXT_DIM), _matrix(pool.column("_b"), META_DIM), rounds)


def score(
    docs: DataFrame, model: Model | None, text: str = "text", id_col: str = "doc_id", source: str = "source", lang: str = "lang", threshold: float = 0.5,
) -> DataFrame:
    """One row per input row: ``id_col``, ``score``, ``score_text``, ``score_page`` (0 to 1) and ``kept`` (score >= threshold).

    Null or empty texts are scored by their empty shape and their page. Null sources and languages are values of their
    own. Without a model every score is 0.5. Repeated rows, null ids and clashing names of other columns do not
    matter; an empty table gives an empty result.
    """
    base = _base(docs, text, id_col, source, lang)
    names = ["score", "score_text", "score_page"]
    schema = T.StructType([base.schema["_id"], *[T.StructField(n, T.DoubleType()) for n in names]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in slices(batches, "_text"):
            texts, sources, langs = (batch.column(c).to_pylist() for c in ("_text", "_source", "_lang"))
            if m is None:
                s = np.full((len(texts), 3), 0.5)
            else:
                a = np.array([text_view(t) for t in texts]).reshape(-1, TEXT_DIM)
                b = np.array([meta_view(x, g, len(t or "")) for t, x, g in zip(texts, sources, langs)]).reshape(-1, META_DIM)
                s = m.scores(a, b)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *[pa.array(s[:, i]) for i in range(3)]], ["_id", *names])

    out = base.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
    return out.withColumn("kept", F.col("score") >= threshold)
