"""Language identification with error-correcting output codes.

Each language has a codeword of +1 and -1. For each bit a linear classifier over hashed character n-grams (1 to 3
bytes of the lower-cased letters) separates the languages with +1 from those with -1: its weights are the log odds of
the n-gram counts of both sides, gathered over all training rows in one pass. A second pass over them takes the mean
and the spread of every bit's margin and how often it is right for each language. Decoding weighs the logistic losses
of the bits by that accuracy and takes the codeword with the lowest sum; a small lead over the next one is flagged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import slices

DIM_BITS = 14
MAX_GRAM = 3
BLOCK_CHARS = 1 << 18
#: Losses closer than this are ambiguous (the losses of a codeword are a weighted mean in nats a bit).
AMBIGUOUS_LEAD = 0.05
MOST_MARGIN = 8.0
UNDEFINED = "und"
LETTER = regex.compile(r"\p{L}")
#: Bytes that count: lower-case letters and all parts of characters beyond ASCII; the others are blanks.
KEPT = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)
#: All columns of an exhaustive code up to this many languages, a random code of LONG_CODE * log2(languages) beyond.
EXHAUSTIVE = 6
LONG_CODE = 12


def gram_counts(text: str, bits: int = DIM_BITS) -> np.ndarray:
    """Counts of hashed n-grams of the whole text."""
    out = np.zeros(1 << bits, np.int64)
    for at in range(0, len(text), BLOCK_CHARS):
        b = KEPT[np.frombuffer(text[max(0, at - MAX_GRAM + 1) : at + BLOCK_CHARS].lower().encode("utf-8", "replace"), np.uint8)]
        code = np.zeros(len(b), np.uint32)
        for n in range(1, MAX_GRAM + 1):
            code = (code[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
            h = (code + np.uint32(n << 24)) * np.uint32(2654435761)
            h ^= h >> np.uint32(15)
            out += np.bincount((h * np.uint32(2246822519)) >> np.uint32(32 - bits), minlength=1 << bits)
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n x bits of +1 and -1, every bit with both signs (no bits for fewer than two languages)."""
    if n < 2:
        return np.ones((n, 0))
    if n <= EXHAUSTIVE:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range((1 << (n - 1)) - 1)]
        return np.array(columns, float).T
    rng, best = np.random.default_rng(seed), None
    bits = int(np.ceil(LONG_CODE * np.log2(n)))
    for _ in range(50):
        m = rng.choice([-1.0, 1.0], (n, bits))
        m = m[:, np.abs(m.sum(0)) < n]
        apart = (m.shape[1] - m @ m.T) / 2 + np.eye(n) * bits
        if best is None or apart.min() > best[0]:
            best = apart.min(), m
    return best[1]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Mean log odds of the n-grams, one for each bit."""
        return counts @ self.weights / max(1, counts.sum())

    def decode(self, margins: np.ndarray, lead: float = AMBIGUOUS_LEAD) -> tuple[str, float, bool]:
        z = np.clip(margins * self.scale + self.shift, -MOST_MARGIN, MOST_MARGIN)
        losses = (self.trust * np.log1p(np.exp(-self.code * z))).sum(1)
        order = np.argsort(losses, kind="stable")
        p = np.exp(-(losses - losses[order[0]]) * self.code.shape[1])
        near = len(order) > 1 and losses[order[1]] - losses[order[0]] < lead
        return self.languages[order[0]], float(p[order[0]] / p.sum()), bool(near)


def _log_odds(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    p = counts + 0.5
    p = p / p.sum(1, keepdims=True)
    cols = [np.log(p[code[:, b] > 0].mean(0)) - np.log(p[code[:, b] < 0].mean(0)) for b in range(code.shape[1])]
    return np.array(cols).T.reshape(counts.shape[1], code.shape[1]).astype(np.float32)


def train(rows: DataFrame, text: str = "text", lang: str = "lang", bits: int = DIM_BITS) -> Model:
    """Fit on all rows that have a text with a letter and a language. What reaches the driver has the size of the model."""
    spark = rows.sparkSession
    rows = rows.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")).filter("_text is not null and _lang is not null")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "_text"):
            for t, g in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist()):
                if LETTER.search(t):
                    sums[g] = sums.get(g, 0) + gram_counts(t, bits)
        for g, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])], ["_lang", "_gram", "_n"])

    table = rows.mapInArrow(count, "_lang string, _gram int, _n bigint").groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n")).toArrow()
    languages = sorted(set(table.column("_lang").to_pylist()))
    counts = np.zeros((len(languages), 1 << bits))
    index = {g: i for i, g in enumerate(languages)}
    counts[[index[g] for g in table.column("_lang").to_pylist()], table.column("_gram").to_numpy()] = table.column("_n").to_numpy()
    code = codewords(len(languages))
    n = code.shape[1]
    model = Model(languages, code, _log_odds(counts, code), np.ones(n), np.zeros(n), np.full((len(languages), n), 1 / max(1, n)))
    if not n:
        return model

    shared = spark.sparkContext.broadcast(model)

    def measure(batches):
        m = shared.value
        got = {g: np.zeros((3, n)) for g in m.languages}
        for batch in slices(batches, "_text"):
            for t, g in zip(batch.column("_text").to_pylist(), batch.column("_lang").to_pylist()):
                if LETTER.search(t):
                    x = m.margins(gram_counts(t, bits))
                    got[g] += np.array([np.ones(n), x, x * x])
        # Sums of rounded integers do not depend on the order in which tasks end.
        flat = [(g, i, *map(int, np.round(v[:, i] * 1e9))) for g, v in got.items() for i in range(n)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*flat)], ["_lang", "_bit", "_c", "_s", "_q"])

    sums = rows.mapInArrow(measure, "_lang string, _bit bigint, _c bigint, _s bigint, _q bigint").groupBy("_lang", "_bit")
    sums = sums.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).cast("double").alias(c) for c in ("_c", "_s", "_q")]).toArrow().to_pylist()
    c, s, q = (np.zeros((len(languages), n)) for _ in range(3))
    for r in sums:
        at = index[r["_lang"]], r["_bit"]
        c[at], s[at], q[at] = r["_c"], r["_s"], r["_q"]
    mean = s / np.maximum(c, 1)
    spread = np.sqrt(np.maximum(q / np.maximum(c, 1) - mean**2, 1e-12))
    plus = np.array([mean[code[:, b] > 0, b].min() for b in range(n)])
    minus = np.array([mean[code[:, b] < 0, b].max() for b in range(n)])
    noise = np.array([spread[:, b].max() for b in range(n)])
    model.scale = 2 / np.maximum(np.maximum(plus - minus, noise) / 2, 1e-9)
    model.shift = -model.scale * (plus + minus) / 2
    # Share of a language's rows on the right side of a bit, from its mean and spread.
    z = code * (mean - (plus + minus) / 2) / spread
    right = 1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))
    model.trust = right / right.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), lead: float = AMBIGUOUS_LEAD) -> DataFrame:
    """One row per input row: ``id_col``, ``lang_pred``, ``score`` (0 to 1), ``ambiguous``, and ``keep``.

    Only the whole text counts. A text that is null or has no letter is ``und`` with score 0 and not ambiguous; so is
    every text if no language was learned. With one language all others get it with score 1. Repeated rows, null ids
    and clashing names of other columns do not matter.
    """
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    sent = ["_id", *["_text" if c == text else f"_keep{i}" for i, c in enumerate(keep)]]  # a kept text goes to the task once
    d = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"), *[F.col(c).alias(n) for c, n in zip(keep, sent[1:]) if n != "_text"])
    schema = T.StructType(
        [T.StructField(n, d.schema[s].dataType, d.schema[s].nullable, d.schema[s].metadata) for n, s in zip(names, sent)]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        bits = int(m.weights.shape[0]).bit_length() - 1
        for batch in slices(batches, "_text"):
            out = [
                m.decode(m.margins(gram_counts(t, bits)), lead) if t and m.languages and LETTER.search(t) else (UNDEFINED, 0.0, False)
                for t in batch.column("_text").to_pylist()
            ]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in sent], *columns], [*names, "lang_pred", "score", "ambiguous"])

    out = d.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), "lang_pred", "score", "ambiguous", *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)])


def identify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Learn from the rows that ``learn`` selects and predict all rows."""
    return predict(docs, train(docs.filter(learn), text, lang), text, id_col, keep)
