"""Periodic runs of words, found by block convolution with an exact number-theoretic transform.

A run is a stretch of consecutive words that repeats with smallest period ``q`` over at least ``repeats`` periods and that no
neighbouring word extends. Texts are independent; a task takes them in batches of bounded size, longer ones alone.

* Scale ``B`` (1, 2, 4, ...) looks for the periods in [B, 2B). The numbered words of all texts that are long enough are one
  sequence with a separator of its own after each text, cut into aligned blocks of ``B``.
* For each block the sums of squared differences to the places ``B`` .. ``2B - 1`` further on come from one cyclic
  convolution of size ``2B`` modulo the prime ``P``, in integers. A block occurs where the sum is zero. The transform of a
  window is put together from those of its two blocks, so every block is transformed once.
* A run of four periods ``q`` holds at least two whole neighbouring blocks that both occur at distance ``q``. The first block of each
  such row is a seed; seeds are extended word by word in both directions, which also settles sums that are a multiple of ``P``
  without being zero. Distances rise, so a seed inside a known run whose period divides its distance is that run again.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import slices

#: A prime with roots of unity of every order up to 2^27, and a generator. Products of two residues fit in 62 bits.
P, GENERATOR = 2013265921, 31
REPEATS, LEAST = 4, 6
#: Bytes of text in one batch of texts, and values that are transformed at once.
BATCH_BYTES = 1 << 20
CHUNK = 1 << 15
_P = np.uint64(P)
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


@lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. half - 1 of a root of unity of order 2 * half."""
    w = pow(GENERATOR, (P - 1) // (2 * half), P)
    w = pow(w, P - 2, P) if inverse else w
    out = np.ones(half, np.uint64)
    n = 1
    while n < half:
        out[n : 2 * n] = out[:n] * np.uint64(pow(w, n, P)) % _P
        n *= 2
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Transform of each row of residues, in bit-reversed order; changes ``x``."""
    rows, size = x.shape
    half = size // 2
    while half:
        v = x.reshape(rows, size // (2 * half), 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        low = (a + (_P - b)) * _twiddles(half, False) % _P
        v[:, :, 0] = (a + b) % _P
        v[:, :, 1] = low
        half //= 2
    return x


def back(x: np.ndarray) -> np.ndarray:
    """Inverse of ``transform`` times the size of a row; changes ``x``."""
    rows, size = x.shape
    half = 1
    while half < size:
        v = x.reshape(rows, size // (2 * half), 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * _twiddles(half, True) % _P
        high = (a + (_P - b)) % _P
        v[:, :, 0] = (a + b) % _P
        v[:, :, 1] = high
        half *= 2
    return x


@lru_cache(maxsize=64)
def _negated(size: int) -> np.ndarray:
    """Where frequency -k is, for each place of the bit-reversed order."""
    out = np.zeros(size, np.int64)
    low = 1
    while low < size:
        out[low : 2 * low] = np.arange(2 * low - 1, low - 1, -1)
        low *= 2
    return out


def occurrences(seq: np.ndarray, block: int) -> np.ndarray:
    """blocks x distances: whether the block occurs ``block + distance`` further on (sum of squared differences 0 modulo P).

    ``seq`` has whole blocks; the last two have no full window and are not asked for.
    """
    blocks = len(seq) // block
    x = seq.astype(np.uint64) % _P
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * x % _P)])
    own = (squares[block::block] - squares[:-1:block])[: blocks - 2]
    out = np.zeros((max(0, blocks - 2), block), bool)
    size = 2 * block
    step = max(1, CHUNK // size)
    sign = np.repeat(np.array([1, P - 1], np.uint64), block)
    for j in range(0, blocks - 2, step):
        k = min(j + step, blocks - 2)
        f = np.zeros((k - j + 2, size), np.uint64)
        f[:, :block] = x[j * block : (k + 2) * block].reshape(-1, block)
        f = transform(f)
        window = (f[1:-1] + f[2:] * sign) % _P
        products = back(f[:-2][:, _negated(size)] * window % _P)[:, :block]
        at = (np.arange(j, k) * block)[:, None] + block + np.arange(block)
        sums = (own[j:k, None] + squares[at + block] - squares[at]) % _P
        out[j:k] = products * np.uint64(2) % _P == sums * np.uint64(size) % _P
    return out


def _extended(seq: np.ndarray, i: int, d: int, low: int, high: int) -> tuple[int, int]:
    """The stretch [a, b) around ``i`` in which words ``d`` apart are identical, inside [low, high)."""
    b, step = i, 64
    while b + d < high:
        n = min(step, high - d - b)
        other = seq[b : b + n] != seq[b + d : b + d + n]
        if other.any():
            b += int(other.argmax())
            break
        b, step = b + n, step * 2
    a, step = i, 64
    while a > low:
        n = min(step, a - low)
        other = (seq[a - n : a] != seq[a - n + d : a + d])[::-1]
        if other.any():
            a -= int(other.argmax())
            break
        a, step = a - n, step * 2
    return a, b + d


def runs(texts: list[np.ndarray], repeats: int = REPEATS, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each sequence of word numbers, by start and period.

    ``repeats`` is at least four: fewer would not promise two whole blocks.
    """
    if repeats < 4:
        raise ValueError("repeats must be at least 4")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    base = 1 + max((int(t.max()) for t in texts if len(t)), default=0)
    block = 1
    while True:
        mine = np.flatnonzero(sizes >= max(least, repeats * block))
        if not len(mine):
            break
        starts = np.concatenate([[0], np.cumsum(sizes[mine] + 1)])
        total = int(starts[-1])
        padded = (-(-total // block) + 2) * block
        seq = np.empty(padded, np.int64)
        for k, i in enumerate(mine):
            seq[starts[k] : starts[k + 1] - 1] = texts[i]
        seq[starts[1:] - 1] = base + np.arange(len(mine))
        seq[total:] = base + len(mine) + np.arange(padded - total)
        hit = occurrences(seq, block)
        none = np.zeros((1, block), bool)
        seed = hit & np.concatenate([hit[1:], none]) & ~np.concatenate([none, hit[:-1]])
        j, e = np.nonzero(seed)
        order = np.argsort(e, kind="stable")
        for i, d in zip((j[order] * block).tolist(), (e[order] + block).tolist()):
            k = int(np.searchsorted(starts, i, "right")) - 1
            low = int(starts[k])
            own = found[mine[k]]
            if any(d % q == 0 and s <= i - low and i - low + d + block <= s + n for s, n, q in own):
                continue
            if seq[i] != seq[i + d]:
                continue
            a, b = _extended(seq, i, d, low, int(starts[k + 1]) - 1)
            if b - a >= max(least, repeats * d):
                own.append((a - low, b - a, d))
        block *= 2
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in found]


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    if not found:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def periodic_runs(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = (), repeats: int = REPEATS, least: int = LEAST,
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``runs``, ``collapsed``, and the columns named in ``keep``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text. ``runs`` lists start (word number from 0), length and period of every
    run of at least ``least`` words and ``repeats`` periods, by start and period. ``collapsed`` is the text's words joined by one
    space, without those that some run holds after its first period. Null, empty and blank texts have no words, no runs and
    an empty ``collapsed``. Rows are independent of each other: repeated rows, null ids and clashing names of other columns
    do not matter, and an empty table gives an empty result. A very long text is a batch of its own; memory follows the longest text.
    """
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    d = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"), *[F.col(c).alias(n) for c, n in zip(keep, names[1:])])
    schema = T.StructType([d.schema[n] for n in names] + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches):
        for batch in slices(batches, "_text", BATCH_BYTES):
            words = [(t or b"").split() for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            number = count()
            numbers: dict[bytes, int] = {}
            ids = []
            for w in words:
                for x in set(w):
                    if x not in numbers:
                        numbers[x] = next(number)
                ids.append(np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)))
            found = runs(ids, repeats, least)
            columns = [
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], kind),
                pa.array([_collapsed(w, f) for w, f in zip(words, found)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], [*names, "n_words", "runs", "collapsed"])

    return d.mapInArrow(run, schema).select(
        F.col("_id").alias(id_col), "n_words", "runs", "collapsed", *[F.col(n).alias(c) for c, n in zip(keep, names[1:])],
    )
