"""Phrase collocations: candidates in double-array tries that go to the texts, counted level by level.

* Words are counted per language; words over the support become numbers (a number stands for a word of one language), and
  texts become rows of numbers with 0 for breaks between pieces and for all other words. They are written once.
* Candidates of the next length are windows of the texts whose words, and whose shorter phrases, are all over the support
  (Apriori). Windows are added up in hashed buckets by the tasks and by Spark, and only those in a bucket over the
  support are candidates: a bucket holds at least what each of its phrases has.
* Candidates are cut into shards of at most ``SHARD`` phrases. Each becomes a double-array trie over the bytes of the word
  numbers (bases and owners of slots; a child is at ``base ^ byte``), whose size bounds the broadcast. In a task numpy moves the states of all
  text positions at once, byte by byte, drops those without a child and adds up accepting slots by ``bincount``; Spark adds up tasks.
* Candidates beyond one shard still take one pass: windows that pass a bit table of the candidates are added up and meet the trie of their
  shard, and places are marked by such a table. What goes to a task never grows with the data.
* Cuts, scores (decimals), the rule for parts of longer phrases and the best of each language are Spark SQL.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.llm.common import TABLE_BITS, bit_table, in_table, release, slices, staged
from echofield.llm.lsh_forest import _mixed

LEAST, LONGEST, COVER, TOP = 10, 3, 50, 2000
UNDEFINED = "und"
BREAK = b"."
#: White space inside pieces as it is, everything that ends a piece as one break.
SPLITS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
#: log2 of the numbers in one part of the vocabulary, which is about half full.
PART_BITS = 15
#: Words that go to the tasks at once (some 25 bytes each), and phrases in one trie.
VOCABULARY, SHARD = 1 << 22, 1 << 20
#: Positions whose states move at once; windows that a task adds up before it hands them on.
POSITIONS, HELD = 1 << 18, 3 << 19
BUCKET_BITS = 62


def tokens(text: bytes | None) -> list[bytes]:
    """Words and breaks of a whole text (UTF-8) with A-Z in lower case."""
    return (text or b"").lower().translate(SPLITS).replace(BREAK, b" . ").split()


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


def count_words(docs: DataFrame) -> DataFrame:
    """``lang``, ``word`` and ``f`` of every word; each task adds up first."""

    def run(batches):
        held: dict[str, Counter[bytes]] = defaultdict(Counter)

        def out():
            for lang, c in held.items():
                c.pop(BREAK, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()), pa.array(list(c.values()), pa.int64())], ["lang", "word", "f"])
            held.clear()

        for batch in slices(batches, "_text"):
            for lang, text in zip(batch.column("_lang").to_pylist(), _texts(batch)):
                held[lang].update(tokens(text))
            if sum(map(len, held.values())) > HELD // 2:
                yield from out()
        yield from out()

    return docs.mapInArrow(run, "lang string, word string, f bigint").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def numbered(words: DataFrame) -> DataFrame:
    """Words with ``id`` from 1: parts of about half of 2^PART_BITS words, numbered inside each by one small window."""
    parts = max(1, -(-words.count() >> (PART_BITS - 1)))
    part = F.pmod(F.xxhash64("lang", "word"), F.lit(parts))
    w = W.partitionBy("_part").orderBy("lang", "word")
    return words.withColumn("_part", part).withColumn("id", F.col("_part") * (1 << PART_BITS) + F.row_number().over(w))


#: Words whose numbers a task remembers.
REMEMBERED = 1 << 18


class Numbers:
    """Numbers of the words of each language as flat arrays: sorted 64-bit digests, numbers, and the words themselves to compare with."""

    def __init__(self, langs: list[str], words: list[str], ids: np.ndarray):
        keys = [self.key(lang, word.encode()) for lang, word in zip(langs, words)]
        digest = self.digests(keys)
        order = np.argsort(digest, kind="stable")
        self.digest, self.ids = digest[order], ids[order].astype(np.int32)
        self.flat = b"".join(keys[i] for i in order)
        self.ends = np.cumsum([0] + [len(keys[i]) for i in order])

    @staticmethod
    def key(lang: str, word: bytes) -> bytes:
        raw = lang.encode()
        return len(raw).to_bytes(4, "big") + raw + word

    @staticmethod
    def digests(keys: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blake2b(k, digest_size=8).digest() for k in keys), np.uint64)

    def of(self, lang: str, words: list[bytes]) -> list[int]:
        """The number of each word, 0 for words that have none."""
        keys = [self.key(lang, w) for w in words]
        mine = self.digests(keys)
        out = [0] * len(words)
        for k, low, high in zip(range(len(keys)), np.searchsorted(self.digest, mine).tolist(), np.searchsorted(self.digest, mine, "right").tolist()):
            for i in range(low, high):  # next to always one or none
                if self.flat[self.ends[i] : self.ends[i + 1]] == keys[k]:
                    out[k] = int(self.ids[i])
        return out


def as_numbers(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``ids`` of every text that has words over the support: little-endian 32-bit numbers, 0 for breaks and other words.

    The vocabulary meets the texts in sets of parts of bounded size; more than one set is more than one pass.
    """
    parts = (words.agg(F.max("_part")).first()[0] or 0) + 1
    at_once = max(1, VOCABULARY >> (PART_BITS - 1))
    known = None
    for first in range(0, parts, at_once):
        mine = words.filter(F.col("_part").between(first, first + at_once - 1)).select("lang", "word", "id").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(Numbers(mine.column("lang").to_pylist(), mine.column("word").to_pylist(), mine.column("id").to_numpy()))

        def run(batches):
            held: dict[str, dict[bytes, int]] = defaultdict(dict)
            for batch in slices(batches, "_text"):
                out = []
                before = batch.column("_ids").to_pylist() if "_ids" in batch.schema.names else None
                split = [(lang, tokens(text)) for lang, text in zip(batch.column("_lang").to_pylist(), _texts(batch))]
                if sum(map(len, held.values())) > REMEMBERED:
                    held.clear()
                fresh: dict[str, set[bytes]] = defaultdict(set)
                for lang, t in split:
                    fresh[lang].update(t)
                for lang, new in fresh.items():
                    new = list(new.difference(held[lang]))
                    held[lang].update(zip(new, shared.value.of(lang, new)))
                for k, (lang, t) in enumerate(split):
                    ids = np.fromiter(map(held[lang].__getitem__, t), np.int32, len(t))
                    out.append((ids if before is None else np.maximum(ids, np.frombuffer(before[k], np.int32))).tobytes())
                columns = [batch.column(c) for c in ("_lang", "_text")] if more else []
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], [*(("_lang", "_text") if more else ()), "_ids"])

        more = first + at_once < parts
        source = docs.select("_lang", "_text") if known is None else known
        known = staged(source.mapInArrow(run, ("_lang string, _text string, " if more else "") + "_ids binary"), "phrase-ids")
    return known


def _rows(batches):
    """Numbers of many texts at once, a break after each."""
    held, n = [], 0
    for batch in batches:
        for raw in batch.column("_ids").to_pylist():
            held += [np.frombuffer(raw, np.int32), np.zeros(1, np.int32)]
            n += len(held[-2]) + 1
            if n >= POSITIONS:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _keys(x: np.ndarray) -> np.ndarray:
    """A bucket for each row of word numbers."""
    h = np.zeros(len(x), np.uint64)
    for k in range(x.shape[1]):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + x[:, k].astype(np.uint64))
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _windows(ids: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(ids, size) if len(ids) >= size else np.zeros((0, size), np.int32)


def _distinct(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if x.shape[1] == 2:
        order = np.argsort(x[:, 0].astype(np.int64) << 32 | x[:, 1], kind="stable")
    else:
        order = np.lexsort(x.T[::-1])
    x = x[order]
    first = np.flatnonzero(np.append(True, (x[1:] != x[:-1]).any(1)))
    return x[first], np.add.reduceat(n[order], first)


def candidates(ids: DataFrame, size: int, least: int) -> DataFrame:
    """``w0`` .. of the windows of ``size`` words whose bucket is over the support.

    ``ids`` holds the numbers, and from three words on ``_safe``: a byte for each place, 1 where a phrase of ``size - 1`` words over the
    support starts.
    """
    names = [f"w{k}" for k in range(size)]
    found = _found(ids, size)
    ends = [e for c in names for e in (F.min(c).alias(c), F.max(c).alias(f"_{c}"))]
    full = staged(found.repartition("_bucket").groupBy("_bucket").agg(F.sum("_n").alias("_n"), *ends).filter(F.col("_n") >= least), "phrase-buckets")
    one = " and ".join(f"{c} = _{c}" for c in names)
    shared = full.filter(f"not ({one})").select("_bucket")
    out = full.filter(one).select(*names)
    # Buckets of several phrases are next to none; only for them the windows are made again.
    return out if shared.isEmpty() else out.unionByName(found.join(shared, "_bucket", "left_semi").select(*names).distinct())


def _found(ids: DataFrame, size: int) -> DataFrame:
    """``_bucket``, ``w0`` .. and ``_n`` of the windows of ``size`` words, added up by the tasks."""
    names = [f"w{k}" for k in range(size)]

    def run(batches):
        held, n = [], 0

        def out():
            x, c = _distinct(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            columns = [pa.array(_keys(x)), *[pa.array(x[:, k].astype(np.int64)) for k in range(size)], pa.array(c)]
            return x, c, pa.RecordBatch.from_arrays(columns, ["_bucket", *names, "_n"])

        for batch in batches:
            for x in _safe_windows(batch, size):
                x, c = _distinct(x, np.ones(len(x), np.int64))
                held.append((x, c))
                n += len(x)
                if n > HELD:
                    x, c, full = out()
                    held, n = ([(x, c)], len(x)) if len(x) <= HELD // 2 else ([], 0)
                    if not n:
                        yield full
        if n:
            yield out()[2]

    return ids.mapInArrow(run, "_bucket bigint, " + ", ".join(f"{c} bigint" for c in names) + ", _n bigint")


def _safe_windows(batch: pa.RecordBatch, size: int):
    """Windows of many texts at once, not empty."""
    safe = batch.column("_safe").to_pylist() if size > 2 else [None] * batch.num_rows
    held, flags, n = [], [], 0

    def out():
        x = _windows(np.concatenate(held), size)
        if size == 2:
            return x[(x > 0).all(1)]
        ok = np.concatenate(flags)
        return x[ok[: len(x)] & ok[1 : len(x) + 1]]

    for raw, marks in zip(batch.column("_ids").to_pylist(), safe):
        held += [np.frombuffer(raw, np.int32), np.zeros(1, np.int32)]
        flags += [np.frombuffer(marks, np.bool_), np.zeros(1, bool)] if marks is not None else []
        n += len(held[-2]) + 1
        if n >= POSITIONS:
            if len(x := out()):
                yield x
            held, flags, n = [], [], 0
    if held and len(x := out()):
        yield x


@dataclass
class Trie:
    """Double array: slot ``s`` has the child ``base[s] ^ byte`` if that slot's ``owner`` is ``s``. Slot 0 is the root."""

    base: np.ndarray
    owner: np.ndarray
    levels: int

    def advance(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows of bytes that are accepted, and their slots."""
        at, s = np.arange(len(rows)), np.zeros(len(rows), np.int32)
        for k in range(self.levels):
            child = self.base[s] ^ rows[at, k]
            ok = self.owner[child] == s
            at, s = at[ok], child[ok]
        return at, s


def as_bytes(x: np.ndarray) -> np.ndarray:
    """Rows of word numbers as rows of their bytes, highest first."""
    return np.ascontiguousarray(x, ">u4").view(np.uint8).reshape(len(x), 4 * x.shape[1])


class _Slots:
    """The table of a double array while it is filled."""

    def __init__(self, room: int):
        self.rng = np.random.default_rng(7)
        self.owner = np.full(max(256, -(-room // 256) * 256), -1, np.int32)
        self.base = np.zeros(len(self.owner), np.int32)
        self.owner[0] = 0
        self.claim = np.zeros(0, np.int32)

    def grow(self, slots: int) -> None:
        more = -(-slots // 256) * 256
        self.owner = np.append(self.owner, np.full(more, -1, np.int32))
        self.base = np.append(self.base, np.zeros(more, np.int32))

    def place(self, parents: np.ndarray, first: np.ndarray, n: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Slots of the children (those of a parent side by side in ``symbol``), as many as symbols; sets bases and owners."""
        out = np.zeros(len(symbol), np.int64)
        single = np.flatnonzero(n == 1)
        for low in (128, 64, 32, 16, 8, 4, 2):
            rest = np.flatnonzero((n >= low) & (n < 2 * low) if low < 128 else n >= low)
            for _ in range(24):
                if not len(rest):
                    break
                rest = rest[~self._try(parents, first, n, symbol, out, rest, self.rng.integers(0, len(self.owner), len(rest)))]
            if len(rest):
                start = len(self.owner)
                self.grow(256 * len(rest))
                self._try(parents, first, n, symbol, out, rest, start + 256 * np.arange(len(rest)))
        free = np.flatnonzero(self.owner < 0)
        if len(free) < len(single):
            self.grow(len(single) - len(free))
            free = np.flatnonzero(self.owner < 0)
        slot = free[: len(single)]
        out[first[single]] = slot
        self.base[parents[single]] = slot ^ symbol[first[single]]
        self.owner[slot] = parents[single]
        return out

    def _try(self, parents, first, n, symbol, out, mine, base) -> np.ndarray:
        """Which of the parents ``mine`` got their children's slots at ``base``."""
        width = n[mine]
        edge = np.concatenate([[0], np.cumsum(width)[:-1]])
        child = np.repeat(first[mine] - edge, width) + np.arange(width.sum())
        slot = np.repeat(base, width) ^ symbol[child]
        who = np.repeat(np.arange(len(mine)), width)
        if len(self.claim) < len(self.owner):
            self.claim = np.zeros(len(self.owner), np.int32)
        self.claim[slot] = who
        good = np.logical_and.reduceat((self.claim[slot] == who) & (self.owner[slot] < 0), edge)
        keep = good[who]
        out[child[keep]] = slot[keep]
        self.owner[slot[keep]] = parents[mine][who[keep]]
        self.base[parents[mine][good]] = base[good]
        return good


def build(phrases: np.ndarray) -> tuple[Trie, np.ndarray]:
    """The trie of rows of word numbers, and the accepting slot of each row (rows are distinct)."""
    rows = as_bytes(phrases)
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    slots = _Slots(2 * len(rows) + 512)
    slot_of = np.zeros(max(1, len(rows)), np.int64)
    new = np.zeros(len(rows), bool)
    if len(new):
        new[0] = True
    for k in range(rows.shape[1]):
        before = np.flatnonzero(new) if k else np.zeros(1, np.int64)
        new = new.copy()
        new[1:] |= rows[1:, k] != rows[:-1, k]
        at = np.flatnonzero(new)
        symbol = rows[at, k].astype(np.int64)
        first = np.searchsorted(at, before)
        n = np.diff(np.append(first, len(at)))
        placed = slots.place(slot_of[before], first, n, symbol)
        slot_of = placed[np.cumsum(new) - 1]
    out = np.zeros(len(rows), np.int64)
    out[order] = slot_of
    return Trie(slots.base, slots.owner, rows.shape[1]), out


#: Bytes of a trie in one row of its table.
PIECE = 4 << 20


def _tries(phrases: DataFrame, size: int, shard: int) -> tuple[DataFrame, int]:
    """The tries of all shards, built by one task each and written, and the number of shards.

    Rows are either a piece of the two arrays of a trie (``_piece``, ``_bytes``) or a phrase with its accepting slot (``_slot``, ``w0`` ..).
    """
    names = [f"w{k}" for k in range(size)]
    parts = -(-phrases.count() // shard)
    columns = ["_shard", "_piece", "_bytes", "_slot", *names]

    def run(table: pa.Table) -> pa.Table:
        n = table.num_rows
        trie, slot = build(np.stack([table.column(c).to_numpy() for c in names], 1).astype(np.int32))
        raw = np.stack([trie.base, trie.owner]).astype(np.int32).tobytes()
        pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
        k = table.column("_shard")[0].as_py()
        none = lambda m, kind: pa.nulls(m, kind)
        fill = lambda m: pa.array(np.full(m, k), pa.int64())
        one = pa.table([fill(len(pieces)), pa.array(range(len(pieces)), pa.int64()), pa.array(pieces, pa.binary()), *[none(len(pieces), pa.int64())] * (1 + size)], columns)
        two = pa.table([fill(n), none(n, pa.int64()), none(n, pa.binary()), pa.array(slot), *[table.column(c) for c in names]], columns)
        return pa.concat_tables([one, two])

    dealt = phrases.select(*names, F.pmod(F.xxhash64(*names), F.lit(max(1, parts))).alias("_shard"))
    kinds = "_shard bigint, _piece bigint, _bytes binary, _slot bigint, " + ", ".join(f"{c} bigint" for c in names)
    return staged(dealt.groupBy("_shard").applyInArrow(run, kinds), "phrase-tries"), parts


def _shared(tries: DataFrame, k: int, size: int):
    """Broadcast of the trie of one shard; only its arrays pass the driver."""
    rows = tries.filter((F.col("_shard") == k) & F.col("_piece").isNotNull()).select("_piece", "_bytes").collect()
    both = np.frombuffer(b"".join(bytes(r["_bytes"]) for r in sorted(rows, key=lambda r: r["_piece"])), np.int32).reshape(2, -1)
    return tries.sparkSession.sparkContext.broadcast(Trie(both[0], both[1], 4 * size))


def count_phrases(ids: DataFrame, phrases: DataFrame, size: int, shard: int) -> DataFrame:
    """``w0`` .. and ``f``: all occurrences of the candidates in the texts, by one pass whatever the number of shards.

    ``ids`` has ``_safe`` from three words on where there are several shards.
    """
    names = [f"w{k}" for k in range(size)]
    if phrases.count() > shard:
        return _count_dealt(ids, phrases, size, shard)
    tries, n = _tries(phrases, size, shard)
    cores, parts = max(1, ids.sparkSession.sparkContext.defaultParallelism), []
    for k in range(n):
        shared = _shared(tries, k, size)

        def run(batches):
            t = shared.value
            total = np.zeros(len(t.owner), np.int64)
            for x in _rows(batches):
                x = _windows(x, size)
                x = x[(x > 0).all(1)]
                total += np.bincount(t.advance(as_bytes(x))[1], minlength=len(total))
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["_slot", "f"])

        # As many tasks as cores: each adds up more texts, and what they hand on grows with the phrases alone.
        counted = ids.select("_ids").coalesce(cores).mapInArrow(run, "_slot bigint, f bigint").groupBy("_slot").agg(F.sum("f").alias("f"))
        own = tries.filter((F.col("_shard") == k) & F.col("_slot").isNotNull())
        parts.append(staged(own.join(counted, "_slot").select(*names, "f"), "phrase-counts"))
        shared.unpersist()
    release(tries)
    if not parts:
        return ids.sparkSession.createDataFrame([], ", ".join(f"{c} bigint" for c in [*names, "f"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _count_dealt(ids: DataFrame, phrases: DataFrame, size: int, shard: int) -> DataFrame:
    """Counts of more candidates than a trie holds: windows that pass a bit table of the candidates are added up by phrase and meet the trie of their shard."""
    names = [f"w{k}" for k in range(size)]
    n = phrases.count()
    keyed, bits = staged(_with_bucket(phrases, size), "phrase-keys"), _bits(n)
    table = staged(bit_table(keyed, ["_bucket"], bits, hashed=True), "phrase-table")
    kept = _found(ids, size).withColumn("_table", table.scalar()).filter(in_table("_table", ["_bucket"], bits, hashed=True)).groupBy("_bucket", *names).agg(F.sum("_n").alias("_n"))
    dealt = F.pmod(F.col("_bucket"), F.lit(-(-n // shard))).alias("_shard")
    kinds = ", ".join(f"{c} bigint" for c in [*names, "f"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = lambda t: np.stack([t.column(c).to_numpy() for c in names], 1).astype(np.int32)
        trie, slot = build(rows(left))
        at, s = trie.advance(as_bytes(rows(right)))
        total = np.zeros(len(trie.owner), np.int64)
        np.add.at(total, s, right.column("_n").to_numpy()[at])
        return pa.table([*[left.column(c) for c in names], pa.array(total[slot])], [*names, "f"])

    left, right = keyed.select(dealt, *names).groupBy("_shard"), kept.select(dealt, *names, "_n").groupBy("_shard")
    out = staged(left.cogroup(right).applyInArrow(run, kinds).filter(F.col("f") > 0), "phrase-counts")
    release(keyed, table)
    return out


def _bits(n: int) -> int:
    """log2 of the bits of a table of ``n`` keys: some twelve for each, 16 MB at most."""
    return min(27, max(TABLE_BITS, (12 * n).bit_length()))


def _with_bucket(phrases: DataFrame, size: int) -> DataFrame:
    names = [f"w{k}" for k in range(size)]

    def run(batches):
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in names], 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(_keys(x)), *[b.column(c) for c in names]], ["_bucket", *names])

    return phrases.select(*names).mapInArrow(run, "_bucket bigint, " + ", ".join(f"{c} bigint" for c in names))


def _marked_by_table(ids: DataFrame, phrases: DataFrame, size: int) -> DataFrame:
    """``ids`` with ``_safe`` for more phrases than a trie holds, from a bit table: 1 at all places where a phrase starts and at few others.

    A longer phrase over the support has parts over it in any case, so the others cost windows and change no result.
    """
    bits = _bits(phrases.count())
    told = bit_table(_with_bucket(phrases, size), ["_bucket"], bits, hashed=True).toArrow().column("_table").combine_chunks()
    shared = ids.sparkSession.sparkContext.broadcast(told.flatten().to_numpy())

    def run(batches):
        table, mask = shared.value, (1 << bits) - 1
        for batch in batches:
            flags = []
            for raw in batch.column("_ids").to_pylist():
                x = np.frombuffer(raw, np.int32)
                safe = np.zeros(len(x), bool)
                y = _windows(x, size)
                at = np.flatnonzero((y > 0).all(1))
                slot = _keys(y[at]) & mask
                safe[at] = (table[slot >> 6] >> (slot & 63)) & 1 == 1
                flags.append(safe.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("_ids"), pa.array(flags, pa.binary())], ["_ids", "_safe"])

    return staged(ids.select("_ids").mapInArrow(run, "_ids binary, _safe binary"), "phrase-marks")


def marked(ids: DataFrame, phrases: DataFrame, size: int, shard: int) -> DataFrame:
    """``ids`` with ``_safe``: a byte for each place, 1 where one of the ``phrases`` starts."""
    if phrases.count() > shard:
        return _marked_by_table(ids, phrases, size)
    tries, n = _tries(phrases, size, shard)
    out = ids.select("_ids")
    for k in range(n):
        shared = _shared(tries, k, size)

        def run(batches):
            for batch in batches:
                flags = []
                before = batch.column("_safe").to_pylist() if "_safe" in batch.schema.names else None
                for k, raw in enumerate(batch.column("_ids").to_pylist()):
                    x = np.frombuffer(raw, np.int32)
                    safe = np.zeros(len(x), bool) if before is None else np.frombuffer(before[k], np.bool_).copy()
                    y = _windows(x, size)
                    at = np.flatnonzero((y > 0).all(1))
                    safe[at[shared.value.advance(as_bytes(y[at]))[0]]] = True
                    flags.append(safe.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column("_ids"), pa.array(flags, pa.binary())], ["_ids", "_safe"])

        old, out = out, staged(out.mapInArrow(run, "_ids binary, _safe binary"), "phrase-marks")
        release(old)
    release(tries)
    return out


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, cover: int = COVER, top: int | None = TOP, shard: int = SHARD,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the best phrases of two and three words of each language.

    A-Z is lowered, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words ``[^\\x20\\x09]+``; phrases stay inside pieces. A
    phrase with ``a >= least`` occurrences (overlaps included) scores floor(10^6 a^2 / (l r)) at its lowest-scoring cut, ties to the
    first. It is dropped if a longer one with at least ``cover`` per cent of its occurrences holds it. Ranks go by score,
    ``a`` and the phrase's UTF-8 bytes; ``top`` (None: all) is the length of the report.

    A null language is ``und``. Null, empty and blank texts have no words; a language without phrases has no rows, and an empty
    table gives an empty result. Repeated rows count as often as they come; ids and other columns are not read. A very long text is one
    row of one task, its states in blocks.
    """
    d = docs.select(F.coalesce(F.col(lang), F.lit(UNDEFINED)).alias("_lang"), F.col(text).alias("_text"))
    counts = staged(count_words(d), "phrase-words")
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = staged(numbered(counts.filter(F.col("f") >= least)), "phrase-vocabulary")
    ids = as_numbers(d, words)

    pairs = staged(candidates(ids, 2, least), "phrase-candidates")
    pairs = staged(count_phrases(ids, pairs, 2, shard).filter(F.col("f") >= least), "phrase-pairs")
    if pairs.isEmpty():
        triples = docs.sparkSession.createDataFrame([], "w0 bigint, w1 bigint, w2 bigint, f bigint")
    else:
        safe = marked(ids, pairs, 2, shard)
        triples = staged(candidates(safe, 3, least), "phrase-candidates")
        triples = staged(count_phrases(safe, triples, 3, shard).filter(F.col("f") >= least), "phrase-triples")

    word = lambda k: words.select(F.col("id").alias(f"w{k}"), F.col("lang").alias(f"lang{k}"), F.col("word").alias(f"t{k}"), F.col("f").alias(f"f{k}"))
    wide = lambda a, left, right: (
        F.col(a).cast("decimal(15,0)") * F.col(a).cast("decimal(15,0)") * F.lit(1_000_000).cast("decimal(7,0)"),
        F.col(left).cast("decimal(15,0)") * F.col(right).cast("decimal(15,0)"),
    )
    cut = lambda k, left, right: F.struct(F.call_function("div", *wide("f", left, right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    two = pairs.join(word(0), "w0").join(word(1), "w1")
    two = two.select("w0", "w1", F.col("lang0").alias("lang"), F.concat_ws(" ", "t0", "t1").alias("phrase"), F.col("f").alias("a"), cut(1, "f0", "f1").alias("_cut"))
    inner = lambda x, y, f: pairs.select(F.col("w0").alias(x), F.col("w1").alias(y), F.col("f").alias(f))
    three = triples.join(inner("w0", "w1", "f01"), ["w0", "w1"]).join(inner("w1", "w2", "f12"), ["w1", "w2"]).join(word(0), "w0").join(word(1), "w1").join(word(2), "w2")
    best = F.least(cut(1, "f0", "f12"), cut(2, "f01", "f2"))
    three = three.select(F.col("lang0").alias("lang"), F.concat_ws(" ", "t0", "t1", "t2").alias("phrase"), F.col("f").alias("a"), best.alias("_cut"))

    longer = triples.select("w0", "w1", "f").union(triples.select("w1", "w2", "f")).groupBy("w0", "w1").agg(F.max("f").alias("_longer"))
    two = two.join(longer, ["w0", "w1"], "left").filter(F.coalesce(100 * F.col("_longer") < cover * F.col("a"), F.lit(True)))
    out = two.select("lang", "phrase", "a", "_cut").unionByName(three)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("_cut.score").desc(), F.col("a").desc(), "phrase"))
    out = out.withColumn("rank", rank)
    out = out if top is None else out.filter(F.col("rank") <= top)
    return out.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))
