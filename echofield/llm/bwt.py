"""Repeated passages by merging shard Burrows-Wheeler transforms.

1. Windows. Every string of ``LENGTH`` bytes is named by the lowest hash of its ``GRAM``-byte grams: equal strings have
   equal names. Consecutive windows with one name are a run, about one for 85 bytes of text. A name that one run has
   cannot repeat and is dropped; a bit table of fixed size carries the others to the second pass.
2. Whole runs. Runs of equal bytes are found by their digests; all their windows repeat.
3. The others: runs that are alone but share a name with another run. Their bytes, whole names together, are cut into
   shards. Each shard has its transform (for each suffix in order, the eight bytes before it) and its LF map. All
   shards of a batch are merged by interleave refinement: the interleave starts with shard after shard, and each round
   sorts it stably by the preceding words, which orders it by eight more bytes; no suffix is compared again. Where the
   word or the block of the suffix after it changes, a new block begins, so blocks are the intervals with a common
   prefix of that depth. Blocks of one suffix are left out of later rounds. Blocks that are left after ``LENGTH`` bytes
   are the repeated intervals.
4. Names with more than ``HOT_STRINGS`` different runs would be one task's work; their windows are counted by digest
   all over the cluster instead.

Covered bytes are cut where the text is; texts without a repeated window are not shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import bit_table, in_table, slices, staged, with_group
from echofield.llm.lsh_forest import _mixed

LENGTH = 200
GRAM = 32
WORD_BYTES = 8
LONGEST_RUN = 256
BLOCK_BYTES = 4 << 20
HOT_STRINGS = 2_000
SHARDS = 4
BATCH_BYTES = 1 << 19
#: log2 of the bits of the table of repeated names: sixteen for each, 16 MB at most.
MOST_BITS = 27
NONE = np.uint64(2**64 - 1)


def _slide(x: np.ndarray, width: int, op, pad) -> np.ndarray:
    """op over every ``width`` neighbours, from block-wise running values in both directions."""
    n = len(x) - width + 1
    full = np.concatenate([x, np.full(-len(x) % width, pad, x.dtype)]).reshape(-1, width)
    ahead = op.accumulate(full, 1).ravel()
    back = op.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1 : width - 1 + n])


def block_runs(b: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, numbers of windows, names, and whether a run's windows may equal each other, of one block of bytes."""
    if len(b) < length:
        e = np.empty(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(bool)
    h = b.astype(np.uint64) + np.uint64(1)
    for k in range(5):
        step = 1 << k
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x51ED27) + h[step:]
        h ^= h >> np.uint64(29)
    h = _mixed(h)
    width = length - GRAM + 1
    m = _slide(h, width, np.minimum, NONE)
    new = np.append(True, m[1:] != m[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(m)))
    if sizes.max() > LONGEST_RUN:
        parts = -(-sizes // LONGEST_RUN)
        first = np.repeat(starts, parts)
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(starts + sizes, parts)
        starts = first + at * LONGEST_RUN
        sizes = np.minimum(ends - starts, LONGEST_RUN)
    names = m[starts]
    # Grams that name a window, and names that stand twice within the reach of a run.
    reach = _slide(np.concatenate([np.zeros(width - 1, np.uint64), m, np.zeros(width - 1, np.uint64)]), width, np.maximum, np.uint64(0))
    at = np.flatnonzero(h == reach)
    by = np.lexsort((at, h[at]))
    at, v = at[by], h[at[by]]
    twice = (v[1:] == v[:-1]) & (np.diff(at) <= LONGEST_RUN + width)
    return starts, sizes, names, np.isin(names, np.unique(v[1:][twice]))


def text_runs(b: np.ndarray, length: int = LENGTH):
    """The same for a whole text, by blocks that overlap by a window."""
    for at in range(0, max(1, len(b) - length + 1), BLOCK_BYTES):
        s, n, m, own = block_runs(b[at : at + BLOCK_BYTES + length - 1], length)
        yield s + at, n, m, own


def _order(key: np.ndarray) -> np.ndarray:
    """Places that sort whole numbers stably. Numbers and places share 63 bits where they fit: values sort faster than places."""
    n = len(key)
    place = max(1, int(n).bit_length())
    if n and int(key.max()).bit_length() + place <= 63:
        return np.sort(key.astype(np.int64) << place | np.arange(n)) & ((1 << place) - 1)
    return np.argsort(key, kind="stable")


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks of values, equal ones alike."""
    order = _order(key)
    s = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(0, s[1:] != s[:-1]))
    return out


def _words(strings: list[bytes]) -> np.ndarray:
    """For each suffix of each string, the empty one included, the rank of its first eight bytes; short ones end in zeros."""
    sizes = np.array([len(s) + 1 for s in strings])
    text = np.frombuffer(b"".join(s + b"\0" for s in strings) + bytes(WORD_BYTES), np.uint8)
    n = len(text) - WORD_BYTES
    words = np.ndarray((n,), ">u8", text.data, 0, (1,)).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(n)
    short = np.flatnonzero(left < WORD_BYTES)
    words[short] &= ~(NONE >> (np.uint64(8) * left[short].astype(np.uint64)))
    return np.unique(words, return_inverse=True)[1]


class Shard:
    """Suffix order, transform and LF map of a list of strings, each at least ``WORD_BYTES`` long, and their words."""

    def __init__(self, strings: list[bytes], words: np.ndarray, depth: int = LENGTH):
        # Each string is followed by a place for its empty suffix.
        sizes = np.array([len(s) + 1 for s in strings])
        self.start = np.cumsum(sizes) - sizes
        ends = np.repeat(self.start + sizes - 1, sizes)
        n = len(words)
        rank, reach = _dense(words), WORD_BYTES
        while reach < depth and rank.max() < n - 1:
            # Suffixes that end within the reach are told apart by what is left of them.
            at = np.arange(n) + reach
            after = np.where(at < ends, rank[np.minimum(at, n - 1)] + 1, 0)
            rank = _dense(rank * (n + 2) + after)
            reach *= 2
        self.order = _order(rank)
        offset = np.arange(n) - np.repeat(self.start, sizes)
        before = np.where(offset >= WORD_BYTES, np.arange(n) - WORD_BYTES, ends + 1 - WORD_BYTES + offset)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        #: Of the suffix at each place: the word before it, the place of the suffix that begins there, whether one does.
        self.transform = words[before[self.order]]
        self.lf = place[before[self.order]]
        self.inner = (offset >= WORD_BYTES)[self.order]


def merge(shards: list[Shard], depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Interleave refinement over all shards: the interleave of the suffixes that share ``depth`` bytes with another
    one, and their blocks. A suffix is given by its place in its shard plus the length of the shards before it."""
    shift = np.cumsum([0, *[len(s.order) for s in shards]])
    transform = np.concatenate([np.where(s.inner, s.transform, -1) for s in shards]).astype(np.int32)
    lf = np.concatenate([s.lf + k for s, k in zip(shards, shift)]).astype(np.int32)
    rows = np.arange(shift[-1], dtype=np.int32)
    block = np.zeros(len(rows), np.int32)
    for _ in range(depth // WORD_BYTES):
        word = transform[rows]
        # The first suffixes of a string have no word before them inside it.
        inner = word >= 0
        rows, block, word = lf[rows[inner]], block[inner], word[inner]
        if not len(rows):
            break
        order = _order(word)
        rows, block, word = rows[order], block[order], word[order]
        # Sorted stably by word, rows of a word stand in the order of the suffixes after it.
        new = np.empty(len(rows) + 1, bool)
        new[0] = new[-1] = True
        np.logical_or(word[1:] != word[:-1], block[1:] != block[:-1], out=new[1:-1])
        many = ~(new[:-1] & new[1:])
        rows, block = rows[many], np.cumsum(new[:-1], dtype=np.int32)[many]
    return rows, block


def repeated_windows(strings: list[bytes], depth: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """For each string the offsets of its ``depth``-byte windows that stand anywhere else in the strings."""
    parts = [list(range(k, len(strings), shards)) for k in range(min(shards, len(strings)))]
    words = _words([strings[i] for p in parts for i in p])
    cut = np.cumsum([0, *[sum(len(strings[i]) + 1 for i in p) for p in parts]])
    built = [Shard([strings[i] for i in p], words[a:b], depth) for p, a, b in zip(parts, cut, cut[1:])]
    rows, _ = merge(built, depth)
    at = np.sort(np.concatenate([s.order + k for s, k in zip(built, cut)])[rows])
    starts = np.concatenate([s.start + k for s, k in zip(built, cut)])
    ends = np.searchsorted(at, np.append(starts[1:], cut[-1]))
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(strings)
    for j, i in enumerate(i for p in parts for i in p):
        out[i] = at[ends[j - 1] if j else 0 : ends[j]] - starts[j]
    return out


def _intervals(at: np.ndarray) -> list[tuple[int, int]]:
    """Ascending numbers as half-open intervals."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), (at[np.append(cut, len(at) - 1)] + 1).tolist()))


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _names(base: DataFrame, length: int) -> DataFrame:
    """``_m`` and how many runs have this name; a run that may repeat in itself counts twice."""

    def run(batches):
        for batch in slices(batches, "_text"):
            found = [np.concatenate([m, m[own]]) for t in batch.column("_text").to_pylist() for _, _, m, own in text_runs(np.frombuffer(t.encode("utf-8", "replace"), np.uint8), length)]
            m, n = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(n)], ["_m", "_n"])

    return base.select("_text").mapInArrow(run, "_m bigint, _n bigint").groupBy("_m").agg(F.sum("_n").alias("_n"))


RUNS = "_h binary, _p bigint, _len int, _m bigint, _d binary, _own boolean"


def _runs(base: DataFrame, table: np.ndarray, bits: int, length: int) -> DataFrame:
    """Runs whose name is in the table, with the digest of their bytes."""
    shared = base.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        words = shared.value
        for batch in slices(batches, "_text"):
            out: list[tuple] = []
            for t, h in zip(batch.column("_text").to_pylist(), batch.column("_h").to_pylist()):
                raw = t.encode("utf-8", "replace")
                for s, n, m, own in text_runs(np.frombuffer(raw, np.uint8), length):
                    slot = _mixed(m) >> np.uint64(64 - bits)
                    hit = np.flatnonzero(words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))
                    for p, k, name, o in zip(s[hit].tolist(), n[hit].tolist(), m[hit].view(np.int64).tolist(), own[hit].tolist()):
                        out.append((h, p, k, name, hashlib.blake2b(raw[p : p + k + length - 1], digest_size=16).digest(), o))
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["_h", "_p", "_len", "_m", "_d", "_own"])

    return base.select("_h", "_text").mapInArrow(run, RUNS)


def _name_table(names: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the repeated names: a table of at most 2^MOST_BITS bits, joined from the tables of the tasks."""
    repeated = names.filter("_n > 1").select("_m")
    bits = int(min(MOST_BITS, max(16, np.ceil(np.log2(16 * max(1, repeated.count()))))))

    def run(batches):
        words = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            slot = _mixed(batch.column("_m").to_numpy().view(np.uint64)) >> np.uint64(64 - bits)
            np.bitwise_or.at(words, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["_word", "_bits"])

    table = repeated.mapInArrow(run, "_word bigint, _bits bigint").groupBy("_word").agg(F.bit_or("_bits").alias("_bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[table.column("_word").to_numpy()] = table.column("_bits").to_numpy().view(np.uint64)
    return words, bits


def _contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Bytes of the wanted runs (``_one``, ``_h``, ``_p``, ``_len``, ``_m``, ``_d``, ``_alone``, ``_big``), each from one row."""
    by = wanted.groupBy("_one", "_h").agg(F.collect_list(F.struct("_p", "_len", "_m", "_d", "_alone", "_big")).alias("_list"))
    by = staged(by, "bwt-wanted")
    table = staged(bit_table(by, ["_h"]), "bwt-table")
    d = docs.withColumn("_table", table.scalar()).filter(in_table("_table", ["_h"])).drop("_table")
    d = d.join(by.withColumnRenamed("_h", "_h2"), d["_id"].eqNullSafe(by["_one"]) & (d["_h"] == F.col("_h2"))).select("_text", "_list")

    def run(batches):
        for batch in slices(batches, "_text"):
            out = [
                (r["_m"], r["_d"], r["_alone"], r["_big"], raw[r["_p"] : r["_p"] + r["_len"] + length - 1])
                for t, rows in zip(batch.column("_text").to_pylist(), batch.column("_list").to_pylist())
                for raw in [t.encode("utf-8", "replace")] for r in rows
            ]
            kinds = [pa.int64(), pa.binary(), pa.bool_(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["_m", "_d", "_alone", "_big", "_bytes"])

    return d.mapInArrow(run, "_m bigint, _d binary, _alone boolean, _big boolean, _bytes binary")


FOUND = "_d binary, _spans array<struct<a: bigint, b: bigint>>"


def _found(rows: list[tuple[bytes, list[tuple[int, int]]]]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    spans = pa.array([[{"a": a, "b": b} for a, b in s] for _, s in rows], kind)
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.binary()), spans], ["_d", "_spans"])


def _merged(contents: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the runs that are alone, by merged transforms of whole names."""
    c = contents.filter("not _big").select("_m", "_d", "_alone", "_bytes").repartition("_m").sortWithinPartitions("_m", "_d")

    def solve(group):
        at = repeated_windows([b for _, _, b in group], length)
        return _found([(d, _intervals(x)) for (d, alone, _), x in zip(group, at) if alone and len(x)])

    def run(batches):
        held: list[tuple[bytes, bool, bytes]] = []
        size, name, last = 0, None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["_m"] != name and size >= BATCH_BYTES:
                    yield solve(held)
                    held, size = [], 0
                name = r["_m"]
                if r["_d"] != last:
                    held.append((r["_d"], r["_alone"], r["_bytes"]))
                    size += len(r["_bytes"])
                last = r["_d"]
        if held:
            yield solve(held)

    return c.mapInArrow(run, FOUND)


def _counted(contents: DataFrame, length: int) -> DataFrame:
    """The same for names with very many runs: windows by digest."""

    def run(batches):
        for batch in batches:
            digests, at, w = [], [], []
            for d, raw in zip(batch.column("_d").to_pylist(), batch.column("_bytes").to_pylist()):
                for p in range(len(raw) - length + 1):
                    digests.append(d)
                    at.append(p)
                    w.append(hashlib.blake2b(raw[p : p + length], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(at, pa.int64()), pa.array(w, pa.binary())], ["_d", "_at", "_w"])

    hot = contents.filter("_big").dropDuplicates(["_d"])
    windows = staged(hot.select("_d", "_bytes").mapInArrow(run, "_d binary, _at bigint, _w binary"), "bwt-windows")
    often = windows.groupBy("_w").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    often = staged(often, "bwt-often")
    named = with_group(windows, often, "_w", "_n", windows.count()).filter("_n is not null")
    alone = contents.filter("_big and _alone").select("_d").distinct()
    spans = named.join(alone, "_d", "left_semi").groupBy("_d").agg(F.collect_list(F.struct(F.col("_at").alias("a"), (F.col("_at") + 1).alias("b"))).alias("_spans"))
    return spans


def repeated_passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``spans`` (array of start and end in bytes) and ``rest`` (binary), and ``keep``.

    ``spans`` are the maximal runs of bytes that are covered by a string of ``length`` bytes that also starts anywhere else,
    in the same text too; ``rest`` is the UTF-8 of the text without them. ``length`` is a multiple of eight over
    ``GRAM``. Matches do not cross rows. A null text is empty. Texts under ``length`` bytes have no spans. Rows that
    repeat an id or a text are documents of their own. An empty table gives an empty result; clashing names of other
    columns do not matter.
    """
    if length % WORD_BYTES or length <= GRAM:
        raise ValueError("length must be a multiple of 8 over 32")
    kept = [f"_keep{i}" for i in range(len(keep))]
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), body.alias("_text"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("_h"), *[F.col(c).alias(n) for c, n in zip(keep, kept)])
    names = staged(_names(base, length), "bwt-names")
    table, bits = _name_table(names)
    runs = staged(_runs(base, table, bits, length), "bwt-runs")
    by_digest = runs.groupBy("_d").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("_h", "_p", "_len")).alias("_at"), F.first("_m").alias("_m"), F.bool_or("_own").alias("_own")
    )
    by_digest = staged(by_digest, "bwt-digests")
    by_name = by_digest.groupBy("_m").agg(
        F.count(F.lit(1)).alias("_strings"), F.count_if(F.col("_n") == 1).alias("_lone"), F.bool_or(F.col("_own") & (F.col("_n") == 1)).alias("_self")
    )
    by_name = by_name.filter("_lone > 0 and (_strings > 1 or _self)").withColumn("_big", F.col("_strings") > HOT_STRINGS)
    by_name = staged(by_name, "bwt-groups")
    wanted = with_group(by_digest, by_name.select("_m", "_strings", "_big"), "_m", "_strings", by_digest.count()).filter("_strings is not null")
    wanted = wanted.select("_d", "_at.*", "_m", (F.col("_n") == 1).alias("_alone"), "_big")
    sizes = staged(base.groupBy("_h").agg(F.min("_id").alias("_one"), F.count(F.lit(1)).alias("_size")), "bwt-texts")
    wanted = wanted.join(sizes.select("_h", "_one"), "_h")
    contents = staged(_contents(base, wanted, length), "bwt-contents")
    found = staged(_merged(contents, length).unionByName(_counted(contents, length)), "bwt-found")

    lone = found.join(by_digest.select("_d", "_at"), "_d").select("_at._h", F.explode(F.transform("_spans", lambda s: F.struct((s["a"] + F.col("_at._p")).alias("a"), (s["b"] + F.col("_at._p") + (length - 1)).alias("b")))).alias("_s"))
    many = by_digest.filter("_n > 1").select("_d", "_n")
    whole = with_group(runs.select("_d", "_h", "_p", "_len"), many, "_d", "_n", runs.count()).filter("_n is not null")
    whole = whole.select("_h", F.struct(F.col("_p").alias("a"), (F.col("_p") + F.col("_len") + (length - 1)).alias("b")).alias("_s")).distinct()
    spans = lone.unionByName(whole).groupBy("_h").agg(F.collect_list("_s").alias("_spans"))

    def tidy(batches):
        for batch in batches:
            rows = [(h, _union([(s["a"], s["b"]) for s in spans])) for h, spans in zip(batch.column("_h").to_pylist(), batch.column("_spans").to_pylist())]
            yield _found(rows).rename_columns(["_h", "_spans"])

    spans = spans.mapInArrow(tidy, FOUND.replace("_d", "_h"))
    spans = staged(spans.join(sizes.select("_h", "_size"), "_h"), "bwt-spans")
    bits_of = staged(bit_table(spans, ["_h"]), "bwt-table")
    marked = base.withColumn("_table", bits_of.scalar()).withColumn("_hit", in_table("_table", ["_h"])).drop("_table")
    none = marked.filter("not _hit").select("_id", "_text", *kept, F.lit(None).cast("array<struct<a: bigint, b: bigint>>").alias("_spans"))
    hit = with_group(marked.filter("_hit").select("_id", "_text", "_h", *kept), spans, "_h", "_size", sizes.agg(F.sum("_size")).first()[0] or 0)
    both = none.unionByName(hit.select("_id", "_text", *kept, "_spans"))
    schema = T.StructType([both.schema[n] for n in ("_id", *kept)] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))), T.StructField("rest", T.BinaryType()),
    ])

    def cut(batches):
        for batch in slices(batches, "_text"):
            sizes_, rests = [], []
            spans_ = [s or [] for s in batch.column("_spans").to_pylist()]
            for t, s in zip(batch.column("_text").to_pylist(), spans_):
                raw = t.encode("utf-8", "replace")
                edges = [0, *[e for x in s for e in (x["a"], x["b"])], len(raw)]
                sizes_.append(len(raw))
                rests.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            columns = [pa.array(sizes_, pa.int64()), pa.array(spans_, kind), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("_id", *kept)], *columns], ["_id", *kept, "n_bytes", "spans", "rest"])

    out = both.mapInArrow(cut, schema)
    return out.select(F.col("_id").alias(id_col), "n_bytes", "spans", "rest", *[F.col(n).alias(c) for c, n in zip(keep, kept)])
