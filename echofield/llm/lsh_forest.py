"""Near-duplicate components by an LSH forest over word shingles.

* A document's set is its distinct shingles of five words, hashed to 64 bits. Equal sets (128-bit digest) are one
  class, so that thousands of copies are one entry from here on.
* Each class has a signature of ``TREES * DEPTH`` minimum hashes. Each tree orders all classes by its own ``DEPTH`` of
  them. The order is range-partitioned over the cluster, so no bucket has to fit in a task.
* Neighbours in an order with a common prefix are candidates. A region of at most ``REACH + 1`` classes with a common
  first hash gives all its pairs; in a denser one the ``REACH`` nearest are those with the longest common prefixes, and
  all its classes are marked as cut. Rows at the edges of partitions meet in a second, small pass.
* Candidates whose sketches (how many shingles of a set fall in each of ``SKETCH`` buckets) leave no room for an intersection over
  the threshold are out before any set moves; that bound is exact.
* The others are confirmed on full sets: first the best of each class, then those between classes that the first
  links have not already connected.
* The cut classes are finished by an exact join: shingles are ordered from rare to common, two sets over the
  threshold share one of their first ones, and the places there and the lengths leave few pairs. Pairs inside a component
  are left out before they are made; tokens of many classes are dealt out in blocks.

A pair whose first hashes agree in a tree misses it by its other hashes or because both ends are cut there. Without a cut, a
pair at the threshold misses one tree with a probability under 0.2, and all sixteen with one under 1e-11; cut ends meet in the
exact join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import TABLE_BITS, bit_table, in_table, release, shuffle_width, slices, staged, with_group
from echofield.llm.components import components

SHINGLE = 5
TREES, DEPTH = 16, 8
REACH = 4
#: Equal hashes in the part of the signature that orders a tree, for a pair to be a candidate there.
AGREE = 4
THRESHOLD = 85
#: log2 of the buckets that count shingles for the order of the exact join.
TALLY_BITS = 20
#: Classes of a common shingle that one group of the exact join holds, and pairs that it looks at together.
HOT_BLOCK = 4096
MEET_PAIRS = 1 << 20
BLOCK_BYTES = 4 << 20
#: Buckets of the sketch of a set; a bucket holds up to FULL, which stands for any larger number.
SKETCH, FULL = 128, 255
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser over unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


PERMUTE = _odd(TREES * DEPTH, 1)
SHIFT = _odd(TREES * DEPTH, 2)
PLACE = _odd(SHINGLE, 3)
#: Bytes from which a word is hashed by digest, and masks of the first 0 to 8 bytes of a number.
LONG_WORD = 64
HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _block_hashes(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the words of a block: eight bytes at a time over all words, the few long ones by digest."""
    space = SPACES[part]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    starts, length = np.flatnonzero(first), np.flatnonzero(last) + 1
    length -= starts
    padded = np.append(part, np.zeros(8, np.uint8))
    at_any_byte = np.ndarray((len(part),), "<u8", padded.data, 0, (1,))
    h = (at_any_byte[starts] & HEAD[np.minimum(length, 8)]) * PERMUTE[0]
    for k in range(8, LONG_WORD, 8):
        i = np.flatnonzero(length > k)
        if not len(i):
            break
        h[i] = _mixed(h[i]) + (at_any_byte[starts[i] + k] & HEAD[np.minimum(length[i] - k, 8)]) * PERMUTE[1]
    for i in np.flatnonzero(length > LONG_WORD):
        word = part[starts[i] : starts[i] + length[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return _mixed(h + length.astype(np.uint64) * PERMUTE[2]), starts


def batch_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of whole texts with A-Z in lower case, and how many each text has."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    b = LOWER[np.frombuffer(b"\n".join(raw), np.uint8)]
    out, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(b):
        end = at + BLOCK_BYTES
        while end < len(b) and not SPACES[b[end]].item():
            ahead = SPACES[b[end : end + 4096]]
            end = end + int(ahead.argmax()) if ahead.any() else end + len(ahead)
        h, starts = _block_hashes(b[at:end])
        out.append(h)
        places.append(starts + at)
        at = end
    upto = np.searchsorted(np.concatenate(places), np.cumsum([len(r) + 1 for r in raw]))
    return np.concatenate(out), np.diff(np.append(0, upto))


def word_hashes(text: str | None) -> np.ndarray:
    return batch_hashes([text])[0]


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of shingle hashes; fewer words than a shingle make one; no words make none."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    n = min(SHINGLE, len(w))
    sums = np.zeros(len(w) - n + 1, np.uint64)
    for k in range(n):
        sums += w[k : len(w) - n + 1 + k] * PLACE[k]
    return np.unique(_mixed(sums + np.uint64(n)))


def digest(s: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([_mixed(s).sum(), _mixed(s * PERMUTE[0] + SHIFT[0]).sum()], np.uint64).tobytes()


def signature(s: np.ndarray) -> np.ndarray:
    low = np.full(TREES * DEPTH, 2**64 - 1, np.uint64)
    for at in range(0, len(s), 2048):
        low = np.minimum(low, (s[at : at + 2048, None] * PERMUTE + SHIFT).min(0))
    return (low >> np.uint64(32)).astype(">u4")


def sketch(s: np.ndarray) -> bytes:
    """How many shingles of a set fall in each bucket."""
    return np.minimum(np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=SKETCH), FULL).astype(np.uint8).tobytes()


def _classes(docs: DataFrame, text: str, id_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``_id``, the kept columns, ``_n``, ``_cls`` (null for no words), ``_sig`` and ``_sk`` of every row."""
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    d = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), *[F.col(c).alias(n) for c, n in zip(keep, names[1:])])

    def run(batches):
        for batch in slices(batches, "_text"):
            sets = [shingles(t) for t in batch.column("_text").to_pylist()]
            columns = [
                pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns], [*names, "_n", "_cls", "_sig", "_sk"])

    kinds = [("_n", T.LongType()), ("_cls", T.BinaryType()), ("_sig", T.BinaryType()), ("_sk", T.BinaryType())]
    return d.mapInArrow(run, T.StructType([*[d.schema[n] for n in names], *[T.StructField(n, k) for n, k in kinds]]))


PAIR = "_tree int, _x binary, _y binary, _m bigint, _n bigint, _label binary, _label2 binary, _edge boolean"


def _agree(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (labels[i] == labels[j]).sum(1)


def _candidates(batch: pa.RecordBatch, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of candidate pairs of one sorted run, and of rows that have a next one beyond the reach with their first hash."""
    n = batch.num_rows
    tree = batch.column("_tree").to_numpy(zero_copy_only=False)
    size = batch.column("_n").to_numpy(zero_copy_only=False)
    labels = np.frombuffer(b"".join(batch.column("_label").to_pylist()), ">u4").reshape(n, DEPTH).astype(np.uint32)
    left, right = [], []
    for reach in range(1, REACH + 1):
        i = np.arange(n - reach)
        j = i + reach
        near = (tree[i] == tree[j]) & (labels[i, 0] == labels[j, 0])
        near &= 100 * np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
        i, j = i[near], j[near]
        good = _agree(labels, i, j) >= AGREE
        left.append(i[good])
        right.append(j[good])
    i = np.arange(n - REACH - 1)
    far = i[(tree[i] == tree[i + REACH + 1]) & (labels[i, 0] == labels[i + REACH + 1, 0])]
    return np.concatenate(left), np.concatenate(right), far


def _neighbours(threshold: int):
    """Pairs of a sorted partition, its cut classes as pairs with themselves, and its first and last rows for the second pass."""
    names = ["_tree", "_x", "_y", "_m", "_n"]

    def pairs(batch, i, j):
        take = lambda c, at: batch.column(c).take(pa.array(at))
        return pa.RecordBatch.from_arrays([take("_tree", i), take("_cls", i), take("_cls", j), take("_n", i), take("_n", j)], names)

    def run(batches):
        carry, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = batch if carry is None else pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
            old = 0 if carry is None else carry.num_rows
            i, j, far = _candidates(joined, threshold)
            new = j >= old
            yield _full(pairs(joined, i[new], j[new]))
            cut = np.union1d(far, far + REACH + 1)
            yield _full(pairs(joined, cut, cut))
            if first is None or first.num_rows <= REACH:
                first = joined.slice(0, REACH + 1)
            carry = joined.slice(max(0, joined.num_rows - REACH - 1))
        if carry is not None:
            yield _edge(first)
            yield _edge(carry)

    return run


def _full(b: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(b.num_rows, pa.binary())
    return pa.RecordBatch.from_arrays([*b.columns, none, none, pa.array(np.zeros(b.num_rows, bool))], ["_tree", "_x", "_y", "_m", "_n", "_label", "_label2", "_edge"])


def _edge(b: pa.RecordBatch) -> pa.RecordBatch:
    c = b.column
    columns = [c("_tree"), c("_cls"), c("_cls"), c("_n"), c("_n"), c("_label"), c("_label"), pa.array(np.ones(b.num_rows, bool))]
    return pa.RecordBatch.from_arrays(columns, ["_tree", "_x", "_y", "_m", "_n", "_label", "_label2", "_edge"])


def candidates(classes: DataFrame, threshold: int, trees: int = TREES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``_a`` < ``_b`` and ``_trees`` (in how many trees they met) of all candidate pairs of classes, ``_cls`` of the cut classes, and the staged table of both."""
    labels = F.explode(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.alias("_tree"), F.substring("_sig", t * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("_label"))))
    flat = classes.select("_cls", "_n", labels.alias("_l")).select("_l._tree", "_l._label", "_cls", "_n")
    order = ["_tree", "_label", "_cls"]
    runs = flat.repartitionByRange(shuffle_width(classes), *order).sortWithinPartitions(*order)
    found = staged(runs.mapInArrow(_neighbours(threshold), PAIR), "forest-pairs")
    # The edges: a few rows of each partition, in the order of each tree.
    edges = found.filter("_edge").select("_tree", "_label", F.col("_x").alias("_cls"), "_n").distinct()
    w = W.partitionBy("_tree").orderBy("_label", "_cls")
    met, cut = [], [found.filter("not _edge and _x = _y").select(F.col("_x").alias("_cls"))]
    for reach in range(1, REACH + 2):
        ahead = lambda c: F.lead(c, reach).over(w)  # noqa: B023, E731
        e = edges.select("_tree", F.col("_cls").alias("_x"), ahead("_cls").alias("_y"), F.col("_n").alias("_m"), ahead("_n").alias("_n"), "_label", ahead("_label").alias("_next"))
        e = e.filter(F.substring("_label", 1, 4) == F.substring("_next", 1, 4))
        if reach > REACH:
            cut += [e.select(F.col("_x").alias("_cls")), e.select(F.col("_y").alias("_cls"))]
            continue
        e = e.filter((100 * F.least("_m", "_n") >= threshold * F.greatest("_m", "_n")))
        same = sum((F.substring("_label", 4 * k + 1, 4) == F.substring("_next", 4 * k + 1, 4)).cast("int") for k in range(DEPTH))
        met.append(e.filter(same >= AGREE).select("_tree", "_x", "_y"))
    pairs = found.filter("not _edge and _x <> _y").select("_tree", "_x", "_y")
    for m in met:
        pairs = pairs.unionByName(m)
    pairs = pairs.select(F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b"), "_tree").distinct()
    return pairs.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_trees")), cut[0].union(cut[1]).union(cut[2]).distinct(), found


def _sets(docs: DataFrame, wanted: DataFrame, text: str, id_col: str) -> DataFrame:
    """``_cls``, ``_set`` and ``_cut`` of the classes in ``wanted`` (``_cls``, ``_one``, ``_cut``), from the text of one row each.

    A bit table of fixed size holds back the other texts before the shuffle.
    """
    table = staged(bit_table(wanted, ["_one"], TABLE_BITS), "forest-table")
    d = docs.select(F.col(id_col).alias("_one"), F.col(text).alias("_text"), table.scalar().alias("_table"))
    d = d.filter(in_table("_table", ["_one"], TABLE_BITS)).select("_one", "_text")
    same = d["_one"].eqNullSafe(wanted["_one"])
    d = d.join(wanted, same).select("_cls", "_text", "_cut")

    def run(batches):
        for batch in slices(batches, "_text"):
            sets = [shingles(t) for t in batch.column("_text").to_pylist()]
            own = [len(s) > 0 and digest(s) == c for s, c in zip(sets, batch.column("_cls").to_pylist())]
            keep = [i for i, ok in enumerate(own) if ok]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_cls").take(at), pa.array([sets[i].tobytes() for i in keep], pa.binary()), batch.column("_cut").take(at)], ["_cls", "_set", "_cut"])

    return d.mapInArrow(run, "_cls binary, _set binary, _cut boolean")


def possible(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose sketches and sizes do not rule out 100 * intersection >= threshold * union."""
    side = lambda c, n, sk: classes.select(F.col("_cls").alias(c), F.col("_n").alias(n), F.col("_sk").alias(sk))
    p = pairs.join(side("_a", "_n", "_s"), "_a").join(side("_b", "_m", "_t"), "_b")

    names = pairs.columns

    def buckets(column: pa.Array) -> np.ndarray:
        x = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int64)
        x[x == FULL] = 1 << 40
        return x

    def run(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("_n", "_m"))
            both = np.minimum(np.minimum(buckets(batch.column("_s")), buckets(batch.column("_t"))).sum(1), np.minimum(n, m))
            good = pa.array(np.flatnonzero(100 * both >= threshold * (n + m - both)))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(good) for c in names], names)

    return p.select(*names, "_n", "_m", "_s", "_t").mapInArrow(run, pairs.schema)


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= threshold * union. Sets of no pair stay where they are."""
    ends = pairs.select(F.col("_a").alias("_cls")).union(pairs.select("_b"))
    table = staged(bit_table(ends, ["_cls"], TABLE_BITS), "forest-ends")
    sets = sets.select("_cls", "_set", table.scalar().alias("_table")).filter(in_table("_table", ["_cls"], TABLE_BITS)).drop("_table")
    p = pairs.select("_a", "_b").join(sets.select(F.col("_cls").alias("_a"), F.col("_set").alias("_s")), "_a")
    p = p.join(sets.select(F.col("_cls").alias("_b"), F.col("_set").alias("_t")), "_b").select("_a", "_b", "_s", "_t")

    def run(batches):
        for batch in slices(batches, "_s"):
            good = []
            for i, (s, t) in enumerate(zip(batch.column("_s").to_pylist(), batch.column("_t").to_pylist())):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    good.append(i)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_a").take(at), batch.column("_b").take(at)], ["_a", "_b"])

    return p.mapInArrow(run, "_a binary, _b binary").distinct()


def _tally(sets: DataFrame) -> np.ndarray:
    """In how many sets the shingles of each of 2^TALLY_BITS buckets are.

    A task for each core, as each sends a count for nearly every bucket whatever its input.
    """

    def run(batches):
        n = np.zeros(1 << TALLY_BITS, np.int64)
        for batch in batches:
            for s in batch.column("_set").to_pylist():
                np.add.at(n, (np.frombuffer(s, np.uint64) >> np.uint64(64 - TALLY_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["_bucket", "_times"])

    few = sets.select("_set").coalesce(max(1, sets.sparkSession.sparkContext.defaultParallelism))
    found = few.mapInArrow(run, "_bucket bigint, _times bigint").groupBy("_bucket").agg(F.sum("_times").alias("_times")).toArrow()
    out = np.zeros(1 << TALLY_BITS, np.int64)
    out[found.column("_bucket").to_numpy()] = found.column("_times").to_numpy()
    return out


def _prefixes(sets: DataFrame, roots: DataFrame, threshold: int) -> DataFrame:
    """The first shingles of each cut set (``_tok``, ``_cls``, ``_root``, ``_n``, ``_cap``) from rare to common, so many that two sets over the threshold share one.

    ``_cap`` is the largest set that can still reach the threshold when this is the first common shingle. Only these shingles
    leave the task, not the sets, and only those of classes that have a link meet the roots.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_tally(sets))

    def run(batches):
        times = shared.value
        for batch in slices(batches, "_set", 1 << 20):
            entries, sizes = [], []
            for raw in batch.column("_set").to_pylist():
                s = np.frombuffer(raw, np.uint64)
                n = len(s)
                first = n - (threshold * n + 99) // 100 + 1
                toks = s[np.lexsort((s, times[(s >> np.uint64(64 - TALLY_BITS)).astype(np.int64)]))[:first]].view(np.int64)
                caps = ((100 + threshold) * (n - np.arange(first)) - threshold * n) // threshold
                entries.append(pa.StructArray.from_arrays([pa.array(toks), pa.array(caps.astype(np.int64))], ["_tok", "_cap"]))
                sizes.append(n)
            if sizes:
                edges = pa.array(np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("_cls"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(edges, pa.concat_arrays(entries))], ["_cls", "_n", "_e"])

    table = staged(bit_table(roots, ["node"], TABLE_BITS), "forest-linked")
    cut = sets.filter("_cut").withColumn("_table", table.scalar()).withColumn("_hit", in_table("_table", ["_cls"], TABLE_BITS))
    entries = lambda hit: cut.filter(hit).select("_cls", "_set").mapInArrow(run, "_cls binary, _n bigint, _e array<struct<_tok: bigint, _cap: bigint>>")
    linked = entries("_hit").join(roots.select(F.col("node").alias("_cls"), F.col("root").alias("_root")), "_cls", "left")
    cut = linked.withColumn("_root", F.coalesce("_root", "_cls")).unionByName(entries("not _hit").withColumn("_root", F.col("_cls")))
    return cut.select("_cls", "_root", "_n", F.explode("_e").alias("_e")).select("_e._tok", "_cls", "_root", "_n", "_e._cap")


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _meet(b: pa.RecordBatch):
    """Pairs of whole groups, sorted by token, block and size: the smaller set asks, the larger one is stored."""
    tok, block, n, cap = (b.column(c).to_numpy() for c in ("_tok", "_block", "_n", "_cap"))
    asks = b.column("_asks").to_numpy(zero_copy_only=False)
    group = np.cumsum(np.append(True, (tok[1:] != tok[:-1]) | (block[1:] != block[:-1]))) << 32
    cls, root = _words(b.column("_cls")), _words(b.column("_root"))
    asking, stored = np.flatnonzero(asks), np.flatnonzero(~asks)
    keys = group[stored] + n[stored]
    low = np.searchsorted(keys, group[asking] + n[asking])
    upto = np.cumsum(np.searchsorted(keys, group[asking] + cap[asking], "right") - low)
    at = 0
    while at < len(asking):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + MEET_PAIRS, "right")))
        width = np.diff(np.append(done, upto[at:end]))
        i = np.repeat(asking[at:end], width)
        j = stored[np.repeat(low[at:end] - (upto[at:end] - width), width) + np.arange(done, upto[end - 1])]
        order = (cls[i, 0] < cls[j, 0]) | ((cls[i, 0] == cls[j, 0]) & (cls[i, 1] < cls[j, 1]))
        good = (cap[j] >= n[i]) & (root[i] != root[j]).any(1) & ((n[i] < n[j]) | order)
        take = lambda k: b.column("_cls").take(pa.array(k[good]))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([take(i), take(j)], ["_x", "_y"])
        at = end


def _meetings(batches):
    """Groups come with their stored rows first, so that only those of the last group wait for the next batch, however many ask."""
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        joined = batch if carry is None else pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        yield from _meet(joined)
        tok, block = joined.column("_tok").to_numpy(), joined.column("_block").to_numpy()
        last = (tok == tok[-1]) & (block == block[-1]) & ~joined.column("_asks").to_numpy(zero_copy_only=False)
        carry = joined.take(pa.array(np.flatnonzero(last)))


def finishing(sets: DataFrame, roots: DataFrame, threshold: int) -> DataFrame:
    """``_a`` < ``_b`` of all pairs of cut sets with different roots that can reach the threshold, by their first common shingle.

    Shingles that no pair can share stay where they are behind a bit table.
    """
    entries = staged(_prefixes(sets, roots, threshold), "forest-prefixes")
    groups = entries.groupBy("_tok").agg(F.count(F.lit(1)).alias("_size"), F.min("_root").alias("_r"), F.max("_root").alias("_s"), F.max((F.col("_cap") >= F.col("_n")).cast("int")).alias("_any"))
    groups = staged(groups.filter("_r <> _s and _any = 1").select("_tok", "_size"), "forest-tokens")
    table = staged(bit_table(groups, ["_tok"], TABLE_BITS), "forest-shared")
    rows = entries.withColumn("_table", table.scalar()).filter(in_table("_table", ["_tok"], TABLE_BITS)).drop("_table")
    rows = with_group(rows, groups, "_tok", "_size", entries.count()).filter("_size is not null")
    rows = rows.withColumn("_blocks", F.ceil(F.col("_size") / HOT_BLOCK)).drop("_size")
    place = lambda block, asks: F.struct(block.alias("_block"), F.lit(asks).alias("_asks"))
    own = F.array(place(F.pmod(F.xxhash64("_cls"), F.col("_blocks")), False))
    every = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1), lambda b: place(b, True))
    dealt = rows.withColumn("_p", F.explode(F.when(F.col("_cap") >= F.col("_n"), F.concat(own, every)).otherwise(own)))
    dealt = dealt.select("_tok", "_cls", "_root", "_n", "_cap", "_p._block", "_p._asks")
    dealt = dealt.repartition(shuffle_width(sets), "_tok", "_block").sortWithinPartitions("_tok", "_block", "_asks", "_n")
    met = dealt.mapInArrow(_meetings, "_x binary, _y binary").select(F.least("_x", "_y").alias("_a"), F.greatest("_x", "_y").alias("_b")).distinct()
    met = staged(met, "forest-met")
    release(entries, groups)
    return met


def near_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: int = THRESHOLD, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``, and the columns named in ``keep``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case. Documents are linked when 100 times the
    intersection of their sets is at least ``threshold`` times the union; ``component_id`` is the smallest id that can
    be reached over links, itself included, and ``kept`` says that it is the row's own. A text without words (null,
    empty, blank) has ``n_shingles`` 0 and no link. Rows that repeat an id are documents of their own with equal ids. A
    null id comes after every other; a component without any id has a null ``component_id`` and is kept. An empty table
    gives an empty result. Other columns are ignored whatever their names.
    """
    rows = staged(_classes(docs, text, id_col, keep), "forest-rows")
    members = rows.filter(F.col("_cls").isNotNull()).groupBy("_cls").agg(
        F.min("_id").alias("_one"), F.count(F.lit(1)).alias("_size"), F.first("_n").alias("_n"), F.first("_sig").alias("_sig"), F.first("_sk").alias("_sk")
    )
    members = staged(members, "forest-classes")
    found, cut, sorted_runs = candidates(members, threshold)
    found, cut = staged(found, "forest-candidates"), staged(cut, "forest-cut")
    pairs = staged(possible(found, members, threshold), "forest-possible")
    release(found, sorted_runs)

    ends = pairs.select(F.col("_a").alias("_cls"), F.lit(False).alias("_cut")).union(pairs.select("_b", F.lit(False))).union(cut.select("_cls", F.lit(True)))
    ends = ends.groupBy("_cls").agg(F.bool_or("_cut").alias("_cut"))
    wanted = staged(members.select("_cls", "_one").join(ends, "_cls"), "forest-wanted")
    sets = staged(_sets(docs, wanted, text, id_col), "forest-sets")

    best = pairs.select(F.col("_a").alias("_cls"), "_a", "_b", "_trees").union(pairs.select(F.col("_b").alias("_cls"), "_a", "_b", "_trees"))
    best = best.groupBy("_cls").agg(F.max(F.struct("_trees", "_a", "_b")).alias("_p")).select("_p._a", "_p._b").distinct()
    best = staged(best, "forest-best")
    links = staged(confirm(best, sets, threshold), "forest-links")
    roots = components(links, "_a", "_b")

    def apart(some: DataFrame) -> DataFrame:
        """The pairs that no link has connected yet."""
        root = lambda side, name: roots.select(F.col("node").alias(side), F.col("root").alias(name))
        d = some.select("_a", "_b").join(root("_a", "_ra"), "_a", "left").join(root("_b", "_rb"), "_b", "left")
        return d.filter("_ra is null or _rb is null or _ra <> _rb").select("_a", "_b")

    rest = staged(apart(pairs.join(best, ["_a", "_b"], "left_anti")), "forest-rest")
    more = staged(confirm(rest, sets, threshold), "forest-more")
    if not more.isEmpty():
        links = links.unionByName(more)
        release(roots)
        roots = components(links, "_a", "_b")
    release(wanted, best, rest)

    if not cut.isEmpty():
        met = finishing(sets, roots, threshold)
        last = staged(possible(apart(met.join(pairs, ["_a", "_b"], "left_anti")), members, threshold), "forest-last")
        final = staged(confirm(last, sets, threshold), "forest-finished")
        if not final.isEmpty():
            old, roots = roots, components(links.unionByName(final), "_a", "_b")
            release(old)
        release(met, last)
    release(sets, pairs, cut)

    named = members.join(roots.withColumnRenamed("node", "_cls"), "_cls", "left").filter("root is not null or _size > 1")
    named = named.select("_cls", "_one", "_size", F.coalesce("root", "_cls").alias("_root"))
    tops = named.groupBy("_root").agg(F.min("_one").alias("_component"))
    named = staged(named.join(tops, "_root").select("_cls", "_size", "_component"), "forest-components")
    release(members, roots)
    out = with_group(rows.drop("_sig", "_sk"), named, "_cls", "_size", rows.count())
    component = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_component"))
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"),
        *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
    )
