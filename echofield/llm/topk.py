"""Exact BM25 top-k by block-max WAND over a sharded inverted index.

A shard is one scan partition. Its task numbers its documents in the order of their ids and writes one row for each
term: postings (document number, term frequency) and, for each block of ``BLOCK`` postings, the last number, the
highest frequency and the shortest length. These bound a block's score whatever the global average length is.

A search takes document frequencies, the number of documents and their mean length over all shards, runs every query
against every shard with document-at-a-time cursors that skip by the block bounds, and merges the k best of each shard.
Scores use global statistics only, so the merge is exact. Queries of more than ``LONG_QUERY`` different terms, whose bounds
rule out next to nothing, add up all postings of their terms in the shard instead.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import bit_table, in_table, shuffle_width, slices, staged

K1, B = 1.2, 0.75
BLOCK = 64
DIGITS = 6
#: Queries that one task runs against a shard at a time, and the fewest of a block; a shard's postings are sent once for each block.
QUERY_BLOCK, LEAST_BLOCK = 8192, 256
#: Different terms from which on a query takes whole postings.
LONG_QUERY = 64
#: Tasks of a search beyond the session's shuffle partitions, at most.
MOST_TASKS = 2000
TERMS_AT_ONCE = 20_000
#: Binary columns of a term's row: documents, frequencies, and for each block its last document, highest frequency, shortest length.
PARTS = ("docs", "tfs", "last", "high", "short")
TERM = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case, of the whole text."""
    return TERM.findall((text or "").lower())


def build_index(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows of three kinds: documents (``shard``, ``at``, ``id``), lengths (``shard``, ``docs``, their sum in ``df``), postings (``shard``, ``term``, ``df`` and the columns of PARTS)."""
    d = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    kinds = [("kind", T.IntegerType()), ("shard", T.IntegerType()), ("at", T.IntegerType()), ("id", d.schema["_id"].dataType), ("term", T.StringType()), ("df", T.LongType()), *[(p, T.BinaryType()) for p in PARTS]]
    schema = T.StructType([T.StructField(n, k) for n, k in kinds])
    layout = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("at", pa.int32()), ("id", _arrow(d)), ("term", pa.string()), ("df", pa.int64()), *[(p, pa.binary()) for p in PARTS]])

    def run(batches):
        shard, numbers = TaskContext.get().partitionId(), {}
        ids, found, lengths = [], [], []
        for batch in slices(batches, "_text"):
            ids += batch.column("_id").to_pylist()
            for t in batch.column("_text").to_pylist():
                words = terms(t)
                lengths.append(len(words))
                found.append(np.unique(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32), return_counts=True))
        if not ids:
            return
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]) if ids[i] is not None else (True, 0))
        size = np.array([lengths[i] for i in order], np.int32)
        yield _rows(layout, kind=0, shard=shard, at=np.arange(len(ids), dtype=np.int32), id=[ids[i] for i in order])
        yield _rows(layout, kind=1, shard=shard, df=[int(size.sum(dtype=np.int64))], docs=[size.tobytes()])
        at = np.repeat(np.arange(len(ids), dtype=np.int32), [len(found[i][0]) for i in order])
        term = np.concatenate([found[i][0] for i in order]) if at.size else np.empty(0, np.int32)
        tf = np.concatenate([found[i][1] for i in order]).astype(np.int32) if at.size else term
        by = np.argsort(term, kind="stable")
        at, term, tf = at[by], term[by], tf[by]
        cut = np.searchsorted(term, np.arange(len(numbers) + 1))
        yield from _postings(layout, shard, list(numbers), cut, at, tf, size)

    return d.mapInArrow(run, schema)


def _arrow(d: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(d.schema["_id"].dataType)


def _rows(layout: pa.Schema, **columns) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values() if not isinstance(c, int))

    def column(f: pa.Field) -> pa.Array:
        c = columns.get(f.name)
        if c is None:
            return pa.nulls(n, f.type)
        return c if isinstance(c, pa.Array) else pa.array([c] * n if isinstance(c, int) else c, f.type)

    return pa.RecordBatch.from_arrays([column(f) for f in layout], schema=layout)


def _cut_bytes(x: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Binary values from neighbouring pieces of one array, without touching the pieces."""
    x = np.ascontiguousarray(x[cut[0] : cut[-1]], np.int32)
    offsets = ((cut - cut[0]) * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(x)])


def _blocks(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the blocks of all terms start, and where each term's blocks start among them."""
    n = -(-np.diff(cut) // BLOCK)
    first = np.append(0, np.cumsum(n))
    within = np.arange(first[-1]) - np.repeat(first[:-1], n)
    return np.repeat(cut[:-1], n) + within * BLOCK, first


def _postings(layout: pa.Schema, shard: int, names: list[str], cut: np.ndarray, at: np.ndarray, tf: np.ndarray, size: np.ndarray):
    """Rows of all terms with their block bounds, some terms at a time."""
    if not names:
        return
    starts, first = _blocks(cut)
    ends = np.append(starts[1:], len(at)) - 1
    last, high, short = at[ends], np.maximum.reduceat(tf, starts), np.minimum.reduceat(size[at], starts)
    for k in range(0, len(names), TERMS_AT_ONCE):
        c, f = cut[k : k + TERMS_AT_ONCE + 1], first[k : k + TERMS_AT_ONCE + 1]
        yield _rows(
            layout, kind=2, shard=shard, term=names[k : k + TERMS_AT_ONCE], df=np.diff(c), docs=_cut_bytes(at, c), tfs=_cut_bytes(tf, c),
            last=_cut_bytes(last, f), high=_cut_bytes(high, f), short=_cut_bytes(short, f),
        )


class _Cursor:
    """Postings of one term of one query in a shard."""

    __slots__ = ("at", "score", "last", "most", "top", "i", "doc")

    def __init__(self, row: dict, weight: float, size: np.ndarray, mean: float):
        at, tf = (np.frombuffer(row[c], np.int32) for c in PARTS[:2])
        if row["last"] is None:
            last, high, short = at[-1:], tf.max(keepdims=True), size[at].min(keepdims=True)
        else:
            last, high, short = (np.frombuffer(row[c], np.int32) for c in PARTS[2:])
        self.at = at
        self.score = _impact(weight, tf, size[at], mean)
        self.last, self.most = last, _impact(weight, high, short, mean)
        self.top = float(self.most.max())
        self.i, self.doc = 0, int(at[0])

    def seek(self, doc: int) -> None:
        """To the first posting at or after ``doc``; past the end the document number is END."""
        self.i += int(np.searchsorted(self.at[self.i :], doc))
        self.doc = int(self.at[self.i]) if self.i < len(self.at) else END

    def block(self, doc: int) -> tuple[float, int]:
        """Bound and last document of the block that may hold ``doc``."""
        b = int(np.searchsorted(self.last, doc))
        return (float(self.most[b]), int(self.last[b])) if b < len(self.last) else (0.0, END - 1)


END = 1 << 31


def _impact(weight, tf, size, mean: float):
    return weight * (tf * (K1 + 1.0)) / (tf + K1 * (1.0 - B + B * (size / mean)))


def block_max_wand(cursors: list[_Cursor], k: int) -> list[tuple[float, int]]:
    """The k best (score, document), ties to the lower number; a skipped document's bound is below the k-th score."""
    heap: list[tuple[float, int]] = []
    floor, slack = -1.0, 10.0**-DIGITS
    live = sorted(cursors, key=lambda c: c.doc)
    while live:
        bound, pivot = 0.0, -1
        for p, c in enumerate(live):
            bound += c.top
            if bound + slack >= floor:
                pivot = p
                break
        if pivot < 0:
            break
        doc = live[pivot].doc
        if doc == END:
            break
        while pivot + 1 < len(live) and live[pivot + 1].doc == doc:
            pivot += 1
        head = live[: pivot + 1]
        blocks = [c.block(doc) for c in head]
        if sum(b for b, _ in blocks) + slack < floor:
            # No document up to the end of the nearest block, or to the next cursor, can reach the k-th score.
            beyond = min(e for _, e in blocks) + 1
            if pivot + 1 < len(live):
                beyond = min(beyond, live[pivot + 1].doc)
            beyond = max(beyond, doc + 1)
            for c in head:
                if c.doc < beyond:
                    c.seek(beyond)
        elif head[0].doc == doc:
            score = round(sum(float(c.score[c.i]) for c in head), DIGITS)
            if len(heap) < k:
                heapq.heappush(heap, (score, -doc))
            elif (score, -doc) > heap[0]:
                heapq.heapreplace(heap, (score, -doc))
            if len(heap) == k:
                floor = heap[0][0]
            for c in head:
                c.seek(doc + 1)
        else:
            for c in head:
                if c.doc < doc:
                    c.seek(doc)
        live = sorted([c for c in live if c.doc != END], key=lambda c: c.doc)
    return [(s, -d) for s, d in sorted(heap, key=lambda x: (-x[0], -x[1]))]


def _query_blocks(queries: int, shards: int, cores: int) -> int:
    """Blocks of queries: as few as memory allows, but more while few shards leave cores idle."""
    return max(1, -(-queries // QUERY_BLOCK), min(-(-queries // LEAST_BLOCK), _blocks_at_once(shards, cores)))


def _blocks_at_once(shards: int, cores: int) -> int:
    """Blocks that are searched side by side: one, or more while few shards leave cores idle."""
    return max(1, -(-2 * cores // max(1, shards)))


def whole_postings(postings: list[tuple[float, np.ndarray, np.ndarray]], n: int, k: int) -> list[tuple[float, int]]:
    """The k best (score, document) of ``n`` documents, ties to the lower number, from the weight, documents and unit impacts of every term."""
    weight = np.repeat([w for w, _, _ in postings], [len(at) for _, at, _ in postings])
    scores = np.bincount(np.concatenate([at for _, at, _ in postings]), weight * np.concatenate([x for _, _, x in postings]), n)
    found = np.flatnonzero(scores)
    rounded = np.round(scores[found], DIGITS)
    if len(found) > k:
        best = np.flatnonzero(rounded >= np.partition(rounded, len(found) - k)[len(found) - k])
        found, rounded = found[best], rounded[best]
    order = np.lexsort((found, -rounded))[:k]
    return [(float(rounded[i]), int(found[i])) for i in order]


def search(index: DataFrame, queries: DataFrame, k: int = 10, text: str = "text", id_col: str = "query_id", long_query: int = LONG_QUERY) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of the k best documents of every query.

    ``index`` is a written table of ``build_index``. Score: BM25 with k1 1.2 and b 0.75, repeated query terms count as often
    as they occur, rounded to six digits; documents without a term of the query are no results; ties go to the smaller
    id, null ids last. Null or empty queries and documents give no result; rows that repeat a query id are
    answered as one query with all their terms; an empty index or query table gives an empty result. Queries go to the shards
    in blocks of at most about ``QUERY_BLOCK``, one block after the other once the shards fill the cores; none passes through the driver. Queries of more than ``long_query`` different terms take whole postings.
    """
    q = queries.select(F.col(id_col).alias("_q"), F.col(text).alias("_text"))

    def split(batches):
        for batch in batches:
            found = [(i, w) for i, t in zip(batch.column("_q").to_pylist(), batch.column("_text").to_pylist()) for w in terms(t)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], batch.column("_q").type), pa.array([w for _, w in found], pa.string())], ["_q", "term"])

    q = q.mapInArrow(split, T.StructType([q.schema["_q"], T.StructField("term", T.StringType())]))
    sizes = index.filter("kind = 1")
    n, total, shards = sizes.agg(F.sum(F.octet_length("docs") / 4), F.sum("df"), F.count(F.lit(1))).first()
    blocks = _query_blocks(queries.count(), shards, index.sparkSession.sparkContext.defaultParallelism)
    q = q.groupBy("_q", "term").agg(F.count(F.lit(1)).cast("int").alias("_times")).withColumn("_block", F.pmod(F.xxhash64("_q"), F.lit(blocks)).cast("int"))
    q = staged(q, "search-terms")
    if not n or not total:
        return index.sparkSession.createDataFrame([], f"query_id {q.schema['_q'].dataType.simpleString()}, rank int, id {index.schema['id'].dataType.simpleString()}, score double")
    mean = total / n

    # A block's queries are numbers, and a term's queries one row.
    numbers = q.select(F.col("_block").alias("_in"), F.col("_q").alias("_id")).distinct().withColumn("_n", F.row_number().over(W.partitionBy("_in").orderBy("_id")))
    numbers = staged(numbers, "search-queries")
    # Postings meet the terms of all queries behind a bit table, so that the index is not shuffled for it; terms beside them are not looked at.
    table = staged(bit_table(q, ["term"]), "search-table")
    kept = index.filter("kind = 2").withColumn("_table", table.scalar()).filter(in_table("_table", ["term"])).drop("_table")
    found = staged(kept.groupBy("term").agg(F.sum("df").alias("df"), F.collect_list("shard").alias("_shards")), "search-found")
    rarity = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    # The bounds of a single block are those of its postings.
    bounds = [F.when(F.col("df") > BLOCK, F.col(c)).alias(c) for c in PARTS[2:]]
    blobs = kept.select("shard", "term", *PARTS[:2], *bounds).unionByName(sizes.select("shard", F.lit(None).cast("string").alias("term"), *PARTS))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, kinds = [], [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        if right.num_rows and left.num_rows:
            shard, block = left.column("shard")[0].as_py(), left.column("_block")[0].as_py()
            parts = {c: left.column(c).combine_chunks() for c in PARTS}
            where = {t: i for i, t in enumerate(left.column("term").to_pylist())}
            size = np.frombuffer(parts["docs"][where[None]].as_buffer(), np.int32)
            right = right.sort_by("term")
            names = right.column("term").to_pylist()
            lists = right.column("_n").combine_chunks()
            each = lists.value_lengths().to_numpy()
            number, idf = lists.flatten().to_numpy(), right.column("_idf").to_numpy()
            # by query, in each by term
            by = np.argsort(number, kind="stable")
            number, term = number[by], np.repeat(np.arange(len(names), dtype=np.int32), each)[by]
            times = right.column("_times").combine_chunks().flatten().to_numpy()[by]
            del by, lists, right, left
            first = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
            units: dict[int, tuple[np.ndarray, np.ndarray]] = {}

            def unit(t: int) -> tuple[np.ndarray, np.ndarray]:
                if t not in units:
                    at, tf = (np.frombuffer(parts[c][where[names[t]]].as_buffer(), np.int32) for c in PARTS[:2])
                    units[t] = at, _impact(1.0, tf, size[at], mean)
                return units[t]

            for i, j in zip(first, np.append(first[1:], len(number))):
                told = zip(term[i:j].tolist(), (times[i:j] * idf[term[i:j]]).tolist())
                if j - i > long_query:
                    best = whole_postings([(w, *unit(t)) for t, w in told], len(size), k)
                else:
                    best = block_max_wand([_Cursor({c: parts[c][where[names[t]]].as_buffer() for c in PARTS}, w, size, mean) for t, w in told], k)
                out += [(block, int(number[i]), shard, at, s) for s, at in best]
        return pa.table([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=["_in", "_n", "shard", "at", "score"])

    # Some blocks after the others, so that the postings and the terms of the queries on their way to the shards do not add up over the blocks.
    at_once = _blocks_at_once(shards, index.sparkSession.sparkContext.defaultParallelism)
    rounds = []
    for first in range(0, blocks, at_once):
        last = min(first + at_once, blocks) - 1
        mine = F.col("_block").between(first, last)
        lists = q.filter(mine).join(numbers.filter(F.col("_in").between(first, last)), (F.col("_block") == F.col("_in")) & F.col("_q").eqNullSafe(F.col("_id")))
        lists = lists.groupBy("_block", "term").agg(F.sort_array(F.collect_list(F.struct("_n", "_times"))).alias("_asked"))
        asked = lists.join(found, "term").select(F.explode("_shards").alias("shard"), "_block", "term", rarity.alias("_idf"), F.col("_asked._n").alias("_n"), F.col("_asked._times").alias("_times"))
        sent = blobs.withColumn("_block", F.explode(F.sequence(F.lit(first), F.lit(last))) if last > first else F.lit(first))
        # By number, so that small blocks of long work are not put together in one task.
        width = max(shuffle_width(index), min(shards * (last - first + 1), MOST_TASKS))
        sent, asked = (d.repartition(width, "shard", "_block") for d in (sent, asked))
        best = sent.groupBy("shard", "_block").cogroup(asked.groupBy("shard", "_block")).applyInArrow(run, "_in int, _n int, shard int, at int, score double")
        rounds.append(staged(best, "search-best"))
    best = index.sparkSession.read.schema(rounds[0].schema).parquet(*[r._staged_folder for r in rounds])
    named = best.join(index.filter("kind = 0").select("shard", "at", "id"), ["shard", "at"])
    w = W.partitionBy("_in", "_n").orderBy(F.desc("score"), F.col("id").isNull(), F.col("id"))
    named = named.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).join(numbers, ["_in", "_n"])
    return named.select(F.col("_id").alias("query_id"), "rank", "id", "score")
