"""Benchmark passages in documents by a prefix-filtered set join, in DataFrame functions only.

* Items give windows of ``WINDOW`` words (shorter items one window). Equal windows are one, with the set of their items; equal sets
  of items are one as well, so that windows shared by many items are not multiplied by them.
* A window is the set of its shingles of ``SHINGLE`` words (shorter windows are one shingle). Shingles are ordered from rare to common by the
  number of document places that have them. All of a window must be in the document, so its necessary prefix is one shingle, the rarest.
* A bit table of the prefix shingles, sized by their number, goes with the scan; words are hashed inside their row, and only places in the table leave it, with the words
  around them. Texts are never shuffled.
* Places and windows meet by shingle. A candidate has to start inside the document (position bound) and fit in its
  words (length bound), and then has to have the very words of the window.
* Covered words are the union of the verified stretches of a document, summed in one pass over their sorted starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echofield.functions.text import runs
from echofield.llm.common import bit_table, in_table, staged

WINDOW, SHINGLE = 10, 4
#: log2 of the bits of the smallest and the largest table of shingles: 32 KB to 16 MB.
LEAST_BITS, MOST_BITS = 18, 27
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z in lower case; null has none."""
    return runs(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(w: Column, width: int) -> Column:
    """(place, hash) of every shingle of ``width`` words."""

    def hashed(h: Column) -> Column:
        last = F.size(h) - width
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(i.alias("p"), F.xxhash64(*[F.get(h, i + k) for k in range(width)]).alias("t")))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), hashed)


def windows(items: DataFrame, text: str, id_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (``_w``, ``_set``), and the sets of items (``_set``, ``_items``)."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_item"), words(F.col(text)).alias("_ws")).filter(F.size("_ws") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("_ws") - (window - 1), F.lit(1)))
    rows = rows.select("_item", F.explode(F.transform(at, lambda i: F.slice("_ws", i, F.lit(window)))).alias("_w"))
    same = rows.groupBy("_w").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    same = staged(same.withColumn("_set", F.sha2(F.to_json("_items"), 256)), "leak-windows")
    return same.select("_w", "_set"), same.groupBy("_set").agg(F.first("_items").alias("_items"))


def _bits(n: int) -> int:
    """Bits of a table in which one of 32 slots is taken, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, n.bit_length() + 5))


def _places(docs: DataFrame, keys: DataFrame, widths: list[int], carried: list[str], context: int | None) -> DataFrame:
    """``carried``, ``_n`` (words) and ``_hits``: (p, t) of the places whose shingle may be a key, with up to ``context`` words around."""
    bits = _bits(keys.count())
    table = staged(bit_table(keys.select("t"), ["t"], bits, hashed=True), "leak-table")
    rows = docs.select(*carried, words(F.col("_text")).alias("_ws")).withColumn("_table", table.scalar())

    def around(w: Column, x: Column, width: int) -> Column:
        first = F.greatest(x["p"] - (context - width), F.lit(0))
        return F.struct(x["p"].alias("p"), x["t"].alias("t"), first.alias("first"), F.slice(w, first + 1, x["p"] + context - first).alias("near"))

    def hits(w: Column) -> Column:
        found = []
        for width in widths:
            own = F.filter(_shingles(w, width), lambda x: in_table(F.col("_table"), [x["t"]], bits, hashed=True))
            found.append(own if context is None else F.transform(own, lambda x: around(w, x, width)))  # noqa: B023
        return F.struct(F.size(w).alias("n"), (F.concat(*found) if len(found) > 1 else found[0]).alias("hits"))

    return rows.withColumn("_found", _let(F.col("_ws"), hits)).select(*carried, F.col("_found.n").alias("_n"), F.col("_found.hits").alias("_hits"))


def contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    keep: tuple[str, ...] = (), window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``, ``items``, ``spans``, and the columns named in ``keep``.

    ``spans`` are the stretches of word numbers [a, b) that occurrences of item windows cover, merged; ``n_hit`` is the
    number of their words; ``items`` are the ids, as sorted strings, of the items with an occurring window.

    Null, empty and blank texts have no words: as documents they have no hits, as items no window. Repeated rows and null ids of documents
    are documents of their own. Items that repeat an id are one item with the windows of all; a null item id is the empty string.
    Other columns are ignored whatever their names; an empty table of documents gives an empty result, one of items no hits. A very long text
    stays one row and only its places in the table leave it.
    """
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    d = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"), *[F.col(c).alias(n) for c, n in zip(keep, names[1:])])
    asked, sets = windows(items, item_text, item_id, window)
    width = F.least(F.size("_w"), F.lit(shingle))
    widths = sorted(r[0] for r in asked.select(width).distinct().collect())  # 1 .. shingle at most
    own = F.lit(None)
    for k in widths:
        own = F.when(width == k, _shingles(F.col("_w"), k)).otherwise(own) if k != widths[0] else _shingles(F.col("_w"), k)
    if not widths:
        out = [F.col("_id").alias(id_col), F.size(words(F.col("_text"))).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit")]
        none = [F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<a:int,b:int>>").alias("spans")]
        return d.select(*out, *none, *[F.col(n).alias(c) for c, n in zip(keep, names[1:])])

    parts = staged(asked.select("_w", "_set", F.explode(own).alias("_s")).select("_w", "_set", "_s.p", "_s.t"), "leak-shingles")
    keys = parts.select("t").distinct()
    seen = _places(d, keys, widths, [], None).select(F.explode(F.transform("_hits", lambda x: x["t"])).alias("t"))
    times = seen.groupBy("t").agg(F.count(F.lit(1)).alias("_times"))
    rare = parts.join(times, "t").groupBy("_w", "_set").agg(F.min(F.struct("_times", "t", "p")).alias("_s"), F.count_distinct("t").alias("_known"))
    # A shingle that no document has rules its window out.
    whole = parts.groupBy("_w").agg(F.count_distinct("t").alias("_all"))
    prefix = rare.join(whole, "_w").filter("_known = _all").select("_w", "_set", F.col("_s.t").alias("t"), F.col("_s.p").alias("_offset"))
    prefix = staged(prefix, "leak-prefixes")

    rows = _places(d, prefix.select("t").distinct(), widths, names, window).withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows, "leak-rows")
    near = rows.filter(F.size("_hits") > 0).select("_row", "_n", F.explode("_hits").alias("_x")).select("_row", "_n", "_x.*")
    start = F.col("p") - F.col("_offset")
    met = near.join(prefix, "t").filter((start >= 0) & (start + F.size("_w") <= F.col("_n")))
    met = met.filter(F.when(start >= F.col("first"), F.slice("near", F.greatest(start - F.col("first") + 1, F.lit(1)), F.size("_w")) == F.col("_w")))
    met = staged(met.select("_row", start.alias("a"), (start + F.size("_w")).alias("b"), "_set").distinct(), "leak-met")

    def joined(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        more = F.when(
            (F.size(acc) > 0) & (x["a"] <= F.coalesce(F.get(acc, F.size(acc) - 1)["b"], F.lit(-1))),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b")))),
        )
        return more.otherwise(F.concat(acc, F.array(x)))

    spans = met.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("_all"), F.array_sort(F.collect_set("_set")).alias("_sets"))
    spans = staged(spans.select("_row", "_sets", F.aggregate("_all", F.array().cast("array<struct<a:int,b:int>>"), joined).alias("spans")), "leak-spans")
    kinds = spans.select("_sets").distinct()
    named = kinds.select("_sets", F.explode("_sets").alias("_set")).join(sets, "_set").select("_sets", F.explode("_items").alias("_item"))
    named = named.groupBy("_sets").agg(F.array_sort(F.collect_set("_item")).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    told = spans.join(named, "_sets").select("_row", "items", "spans", hit.alias("n_hit"))
    out = rows.drop("_hits").join(told, "_row", "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").cast("bigint").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")).alias("spans"),
        *[F.col(n).alias(c) for c, n in zip(keep, names[1:])],
    )
