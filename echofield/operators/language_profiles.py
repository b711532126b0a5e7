"""Language identification by trigram profiles that are fitted on labelled texts and stored as a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.functions import text as tx

#: Most frequent trigrams of a language in its profile, and languages of one table: together they bound what is broadcast.
TOP, MAX_LANGUAGES = 1000, 200
#: Lead per trigram, in thousandths of a natural logarithm, below which the language is unknown.
MARGIN = 20
NOT_LETTERS = r"[^\p{L}]+"


#: Characters of text whose trigrams a task holds at once, and different trigrams that it adds up before it hands them on.
CHARACTERS, HELD = 4 << 20, 1_000_000


def letters(c: Column) -> Column:
    """The whole text as its trigrams see it: letters in lower case, everything between them one blank, one blank at both ends."""
    bare = F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), NOT_LETTERS, " "))
    return F.concat(F.lit(" "), bare, F.lit(" "))


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping trigrams of all texts as numbers (21 bits for each code point, so numbers have the order of the trigrams),
    and how many each text has."""
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    n = np.maximum(sizes - 2, 0)
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
    return (x[at] << 42) | (x[at + 1] << 21) | x[at + 2], n


def _gram(code: int) -> str:
    return chr(code >> 42) + chr(code >> 21 & 0x1FFFFF) + chr(code & 0x1FFFFF)


def _code(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def _pieces(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of at most ``CHARACTERS`` characters; a longer text is alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHARACTERS:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < batch.num_rows:
        yield start, batch.num_rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, f): each task adds up its own trigrams first."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def told():
        for lang, (codes, f) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array([_gram(int(c)) for c in codes], pa.string()), pa.array(f)], ["lang", "gram", "f"])

    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), object)
        for a, b in _pieces(batch, texts):
            codes, n = _trigrams(texts[a:b])
            of = np.repeat(langs[a:b], n)
            for lang in set(langs[a:b]):
                mine, f = np.unique(codes[of == lang], return_counts=True)
                if lang in sums:
                    both = np.concatenate([sums[lang][0], mine])
                    mine, place = np.unique(both, return_inverse=True)
                    f = np.bincount(place, np.concatenate([sums[lang][1], f])).astype(np.int64)
                sums[lang] = mine, f
            if sum(len(c) for c, _ in sums.values()) > HELD:
                yield from told()
                sums.clear()
    yield from told()


def _thousandths(over: Column, under: Column) -> Column:
    return F.round(1000 * F.log(over / under)).cast("bigint")


def fit(df: DataFrame, text: str, lang: str, top: int = TOP) -> DataFrame:
    """The profile table (``lang``, ``gram``, ``weight``): smoothed log shares in thousandths, and under the gram ``''`` that of all others.

    Learns from all rows with a language; rows without a trigram add nothing, and a language with no other rows has no profile. Counts
    are added up in the tasks, so that a language with most of the rows is no burden. An empty table gives an empty profile.
    """
    rows = df.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), letters(F.col(text)).alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram string, f bigint").groupBy("lang", "gram").agg(F.sum("f").alias("f"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("f"), "gram"))
    kept = counts.withColumn("_rank", rank).filter(F.col("_rank") <= top)
    # a language has at most ``top`` rows here
    w = W.partitionBy("lang")
    kept = kept.withColumn("_under", 2 * F.sum("f").over(w) + F.count(F.lit(1)).over(w) + 1)
    seen = kept.select("lang", "gram", _thousandths(2 * F.col("f") + 1, F.col("_under")).alias("weight"))
    rest = kept.filter(F.col("_rank") == 1).select("lang", F.lit("").alias("gram"), _thousandths(F.lit(1), F.col("_under")).alias("weight"))
    return seen.unionByName(rest)


def detect(df: DataFrame, text: str, key: str, profiles: DataFrame, margin: int = MARGIN, name: str = "detected_lang") -> DataFrame:
    """(``key``, ``name``, ``lead``) for unique keys: the language whose profile gives a text the highest probability.

    Mostly Devanagari letters are ``hi`` whatever the profiles say. ``unknown`` if the lead on the second language is below ``margin``
    for each trigram, if no trigram of the text is in any profile (null and empty texts, no profiles). Equal scores go to the smaller
    name, if ``margin`` is 0. ``lead`` is null where there are no two languages to compare. Trigrams meet the profiles in the tasks and are added
    up there: one row per text is shuffled, however long it is.
    """
    floors = profiles.filter(F.col("gram") == "").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(floors) > MAX_LANGUAGES:
        raise ValueError(f"profiles of more than {MAX_LANGUAGES} languages")
    place = {r["lang"]: i for i, r in enumerate(floors)}
    known = profiles.filter(F.col("gram") != "").toArrow().to_pylist()  # bounded as the profile table is
    codes = np.unique(np.array([_code(r["gram"]) for r in known], np.int64))
    gains = np.zeros((len(floors), len(codes)), np.int64)
    for r in known:
        if r["lang"] in place:
            gains[place[r["lang"]], np.searchsorted(codes, _code(r["gram"]))] = r["weight"] - floors[place[r["lang"]]]["weight"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in _pieces(batch, texts):
                grams, n = _trigrams(texts[a:b])
                at = np.searchsorted(codes, grams)
                hit = np.flatnonzero(codes[np.minimum(at, len(codes) - 1)] == grams) if len(codes) else np.empty(0, np.int64)
                at, doc = at[hit], np.repeat(np.arange(b - a), n)[hit]
                sums = [np.bincount(doc, g[at], b - a).astype(np.int64) for g in gains]
                found = np.bincount(doc, minlength=b - a).astype(np.int64)
                part = batch.slice(a, b - a)
                columns = [part.column("_key"), part.column("_native"), *map(pa.array, (n.astype(np.int64), found, *sums))]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "_native", "_n", "_known", *[f"_s{i}" for i in range(len(floors))]])

    numbers = ["_n", "_known", *[f"_s{i}" for i in range(len(floors))]]
    ruled = df.select(F.col(key).alias("_key"), F.coalesce(tx.mostly_devanagari(F.col(text)), F.lit(False)).alias("_native"), letters(F.col(text)).alias("_text"))
    schema = T.StructType([ruled.schema["_key"], T.StructField("_native", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in numbers]])
    sums = ruled.mapInArrow(add_up, schema).groupBy("_key").agg(F.max("_native").alias("_native"), *[F.sum(c).alias(c) for c in numbers])
    score = lambda i, r: F.struct((F.col(f"_s{i}") + F.col("_n") * F.lit(r["weight"])).alias("score"), F.lit(-i).alias("place"))
    none = F.array().cast("array<struct<score:bigint,place:int>>")
    sums = sums.withColumn("_order", F.sort_array(F.array(*[score(i, r) for i, r in enumerate(floors)]), asc=False) if floors else none)
    names = F.array(*[F.lit(r["lang"]) for r in floors]) if floors else F.array().cast("array<string>")
    best, second = F.get("_order", F.lit(0)), F.get("_order", F.lit(1))
    lead = F.when(F.col("_n") > 0, best["score"] - second["score"])
    unknown = (F.col("_known") == 0) | F.coalesce(lead < margin * F.col("_n"), F.lit(False))
    told = F.when(F.col("_native"), "hi").when(unknown, "unknown").otherwise(F.get(names, -best["place"]))
    return sums.select(F.col("_key").alias(key), told.alias(name), lead.alias("lead"))
