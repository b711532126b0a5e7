"""Token counts through a digest cache.

The digest of a content and the digest of the tokenizer file name a stored count. Only contents without one are
encoded, each once however often it occurs, and their counts are appended to the cache: a Parquet table that later
runs read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echofield.llm.bpe import byte_alphabet
from echofield.llm.common import slices, staged, with_group
from echofield.sources.tables import path_exists, shared_folder

CACHE = "content binary, tokenizer string, n_tokens bigint"
#: Characters that are encoded at once: cuts are made where a token always ends.
LONG_TEXT = 1 << 17


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_level(spec: dict) -> bool:
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        and not spec.get("normalizer") and not model.get("end_of_word_suffix") and not model.get("ignore_merges")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"])
    )


def counter(path: str) -> Callable[[str], int]:
    """A function from a text to its number of tokens, without added begin or end tokens.

    Byte-level files whose ids are in the order of their merges are counted by tiktoken over the same ranks, which
    gives the same tokens several times faster; special strings in the text count as one token each, as in the
    library. Other ``.json`` files go through ``tokenizers``, ``.model`` files through ``sentencepiece``.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec) if _byte_level(spec) else None
    if ranks is None:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return lambda text: len(tok.encode(text, add_special_tokens=False).ids)
    import public_tokenizers
    import tiktoken

    enc = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t["content"] for t in spec["added_tokens"]]

    def count(text: str) -> int:
        n, parts = 0, [text]
        for s in special:
            if s in text:
                parts = [x for p in parts for x in p.split(s)]
        n = len(parts) - 1
        return n + sum(len(enc.encode_ordinary(b)) for p in parts for b in inner_cuts(p))

    return count


def inner_cuts(text: str, size: int = LONG_TEXT):
    """The text in parts cut before a single blank between other characters, where a token always starts."""
    from echofield.llm.bpe import regex

    at, cut = 0, regex.compile(r"(?<=\S) (?=\S)")
    while len(text) - at > size:
        m = cut.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes of each token by id, if ids follow the merges."""
    back = {c: b for b, c in enumerate(byte_alphabet())}
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or len(vocab) != 256 + len(merges):
        return None
    return {bytes(back[c] for c in token): i for token, i in vocab.items()}


_counters: dict[str, Callable[[str], int]] = {}


def content_digest(text: Column) -> Column:
    """sha256 of the normalised content: null counts as empty; token counts depend on every byte, so nothing else is changed."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; an absent cache is an empty one."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(cache)


def encode_misses(misses: DataFrame, tokenizer: str, digest: str) -> DataFrame:
    """``_digest`` and ``_text`` -> rows of the cache."""

    def run(batches):
        if tokenizer not in _counters:
            _counters[tokenizer] = counter(tokenizer)
        count = _counters[tokenizer]
        for batch in slices(batches, "_text"):
            n = [count(t or "") for t in batch.column("_text").to_pylist()]
            kind = pa.array([digest] * len(n), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_digest"), kind, pa.array(n, pa.int64())], ["content", "tokenizer", "n_tokens"])

    return misses.select("_digest", "_text").mapInArrow(run, CACHE)


def token_counts(
    docs: DataFrame, tokenizer: str, cache: str | None = None, text: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes`` of the whole text in UTF-8 and ``n_tokens``.

    ``tokenizer`` is a file that the driver and every executor have, ``cache`` the folder of stored counts in shared
    storage (a new one in the shared folder of the session if none is given). A null text counts as empty and has 0
    bytes. Equal texts share one entry. Repeated rows and null ids keep their rows. An empty table gives an empty
    result; other columns are ignored whatever their names.
    """
    spark = docs.sparkSession
    cache = cache or shared_folder(spark, "token-cache")
    kind = tokenizer_digest(tokenizer)
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), body.alias("_text"), content_digest(F.col(text)).alias("_digest"))
    rows = staged(base.select("_id", "_digest", F.octet_length("_text").cast("bigint").alias("n_bytes")), "token-rows")
    groups = rows.groupBy("_digest").agg(F.min("_id").alias("_one"), F.count(F.lit(1)).alias("_n"))
    groups = staged(groups, "token-groups")

    stored = read_cache(spark, cache).filter(F.col("tokenizer") == kind).select(F.col("content").alias("_digest"))
    misses = staged(groups.join(stored, "_digest", "left_anti").select("_digest", "_one"), "token-misses")
    if not misses.isEmpty():
        same = base["_id"].eqNullSafe(misses["_one"]) & (base["_digest"] == misses["_digest"])
        wanted = base.join(misses, same, "left_semi")
        fresh = encode_misses(wanted, tokenizer, kind)
        fresh.write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).filter(F.col("tokenizer") == kind)
    counts = counts.groupBy(F.col("content").alias("_digest")).agg(F.max("n_tokens").alias("n_tokens"))
    sized = groups.select("_digest", "_n").join(counts, "_digest")
    return with_group(rows, sized, "_digest", "_n", rows.count()).select(F.col("_id").alias(id_col), "n_bytes", F.col("n_tokens"))
