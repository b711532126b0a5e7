"""BPE encoding and decoding of whole texts with a contiguous rank array per word.

A word is a short array of parts and an array of the ranks of adjacent pairs. The lowest rank is looked for by a scan,
its boundary is deleted, and the two neighbouring ranks are looked up again. Words longer than ``LONG_WORD`` parts,
where repeated scans are quadratic, take the merges of one rank at a time from a heap; the result is the same.

Tokens of a word depend on the word alone, so a task keeps the tokens of the white-space separated pieces that it has
met in two generations of ``MEMO_PIECES``: when the young one is full it becomes the old one, and a piece that is met
again moves to the young one. Texts are cut at white space into blocks, so memory follows the
block and not the text.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echofield.llm.common import slices

MEMO_PIECES = 130_000
MEMO_CHARS = 64
LONG_WORD = 200
BLOCK_CHARS = 1 << 20
#: Bytes of text whose ids and decoded text a task holds at once.
SLICE_BYTES = 2 << 20
NO_RANK = 1 << 60


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte in the vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Ranks, tokens and text rules of a tokenizer file with word ends (kind ``BPE`` with ``end_of_word_suffix``)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError(f"{path}: text rules that this reader does not know")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        alphabet = byte_alphabet()
        self.first = [vocab.get(c, -1) for c in alphabet]
        self.last = [vocab.get(c + self.end, -1) for c in alphabet]
        if -1 in self.first or -1 in self.last:
            raise ValueError(f"{path}: a byte without a token")
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault(vocab[a] << 32 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word."""
        first = self.first
        parts = [first[b] for b in word]
        parts[-1] = self.last[word[-1]]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << 32 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NO_RANK:
                break
            i = ranks.index(rank)
            parts[i] = merged[rank]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, get = len(parts), self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or get(parts[i] << 32 | parts[j]) != rank:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := get(parts[a] << 32 | parts[after[a]])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p >= 0]

    def piece(self, piece: str) -> bytes:
        """Ids of a piece without white space, as 32-bit integers."""
        out = self.old.get(piece)
        if out is None:
            out = array("i", [i for w in self.word.findall(piece) for i in self.merge(w.encode())]).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_PIECES:
                self.memo, self.old = {}, self.memo
            self.memo[piece] = out
        return out

    def plain(self, text: str) -> bytes:
        """Ids of a text in which no special token counts."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()
        pieces = text.split() if not SEPARATORS.search(text) else SPACE.split(text)
        encode = self.piece
        return b"".join([self.memo.get(p) or encode(p) for p in pieces if p])

    def encode(self, text: str) -> np.ndarray:
        out = []
        for block in blocks(text):
            at = 0
            for m in self.cut.finditer(block) if self.cut and "<" in block else ():
                out += [self.plain(block[at : m.start()]), np.array([self.special[m[0]]], np.int32).tobytes()]
                at = m.end()
            out.append(self.plain(block[at:]))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by one space: what the file says, as it names no decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist()])


#: Controls that Python's split() takes for white space and the pattern does not.
SEPARATORS = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")
BREAK = regex.compile(r"\p{White_Space}(?!\p{White_Space})")


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text cut before white space into blocks of about ``size`` characters."""
    at = 0
    while len(text) - at > size:
        m = BREAK.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def round_trip(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` array<int>, ``decoded`` string, and the columns named in ``keep``.

    ``path`` is a tokenizer file that every executor has. A null or empty text has no ids and decodes to the empty
    string. Whole texts are encoded, without added special tokens; special strings inside a text are special tokens, as
    in the library. Rows are independent: repeated rows, null ids and clashing names of other columns do not
    matter, and no row is shuffled.
    """
    names = ["_id", *[f"_keep{i}" for i in range(len(keep))]]
    d = docs.select(F.col(text).alias("_text"), F.col(id_col).alias("_id"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    schema = T.StructType([d.schema[n] for n in names] + [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches):
        v = vocabulary(path)
        for batch in slices(batches, "_text", SLICE_BYTES):
            ids = [v.encode(t) if t else np.empty(0, np.int32) for t in batch.column("_text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            decoded = pa.array([v.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], lists, decoded], [*names, "ids", "decoded"])

    out = d.mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), "ids", "decoded", *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)])


def encode(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    return round_trip(docs, path, text, id_col, keep).drop("decoded")


def decode(rows: DataFrame, path: str, ids: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``decoded`` of arrays of ids; a null array decodes to the empty string."""
    d = rows.select(F.col(id_col).alias("_id"), F.col(ids).alias("_ids"))

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(np.array(x or [], int)) for x in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], ["_id", "decoded"])

    return d.mapInArrow(run, T.StructType([d.schema["_id"], T.StructField("decoded", T.StringType())])).withColumnRenamed("_id", id_col)
