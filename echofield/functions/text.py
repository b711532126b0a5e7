"""Text scalars as native column expressions: no Python runs per row."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from echofield import fixed
from echofield.functions.numbers import let

WHITESPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
DEVANAGARI = r"\x{0900}-\x{097F}"
SEARCH_TOKEN = r"[a-z0-9]+|[\x{0900}-\x{097F}]+"


def clean_text(c: Column) -> Column:
    """Lower-case; drop links, tags and symbols; shorten runs of 4+ equal characters to 2; tidy blanks."""
    c = F.lower(F.coalesce(c, F.lit("")))
    c = F.regexp_replace(c, rf"http[^{WHITESPACE}]+|www[^{WHITESPACE}]+", " ")
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    c = F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}_{WHITESPACE}{DEVANAGARI}.,!?'-]", " ")
    c = F.regexp_replace(c, r"([^\n])\1{3,}", "$1$1")
    return F.trim(F.regexp_replace(c, rf"[{WHITESPACE}]+", " "))


def words(c: Column) -> Column:
    """Blank-separated words; an empty text has none."""
    flat = F.trim(F.regexp_replace(c, rf"[{WHITESPACE}]+", " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def runs(c: Column, gap: str) -> Column:
    """What lies between the matches of ``gap``: taking matches of words from a text one by one costs several times as much."""
    return F.filter(F.split(c, gap), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def language_hits(c: Column) -> Column:
    """Array of function-word hits, one per listed language, from the whole text and without a shuffle."""
    spaced = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]+", "  ")
    padded = F.concat(F.lit(" "), spaced, F.lit(" "))
    patterns = [" (" + "|".join(ws) + ") " for ws in fixed.STOP_WORDS.values()]
    return let(padded, lambda p: F.array(*[F.regexp_count(p, F.lit(x)) for x in patterns]))


def mostly_devanagari(c: Column) -> Column:
    """More than half as many Devanagari signs as letters; null for a null text."""
    # what is left of the text is counted: a match for each run of other signs, not for each letter
    letters = F.length(F.regexp_replace(c, r"\P{L}+", ""))
    native = F.length(F.regexp_replace(c, r"[^\x{0900}-\x{097F}]+", ""))
    return (native > 0) & (native * 2 > letters)


def detect_language(c: Column) -> Column:
    """Language with most function-word hits (ties: list order); mostly Devanagari letters -> hi; else unknown."""

    def pick(hits: Column) -> Column:
        top = F.array_max(hits)
        out = F.when(top == 0, F.lit("unknown"))
        for i, lang in enumerate(fixed.STOP_WORDS):
            out = out.when(hits[i] == top, F.lit(lang))
        return out

    return F.when(F.coalesce(mostly_devanagari(c), F.lit(False)), "hi").otherwise(let(language_hits(c), pick))


def is_hinglish(c: Column, lang: Column, strict: bool = False, minimum: int = 2) -> Column:
    listed = [w for w in fixed.HINGLISH_WORDS if not (strict and w in fixed.HINGLISH_ENGLISH_OVERLAP)]
    tokens = F.array_distinct(words(F.lower(c)))
    known = F.array(*[F.lit(w) for w in listed])
    return F.coalesce((lang == "en") & (F.size(F.array_intersect(tokens, known)) >= minimum), F.lit(False))


def search_tokens(c: Column) -> Column:
    """Latin/digit runs and Devanagari runs of the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit(SEARCH_TOKEN), F.lit(0))


# Latin letters with marks and their base letters, for the translate() form of accent removal.
_MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def strip_accents(c: Column) -> Column:
    """Latin-1 accents removed by a codegen-friendly translate; the Devanagari nukta and virama go too."""
    return F.translate(c, _MARKED + "़्", _PLAIN)


@F.pandas_udf(StringType())
def strip_accents_full(s: pd.Series) -> pd.Series:
    """Full Unicode coverage: decompose, drop combining marks. Arrow batches."""
    import unicodedata

    def one(t):
        if t is None:
            return None
        return "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch))

    return s.map(one)


def term_tokens(c: Column, faithful: bool = False) -> Column:
    """Words of two or more characters for term weighting.

    ``faithful`` strips accents and then cuts at vowel signs, as a word-character tokenizer does; the
    default keeps combining marks inside the word.
    """
    low = F.lower(c)
    if faithful:
        return F.filter(F.split(strip_accents(low), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) > 1)
    return F.filter(F.split(low, r"[^\p{L}\p{M}\p{N}_]+"), lambda w: F.length(w) > 1)


def _joined_run(t: Column, n: int):
    """i -> words i..i+n-1 of ``t``; element access keeps the cost per n-gram constant."""
    return lambda i: F.concat_ws(" ", *[F.element_at(t, i + k) for k in range(n)])


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of the token array, low..high words long, joined by one blank."""

    def of(t: Column) -> Column:
        parts = []
        for n in range(low, high + 1):
            if n == 1:
                parts.append(t)
                continue
            starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(
                F.array().cast("array<int>")
            )
            parts.append(F.transform(starts, _joined_run(t, n)))
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    return let(tokens, of)


def counted(tokens: Column) -> Column:
    """Array of (term, tf) from a token array, counted inside the row by sorting: no shuffle is needed,
    because a document is one row."""

    def of(g: Column) -> Column:
        n = F.size(g)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 1) | (F.element_at(g, i) != F.element_at(g, F.greatest(i - 1, F.lit(1)))))

        def runs(s: Column) -> Column:
            after = lambda j: F.coalesce(F.get(s, j + 1), n + 1)
            return F.transform(
                s, lambda i, j: F.struct(F.element_at(g, i).alias("term"), (after(j) - i).cast("long").alias("tf"))
            )

        return let(starts, runs)

    return let(F.sort_array(tokens), of)


def exclamation_count(c: Column) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit("!"))


def upper_ratio(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    return F.regexp_count(c, F.lit(r"\p{Lu}")) / F.greatest(F.length(c), F.lit(1))


def any_word(c: Column, terms: list[str]) -> Column:
    """Whole-word, case-insensitive hit of any listed term."""
    return F.coalesce(c.rlike(r"(?i)\b(" + "|".join(terms) + r")\b"), F.lit(False))


def substring_hits(c: Column, terms: list[str]) -> Column:
    """How many of the listed terms occur in the lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda a, b: a + b, [F.contains(low, F.lit(t)).cast("int") for t in terms])


def short_id(c: Column) -> Column:
    """R0042: at least four digits, never truncated."""
    return F.format_string("R%04d", c)


def citations(c: Column) -> Column:
    """Cited ids in order of first mention."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"R\d{4,}"), F.lit(0)))


def is_refusal(c: Column) -> Column:
    return F.contains(F.lower(c), F.lit(fixed.REFUSAL_SENTENCE.lower().rstrip(".")))


def context_line(sid, platform, rating, date, severity, team, text) -> Column:
    show = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(
        F.lit("["), sid, F.lit("] (platform="), show(platform), F.lit(", rating="), show(rating),
        F.lit(", date="), show(date), F.lit(", severity="), show(severity), F.lit(", team="), show(team),
        F.lit(") "), F.trim(F.regexp_replace(text, rf"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")),
    )


def plain_dashes(c: Column) -> Column:
    """Spaced em/en dash -> colon, other em/en dash -> comma, non-breaking hyphen -> hyphen."""
    for dash in ("—", "–"):
        c = F.replace(F.replace(c, F.lit(f" {dash} "), F.lit(": ")), F.lit(dash), F.lit(", "))
    return F.replace(c, F.lit("‑"), F.lit("-"))


def cut(c: Column, n: int, ellipsis: str = "") -> Column:
    head = F.substring(F.coalesce(c, F.lit("")), 1, n)
    return F.concat(head, F.lit(ellipsis)) if ellipsis else head


def right_closed_band(c: Column, edges: list[float], labels: list[str]) -> Column:
    """(a, b] bins; values outside every bin give null."""
    out = None
    for lo, hi, name in zip(edges, edges[1:], labels):
        test = (c > lo) & (c <= hi)
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out
