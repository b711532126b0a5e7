"""Small tables with awkward rows, and plain-Python versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size int, score string, _id int, _text string, spans int"


def text(seed: int, words: int = 40, lang: str = "en") -> str:
    r = random.Random(seed)
    parts = {"en": ["the", "of", "thing", "ing", "wh", "sh", "ed"], "fr": ["é", "eau", "oi", "que", "ç", "ment", "le"]}[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(words)).capitalize() + "."


def rows(long: int = 30_000) -> list[tuple]:
    """Copies, near copies, ties, repeated rows, nulls everywhere, empty and blank texts, one very long text."""
    out = [(i, text(i, 30 + i, "en" if i % 3 else "fr"), "en" if i % 3 else "fr", f"s{i % 3}") for i in range(24)]
    out += [(100, text(1, 31), "en", None), (101, " " + text(1, 31).replace(" ", "\n"), "en", "s0"), (102, text(2, 32) + " more", "en", "s1")]
    out += [(3, text(3, 33, "fr"), "fr", "s0"), (3, text(3, 33, "fr"), "fr", "s0")]
    out += [(200, None, None, None), (201, "", "en", "s2"), (202, " \n\t", None, "s2"), (203, "12 34 !?", "en", "s1"), (204, "A", "en", "s1")]
    out += [(None, text(9, 39), None, "s2"), (None, None, None, None), (300, text(77, long), "en", "s0"), (301, text(5, 35) + text(77, 90), None, "s0")]
    out += [(302, "<|endoftext|> café ΣΑΣ x y<|startoftext|>\x1cz", "fr", "s1"), (303, "ab " * 300, "en", "s1"), (304, "x" * 5000, None, "s2")]
    return [(*r, len(r[1] or ""), "clash", 7, "clash", 1, "clash", 2) for r in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def lowered(t: str | None) -> list[bytes]:
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))


def shingle_set(t: str | None, k: int = 5) -> frozenset:
    w = lowered(t)
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if w else [])


def near_components(data: list[tuple], threshold: int = 85) -> list[tuple[int, object]]:
    """Set size and component id of each row, by comparing all pairs."""
    sets = [shingle_set(r[1]) for r in data]
    top = list(range(len(data)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= threshold * len(sets[i] | sets[j]):
                top[root(i)] = root(j)
    low: dict[int, list] = {}
    for i, r in enumerate(data):
        low.setdefault(root(i), []).append(r[0])
    first = lambda ids: min((x for x in ids if x is not None), default=None)
    return [(len(sets[i]), first(low[root(i)])) for i in range(len(data))]


def covered(texts: list[str | None], length: int) -> list[tuple[list[tuple[int, int]], bytes]]:
    """Covered spans and the remaining bytes of each text."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        spans: list[list[int]] = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        edges = [0, *[e for s in spans for e in s], len(b)]
        out.append(([tuple(s) for s in spans], b"".join(b[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))))
    return out
