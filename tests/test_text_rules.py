"""Expected values for the scalar rules; one Spark job per test."""

from pyspark.sql import functions as F

from echofield import fixed
from echofield.functions import labels as lb
from echofield.functions import numbers as nm
from echofield.functions import text as tx


def values(spark, rows, schema, **columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_clean_text(spark):
    rows = [("Veryyyyyy BAD!!!!! http://x.y/z <b>अच्छा</b> café 😞 'ok-no'",), (None,), ("  \n ",), ("नहीं मिला",)]
    got = values(spark, rows, "t string", c=tx.clean_text(F.col("t")), n=tx.word_count(tx.clean_text(F.col("t"))))
    assert got == [("veryy bad!! अच्छा café 'ok-no'", 5), ("", 0), ("", 0), ("नहीं मिला", 2)]


def test_search_tokens(spark):
    rows = [("Refund NOT received!! 20 days",), ("पैसा वापस नहीं",), ("😞🙏",)]
    got = values(spark, rows, "t string", c=tx.search_tokens(F.col("t")))
    assert got == [(["refund", "not", "received", "20", "days"],), (["पैसा", "वापस", "नहीं"],), ([],)]


def test_term_tokens_and_ngrams(spark):
    rows = [("नहीं अच्छा बहुत",)]
    got = values(
        spark, rows, "t string", faithful=tx.term_tokens(F.col("t"), faithful=True), kept=tx.term_tokens(F.col("t")),
        grams=tx.ngrams(tx.term_tokens(F.col("t"))), one=tx.ngrams(F.array(F.lit("a"))), none=tx.ngrams(F.array().cast("array<string>")),
    )
    assert got[0][0] == ["नह", "अचछ", "बह"]
    assert got[0][1] == ["नहीं", "अच्छा", "बहुत"]
    assert got[0][2] == ["नहीं", "अच्छा", "बहुत", "नहीं अच्छा", "अच्छा बहुत"]
    assert got[0][3] == ["a"] and got[0][4] == []


def test_language_and_hinglish(spark):
    rows = [("the refund of money is not in the bank",), ("बहुत खराब सेवा",), ("zzz qqq",), (None,), ("der Hund und die Katze",)]
    got = [r[0] for r in values(spark, rows, "t string", c=tx.detect_language(F.col("t")))]
    assert got == ["en", "hi", "unknown", "unknown", "de"]
    rows = [("refund nahi mila", "en"), ("nahi", "en"), ("nahi mila", "hi"), ("the to", "en")]
    h = values(spark, rows, "t string, l string", a=tx.is_hinglish(F.col("t"), F.col("l")), b=tx.is_hinglish(F.col("t"), F.col("l"), strict=True))
    assert h == [(True, True), (False, False), (False, False), (True, False)]


def test_star_buckets_and_labels(spark):
    rows = [(None,), (1.0,), (2.0,), (2.5,), (3.0,), (4.0,)]
    got = [r[0] for r in values(spark, rows, "s double", c=lb.star_bucket(F.col("s")))]
    assert got == ["unknown", "complaint", "complaint", "positive", "mixed", "positive"]
    rows = [("this is a SCAM", 5.0), ("late", 2.0), ("late", 3.0), ("late", None), ("double amount charged", 4.0)]
    got = values(spark, rows, "t string, s double", w=lb.weak_label(F.col("t"), F.col("s")), g=lb.gold_label(F.col("t"), F.col("s")))
    assert got == [(2, 2), (1, 1), (0, 0), (0, 0), (0, 2)]


def test_drivers(spark):
    rows = [("refund!", 1.0, 0, 1), ("fine", 5.0, 0, 1)]
    d = lb.severity_drivers(F.col("t"), F.col("s"), F.col("u"), F.col("n"))
    got = values(spark, rows, "t string, s double, u int, n int", d=d)
    names = fixed.DRIVER_NAMES
    assert [tuple(x) for x in got[0][0]] == [(names["money"], 0.27), (names["stars"], 0.18), (names["exclaim"], 0.05)]
    assert [tuple(x) for x in got[1][0]] == [(names["none"], 0.03)]


def test_bands_quality_ids_and_rounding(spark):
    got = [r[0] for r in values(spark, [(0.7,), (0.69,), (0.4,), (0.39,)], "s double", c=lb.churn_band(F.col("s")))]
    assert got == ["High", "Medium", "Medium", "Low"]
    rows = [("Refund not received, please help",)]
    reply = lb.reply(fixed.REPLY_TEMPLATES["template_v1"], F.lit("General"))
    assert abs(values(spark, rows, "t string", q=lb.reply_quality(F.col("t"), reply))[0][0] - 0.64) < 1e-9
    assert [r[0] for r in values(spark, [(0,), (42,), (123456,)], "i long", c=tx.short_id(F.col("i")))] == ["R0000", "R0042", "R123456"]
    assert [r[0] for r in values(spark, [(0.5,), (1.5,), (2.5,)], "x double", c=nm.round_even(F.col("x"), 0))] == [0.0, 2.0, 2.0]


def test_citations_refusals_dashes(spark):
    rows = [("Refunds are slow [R0002][R0001]. Support ignores users [R0002].",), ("Claim [R12345].",)]
    assert values(spark, rows, "t string", c=tx.citations(F.col("t"))) == [(["R0002", "R0001"],), (["R12345"],)]
    rows = [("NOT enough evidence in the retrieved reviews to answer this, sorry",), ("ok",)]
    assert values(spark, rows, "t string", c=tx.is_refusal(F.col("t"))) == [(True,), (False,)]
    assert values(spark, [("a — b–c‑d",)], "t string", c=tx.plain_dashes(F.col("t"))) == [("a: b, c-d",)]


def test_words_between_gaps_are_the_matches_of_their_patterns(spark):
    import random

    from echofield.llm import contamination

    letters = ["a", "Z", "7", "_", "é", "É", "İ", "ß", "क", "ि", "१", "́", "中", "😀", "٣", " ", "\n", ".", "-", "\x00", "\x7f", " ", "‍"]
    rng = random.Random(5)
    texts = ["", " ", "a", "..", None, "abकa", "क", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(300))]
    c, low = F.col("t"), F.lower("t")
    matches = lambda of, pattern: F.regexp_extract_all(of, F.lit(pattern), F.lit(0))
    upper = F.translate(F.coalesce(c, F.lit("")), contamination.UPPER, contamination.LOWER)
    both = [
        (tx.term_tokens(c), matches(low, r"[\p{L}\p{M}\p{N}_]{2,}")),
        (tx.term_tokens(c, faithful=True), matches(tx.strip_accents(low), r"[\p{L}\p{N}_]{2,}")),
        (contamination.words(c), matches(upper, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")),
    ]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for got, want in both:
        assert "regexp_extract_all" not in str(got)
        assert d.filter(~got.eqNullSafe(want)).count() == 0
